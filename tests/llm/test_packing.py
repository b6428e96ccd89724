import random
import zlib

import numpy as np
import pytest

import corpus
from storeledger.llm import packing
from storeledger.llm.queries import tokenizer_file


def naive_first_fit(lengths, capacity):
    room, bins, offsets = [], [], []
    for size in lengths:
        at = next((i for i, r in enumerate(room) if r >= size), len(room))
        if at == len(room):
            room.append(capacity)
        bins.append(at)
        offsets.append(capacity - room[at])
        room[at] -= size
    return bins, offsets


@pytest.mark.parametrize("seed", range(5))
def test_tree_finds_the_first_bin_with_room(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(0, 64) for _ in range(rng.choice([0, 1, 2, 77, 256]))]
    bins, offsets = packing.first_fit(np.array(lengths, np.int64), 64)
    assert (bins.tolist(), offsets.tolist()) == tuple(map(list, naive_first_fit(lengths, 64)))


def test_too_long_a_piece_is_refused():
    with pytest.raises(ValueError, match="between"):
        packing.first_fit(np.array([65]), 64)


def check_whole(pieces, expected, sequence):
    """Each id in exactly one piece, sequences without gaps and within their length."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for (doc_id, tokens), found in by_doc.items():
        texts = expected[doc_id]
        assert sum(p.length for p in found) == tokens * len([t for t in texts if len(t) == tokens])
        for p in found:
            assert any(len(t) == tokens and zlib.crc32(np.array(t[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for t in texts)
            assert list(p.ids) in [t[p.start : p.start + p.length] for t in texts]
    for held in by_sequence.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= sequence


def test_pieces_hold_every_id_once(spark):
    from tokenizers import Tokenizer

    rng = random.Random(4)
    texts = [corpus.prose(rng, rng.choice([1, 20, 200])) for _ in range(60)] + [None, "", " ", "ö" * 3000, "twin text", "twin text", "<|endoftext|>"]
    ids = [*range(64), 64, 64, None]
    model = Tokenizer.from_file(tokenizer_file())
    model.encode_special_tokens = True
    expected = {}
    for i, t in zip(ids, texts):
        expected.setdefault(i, []).append([*model.encode(t or "", add_special_tokens=False).ids, 1])
    pieces = packing.token_pieces(corpus.frame(spark, texts, ids), tokenizer_file(), sequence=256)
    got = packing.pack(pieces, sequence=256, group_pieces=50).collect()
    check_whole(got, expected, 256)
    assert sum(p.length for p in got) == sum(len(t) for held in expected.values() for t in held)
    padded = len({p.sequence_id for p in got}) * 256 / sum(p.length for p in got)
    assert padded < 1.1


def test_pack_keeps_columns_and_takes_empty_tables(spark):
    rows = spark.createDataFrame([(1, 10, "x"), (2, 60, "y"), (2, 60, "y"), (3, None, "z")], "_group int, length long, offset string")
    got = packing.pack(rows, sequence=64)
    assert got.columns == ["_group", "length", "sequence_id", "offset"]
    assert len({r.sequence_id for r in got.collect() if r.length == 60}) == 2
    assert packing.pack(rows.limit(0), sequence=64).collect() == []


def test_cut_texts_have_the_ids_of_whole_texts():
    import pyarrow as pa

    from storeledger.llm.tokens import Encoder

    rng = random.Random(10)
    letters = [*"abcé ÷×'s\n  ,.!12\t\r  x-ß中’_　\x85", "'s", "'re", "  ", "wo", "the ", "<|endoftext|>", "\n\n", "😀"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 16))) for _ in range(6000)]
    texts += [corpus.prose(rng, 200) for _ in range(20)] + [None, "", "\n", " "]
    encoder = Encoder(tokenizer_file(), known=500)
    for low in range(0, len(texts), 1000):
        part = texts[low : low + 1000]
        ids, at = encoder.encode(pa.array(part, pa.string()))
        whole = encoder.model.encode_batch([t or "" for t in part], add_special_tokens=False)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [w.ids for w in whole]

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus
from storeledger.llm import language

# Syllables of made-up languages.
SOUNDS = {
    "aa": ["ka", "lo", "mi", "tu", "ne", "ri"],
    "bb": ["schr", "ung", "bei", "ver", "gen", "ich"],
    "cc": ["eau", "oux", "tion", "lle", "ère", "que"],
}


def text(rng, lang, words):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(8)
    langs = [rng.choice(list(SOUNDS)) for _ in range(300)]
    texts = [text(rng, lang, rng.randint(5, 200)) for lang in langs]
    return texts, langs, corpus.frame(spark, texts, langs=langs)


def test_held_out_accuracy(case):
    _, langs, docs = case
    model = language.train(docs.where("doc_id % 3 <> 1"))
    rows = language.identify(docs.drop("lang"), model).where("doc_id % 3 = 1").collect()
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_texts_have_a_result(spark, case):
    model = language.train(case[2])
    rng = random.Random(9)
    odd = [None, "", "123 !!", "٣٤", "q", text(rng, "bb", 60_000), text(rng, "aa", 40) + " " + text(rng, "cc", 40)]
    rows = language.identify(corpus.frame(spark, odd).withColumn("score", F.lit(1)), model).collect()
    got = {r.doc_id: (r.lang_pred, r.rejected) for r in rows}
    assert [got[i][0] for i in range(4)] == ["und"] * 4 and all(got[i][1] for i in range(4))
    assert got[4][0] in SOUNDS and got[4][1]
    assert got[5] == ("bb", False)
    assert language.identify(case[2].limit(0), model).collect() == []


def test_too_many_languages_are_refused(case):
    with pytest.raises(ValueError, match="languages"):
        language.train(case[2], max_languages=1)


def test_verdict_is_the_smallest_code(case):
    """Against sizes taken one by one, without pieces, for texts shorter than a piece."""
    import zstandard

    model = language.train(case[2])
    coders = language.Coders(model)
    for given in case[0][:40]:
        data = language.letters(given)
        if len(data) > language.CHUNK_BYTES:
            continue
        sizes = {}
        for name, held in model.contents.items():
            own = zstandard.ZstdCompressionDict(held, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=language.LEVEL)
            coder = zstandard.ZstdCompressor(dict_data=own, write_checksum=False, write_content_size=False, write_dict_id=False)
            packed = coder.compress(data)
            sizes[name] = len(packed)
            assert zstandard.ZstdDecompressor(dict_data=own).decompress(packed, max_output_size=len(data)) == data
        assert sizes[coders.verdict(given).language] == min(sizes.values())


def test_few_long_texts_and_copies_reach_the_size(spark):
    """A language of three long texts, one of many copies of few texts, one of few letters among digits, one of one short text."""
    rng = random.Random(10)
    size = 4 << 10
    texts = [(text(rng, "aa", 40_000), "aa") for _ in range(3)]
    own = [text(rng, "bb", 150) for _ in range(40)]
    texts += [(t, "bb") for t in own] + [(own[0], "bb")] * 4000
    texts += [(text(rng, "cc", 1) + " 7" * 1000, "cc") for _ in range(400)] + [("qu", "dd"), ("", "ee"), ("12", "ff")]
    docs = corpus.frame(spark, [t for t, _ in texts], langs=[lang for _, lang in texts])
    model = language.train(docs, size)
    assert set(model.contents) == {"aa", "bb", "cc", "dd"}
    whole = {lang: sum(len(language.letters(t)) for t, other in set(texts) if other == lang) for lang in model.contents}
    for lang in ("aa", "bb", "cc"):
        assert min(size, whole[lang]) <= len(model.contents[lang]) <= size + 4 * language.PIECE
    assert sum(" ".join(t.split()[5:25]).encode() in model.contents["bb"] for t in own) > 1
    rows = language.identify(docs.where("doc_id < 3 or lang = 'bb'").limit(200), model).collect()
    assert all(r.lang_pred == r.lang for r in rows)


def test_texts_without_letters_teach_nothing(spark):
    docs = corpus.frame(spark, ["12 34", "!!"], langs=["aa", "bb"])
    assert language.train(docs).contents == {}


def test_letters_are_letters_and_nothing_learnt_is_und(spark):
    model = language.Model({"a": b"some letters here", "b": b"other words there"})
    coders = model.coders()
    for text in ("½", "① ②", "²", "Ⅷ", "12 %", "", None):
        assert coders.verdict(text).language == "und"
    for text in ("é", "ß", "字", "1a"):
        assert coders.verdict(text).language in ("a", "b")
    empty = corpus.frame(spark, [])
    nothing = language.train(empty)
    assert nothing.contents == {} and language.identify(empty, nothing).collect() == []
    assert [r.lang_pred for r in language.identify(corpus.frame(spark, ["text", None]), nothing).collect()] == ["und", "und"]

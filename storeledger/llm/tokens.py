"""Token ids of whole text columns, with each distinct stretch of text encoded once.

The byte-level tokenizer splits a text before it merges bytes, and never merges across a split. It splits before a space
that stands between two other characters, on either side of a line feed that does, and where letters, digits and marks
meet. So a text can be cut at these places, and the ids of the cuts joined are the ids of the text. Natural text repeats
its cuts, so few have to be encoded. Texts with other blanks, or several in a row, are encoded whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from storeledger.llm.text import mixed, run_hashes, utf8

KNOWN = 1_000_000  # distinct cuts a task remembers

_SPACE, _FEED = 32, 10
_ODD_BLANK = np.zeros(256, bool)
_ODD_BLANK[[9, 11, 12, 13, *range(28, 32)]] = True
# Blanks of two and three bytes, by first byte and ranges of the others; a few marks are in them too.
_WIDE_BLANKS = (
    (0xC2, (0x85, 0x85)),
    (0xC2, (0xA0, 0xA0)),
    (0xE1, (0x9A, 0x9A), (0x80, 0x80)),
    (0xE2, (0x80, 0x80), (0x80, 0x8A)),
    (0xE2, (0x80, 0x80), (0xA8, 0xAF)),
    (0xE2, (0x81, 0x81), (0x9F, 0x9F)),
    (0xE3, (0x80, 0x80), (0x80, 0x80)),
)
# What a byte belongs to: 1 letter, 2 digit, 3 mark, 0 other. Two-byte letters from U+00C0 on begin with byte 195.
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = 3
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = 1
_KIND[39] = 0  # an apostrophe may join the letters after it


class Encoder:
    """Ids of texts by a tokenizer file; one object for each task, which grows to KNOWN cuts and then starts anew."""

    def __init__(self, path: str, known: int = KNOWN) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread for one core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True  # their strings in a text are ordinary text
        self.feed = self.model.encode("\n", add_special_tokens=False).ids
        self.known = known
        self._forget()

    def _forget(self) -> None:
        self.keys, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, "<u4")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and where those of each text begin and the last ends. Null texts are empty."""
        data, offsets = utf8(texts)
        whole = _whole(data, offsets)
        if len(self.feed) != 1:
            whole[:] = True
        kept = np.repeat(~whole, np.diff(offsets))
        cut_ids, cut_counts = self._by_cuts(data[kept], np.diff(offsets)[~whole])
        if not whole.any():
            return cut_ids, np.concatenate([[0], np.cumsum(cut_counts)])
        rows = np.flatnonzero(whole)
        found = self.model.encode_batch_fast([texts[i].as_py() or "" for i in rows.tolist()], add_special_tokens=False)
        ids = dict(zip(rows.tolist(), (np.array(f.ids, "<u4") for f in found)))
        ends = np.cumsum(cut_counts)
        ids |= {r: cut_ids[e - n : e] for r, e, n in zip(np.flatnonzero(~whole).tolist(), ends, cut_counts)}
        ordered = [ids[i] for i in range(len(texts))]
        return np.concatenate(ordered), np.concatenate([[0], np.cumsum([len(x) for x in ordered])])

    def _by_cuts(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        start = _cuts(data, offsets[:-1][lengths > 0])
        if not len(start):
            return np.zeros(0, "<u4"), np.zeros(len(lengths), np.int64)
        end = np.append(start[1:], len(data))
        keys = mixed(run_hashes(data, start, end) ^ (end - start).astype(np.uint64))
        distinct, sample, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) > self.known:
            self._forget()
        place = np.searchsorted(self.keys, distinct)
        seen = np.zeros(len(distinct), bool)
        inside = place < len(self.keys)
        seen[inside] = self.keys[place[inside]] == distinct[inside]
        if not seen.all():
            self._learn(data, start[sample[~seen]], end[sample[~seen]], distinct[~seen])
            place = np.searchsorted(self.keys, distinct)
        first, count = self.first[place][which], self.count[place][which]
        ends = np.cumsum(count)
        ids = self.pool[np.repeat(first - (ends - count), count) + np.arange(ends[-1])]
        total = np.concatenate([[0], ends])[np.searchsorted(start, offsets)]
        return ids, np.diff(total)

    def _learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray) -> None:
        """Encode cuts that are new, many at once: with line feeds between them, whose id tells them apart."""
        raw = data.tobytes()
        cuts = [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]
        feeds = np.array([c == b"\n" for c in cuts], bool)
        # Two feeds in a row would be one id, so another letter stands in for a feed.
        cuts = [b"a" if feed else c for c, feed in zip(cuts, feeds)]
        lines = [b"\n".join([*cuts[i : i + 256], b""]).decode("utf-8", "replace") for i in range(0, len(cuts), 256)]
        ids = np.concatenate([np.array(f.ids, "<u4") for f in self.model.encode_batch_fast(lines, add_special_tokens=False)])
        stops = np.flatnonzero(ids == self.feed[0])
        begins = np.concatenate([[0], stops[:-1] + 1])
        begins = np.where(feeds, stops, begins)
        count = np.where(feeds, 1, stops - begins)
        first = np.concatenate([self.first, begins + len(self.pool)])
        self.pool = np.concatenate([self.pool, ids])
        keys, count = np.concatenate([self.keys, keys]), np.concatenate([self.count, count])
        order = np.argsort(keys, kind="stable")
        self.keys, self.first, self.count = keys[order], first[order], count[order]


def _whole(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts that are not cut: those with blanks but space and line feed, with two blanks together or a blank at an end."""
    blank = (data == _SPACE) | (data == _FEED)
    bad = _ODD_BLANK[data]
    bad[1:] |= blank[1:] & blank[:-1]
    for lead, *rest in _WIDE_BLANKS:
        at = np.flatnonzero(data[: len(data) - len(rest)] == lead)
        for step, (low, high) in enumerate(rest, 1):
            at = at[(data[at + step] >= low) & (data[at + step] <= high)]
        bad[at] = True
    begins, ends = offsets[:-1], offsets[1:]
    some = ends > begins
    bad[begins[some]] |= blank[begins[some]]
    bad[ends[some] - 1] |= blank[ends[some] - 1]
    out = np.zeros(len(begins), bool)
    out[np.searchsorted(offsets, np.flatnonzero(bad), "right") - 1] = True
    return out


def _cuts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where cuts begin: at a text's beginning, at spaces, at and after line feeds, and where the kind of byte changes.

    Kinds count only in stretches between blanks that hold nothing but ASCII and two-byte Latin letters.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    feed = data == _FEED
    edge = (data == _SPACE) | feed
    edge[1:] |= feed[:-1]
    edge[begins] = True
    kind = _KIND[data]
    lead = np.flatnonzero(data[:-1] == 195)
    letter = lead[(data[lead + 1] >= 128) & (data[lead + 1] != 151) & (data[lead + 1] != 183)]
    kind[letter] = kind[letter + 1] = 1
    blank = (data == _SPACE) | feed
    stretch = np.flatnonzero(edge)
    plain = np.logical_and.reduceat((kind > 0) | blank, stretch)
    inner = np.zeros(len(data), bool)
    inner[1:] = (kind[1:] != kind[:-1]) & ~blank[:-1]
    inner &= np.repeat(plain, np.diff(np.append(stretch, len(data))))
    return np.flatnonzero(edge | inner)

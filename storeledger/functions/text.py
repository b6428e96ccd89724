"""Text that arrives in several Unicode spellings."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def spellings(values: Iterable[str]) -> list[str]:
    """The values in composed and decomposed form, without repeats."""
    return list(dict.fromkeys(unicodedata.normalize(form, value) for value in values for form in ("NFC", "NFD")))


def canonical(column: Column, domain: Sequence[str]) -> Column:
    """The domain value that `column` spells, whatever its normalisation form; NULL when it spells none.

    Composed and decomposed accents differ byte by byte but are equal under the ICU root collation, which still
    tells accented and plain letters apart.
    """
    spelled = F.collate(column, "UNICODE")
    branches = [F.when(spelled == F.lit(value), F.lit(value)) for value in domain]
    return F.coalesce(*branches)


# The characters that code page 1252 has at 0x80 to 0x9F, and those bytes; five bytes stand for nothing.
_CP1252 = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…", 0x86: "†", 0x87: "‡", 0x88: "ˆ", 0x89: "‰", 0x8A: "Š", 0x8B: "‹",
    0x8C: "Œ", 0x8E: "Ž", 0x91: "‘", 0x92: "’", 0x93: "“", 0x94: "”", 0x95: "•", 0x96: "–", 0x97: "—", 0x98: "˜", 0x99: "™",
    0x9A: "š", 0x9B: "›", 0x9C: "œ", 0x9E: "ž", 0x9F: "Ÿ",
}


def redecoded(column: Column) -> Column:
    """The text that `column` is if its UTF-8 bytes were once read as Latin-1 or code page 1252; NULL if they cannot have been.

    The characters are turned back into the bytes they were read from, and these are decoded strictly. Sound text with an
    accent fails that, since an accented letter alone is no UTF-8; plain ASCII needs no repair.
    """
    single = F.translate(column, "".join(_CP1252.values()), "".join(map(chr, _CP1252)))
    foreign = single.rlike("[^\\x00-\\x7F]") & ~single.rlike("[^\\x00-\\xFF]")
    read = F.when(foreign, F.encode(single, "ISO-8859-1")).cast("string")
    return F.when(F.is_valid_utf8(read), read)


def repaired(column: Column, times: int = 2) -> Column:
    """`column` with text that was wrongly decoded, up to `times` times over, put right; all other text as it is."""
    for _ in range(times):
        column = F.coalesce(redecoded(column), column)
    return column


def is_blank(column: Column) -> Column:
    """NULL, empty or spaces only."""
    return F.nullif(F.trim(column), F.lit("")).isNull()

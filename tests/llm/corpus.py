"""Small made-up corpora and plain re-statements of what the operators compute."""

import random
import re
from collections import defaultdict

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = ["ka", "lo", "mi", "ter", "un", "ves", "ra", "pel", "ost", "in", "qua", "dor", "fe", "zim", "bru", "gan"]


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def prose(rng, words):
    out = [word(rng) for _ in range(words)]
    for at in range(9, words, 10):
        out[at] += ".\n" if at % 30 == 29 else "."
    return " ".join(out).replace("\n ", "\n")


def edited(rng, text, changes):
    parts = text.split(" ")
    for _ in range(changes):
        parts[rng.randrange(len(parts))] = word(rng)
    return " ".join(parts)


def frame(spark, texts, ids=None, sources=None, langs=None, parts=3):
    count = len(texts)
    ids = list(range(count)) if ids is None else ids
    rows = [
        (ids[i], texts[i], langs[i] if langs else "en", sources[i] if sources else f"s{i % 3}", len(texts[i] or ""))
        for i in range(count)
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(parts) if rows else spark.createDataFrame([], DOC_SCHEMA)


def stored(spark, df, folder):
    path = str(folder / "documents.parquet")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def shingle_set(text, size=5):
    found = words(text)
    if 0 < len(found) < size:
        return {tuple(found)}
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def groups(count, pairs):
    parent = list(range(count))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in pairs:
        parent[find(a)] = find(b)
    out = defaultdict(set)
    for i in range(count):
        out[find(i)].add(i)
    return {frozenset(g) for g in out.values()}

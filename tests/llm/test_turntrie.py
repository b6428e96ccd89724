"""Conversation trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from storeledger.llm import turntrie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            mark = hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), mark, (role or "", text or "")))
    for conv in own:
        own[conv] = [t for _, _, t in sorted(own[conv], key=lambda x: x[:2])]
    out = {}
    for conv, turns in own.items():
        base = conv - int(conv / 5) * 5 if conv < 0 else conv % 5
        h = zlib.crc32(str(conv).encode()) % 9
        out[conv] = tuple(turns) if base == 0 else tuple(own.get(conv - base, [])[:h] + turns[h:])
    return out


def nodes(conversations):
    members = defaultdict(list)
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[c] for c in below) or 1
        size = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * size + sum(saved[c] for c in below)
        ends = ",".join(map(str, sorted(c for c in members[node] if conversations[c] == node)))
        out.append(
            (
                min(members[node]),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(members[node]),
                len(below),
                leaves[node],
                saved[node],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return out


def rows():
    rng = random.Random(3)
    found = []
    for conv in [*range(60), -1, -5, -7, 103, 10**15]:
        length = rng.choice([0, 1, 2, 3, 5, 9, 12])
        same = rng.random() < 0.5
        for turn in range(length):
            text = "common" if same and turn < 4 else rng.choice(["yes", "no", "", "é" * 3, None])
            found.append((conv, turn, rng.choice(["user", None]) if turn > 2 else "user", text))
    found += [(200 + 5 * i, t, "system", f"t{t}") for i in range(40) for t in range(6)]  # copies
    found += [(1000, t, "user", f"long {t % 3}") for t in range(700)]  # one long conversation
    found += [(1005, t, "user", f"long {t % 3}") for t in range(650)] + [(1010, t, "user", "long 0") for t in range(30)]
    found += [(None, 0, "user", "nobody's"), (300, None, "user", "z"), (300, 0, "user", "a"), (300, 1, "a", "x"), (300, 1, "a", "x")]
    found += [(311, 0, "ab", "c"), (316, 0, "a", "bc"), (321, 0, None, None)]
    rng.shuffle(found)
    return found


@pytest.mark.parametrize("container_turns", [2, 40, turntrie.CONTAINER_TURNS])
def test_against_brute_force(spark, container_turns):
    given = rows()
    frame = spark.createDataFrame(given, SCHEMA).withColumns({c: F.lit(1) for c in ("depth", "ids", "full", "part", "place")})
    turns = frame.select("conv_id", "turn", "role", "text")
    ids = turns.where("conv_id is not null").select("conv_id").distinct()
    found = turntrie.prefix_trie(ids, turntrie.rebuilt_turns(turns), container_turns, shard_turns=100)
    want = nodes(rebuilt(given))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_containers_of_a_common_beginning_burst(spark):
    """A third of the conversations begin alike for 20 turns: no task sweeps more than a container of them."""
    given = [(c, t, "user", f"same {t}" if c % 3 == 0 and t < 20 else f"{c} {t}") for c in range(300) for t in range(24)]
    ids = spark.createDataFrame([(c,) for c in range(300)], "conv_id long")
    turns = turntrie.rebuilt_turns(spark.createDataFrame(given, SCHEMA), group=1)
    distinct = turntrie.sequences(ids, turns).withColumn("n", F.lit(1).cast("long"))
    heads, contained = turntrie._burst(distinct, 64)
    assert heads.where("depth > 0").agg(F.min("depth"), F.max("depth"), F.count("*")).first() == (1, 20, 20)
    sizes = contained.groupBy("container").agg(F.count("*").alias("n"), F.sum(F.size("bytes") - 1).alias("turns"))
    assert contained.count() == 300 and sizes.where("n > 1 and turns > 64").count() == 0


def test_ids_of_one_sequence_pass_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(turntrie, "ID_BYTES", 20)
    every = spark.range(0, 5000, 1, 7).select(F.col("id").alias("conv_id"), F.when(F.col("id") % 9 > 0, F.lit(b"x")).otherwise(F.lit(b"y")).alias("full"))
    found = {bytes(r.full): r.ends_sha256 for r in turntrie._digests(every).collect()}
    for name, keep in ((b"x", lambda i: i % 9 > 0), (b"y", lambda i: i % 9 == 0)):
        assert found[name] == hashlib.sha256(",".join(str(i) for i in range(5000) if keep(i)).encode()).hexdigest()


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    found = turntrie.conversation_trie(empty)
    assert found.collect() == [] and found.columns[-1] == "ends_sha256"
    found = turntrie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA))
    assert found.collect() == []

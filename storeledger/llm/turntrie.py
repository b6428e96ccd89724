"""Prefix trie of conversations by burst tries: suffix containers under trie heads, sorted and swept into nodes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.store import staged

CONTAINER_TURNS = 512  # turns of distinct suffixes a container holds before it bursts
STEP = 8  # turns by which a container bursts in the first round; each later round doubles it
SHARD_TURNS = 1 << 20  # turns swept by one task
ID_BYTES = 1 << 16  # of joined ids in one row, on their way to a digest
_EMPTY = hashlib.sha256(b"").hexdigest()

NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
_SWEPT = f"{NODES}, full binary, parent binary, top binary"
_SEQUENCES = "conv_id long, ids array<binary>, bytes array<long>, prefixes array<binary>, full binary"


def rebuilt_turns(turns: DataFrame, group: int = 5, shared: int = 9) -> DataFrame:
    """conv_id, part, place, id, bytes: the turns of every conversation c, rebuilt as a fork of conversation c - c % `group`.

    Its first turns are the first h of that conversation, h being the unsigned CRC-32 of c in decimal, modulo `shared`; its own
    turns after its first h follow. In order of part and place. `id` is a fingerprint of role and text, `bytes` the text's
    UTF-8 size. The original turns stand in order of turn, null first, and equal ones in order of their fingerprints. Only the
    first turns of a conversation meet its forks, so a long one does not multiply.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    mark = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    given = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", mark.alias("id"), F.octet_length(text).cast("long").alias("bytes")
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "id")
    placed = staged(given.withColumn("place", F.row_number().over(order)).drop("turn"))
    forks = _forks(placed, group, shared)
    own = placed.join(forks, "conv_id").where("place > h or conv_id = base").select("conv_id", F.lit(1).alias("part"), "place", "id", "bytes")
    heads = placed.where(F.col("place") < shared).withColumnRenamed("conv_id", "base")
    begun = heads.join(forks.where("conv_id <> base"), "base").where("place <= h")
    return own.union(begun.select("conv_id", F.lit(0).alias("part"), "place", "id", "bytes"))


def _forks(turns: DataFrame, group: int, shared: int) -> DataFrame:
    ids = turns.select("conv_id").distinct()
    h = F.crc32(F.col("conv_id").cast("string")) % shared
    return ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), h.alias("h"))


def sequences(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """conv_id, ids, bytes, prefixes, full for each of `conversations` (conv_id), from `turns` as `rebuilt_turns` gives them.

    prefixes[d] names the sequence of the first d turns, full the whole. Ids travel, texts do not; one conversation's ids come
    together in a row.
    """
    item = F.struct("part", "place", "id", "bytes")
    held = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(item)).alias("turns"))
    found = conversations.join(held, "conv_id", "left").select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.bytes").alias("bytes"))
    none = F.array()
    found = found.select(
        "conv_id", F.coalesce("ids", none.cast("array<binary>")).alias("ids"), F.coalesce("bytes", none.cast("array<long>")).alias("bytes")
    )
    return found.mapInArrow(_with_prefixes, _SEQUENCES)


def _with_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prefixes = []
        for ids in batch.column("ids").to_pylist():
            at = [hashlib.blake2b(b"", digest_size=16).digest()]
            for one in ids:
                at.append(hashlib.blake2b(at[-1] + one, digest_size=16).digest())
            prefixes.append(at)
        columns = [*batch.columns, pa.array(prefixes, pa.list_(pa.binary())), pa.array([p[-1] for p in prefixes], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "ids", "bytes", "prefixes", "full"])


def prefix_trie(
    conversations: DataFrame, turns: DataFrame, container_turns: int = CONTAINER_TURNS, shard_turns: int = SHARD_TURNS
) -> DataFrame:
    """The nodes of the trie of all `conversations` (conv_id, distinct), whose turns are in `turns` (see `rebuilt_turns`).

    A node is a distinct sequence of first turns of some conversation, its members are the conversations that begin with it.
    conv_id is its smallest member; depth; parent_conv_id its parent's conv_id (null at the root); n_convs its members;
    n_children; n_leaves the nodes without children below it, itself included; saved_tokens the sum over it and all below of
    (n_convs - 1) times the bytes of the last turn; ends_sha256 the SHA-256 of the decimal conv_ids, ascending and joined
    by commas, of the conversations that end there. No conversations give no nodes, a conversation without turns ends
    at the root.

    Equal conversations are one weighted sequence. A container holds the suffixes of the sequences under one trie head and
    bursts by the next turns where these are more than `container_turns`. What does not burst is dealt to shards, sorted
    there by container and turn ids, and swept into nodes one container at a time. A container has at most `container_turns`
    turns or one sequence, so a common beginning with a third of all conversations spreads over as many tasks as it fills.
    Heads take their children's figures by sums over the heads above each container.
    """
    every = staged(sequences(conversations, turns))
    equal = every.groupBy("full").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    distinct = staged(every.join(equal.drop("full"), "conv_id"))
    heads, contained = _burst(distinct, container_turns)
    swept = staged(_sweep(contained, shard_turns))

    # Every container and every head adds to all heads above it.
    tops = swept.where("top is not null")
    from_tops = tops.join(distinct.select("conv_id", "prefixes"), "conv_id").select(
        F.expr("slice(prefixes, 1, cast(depth as int))").alias("above"), "depth", "n_leaves", F.col("saved_tokens").alias("saved")
    )
    from_heads = heads.join(distinct.select("conv_id", "prefixes"), "conv_id").select(
        F.expr("slice(prefixes, 1, cast(depth as int) + 1)").alias("above"),
        "depth",
        F.lit(0).cast("long").alias("n_leaves"),
        F.expr("(n_convs - 1) * bytes").alias("saved"),
    )
    sums = (
        from_tops.union(from_heads)
        .select("depth", "n_leaves", "saved", F.posexplode("above").alias("at", "full"))
        .groupBy("full")
        .agg(F.sum((F.col("at") == F.col("depth") - 1).cast("long")).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )
    summed = staged(heads.join(sums, "full"))
    above = summed.select(F.col("full").alias("parent"), F.col("conv_id").alias("above"))
    names = [f.split()[0] for f in NODES.split(", ")]
    of_heads = summed.join(above, "parent", "left").select(
        "conv_id",
        "depth",
        F.col("above").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
        "saved_tokens",
        "full",
    )
    below = swept.where("top is null").select(*names, "full")
    of_tops = tops.join(above, "parent").withColumn("parent_conv_id", F.col("above")).select(*names, "full")
    nodes = below.union(of_tops).union(of_heads)
    ended = nodes.where("full is not null").join(_digests(every), "full", "left")
    digest = F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256")
    return ended.select(*names, digest).union(nodes.where("full is null").select(*names, F.lit(_EMPTY).alias("ends_sha256")))


def _burst(distinct: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """The heads (full, depth, parent, conv_id, n_convs, bytes) and the suffixes in containers (container, parent, depth, ...).

    The root always bursts. A round counts, for all sequences of the containers that burst, the turns below their next
    prefixes. A prefix with too many is a head too, and one below it; since the counts fall along a sequence, its container
    is the first prefix that has few enough. Where all the prefixes of the round are heads, the next round goes on.
    """
    size = F.size("ids")
    root = distinct.groupBy(F.element_at("prefixes", 1).alias("full")).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs")
    )
    heads = root.select(
        "full", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("parent"), "conv_id", "n_convs", F.lit(0).cast("long").alias("bytes")
    )
    found, step = [], STEP
    waiting = distinct.where(size > 0).withColumn("at", F.lit(0))
    while True:
        near = waiting.withColumn("d", F.explode(F.sequence(F.col("at") + 1, F.least(F.col("at") + step, size)))).select(
            "conv_id",
            "n",
            F.expr("prefixes[d]").alias("prefix"),
            F.expr("prefixes[d - 1]").alias("parent"),
            F.expr("bytes[d - 1]").alias("bytes"),
            F.col("d").cast("long").alias("depth"),
            (size - F.col("d")).cast("long").alias("below"),
        )
        counts = near.groupBy("prefix").agg(
            F.any_value("depth").alias("depth"),
            F.any_value("parent").alias("parent"),
            F.min("conv_id").alias("conv_id"),
            F.sum("n").alias("n_convs"),
            F.any_value("bytes").alias("bytes"),
            F.sum("below").alias("below"),
            F.count("*").alias("held"),
        )
        burst = staged(counts.where((F.col("below") > limit) & (F.col("held") > 1)).withColumnRenamed("prefix", "full"))
        passed = near.join(burst.select(F.col("full").alias("prefix")), "prefix").groupBy("conv_id").agg(F.count("*").alias("passed"))
        moved = staged(
            waiting.join(passed, "conv_id", "left").withColumn("passed", F.coalesce("passed", F.lit(0)).cast("int"))
        )
        heads = heads.union(burst.select(*heads.columns))
        at = F.col("at") + F.col("passed") + 1
        found.append(moved.where((F.col("passed") < step) & (at <= size)).withColumn("at", at).drop("passed"))
        waiting = moved.where((F.col("passed") == step) & (F.col("at") + step < size)).withColumn("at", F.col("at") + step).drop("passed")
        if not waiting.head(1):
            break
        step *= 2
    contained = found[0]
    for more in found[1:]:
        contained = contained.union(more)
    return staged(heads), contained.select(
        F.expr("prefixes[at]").alias("container"),
        F.expr("prefixes[at - 1]").alias("parent"),
        F.col("at").cast("long").alias("depth"),
        "conv_id",
        "n",
        F.expr("slice(ids, at + 1, size(ids))").alias("ids"),
        F.expr("slice(bytes, at, size(bytes))").alias("bytes"),
        "full",
    )


def _sweep(contained: DataFrame, shard_turns: int) -> DataFrame:
    held = staged(contained)
    turns = held.agg(F.sum(F.size("bytes").cast("long"))).first()[0] or 0
    spark = held.sparkSession
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))
    sorted_in_shards = held.repartition(shards, "container").sortWithinPartitions("container", "ids")
    return sorted_in_shards.mapInArrow(_swept, _SWEPT)


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the containers, whose suffixes arrive together and in order."""
    kinds = [pa.int64()] * 7 + [pa.binary()] * 3
    names = [f.split()[0] for f in _SWEPT.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    held: list[dict] = []
    out: list[tuple] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["container"] != row["container"]:
                out += _nodes_of(held)
                held = []
                if len(out) >= 8192:
                    yield batch_of(out)
                    out = []
            held.append(row)
    if held:
        out += _nodes_of(held)
    if out:
        yield batch_of(out)


def _nodes_of(rows: list[dict]) -> list[tuple]:
    """The nodes of one container: a node is opened where a suffix leaves the one before it, and closed figures run up to its parent."""
    first, parents, depths, convs, counts, bytes_, ends = rows[0], [-1], [rows[0]["depth"]], [rows[0]["conv_id"]], [0], [rows[0]["bytes"][0]], [None]
    path, before = [0], []
    for row in rows:
        ids, common = row["ids"], 0
        for a, b in zip(before, ids):
            if a != b:
                break
            common += 1
        del path[common + 1 :]
        for place in range(common, len(ids)):
            parents.append(path[-1])
            path.append(len(convs))
            depths.append(first["depth"] + place + 1)
            convs.append(row["conv_id"])
            counts.append(0)
            bytes_.append(row["bytes"][place + 1])
            ends.append(None)
        at, before = path[-1], ids
        convs[at] = min(convs[at], row["conv_id"])
        counts[at] += row["n"]
        ends[at] = row["full"]
    children, leaves, saved = [0] * len(convs), [0] * len(convs), [0] * len(convs)
    for at in range(len(convs) - 1, -1, -1):
        leaves[at] = leaves[at] or 1
        saved[at] += (counts[at] - 1) * bytes_[at]
        up = parents[at]
        if up >= 0:
            convs[up] = min(convs[up], convs[at])
            counts[up] += counts[at]
            children[up] += 1
            leaves[up] += leaves[at]
            saved[up] += saved[at]
    return [
        (
            convs[at],
            depths[at],
            convs[parents[at]] if at else None,
            counts[at],
            children[at],
            leaves[at],
            saved[at],
            ends[at],
            None if at else first["parent"],
            None if at else first["container"],
        )
        for at in range(len(convs))
    ]


def _digests(every: DataFrame) -> DataFrame:
    """full, ends_sha256 of the ids of equal conversations, in order.

    The ids are sorted over ranges of equal size and joined to texts there, so that the many ids of one sequence meet as
    a few rows; these run through the digest one after another.
    """
    ranged = every.select("full", "conv_id").repartitionByRange("full", "conv_id").sortWithinPartitions("full", "conv_id")
    joined = staged(ranged.mapInArrow(_joined_ids, "full binary, first long, ids string"))
    return joined.repartition("full").sortWithinPartitions("full", "first").mapInArrow(_digested, "full binary, ends_sha256 string")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["full", "first", "ids"]
    at, first, ids, size = None, 0, [], 0
    for batch in batches:
        out = []
        for full, conv in zip(batch.column("full").to_pylist(), batch.column("conv_id").to_pylist()):
            if full != at or size > ID_BYTES:
                if ids:
                    out.append((at, first, ",".join(ids)))
                at, first, ids, size = full, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names)
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(ids)])], names)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, digest = None, hashlib.sha256()
    for batch in batches:
        out = []
        for full, ids in zip(batch.column("full").to_pylist(), batch.column("ids").to_pylist()):
            if full == at:
                digest.update(b"," + ids.encode())
                continue
            if at is not None:
                out.append((at, digest.hexdigest()))
            at, digest = full, hashlib.sha256(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string()))], ["full", "ends_sha256"])
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([digest.hexdigest()])], ["full", "ends_sha256"])


def conversation_trie(turns: DataFrame, group: int = 5, shared: int = 9) -> DataFrame:
    """The trie of the rebuilt conversations of `turns` (conv_id, turn, role, text): `rebuilt_turns`, then `prefix_trie`.

    A null role or text is empty, a row without conv_id takes no part, other columns are left out.
    """
    given = turns.select("conv_id", "turn", "role", "text")
    rebuilt = rebuilt_turns(given, group, shared)
    ids = given.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    return prefix_trie(ids, rebuilt)

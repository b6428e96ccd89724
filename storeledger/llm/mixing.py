"""Mixing of sources to target weights: a low-discrepancy schedule of equal blocks of words."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.store import small, staged

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # words of the mix for each word given
PASSES = 2  # a document is taken so often at most
BLOCK_WORDS = 1024
_WORD = r"[^\x20\x09-\x0D]+"
_LAID_BITS = 12  # slots that are made by one row
_RANKED_BITS = 10, 16  # slots ranked together, at least; groups of them for each source, at most


class Mix(NamedTuple):
    """`documents` has a row for each row given, `sources` one for each source, `pieces` one for each stretch the mix takes.

    documents: place (the row's own number), key, source_no, size, source_size, target.
    sources: source, source_no, source_size, weight, target, words (the target in whole words), blocks, first.
    pieces: slot (their order in the mix), source_no, block, place, key, begin (words of the document before it), length.
    """

    documents: DataFrame
    sources: DataFrame
    pieces: DataFrame


def word_count(text: Column) -> Column:
    """Runs of characters other than blank, tab, line feed, vertical tab, form feed and carriage return; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES, block: int = BLOCK_WORDS
) -> DataFrame:
    """The words each source gives to the mix; see `Mix.sources`.

    `sizes` has source and size. Sources are numbered by code point, a null source last, and weigh `weights`, repeated as
    long as there are sources. They share `share` times all words by weight; a target stops at `passes` times its source's
    size, and what is left over goes to the others by weight, until none is above. That is one level, times the weight, for
    all sources below their bound: with the sources ordered by bound over weight, the level that follows from the first n of
    them standing at their bounds is largest for the right n.

    One row for each source goes through a window of one task; documents do not.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = totals.withColumn("source_no", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    bound = F.col("source_size") * passes
    weighed = named.withColumn("weight", weight.cast("long")).withColumn("bound", bound)

    everyone = Window.partitionBy()
    ahead = Window.orderBy(F.col("bound") / F.col("weight"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    given = F.coalesce(F.sum("bound").over(ahead), F.lit(0))
    rest = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(ahead), F.lit(0))
    level = (F.sum("source_size").over(everyone) * F.lit(float(share)) - given) / rest
    levelled = weighed.withColumn("level", level).withColumn("level", F.max("level").over(everyone))
    target = F.least(F.col("level") * F.col("weight"), F.col("bound").cast("double"))
    aimed = levelled.withColumn("target", target).withColumn("words", F.round("target").cast("long"))
    counted = aimed.withColumn("blocks", F.expr(f"(words + {block - 1}) div {block}"))
    earlier = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("blocks").over(earlier), F.lit(0))
    return counted.withColumn("first", first).drop("bound", "level")


def schedule(sources: DataFrame) -> DataFrame:
    """source_no, block, slot: the slot in which the mix takes each block.

    A slot's point is its number's bits in reverse, the van der Corput sequence. The sources divide the range of points in
    proportion to their blocks, and a slot belongs to the source in whose part its point falls, so that any run of slots
    holds the sources in nearly the right shares. As reversing bits undoes itself, the slots of a source are the reversed
    numbers of its part: none is made for points that belong to no source, and each source gets its blocks exactly. The
    slots of a source in their order take its blocks in theirs.

    Slots are ranked in groups of neighbouring numbers, and a group starts where the counts of those before it end.
    """
    total = sources.agg(F.sum("blocks")).first()[0] or 0
    bits = max(1, (total - 1).bit_length())
    used = sources.where("blocks > 0").select("source_no", "first", "blocks")
    runs = used.select("*", F.explode(F.expr(f"sequence(0L, shiftright(blocks - 1, {_LAID_BITS}))")).alias("run"))
    points = F.expr(f"sequence(first + shiftleft(run, {_LAID_BITS}), first + least(blocks, shiftleft(run + 1, {_LAID_BITS})) - 1)")
    points = runs.repartition("source_no", "run").select("source_no", F.explode(points).alias("point"))
    slot = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long")
    slots = points.select("source_no", slot.alias("slot"))

    grouped = slots.withColumn("run", F.shiftright("slot", max(_RANKED_BITS[0], bits - _RANKED_BITS[1])))
    before = Window.partitionBy("source_no").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    counts = grouped.groupBy("source_no", "run").agg(F.count("*").alias("count"))
    starts = counts.select("source_no", "run", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("source_no", "run").orderBy("slot")) - 1
    ranked = grouped.withColumn("own", own).join(starts, ["source_no", "run"])
    return ranked.select("source_no", (F.col("start") + F.col("own")).alias("block"), "slot")


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
    block: int = BLOCK_WORDS,
) -> Mix:
    """A mix of all `docs` in which each source has its target's words, to the word, and no document more than `passes` times its own.

    The documents of a source stand one after another in an order drawn from their key and text, anew for each pass, and
    are cut into blocks of `block` words (the last is shorter); `schedule` says when each block is taken. Places in that
    order are running sums over ranges of rows that are as large as one another, so neither a source nor a key with a third of
    all rows comes together in a task.

    The mix depends on keys, texts and sources alone, not on partitions: a rerun gives the same. Rows with the same key,
    text and source are rows of their own; which of them a partial pass takes is left open, as they cannot be told apart. A
    null or empty text has no words and takes no part, a null key is like an empty one, a null source is a source of its own.
    No rows give no rows. All other columns are left out.
    """
    given = docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    mark = F.md5(F.concat_ws("|", F.coalesce(F.col("key").cast("string"), F.lit("")), F.md5("text")))
    sized = given.select("key", "source", word_count(F.col("text")).alias("size"), mark.alias("mark"))
    rows = staged(sized.withColumn("place", F.monotonically_increasing_id()))
    bytes_of_row = F.lit(64) + F.octet_length(F.coalesce(F.col("source"), F.lit("")))
    sources = small(source_targets(rows, weights, share, passes, block), bytes_of_row)
    named = sources.withColumnRenamed("source", "name")
    documents = rows.join(named, rows["source"].eqNullSafe(named["name"])).drop("name")

    needed = F.least(F.lit(passes), F.expr("cast((words - 1) div source_size as int) + 1"))
    turns = documents.where("size > 0 and words > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), needed - 1)))
    turns = turns.withColumn("draw", F.md5(F.concat_ws(":", F.col("pass").cast("string"), "mark")))
    order = ["source_no", "pass", "draw", "place"]
    ranged = turns.select(*order, "key", "size", "words").repartitionByRange(*order)
    parts = staged(ranged.withColumn("part", F.spark_partition_id()))

    within = Window.partitionBy("part", "source_no", "pass").orderBy("draw", "place")
    local = parts.withColumn("ends", F.sum("size").over(within))
    sums = parts.groupBy("source_no", "pass", "part").agg(F.sum("size").alias("total"))
    before = Window.partitionBy("source_no").orderBy("pass", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source_no", "pass", "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    placed = local.join(offsets, ["part", "source_no", "pass"]).withColumn("start", F.expr("offset + ends - size"))
    cut = placed.withColumn("stop", F.expr("least(start + size, words)")).where("start < stop")
    blocks = F.explode(F.expr(f"sequence(start div {block}, (stop - 1) div {block})"))
    pieces = cut.withColumn("block", blocks).select(
        "source_no",
        "block",
        "place",
        "key",
        F.expr(f"greatest(start, block * {block}) - start").alias("begin"),
        F.expr(f"least(stop, (block + 1) * {block}) - greatest(start, block * {block})").alias("length"),
    )
    taken = pieces.join(schedule(sources), ["source_no", "block"]).select(
        "slot", "source_no", "block", "place", "key", "begin", "length"
    )
    return Mix(documents.select("place", "key", "source_no", "size", "source_size", "target"), sources, taken)


def words_taken(mixed: Mix) -> DataFrame:
    """key, size, source_size, target, taken (words the mix takes of the document, repeats counted) for every document."""
    sums = mixed.pieces.groupBy("place").agg(F.sum("length").alias("taken"))
    found = mixed.documents.join(sums, "place", "left")
    return found.select("key", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

"""Lines that many pages of one site repeat: menus, notices and other boilerplate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.llm.store import free_names, small

RATIO = 0.1
MIN_PAGES = 4


def _fingerprint(name: str) -> list:
    """128 bits of a text: equal for equal texts only, in practice."""
    value = F.col(name)
    return [F.xxhash64(value).alias(f"{name}_a"), F.xxhash64(F.lit(name), value).alias(f"{name}_b")]


LINE = ["line_a", "line_b"]


def site_lines(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """Pages of the host that hold each line: host, line_a, line_b (the line's fingerprint), pages, host_pages.

    A line is what stands between line feeds, exactly; empty lines and lines of blanks are not counted. A page counts
    once for each line, however often it repeats it. A null host is a host of its own. All rows are pages, copies too.
    """
    pages = docs.select(F.col(host).alias("host"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    lines = pages.select("host", F.explode(F.array_distinct(F.split("text", "\n"))).alias("line"))
    seen = lines.where(F.trim("line") != "").select("host", *_fingerprint("line"))
    # Counted within each task first, so a line on a third of all pages is one row for each task.
    counts = seen.groupBy("host", *LINE).agg(F.count("*").alias("pages"))
    hosts = docs.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("host_pages"))
    return counts.join(hosts, counts["host"].eqNullSafe(hosts["host"])).select(counts["host"], *LINE, "pages", "host_pages")


def boilerplate_lines(
    docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """The lines of `site_lines` on more than `ratio` of the host's pages, and on `min_pages` pages at least."""
    return site_lines(docs, text, host).where((F.col("pages") >= min_pages) & (F.col("pages") > ratio * F.col("host_pages")))


def drop_site_boilerplate(
    docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """`docs` with boilerplate lines left out of the text, and `lines_dropped`, how many that were.

    Every other line stays as it is and where it is, repeats and empty lines included. A null text stays null, a text of
    boilerplate only becomes empty. All rows and all other columns stay; a given `lines_dropped` is replaced.

    The verdict on a line depends on its host alone. Lines on more than a tenth of a host's pages are few: at most ten
    times the average page's lines. They are gathered as one set for each host. The sets go to every task where they are
    small in sum; beyond that pages and sets are joined by host, and adaptive execution splits a hot host, since nothing
    after the join needs its pages together.
    """
    docs = docs.drop("lines_dropped")
    site, lines_of_site, left = free_names(docs.columns, "site", "lines_of_site", "left")
    flagged = boilerplate_lines(docs, text, host, ratio, min_pages)
    sets = flagged.groupBy("host").agg(F.collect_list(F.struct(*LINE)).alias(lines_of_site)).withColumnRenamed("host", site)
    sets = small(sets, F.size(lines_of_site) * 16 + 64)
    lines = F.split(text, "\n")
    kept = F.filter(
        lines,
        lambda x: ~F.array_contains(
            F.col(lines_of_site), F.struct(F.xxhash64(x).alias("line_a"), F.xxhash64(F.lit("line"), x).alias("line_b"))
        ),
    )
    whole = F.col(left).isNull()
    return (
        docs.join(sets, F.col(host).eqNullSafe(F.col(site)), "left")
        .withColumn(left, F.when(F.col(lines_of_site).isNotNull(), kept))
        .withColumn("lines_dropped", F.when(whole, 0).otherwise(F.size(lines) - F.size(left)).cast("int"))
        .withColumn(text, F.when(whole, F.col(text)).otherwise(F.array_join(left, "\n")))
        .select(*docs.columns, "lines_dropped")
    )

"""Site-relative line dedup: drop the boilerplate of a site from its pages.

Pages are grouped by host. A line's boilerplate ratio is the number of the host's
pages that contain it, divided by the host's pages; a line whose ratio exceeds
``RATIO`` and that is on at least ``MIN_PAGES`` pages is dropped from all of them.
Lines are compared without the white space around them; blank lines stay.

Only DataFrame functions. Each page's distinct lines are counted under two 64-bit
hashes, first within a task, so a line on every page of a host that holds a third of
all pages reaches the shuffle as one row per task. What exceeds the ratio is stored as
one list per host, of at most (mean lines of a page) / ``RATIO`` lines; the planner sees
the stored size and sends the lists to the pages if they are small, and else shuffles
by host and splits a hot one. Texts are not shuffled in the first case.

Cases: a null text stays null, an empty one empty; a page may lose all its lines and
keeps an empty text. Pages without a host form a host of their own. Repeated rows are
pages each; with ``copies=False`` the rows of a host with equal texts are one page, both
for its lines and in the total, so that a group of copies is not taken for boilerplate.
A column of the table named like a result (``n_lines``, ``n_dropped``) is replaced, all
others are kept; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.arrow import without
from skyledger.sources.scratch import materialize

RATIO = 0.1
MIN_PAGES = 5
_AROUND = " \t\r"


def _stripped(line: Column) -> Column:
    return F.trim(line, F.lit(_AROUND))


def _key(line: Column) -> Column:
    """128 bits: two hashes with different seeds."""
    return F.struct(
        F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b")
    )


def boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    copies: bool = True,
) -> DataFrame:
    """``_host`` and ``_dropped``, the keys of the lines that exceed the ratio."""
    hosted = pages.select(F.col(host).alias("_host"), F.col(text).alias("_text"))
    own = F.filter(
        F.transform(F.split("_text", "\n"), _stripped), lambda x: x != F.lit("")
    )
    if not copies:
        hosted = hosted.withColumn("_page", _key(F.col("_text")))
    page = [c for c in hosted.columns if c != "_text"]
    lines = hosted.select(*page, F.explode(F.array_distinct(own)).alias("_line"))
    keys = lines.select(*page, _key(F.col("_line")).alias("_key"))
    if not copies:
        # Within a task first, so a group of copies is a page of each task in the shuffle.
        keys, hosted = keys.distinct(), hosted.select(*page).distinct()
    counted = (
        keys.groupBy("_host", F.col("_key.a").alias("a"), F.col("_key.b").alias("b"))
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") >= min_pages)
    )
    totals = hosted.groupBy(F.col("_host").alias("_of")).agg(F.count("*").alias("_total"))
    return (
        counted.join(totals, F.col("_host").eqNullSafe(F.col("_of")))
        .where(F.col("_n") > F.col("_total") * F.lit(ratio))
        .groupBy("_host")
        .agg(F.collect_list(F.struct("a", "b")).alias("_dropped"))
    )


def drop_boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    copies: bool = True,
) -> DataFrame:
    """The pages without their host's boilerplate, ``n_lines`` and ``n_dropped``.

    ``n_lines`` counts the lines before, blank ones not.
    """
    pages = without(pages, "n_lines", "n_dropped")
    found = boilerplate(pages, host, text, ratio, min_pages, copies)
    dropped = materialize(found, "boilerplate")
    dropped = dropped.withColumnRenamed("_host", "_of")
    joined = pages.join(dropped, F.col(host).eqNullSafe(F.col("_of")), "left")
    lines = F.split(F.col(text), "\n")
    kept = F.when(F.col("_dropped").isNull(), lines).otherwise(
        F.filter(
            lines,
            lambda x: ~F.array_contains(F.col("_dropped"), _key(_stripped(x)))
            | (_stripped(x) == F.lit("")),
        )
    )
    filled = F.size(F.filter(lines, lambda x: _stripped(x) != F.lit("")))
    others = [f"`{c}`" for c in pages.columns if c != text]
    return (
        joined.withColumn("_kept", kept)
        .select(
            *others,
            F.array_join("_kept", "\n").alias(text),
            F.when(F.col(text).isNull(), 0).otherwise(filled).cast("long").alias("n_lines"),
            F.when(F.col(text).isNull(), 0)
            .otherwise(F.size(lines) - F.size("_kept"))
            .cast("long")
            .alias("n_dropped"),
        )
        .select(*[f"`{c}`" for c in pages.columns], "n_lines", "n_dropped")
    )

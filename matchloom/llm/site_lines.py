"""Lines that a site repeats on many of its pages.

Page texts are rows ``match_id``, ``site``, ``page_text``. Per site, the number
of pages that hold a line is divided by the number of the site's pages; lines
above ``ratio`` are boilerplate of that site and leave all its pages.

Defined results: a line is compared without outer blanks; blank lines are
neither counted nor dropped; a line counts once per page; a null site is the
site ``''``; a null text stays null; each row is a page, repeated ids included.
``min_pages`` keeps tiny sites whole. Columns besides the three are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.session import Workspace

RATIO = 0.1
MIN_PAGES = 5
BLANKS = " \t\r"


def line_key(line: Column) -> Column:
    return F.trim(line, F.lit(BLANKS))


def page_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def site_boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Hashes of the boilerplate lines of each site: ``site``, ``lines``.

    Counting works on 64-bit line hashes, folded before the shuffle, so a site
    that holds a third of all pages is no larger than its distinct lines. A
    site has at most (mean lines per page / ratio) boilerplate lines, so the
    array per site stays short however many pages the site has; two lines
    would have to collide with one of these few to change a result.
    """
    named = pages.select(F.coalesce("site", F.lit("")).alias("site"), "page_text")
    totals = named.groupBy("site").agg(F.count("*").alias("site_pages"))
    keys = F.array_distinct(F.transform(page_lines(F.col("page_text")), line_key))
    hashes = F.transform(F.filter(keys, lambda k: k != ""), lambda k: F.xxhash64(k))
    counts = (named.select("site", F.explode(hashes).alias("line")).groupBy("site", "line")
              .agg(F.count("*").alias("line_pages")).where(F.col("line_pages") >= min_pages))
    return (counts.join(totals, "site").where(F.col("line_pages") > ratio * F.col("site_pages"))
            .groupBy("site").agg(F.collect_set("line").alias("lines")))


def drop_site_lines(pages: DataFrame, work: Workspace, *, ratio: float = RATIO, min_pages: int = MIN_PAGES,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Pages without the boilerplate of their site: ``match_id``, ``page_text``, ``n_lines``, ``n_dropped``.

    Columns named in ``keep`` come along; the site itself comes along as it was given.

    The settled boilerplate table is joined by site. Spark broadcasts it while
    it is below the session's threshold; beyond that it shuffles both sides and
    splits a hot site.
    """
    boilerplate = work.settle(site_boilerplate(pages, ratio, min_pages), "boilerplate")
    named = pages.select(F.coalesce("site", F.lit("")).alias("_site"), "match_id", "page_text", *keep)
    lines = page_lines(F.col("page_text"))
    kept = F.filter(lines, lambda l: ~F.array_contains(F.col("_lines"), F.xxhash64(line_key(l))))
    touched = F.col("_lines").isNotNull() & F.col("page_text").isNotNull()
    joined = named.join(boilerplate.withColumnsRenamed({"site": "_site", "lines": "_lines"}), "_site", "left").withColumn("_kept", F.when(touched, kept))
    return joined.select(
        "match_id",
        F.when(touched, F.array_join("_kept", "\n")).otherwise(F.col("page_text")).alias("page_text"),
        F.when(F.col("page_text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(touched, F.size(lines) - F.size("_kept")).otherwise(0).cast("long").alias("n_dropped"), *keep)

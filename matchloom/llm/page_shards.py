"""Contiguous shards of the pages, nearly equal in bytes.

Pages are rows ``page_id``, ``html``. They are put in one global order (digest of the
html, so that equal pages stand together, then ``page_id``); the bytes before each page come
from per-partition totals, and the order is cut at equal byte targets. A page belongs
to the shard in which its middle byte lies. Equal pages that together hold at most ``whole_percent`` of a
shard's target go as one unit, so they are never parted; larger groups are cut like other
pages. So a shard is off its target by that percentage, or by its largest page if that is more.

Defined results: a page costs its UTF-8 bytes plus ``PAGE_COST``, a null html (other than an empty one only in order) has none; null
ids come first; repeated rows are rows of their own; an empty table gives no row; pages
larger than a target may leave shards empty. Columns besides the two are ignored.

Only DataFrame functions are used. No html is shuffled; what moves is one narrow row per page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.running import NUMBER, PART, TIE, before_each
from matchloom.session import Workspace

LAW = "bytes"
SHARDS = 40
PAGE_COST = 16
WHOLE_PERCENT = 2
COLUMNS = ("page_id", "page_bytes", "page_crc32", "shard", "slot")


def shard_pages(pages: DataFrame, work: Workspace, *, shards: int = SHARDS, whole_percent: int = WHOLE_PERCENT) -> DataFrame:
    """``page_id``, ``page_bytes``, ``page_crc32``, ``shard`` (0 to ``shards`` - 1) and ``slot``, gapless from 0 in each shard."""
    if shards < 1 or not 0 < whole_percent <= 100:
        raise ValueError("shards must be at least 1, whole_percent between 1 and 100")
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = work.settle(pages.select(
        "page_id", (F.octet_length(html).cast("long") + PAGE_COST).alias("page_bytes"), F.crc32(html).alias("page_crc32"),
        F.coalesce(F.md5("html"), F.lit("")).alias("digest")), "pages")
    total = rows.agg(F.sum("page_bytes")).first()[0] or 1
    # Each holds more than whole_percent of a target, so there are at most 100 * shards / whole_percent of them.
    large = (rows.groupBy("digest").agg(F.sum("page_bytes").alias("held"))
             .where(F.col("held") * (100 * shards) > whole_percent * total).select("digest", F.lit(True).alias("large")))
    marked = work.settle(rows.join(F.broadcast(large), "digest", "left").withColumn("large", F.coalesce("large", F.lit(False))), "marked")
    id_order = F.col("page_id").asc_nulls_first()
    # Only large groups may spread over partitions; a small one lies in one partition, where it is seen whole.
    spread = [F.col("digest"), F.when(F.col("large"), F.col("page_id")).asc_nulls_first(), F.when(F.col("large"), F.col(TIE))]
    placed = before_each(marked, work, "dealt", [F.col("digest"), id_order], {"before": "page_bytes"}, ranges=spread)
    group = Window.partitionBy(PART, "digest")
    middle = F.when(F.col("large"), 2 * F.col("before") + F.col("page_bytes")).otherwise(
        2 * F.min("before").over(group) + F.sum("page_bytes").over(group))
    cut = work.settle(placed.withColumn("middle", middle).select(
        "page_id", "page_bytes", "page_crc32", F.floor(F.expr(f"middle * {shards} div {2 * total}")).cast("int").alias("shard"), NUMBER), "cut")
    firsts = cut.groupBy("shard").agg(F.min(NUMBER).alias("first"))  # one row per shard
    return cut.join(F.broadcast(firsts), "shard").withColumn("slot", F.col(NUMBER) - F.col("first")).select(*COLUMNS)

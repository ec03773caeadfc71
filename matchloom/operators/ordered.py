"""Previous and most recent values within a key, without one task per key.

A plain window over a key puts the whole key into one task. Here the key is cut
into buckets that follow the order (a day, a month) and the window runs inside
a bucket. What a bucket needs from the ones before it comes from one or two
rows per non-empty bucket; only those are windowed by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
                  value: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<c>`` of the row before, by ``order`` (total within a key), plus ``prev_seen``.

    ``bucket`` must not decrease along ``order``. Both branches read the same
    columns, so the one large shuffle, on key and bucket, is done once and used twice.
    """
    keys = list(keys)
    carried = F.struct(*[F.col(c) for c in value])
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    staged = df.withColumn("_bucket", bucket).withColumns({
        "_previous": F.lag(carried).over(inside), "_opens": F.row_number().over(inside) == 1,
        "_closes": F.lead(F.lit(True)).over(inside).isNull()})
    edge = F.col("_opens") | F.col("_closes")
    # At most two rows per bucket: what precedes an opening row is the close of the bucket before.
    across = Window.partitionBy(*keys).orderBy(*order)
    edges = staged.filter(edge).withColumn(
        "_previous", F.when(F.col("_opens"), F.lag(carried).over(across)).otherwise(F.col("_previous")))
    both = staged.filter(~edge).unionByName(edges)
    return both.select(
        *df.columns, F.col("_previous").isNotNull().alias(f"{prefix}seen"),
        *[F.col("_previous")[c].alias(f"{prefix}{c}") for c in value])


def carry_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
                  mark: str) -> DataFrame:
    """Fill ``mark`` with the newest non-null ``mark`` at or before each row."""
    keys = list(keys)
    staged = df.withColumn("_bucket", bucket)
    inside = (Window.partitionBy(*keys, "_bucket").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    staged = staged.withColumn("_here", F.last(mark, ignorenulls=True).over(inside))

    position = F.struct(*[F.col(c) for c in order])
    tails = (df.select(*keys, bucket.alias("_bucket"), F.col(mark).alias("_tail"),
                       F.when(F.col(mark).isNotNull(), position).alias("_at"))
               .groupBy(*keys, "_bucket").agg(F.max_by("_tail", "_at").alias("_tail")))
    across = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = tails.select(*keys, "_bucket", F.last("_tail", ignorenulls=True).over(across).alias("_carry"))

    joined = _join_buckets(staged, before, keys)
    filled = F.coalesce(F.col("_here"), F.col("_carry"))
    return joined.select(*[filled.alias(c) if c == mark else F.col(c) for c in df.columns])


def _join_buckets(rows: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    """Join on key and bucket, null keys matching null keys."""
    right = before.select(*[F.col(k).alias(f"_r_{k}") for k in [*keys, "_bucket"]], "_carry")
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in [*keys, "_bucket"]]
    condition = on[0]
    for part in on[1:]:
        condition = condition & part
    return rows.join(right, condition)

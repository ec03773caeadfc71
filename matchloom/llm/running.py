"""Sums over all rows before each row, in one global order.

Rows are dealt to partitions by ranges of the order and written once; each
partition's totals become a table of one row per partition, whose running sums
are what lies before a partition; inside a partition a window does the rest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.session import Workspace

PART, TIE, NUMBER = "part_", "tie_", "number_"


def before_each(rows: DataFrame, work: Workspace, name: str, order: Sequence[Column], sums: Mapping[str, str], *,
                ranges: Sequence[Column] | None = None) -> DataFrame:
    """``rows`` with ``number_`` (rows before this one) and, per entry of ``sums``, the sum of a column before it.

    ``order`` need not tell all rows apart; rows it leaves equal stand in any, but one
    fixed, order. Partitions are ranges of ``ranges`` (default: ``order`` and the row's
    place), so however many rows share a value, they spread over partitions. With an
    own ``ranges``, rows equal in it stay in one partition; it must agree with ``order``. ``rows`` is
    read twice (once for range bounds): pass a table, not a heavy plan. ``part_`` is kept.
    """
    tied = rows.withColumn(TIE, F.monotonically_increasing_id())
    dealt = work.settle(tied.repartitionByRange(*(ranges or [*order, F.col(TIE)])).withColumn(PART, F.spark_partition_id()), name)
    totals = dealt.groupBy(PART).agg(F.count("*").alias(NUMBER), *[F.sum(c).alias(out) for out, c in sums.items()])
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(PART, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_start_") for c in (NUMBER, *sums)])
    inside = Window.partitionBy(PART).orderBy(*order, TIE)
    preceding = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.join(starts, PART).withColumn(NUMBER, F.row_number().over(inside) - 1 + F.col(f"{NUMBER}_start_"))
    for out, column in sums.items():
        placed = placed.withColumn(out, F.coalesce(F.sum(column).over(preceding), F.lit(0)) + F.col(f"{out}_start_"))
    return placed.drop(*[f"{c}_start_" for c in (NUMBER, *sums)])

"""One row per key: newest by an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column],
              not_null: Sequence[str] = ()) -> DataFrame:
    """First row of each key under ``order_by``; rows with a null in ``not_null`` do not compete.

    The ``rank = 1`` filter lets Spark keep one row per key and input partition
    before the shuffle (WindowGroupLimit), so a hot key never travels whole.
    """
    for name in not_null:
        df = df.filter(F.col(name).isNotNull())
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def first_n_by(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int,
               rank: str) -> DataFrame:
    """First ``n`` rows of each key with their rank; pruned before the shuffle like ``latest_by``."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)

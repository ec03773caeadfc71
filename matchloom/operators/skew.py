"""Joins between many rows and one row per key, safe for hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 8


def attach(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], spread_on: Column,
           how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join ``rows`` with ``per_key``, which has one row per key.

    A key's rows are cut into ``salts`` parts by ``spread_on`` and the one row
    is repeated for each part. That also matters to the AQE skew rule: it
    splits a join only when both inputs are fresh shuffles, and an aggregate
    joined on its own key is not one. With the salt in the join key it is, so
    a part that is still too large is split again at run time.
    """
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_on), F.lit(salts)))
    right = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")

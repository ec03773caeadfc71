"""Validity intervals: point-in-time filter, roster lookup and fact-to-interval join.

Intervals are half open, ``valid_from <= t < valid_to``; a null ``valid_to`` is open.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.operators.ordered import carry_forward


def covers(moment: Column, valid_from: Column, valid_to: Column) -> Column:
    return (valid_from <= moment) & (valid_to.isNull() | (valid_to > moment))


def as_of(history: DataFrame, moment: Column) -> DataFrame:
    return history.filter(covers(moment, F.col("valid_from"), F.col("valid_to")))


def roster_as_of(history: DataFrame, players: DataFrame, team: str, moment: Column) -> DataFrame:
    """Players of one team at one moment."""
    members = as_of(history, moment).filter(F.col("team_name") == team).select("player_id")
    return members.join(players.select("player_id", "player_name"), "player_id")


def interval_join(facts: DataFrame, history: DataFrame, keys: Sequence[str], at: str,
                  carry: Sequence[str], row_key: Sequence[str], bucket: str = "month") -> DataFrame:
    """Give every fact row the columns ``carry`` of the interval valid at its own time.

    Intervals of a key must not overlap, so only the newest one that has
    started can cover a row. That one is carried forward along time; no
    fact/interval pairs are formed, and ``bucket`` cuts hot keys by time.
    """
    keys, row_key = list(keys), list(row_key)
    # The two bookkeeping fields keep the payload non-null for an interval start.
    payload = F.struct(F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"),
                       *[F.col(c).alias(f"_c_{c}") for c in carry])
    columns = facts.columns
    blank = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in facts.schema.fields}
    starts = history.select(
        *[F.col(c) if c in keys else blank[c] for c in columns],
        F.col("valid_from").alias("_at"), F.lit(0).alias("_turn"), payload.alias("_interval"))
    empty = F.lit(None).cast(starts.schema["_interval"].dataType)
    rows = facts.select(*columns, F.col(at).alias("_at"), F.lit(1).alias("_turn"), empty.alias("_interval"))
    filled = carry_forward(
        starts.unionByName(rows), keys, ["_at", "_turn", *[k for k in row_key if k not in keys]],
        F.date_trunc(bucket, F.col("_at")), "_interval")
    valid = F.col("_interval._to").isNull() | (F.col("_interval._to") > F.col("_at"))
    return (filled.filter((F.col("_turn") == 1) & F.col("_interval").isNotNull() & valid)
            .select(*columns, *[F.col(f"_interval._c_{c}").alias(c) for c in carry]))

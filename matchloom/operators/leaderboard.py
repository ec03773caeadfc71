"""Top players by a mean metric."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchloom.functions.scalar import exact_mean, fixed

LIMIT_MAX = 100
# Decimal places of any stored metric.
METRIC_SCALE = 6


def top_players(players: DataFrame, min_maps: int = 5, limit: int = 10, by: str = "player_name",
                metric: str = "rating", drop_null_means: bool = False) -> DataFrame:
    """Best ``limit`` players with at least ``min_maps`` rows, highest mean first.

    A player without any metric value has a null mean and sorts first unless
    ``drop_null_means`` is set. Equal means are ordered by the grouping column.
    """
    if min_maps < 1:
        raise ValueError("min_maps must be at least 1")
    if not 1 <= limit <= LIMIT_MAX:
        raise ValueError(f"limit must be between 1 and {LIMIT_MAX}")
    board = (players.groupBy(by)
             .agg(F.count(F.lit(1)).alias("maps_played"), exact_mean(F.col(metric), scale=METRIC_SCALE).alias("avg_rating"))
             .filter(F.col("maps_played") >= min_maps))
    if drop_null_means:
        board = board.filter(F.col("avg_rating").isNotNull())
    return board.orderBy(F.col("avg_rating").desc_nulls_first(), F.col(by).asc_nulls_last()).limit(limit)


def ranked(board: DataFrame, by: str = "player_name") -> DataFrame:
    """Display rank and fixed-point mean. ``board`` holds at most ``LIMIT_MAX`` rows."""
    order = Window.orderBy(F.col("avg_rating").desc_nulls_first(), F.col(by).asc_nulls_last())
    return board.select(
        F.row_number().over(order).alias("rank"), by, "maps_played",
        fixed(F.col("avg_rating")).alias("rating_text"))

"""Staging, intermediate, fact and dimension models.

Each model is a function of the relations it reads; ``build.MODELS`` names
those relations. Staging and intermediate models stay lazy, so a mart plan
reaches down to the columns of the base scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.functions.scalar import loser_of, or_zero
from matchloom.operators.latest import latest_by
from matchloom.schemas import COUNTERS, MAPS, MATCHES, PLAYERS

_STATS = [*COUNTERS, "kast", "kd_diff", "adr", "fk_diff", "round_swing", "rating"]

# The fact's columns in the order its readers expect.
FACT_COLUMNS = [
    "match_id", "map_id", "player_id", "player_name", "team_name", "event", "match_date",
    "match_winner", "map_name", "map_order", "map_date", "map_winner", "map_team1_score", "map_team2_score",
    "kills", "deaths", "assists", "flash_assists", "headshots", "opening_kills", "opening_deaths", "traded_deaths",
    "multi_kills", "clutches_won", "kast", "adr", "rating", "kd_diff", "fk_diff", "round_swing",
]

RELATIONSHIP_COLUMNS = [
    "player_id", "player_name", "map_id", "map_name", "map_order", "match_id", "team1", "team2", "match_winner",
]


def stg_matches(matches: DataFrame) -> DataFrame:
    kept = [c for c in MATCHES.names if c not in ("map_links", "demo_links")]
    renamed = {"winner": "match_winner", "last_inserted_at": "inserted_at"}
    return matches.select(*[F.col(c).alias(renamed.get(c, c)) for c in kept])


def stg_maps(maps: DataFrame) -> DataFrame:
    return maps.select(*MAPS.names)


def stg_players(players: DataFrame) -> DataFrame:
    renamed = {"last_inserted_at": "inserted_at"}
    return players.select(*[F.col(c).alias(renamed.get(c, c)) for c in PLAYERS.names])


def int_match_player_stats(players: DataFrame, maps: DataFrame, matches: DataFrame) -> DataFrame:
    """Player rows with map and match context; one row per player and map.

    A map gets its match's context before its players join it, so the wide player rows are shuffled once at most.
    """
    map_context = maps.select(
        "map_id", "match_id", "map_order", "map_name", "map_winner",
        F.col("team1_score").alias("map_team1_score"), F.col("team2_score").alias("map_team2_score"),
        F.col("date").alias("map_date"))
    match_context = matches.select(
        "match_id", "team1", "team2", "match_winner", "event", "match_type", F.col("date").alias("match_date"))
    stats = players.select("map_id", "player_id", "player_name", "player_url", "team_name", *_STATS)
    joined = stats.join(map_context.join(match_context, "match_id"), "map_id")
    return joined.select(
        "map_id", "player_id", "match_id", "team1", "team2", "match_winner", "event", "match_type",
        "match_date", "map_order", "map_name", "map_winner", "map_team1_score", "map_team2_score",
        "map_date", "player_name", "player_url", "team_name", *_STATS)


def relationship_rows(enriched: DataFrame) -> DataFrame:
    """Nine context columns per player row, all three grains in one line."""
    return enriched.select(*RELATIONSHIP_COLUMNS)


def int_player_current_team(enriched: DataFrame) -> DataFrame:
    """Team of each player's newest map that recorded one."""
    newest = [F.col("map_date").desc_nulls_last(), F.col("map_id").desc()]
    pairs = enriched.select("player_id", "team_name", "map_date", "map_id")
    kept = latest_by(pairs, ["player_id"], newest, not_null=["player_id", "team_name"])
    return kept.select("player_id", "team_name", F.col("map_date").alias("observed_map_date"))


def fact_matches(matches: DataFrame, maps: DataFrame) -> DataFrame:
    return fact_matches_counted(matches, maps.groupBy("match_id").agg(F.count(F.lit(1)).alias("map_count")))


def fact_matches_counted(matches: DataFrame, counts: DataFrame) -> DataFrame:
    """The fact from matches and their number of maps."""
    joined = matches.join(counts, "match_id", "left")
    return joined.select(
        "match_id", "event", "team1", "team2", "score1", "score2",
        F.col("match_winner").alias("winning_team"),
        loser_of(F.col("match_winner"), F.col("team1"), F.col("team2")).alias("losing_team"),
        "match_type", F.col("date").alias("match_date"), "forfeit",
        or_zero(F.col("map_count")).alias("map_count"), "data_complete")


def fact_player_map_stats(enriched: DataFrame) -> DataFrame:
    return enriched.select(*FACT_COLUMNS)


def dim_players(players: DataFrame) -> DataFrame:
    """Newest identity of each player."""
    newest = [F.col("inserted_at").desc_nulls_last(), F.col("map_id").desc()]
    named = players.select("player_id", "player_name", "player_url", "inserted_at", "map_id")
    return latest_by(named, ["player_id"], newest, not_null=["player_id"]).select(
        "player_id", "player_name", "player_url")


def dim_maps(maps: DataFrame) -> DataFrame:
    return maps.select("map_name").filter(F.col("map_name").isNotNull()).distinct()

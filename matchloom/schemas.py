"""Explicit schemas of the base tables, state tables and snapshot."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, TEXT, DOUBLE = T.LongType(), T.StringType(), T.DoubleType()
BOOL, WALL = T.BooleanType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


MAP_LINKS = T.ArrayType(_struct(("map_id", LONG), ("map_url", TEXT)))
DEMO_LINKS = T.ArrayType(_struct(("demo_id", TEXT), ("demo_url", TEXT)))

MATCHES = _struct(
    ("match_id", LONG), ("match_url", TEXT), ("map_links", MAP_LINKS), ("demo_links", DEMO_LINKS),
    ("team1", TEXT), ("team2", TEXT), ("score1", LONG), ("score2", LONG), ("winner", TEXT),
    ("event", TEXT), ("match_type", TEXT), ("forfeit", BOOL), ("date", WALL),
    ("last_inserted_at", WALL), ("last_scraped_at", WALL), ("last_updated_at", WALL),
    ("data_complete", BOOL),
)

MAPS = _struct(
    ("map_id", LONG), ("match_id", LONG), ("map_url", TEXT), ("map_order", LONG), ("map_name", TEXT),
    ("team1_score", LONG), ("team2_score", LONG), ("map_winner", TEXT), ("date", WALL),
    ("inserted_at", WALL), ("last_scraped_at", WALL), ("last_updated_at", WALL),
    ("data_complete", BOOL),
)

COUNTERS = [
    "kills", "headshots", "assists", "flash_assists", "deaths", "traded_deaths",
    "opening_kills", "opening_deaths", "multi_kills", "clutches_won",
]

PLAYERS = _struct(
    ("map_id", LONG), ("player_id", LONG), ("player_name", TEXT), ("player_url", TEXT),
    ("map_name", TEXT), ("team_name", TEXT),
    *[(name, LONG) for name in COUNTERS],
    ("kast", DOUBLE), ("kd_diff", LONG), ("adr", DOUBLE), ("fk_diff", LONG),
    ("round_swing", DOUBLE), ("rating", DOUBLE),
    ("last_inserted_at", WALL), ("last_scraped_at", WALL), ("last_updated_at", WALL),
    ("data_complete", BOOL),
)

# The lifecycle statuses a state row may hold.
STATUSES = ["discovered", "processing", "processed", "failed", "skipped", "dead", "partial"]


def state_schema(key: str, key_type: T.DataType = LONG, url: str = "url",
                 context: tuple[tuple[str, T.DataType], ...] = ()) -> T.StructType:
    """State-table schema for one kind of discovered entity."""
    return _struct(
        (key, key_type), (url, TEXT), *context, ("status", TEXT),
        ("first_seen_at", WALL), ("last_seen_at", WALL), ("last_attempted_at", WALL),
        ("last_processed_at", WALL), ("last_failed_at", WALL), ("failure_count", LONG),
        ("last_error_message", TEXT), ("source", TEXT), ("priority", LONG), ("last_updated_at", WALL),
    )


PAGES = _struct(("page_id", LONG), ("url", TEXT), ("html", TEXT))

ROSTER_HISTORY = _struct(
    ("player_id", LONG), ("team_name", TEXT), ("observed_map_date", WALL), ("scd_id", TEXT),
    ("valid_from", WALL), ("valid_to", WALL), ("updated_at", WALL),
)

# Schemas of the parquet tables the registered queries read.
RAW_TABLES = {
    "orders": _struct(
        ("o_orderkey", LONG), ("o_custkey", LONG), ("o_orderstatus", TEXT),
        ("o_totalprice", DOUBLE), ("o_orderdate", WALL), ("o_orderpriority", TEXT)),
    "lineitem": _struct(
        ("l_orderkey", LONG), ("l_partkey", LONG), ("l_suppkey", LONG),
        ("l_linenumber", T.IntegerType()), ("l_quantity", DOUBLE), ("l_extendedprice", DOUBLE),
        ("l_discount", DOUBLE), ("l_tax", DOUBLE), ("l_returnflag", TEXT), ("l_linestatus", TEXT),
        ("l_shipdate", WALL)),
    "part": _struct(
        ("p_partkey", LONG), ("p_name", TEXT), ("p_brand", TEXT), ("p_type", TEXT),
        ("p_size", T.IntegerType()), ("p_retailprice", DOUBLE)),
    "supplier": _struct(
        ("s_suppkey", LONG), ("s_name", TEXT), ("s_nationkey", T.IntegerType()), ("s_acctbal", DOUBLE)),
    "events": _struct(
        ("event_id", LONG), ("ts", WALL), ("user_id", LONG), ("event_type", TEXT),
        ("value", DOUBLE), ("props", TEXT)),
    "pages": PAGES,
}

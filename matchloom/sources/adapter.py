"""Maps the given order, line and event tables onto the match, map, player and log roles.

Only integer arithmetic is used, so the same formulas can be stated in any SQL
dialect. Duplicate lines are reduced with ``latest_by``, which keeps one row
per key and input partition before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions.scalar import winner_of
from matchloom.operators.latest import latest_by
from matchloom.schemas import MATCHES
from matchloom.sources.tables import raw_table

SITE = "https://example.test"


def _days(moment: Column, count: int) -> Column:
    return moment + F.expr(f"interval {count} day")


def _team(number: Column) -> Column:
    return F.concat(F.lit("T"), number.cast("string"))


def _match_teams() -> tuple[Column, Column]:
    seat = F.col("o_custkey") % 25
    return _team(seat), _team((seat + 1 + F.col("o_orderkey") % 24) % 25)


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("o_orderkey")
    team1, team2 = _match_teams()
    score1, score2 = order % 3, (order * 7 + F.col("o_custkey")) % 3
    first_map = order * 10
    links = F.transform(
        F.sequence(F.lit(1).cast("bigint"), 1 + order % 3),
        lambda n: F.struct(
            (first_map + n).alias("map_id"),
            F.concat(F.lit(f"{SITE}/stats/matches/mapstatsid/"), first_map + n, F.lit("/x")).alias("map_url")))
    demos = F.when(order % 4 == 0, F.array(F.struct(
        order.cast("string").alias("demo_id"),
        F.concat(F.lit(f"{SITE}/download/demo/"), order, F.lit("/x")).alias("demo_url")))).otherwise(
            F.array().cast(MATCHES["demo_links"].dataType))
    return raw_table(spark, sf_dir, "orders").select(
        order.alias("match_id"),
        F.concat(F.lit(f"{SITE}/matches/"), order, F.lit("/a-vs-b")).alias("match_url"),
        links.alias("map_links"), demos.alias("demo_links"),
        team1.alias("team1"), team2.alias("team2"), score1.alias("score1"), score2.alias("score2"),
        winner_of(team1, team2, score1, score2).alias("winner"),
        F.col("o_orderpriority").alias("event"),
        F.element_at(F.array(F.lit("bo1"), F.lit("bo3"), F.lit("bo5")), (order % 3 + 1).cast("int")).alias("match_type"),
        (F.col("o_orderstatus") == "P").alias("forfeit"),
        F.col("o_orderdate").alias("date"),
        _days(F.col("o_orderdate"), 1).alias("last_inserted_at"),
        _days(F.col("o_orderdate"), 2).alias("last_scraped_at"),
        _days(F.col("o_orderdate"), 2).alias("last_updated_at"),
        (order % 11 != 0).alias("data_complete"),
    ).select(*MATCHES.names)


def map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as a map row, repeats of a key included."""
    lines = raw_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return _as_maps(spark, sf_dir, lines, extra=[F.col(c) for c in lines.columns])


def maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = raw_table(spark, sf_dir, "lineitem")
    newest = [F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")]
    kept = latest_by(lines, ["l_orderkey", "l_linenumber"], newest)
    return _as_maps(spark, sf_dir, kept)


def _as_maps(spark: SparkSession, sf_dir: str, lines: DataFrame, extra: list[Column] = ()) -> DataFrame:
    parts = raw_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    team1, team2 = _match_teams()
    teams = raw_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), team1.alias("team1"), team2.alias("team2"))
    # Parts first: where both joins shuffle, the rows then lie by match, as joins and counts per match want them.
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(teams, "l_orderkey")
    map_id = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    score1, score2 = F.round("l_quantity").cast("bigint"), F.col("l_partkey") % 20
    return joined.select(
        map_id.alias("map_id"), F.col("l_orderkey").alias("match_id"),
        F.concat(F.lit(f"{SITE}/stats/matches/mapstatsid/"), map_id, F.lit("/x")).alias("map_url"),
        F.col("l_linenumber").cast("bigint").alias("map_order"), F.col("p_type").alias("map_name"),
        score1.alias("team1_score"), score2.alias("team2_score"),
        winner_of(F.col("team1"), F.col("team2"), score1, score2).alias("map_winner"),
        F.col("l_shipdate").alias("date"),
        _days(F.col("l_shipdate"), 1).alias("inserted_at"),
        _days(F.col("l_shipdate"), 2).alias("last_scraped_at"),
        _days(F.col("l_shipdate"), 2).alias("last_updated_at"),
        F.lit(True).alias("data_complete"), *extra)


def player_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as a player row, repeats of a key included."""
    lines = raw_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_partkey", "l_quantity", "l_extendedprice")
    return _as_players(spark, sf_dir, lines, extra=[F.col(c) for c in lines.columns])


def players(spark: SparkSession, sf_dir: str, by_map: bool = False) -> DataFrame:
    """Player rows. ``by_map`` lays them by map while they are narrow, so that a join on ``map_id`` need not shuffle the stats."""
    lines = raw_table(spark, sf_dir, "lineitem")
    newest = [F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_quantity", "l_extendedprice")]
    kept = latest_by(lines, ["l_orderkey", "l_linenumber", "l_suppkey"], newest)
    return _as_players(spark, sf_dir, kept, by_map=by_map)


def _as_players(spark: SparkSession, sf_dir: str, lines: DataFrame, extra: list[Column] = (), by_map: bool = False) -> DataFrame:
    parts = raw_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    names = raw_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    # Names last: they are longer than types, and where both joins shuffle they travel once less.
    joined = (lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
                   .join(names, F.col("l_suppkey") == F.col("s_suppkey"))
                   .withColumn("map_id", F.col("l_orderkey") * 10 + F.col("l_linenumber")))
    if by_map:
        joined = joined.select("map_id", "l_suppkey", "l_shipdate", "l_partkey", "l_quantity", "s_name", "p_type").repartition("map_id")
    part, player, year = F.col("l_partkey"), F.col("l_suppkey"), F.year("l_shipdate").cast("bigint")
    kills, deaths = F.round("l_quantity").cast("bigint"), part % 30
    opening_kills, opening_deaths = part % 7, player % 5
    rating = F.when(part % 23 != 0, (50 + (part * 13 + player * 7) % 150).cast("double") / 100)
    return joined.select(
        "map_id",
        player.alias("player_id"),
        F.when(year >= 1999, F.concat("s_name", F.lit("_v2"))).otherwise(F.col("s_name")).alias("player_name"),
        F.concat(F.lit(f"{SITE}/player/"), player, F.lit("/p")).alias("player_url"),
        F.col("p_type").alias("map_name"),
        F.when(part % 17 != 0, _team((player + year) % 25)).alias("team_name"),
        kills.alias("kills"), (kills % 9).alias("headshots"),
        (part % 11).alias("assists"), (part % 4).alias("flash_assists"),
        deaths.alias("deaths"), (player % 6).alias("traded_deaths"),
        opening_kills.alias("opening_kills"), opening_deaths.alias("opening_deaths"),
        (part % 5).alias("multi_kills"), (part % 3).alias("clutches_won"),
        ((40 + part % 60).cast("double") / 100).alias("kast"),
        (kills - deaths).alias("kd_diff"),
        ((300 + part % 900).cast("double") / 10).alias("adr"),
        (opening_kills - opening_deaths).alias("fk_diff"),
        ((part % 2001 - 1000).cast("double") / 10000).alias("round_swing"),
        rating.alias("rating"),
        _days(F.col("l_shipdate"), 1).alias("last_inserted_at"),
        _days(F.col("l_shipdate"), 2).alias("last_scraped_at"),
        _days(F.col("l_shipdate"), 2).alias("last_updated_at"),
        F.lit(True).alias("data_complete"), *extra)


def base_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"matches": matches(spark, sf_dir), "maps": maps(spark, sf_dir), "players": players(spark, sf_dir)}


def lifecycle_log(events: DataFrame) -> DataFrame:
    """Event rows as lifecycle commands on the entity ``user_id``.

    Works on batch and streaming input alike. A repeated signup is a
    rediscovery, exactly as a page listing an entity again would be.
    """
    kind = F.col("event_type")
    op = (F.when(kind == "signup", "discover").when(kind == "view", "processing")
           .when(kind == "purchase", "processed").when(kind == "error", "failed")
           .when(kind == "click", "skipped"))
    found = kind == "signup"
    return events.select(
        F.col("user_id").alias("id"), F.col("ts"), F.col("event_id").alias("seq"), op.alias("op"),
        F.when(kind.isin("error", "click"), F.col("props")).alias("reason"),
        F.lit(None).cast("string").alias("expected"),
        F.when(found, F.concat(F.lit(f"{SITE}/matches/"), F.col("user_id"), F.lit("/e"), F.col("event_id"))).alias("url"),
        F.when(found, F.concat(F.lit("feed"), F.col("event_id") % 3)).alias("source"),
        F.when(found, F.round("value").cast("bigint") % 10).alias("priority"))


def requeue_log(events: DataFrame) -> DataFrame:
    """The same commands, with every third purchase read as a conditional requeue."""
    commands = lifecycle_log(events)
    is_retry = (F.col("op") == "processed") & (F.col("seq") % 3 == 0)
    return commands.withColumns({
        "op": F.when(is_retry, "requeue").otherwise(F.col("op")),
        "expected": F.when(is_retry, F.element_at(
            F.array(F.lit("failed"), F.lit("skipped"), F.lit("discovered")),
            (F.floor(F.col("seq") % 9 / 3) + 1).cast("int"))),
    })

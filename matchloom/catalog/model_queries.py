"""Staging, star schema and leaderboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.catalog.registry import query
from matchloom.operators.leaderboard import ranked, top_players
from matchloom.plans import models as m
from matchloom.sources import adapter
from matchloom.sources.tables import as_json_rows, missing_tables, register_views

# Mean of two-place ratings, rounded half up to two places in whole numbers.
MEAN = ("cast((2 * sum(cast(round(rating * 100) as bigint)) + count(rating)) // (2 * count(rating)) as double) / 100")

TOP = f"""
select player_name, count(*) as maps_played,
  case when count(rating) > 0 then {MEAN} end as avg_rating
from players group by player_name having count(*) >= 5
order by avg_rating desc nulls first, player_name limit 10
"""

_STG_MATCHES = """
select match_id, match_url, team1, team2, score1, score2, winner as match_winner, event, match_type, forfeit,
  date, last_inserted_at as inserted_at, last_scraped_at, last_updated_at, data_complete from matches
"""


def enriched(spark, sf):
    return m.int_match_player_stats(
        m.stg_players(adapter.players(spark, sf, by_map=True)), m.stg_maps(adapter.maps(spark, sf)),
        m.stg_matches(adapter.matches(spark, sf)))


@query("top_players", TOP, "players")
def _(spark, sf):
    return top_players(adapter.players(spark, sf))


@query("top_players_ranked", f"""
    select row_number() over (order by avg_rating desc nulls first, player_name) as rank, player_name,
      maps_played, printf('%.2f', avg_rating) as rating_text from ({TOP.strip()})""", "players")
def _(spark, sf):
    return ranked(top_players(adapter.players(spark, sf))).withColumn("rank", F.col("rank").cast("bigint"))


@query("top_players_by_id", f"""
    select player_id, count(*) as maps_played, {MEAN} as avg_rating from players
    group by player_id having count(*) >= 20 and count(rating) > 0
    order by avg_rating desc, player_id limit 25""", "players")
def _(spark, sf):
    return top_players(adapter.players(spark, sf), min_maps=20, limit=25, by="player_id", drop_null_means=True)


@query("top_players_json", f"""
    select concat('{{"player_name":"', player_name, '","maps_played":', maps_played, ',"avg_rating":',
      avg_rating, '}}') as value from ({TOP.strip()})""", "players")
def _(spark, sf):
    return as_json_rows(top_players(adapter.players(spark, sf)))


@query("stg_matches", _STG_MATCHES, "matches")
def _(spark, sf):
    return m.stg_matches(adapter.matches(spark, sf))


@query("stg_maps", "select * from maps", "maps")
def _(spark, sf):
    return m.stg_maps(adapter.maps(spark, sf))


@query("stg_players", "select * exclude (last_inserted_at), last_inserted_at as inserted_at from players", "players")
def _(spark, sf):
    return m.stg_players(adapter.players(spark, sf))


@query("int_match_player_stats", "select * from enriched", "enriched")
def _(spark, sf):
    return enriched(spark, sf)


@query("relationship_rows", """
    select player_id, player_name, map_id, map_name, map_order, match_id, team1, team2, match_winner
    from enriched""", "enriched")
def _(spark, sf):
    return m.relationship_rows(enriched(spark, sf))


@query("fact_player_map_stats", "select * exclude (team1, team2, match_type, player_url) from enriched", "enriched")
def _(spark, sf):
    return m.fact_player_map_stats(enriched(spark, sf))


@query("fact_matches", """
    select t.match_id, event, team1, team2, score1, score2, winner as winning_team,
      case winner when team1 then team2 when team2 then team1 end as losing_team, match_type,
      date as match_date, forfeit, coalesce(map_count, 0) as map_count, data_complete
    from matches t left join (select match_id, count(*) as map_count from maps group by match_id) c
      on c.match_id = t.match_id""", "matches maps")
def _(spark, sf):
    return m.fact_matches(m.stg_matches(adapter.matches(spark, sf)), m.stg_maps(adapter.maps(spark, sf)))


@query("dim_players", """
    select player_id, player_name, player_url from (
      select *, row_number() over (partition by player_id order by last_inserted_at desc nulls last, map_id desc) as rn
      from players where player_id is not null) where rn = 1""", "players")
def _(spark, sf):
    return m.dim_players(m.stg_players(adapter.players(spark, sf)))


@query("dim_maps", "select distinct map_name from maps where map_name is not null", "maps")
def _(spark, sf):
    return m.dim_maps(m.stg_maps(adapter.maps(spark, sf)))


@query("int_player_current_team", """
    select player_id, team_name, map_date as observed_map_date from (
      select *, row_number() over (partition by player_id order by map_date desc nulls last, map_id desc) as rn
      from enriched where player_id is not null and team_name is not null) where rn = 1""", "enriched")
def _(spark, sf):
    return m.int_player_current_team(enriched(spark, sf))


@query("view_rows", "select map_name, count(*) as maps, max(date) as newest from maps group by map_name", "maps")
def _(spark, sf):
    register_views({"maps_view": m.stg_maps(adapter.maps(spark, sf))})
    return spark.sql("select map_name, count(*) as maps, max(date) as newest from maps_view group by map_name")


@query("required_tables", """
    select name, rows from (select 'checked_maps' as name, count(*) as rows from maps union all select 'checked_matches', count(*) from matches
      union all select 'never_built', null)""", "matches maps")
def _(spark, sf):
    """Row counts of the required tables; a missing one has none."""
    register_views({"checked_maps": adapter.maps(spark, sf), "checked_matches": adapter.matches(spark, sf)})
    required = ["checked_maps", "checked_matches", "never_built"]
    gone = missing_tables(spark, required)
    counts = [f"select '{n}' as name, " + ("cast(null as bigint) as rows" if n in gone else f"count(*) as rows from {n}") for n in required]
    return spark.sql(" union all ".join(counts))

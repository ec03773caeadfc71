"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.catalog.registry import query
from matchloom.operators import quality as q
from matchloom.plans import star_tests
from matchloom.plans.build import build_and_test
from matchloom.session import settle, work_dir
from matchloom.sources import adapter
from matchloom.sources.tables import raw_table

BUILD_TIME = "2002-01-01 00:00:00"


def _lines(spark, sf):
    return raw_table(spark, sf, "lineitem")


@query("dq_unique_failures", """
    select l_orderkey, count(*) as n_records from lineitem where l_orderkey is not null
    group by l_orderkey having count(*) > 1""")
def _(spark, sf):
    return q.unique_failures(_lines(spark, sf), "l_orderkey")


@query("dq_unique_combo_failures", """
    select l_orderkey, l_linenumber, l_suppkey, count(*) as n_records from lineitem
    group by all having count(*) > 1""")
def _(spark, sf):
    return q.unique_combination_failures(_lines(spark, sf), ["l_orderkey", "l_linenumber", "l_suppkey"])


@query("dq_not_null_failures", "select map_id, player_id, player_name from players where team_name is null", "players")
def _(spark, sf):
    return q.not_null_failures(adapter.players(spark, sf), "team_name").select("map_id", "player_id", "player_name")


@query("dq_orphans", """
    select o_orderkey, o_custkey from orders
    where o_orderkey is not null and not exists (select 1 from lineitem where l_orderkey = o_orderkey)""")
def _(spark, sf):
    return q.relationship_failures(
        raw_table(spark, sf, "orders"), "o_orderkey", _lines(spark, sf), "l_orderkey").select("o_orderkey", "o_custkey")


@query("dq_check_failures", """
    select map_id, match_id, map_order from maps where not (map_order between 1 and 5)""", "maps")
def _(spark, sf):
    return q.check_failures(adapter.maps(spark, sf), F.col("map_order").between(1, 5)).select(
        "map_id", "match_id", "map_order")


@query("dq_accepted_values", """
    select event, count(*) as rows from matches where event not in ('1-URGENT', '2-HIGH', '5-LOW')
    group by event""", "matches")
def _(spark, sf):
    kept = q.accepted(F.col("event"), ["1-URGENT", "2-HIGH", "5-LOW"])
    return q.check_failures(adapter.matches(spark, sf), kept).groupBy("event").agg(F.count(F.lit(1)).alias("rows"))


def _count_sql(test: q.Test) -> str:
    """Failing-row count of one declared test."""
    cols, t = test.columns, test.table
    if test.kind == "not_null":
        body = f"select count(*) from {t} where {cols[0]} is null"
    elif test.kind == "relationships":
        body = (f"select count(*) from {t} c where c.{cols[0]} is not null and not exists "
                f"(select 1 from {test.parent} p where p.{test.parent_field} = c.{cols[0]})")
    else:
        only = f"where {cols[0]} is not null" if test.kind == "unique" else ""
        body = f"select count(*) from (select 1 from {t} {only} group by {', '.join(cols)} having count(*) > 1)"
    return (f"select '{test.name}' as test, 'error' as severity, ({body}) as failures, "
            f"case when ({body}) = 0 then 'pass' else 'fail' end as status")


_SUITE_RELATIONS = f"""
with source_matches as (select * from matches), source_maps as (select * from maps),
source_players as (select * from players),
stg_matches as (select *, winner as match_winner from matches), stg_maps as (select * from maps),
stg_players as (select * from players), int_match_player_stats as (select * from enriched),
int_player_current_team as (select player_id, team_name, map_date as observed_map_date from (
  select *, row_number() over (partition by player_id order by map_date desc, map_id desc) as rn
  from enriched where team_name is not null) where rn = 1),
fact_matches as (select match_id, winner as winning_team,
  case winner when team1 then team2 when team2 then team1 end as losing_team, date as match_date, 1 as map_count
  from matches),
fact_player_map_stats as (select * from enriched),
dim_players as (select player_id, arg_max(player_name, (last_inserted_at, map_id)) as player_name
  from players group by player_id),
dim_maps as (select distinct map_name from maps),
player_roster_history_snapshot as (select player_id, team_name, timestamp '{BUILD_TIME}' as valid_from,
  md5(concat(player_id, '-{BUILD_TIME}')) as scd_id from int_player_current_team),
dim_player_roster_history as (select *, scd_id as roster_history_key, true as is_current
  from player_roster_history_snapshot)
"""


@query("dq_suite_report",
       _SUITE_RELATIONS + "\nunion all\n".join(_count_sql(t) for t in star_tests.star_tests()),
       "matches maps players enriched")
def _(spark, sf):
    base = {name: settle(df, name) for name, df in adapter.base_tables(spark, sf).items()}
    now = F.expr(f"timestamp_ntz'{BUILD_TIME}'")
    return build_and_test(**base, root=work_dir(spark, "build"), now=now)[1]


@query("dq_base_rules", """
    with counts as (
      select 'check:matches.score1 >= 0' as test, count(*) filter (where not score1 >= 0) as failures from matches
      union all select 'check:matches.score2 >= 0', count(*) filter (where not score2 >= 0) from matches
      union all select 'check:matches.winner in teams', count(*) filter (where winner not in (team1, team2)) from matches
      union all select 'check:maps.map_order in 1..5', count(*) filter (where map_order not between 1 and 5) from maps
      union all select 'check:maps.team1_score >= 0', count(*) filter (where team1_score < 0) from maps
      union all select 'check:maps.team2_score >= 0', count(*) filter (where team2_score < 0) from maps
      union all select 'unique:matches.match_url', count(*) from (
        select 1 from matches group by match_url having count(*) > 1)
      union all select 'unique:maps.map_url', count(*) from (select 1 from maps group by map_url having count(*) > 1)
      union all select 'unique_combo:maps.match_id+map_order', count(*) from (
        select 1 from maps group by match_id, map_order having count(*) > 1))
    select test, 'error' as severity, failures, case when failures = 0 then 'pass' else 'fail' end as status
    from counts""", "matches maps")
def _(spark, sf):
    tables = {"matches": adapter.matches(spark, sf), "maps": settle(adapter.maps(spark, sf), "maps")}
    return q.run_suite(star_tests.base_rules(), tables)


@query("dq_grain_flow", """
    select 'grain:matches' as "check", count(*) as total, count(distinct match_id) as matching,
      count(*) = count(distinct match_id) as ok from matches
    union all select 'grain:maps', count(*), count(distinct map_id), count(*) = count(distinct map_id) from maps
    union all select 'grain:players', count(*), count(distinct (map_id, player_id)),
      count(*) = count(distinct (map_id, player_id)) from players
    union all select 'keys:maps.match_id->matches', count(distinct a.match_id), count(distinct b.match_id),
      count(distinct a.match_id) = count(distinct b.match_id)
      from maps a left join matches b on a.match_id = b.match_id
    union all select 'keys:players.map_id->maps', count(distinct a.map_id), count(distinct b.map_id),
      count(distinct a.map_id) = count(distinct b.map_id)
      from players a left join maps b on a.map_id = b.map_id
    union all select 'keys:matches.match_id->maps', count(distinct a.match_id), count(distinct b.match_id),
      count(distinct a.match_id) = count(distinct b.match_id)
      from matches a left join maps b on a.match_id = b.match_id""", "matches maps players")
def _(spark, sf):
    t = adapter.base_tables(spark, sf)
    maps = settle(t["maps"].select("map_id", "match_id"), "maps")
    return q.grain_flow(
        [("matches", t["matches"], ["match_id"]), ("maps", maps, ["map_id"]),
         ("players", t["players"], ["map_id", "player_id"])],
        [("maps", "match_id", "matches"), ("players", "map_id", "maps"), ("matches", "match_id", "maps")])


@query("stored_failures", """
    select 'not_null' as test, map_id, player_id from players where team_name is null
    union all select 'check', map_id, player_id from players where kd_diff < -20""", "players")
def _(spark, sf):
    tests = [q.Test("players", "not_null", ("team_name",), label="not_null"),
             q.Test("players", "check", (), predicate=F.col("kd_diff") >= -20, label="check")]
    players = settle(adapter.players(spark, sf), "players")
    paths = q.store_failures(tests, {"players": players}, work_dir(spark, "failures"))
    first, second = [spark.read.schema(players.schema).parquet(path).select(F.lit(name).alias("test"), "map_id", "player_id")
                     for name, path in paths.items()]
    return first.unionByName(second)

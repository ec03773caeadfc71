"""Upsert and delete queries.

The target is everything ingested before ``CUT``; the batch is everything
since ``FROM``, so the two overlap, repeat keys and together cover every row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.catalog.registry import query
from matchloom.operators import lifecycle
from matchloom.operators import upsert as u
from matchloom.operators.latest import latest_by
from matchloom.plans import declared
from matchloom.plans import models as m
from matchloom.schemas import MAPS, PLAYERS
from matchloom.sources import adapter
from matchloom.sources.tables import raw_table

CUT, FROM = "1998-07-01", "1998-01-01"


def _before(column):
    return F.col(column) < F.expr(f"timestamp_ntz'{CUT} 00:00:00'")


def _since(column):
    return F.col(column) >= F.expr(f"timestamp_ntz'{FROM} 00:00:00'")


def _full_outer(key: list[str], new: list[str], keep: list[str], order: str) -> str:
    on = " and ".join(f"o.{k} = n.{k}" for k in key)
    keys = ", ".join(f"coalesce(o.{k}, n.{k}) as {k}" for k in key)
    fresh = ", ".join(f"case when n.{key[0]} is not null then n.{c} else o.{c} end as {c}" for c in new)
    kept = ", ".join(f"case when o.{key[0]} is not null then o.{c} else f.{c} end as {c}" for c in keep)
    part = ", ".join(key)
    f_on = " and ".join(f"n.{k} = f.{k}" for k in key)
    desc = ", ".join(f"{c} desc" for c in order.split())
    asc = ", ".join(order.split())
    return f"""
    newest as (select * from (select *, row_number() over (partition by {part} order by {desc}) as rn from batch) where rn = 1),
    oldest as (select * from (select *, row_number() over (partition by {part} order by {asc}) as rn from batch) where rn = 1)
    select {keys}, {fresh}, {kept} from target o full outer join newest n on {on} left join oldest f on {f_on}"""


_MATCH_NEW = ["match_url", "team1", "team2", "score1", "score2", "winner", "event", "match_type", "forfeit", "date",
              "last_scraped_at", "last_updated_at", "data_complete"]


@query("upsert_matches", f"""
    with target as (select * from matches where date < timestamp '{CUT}'),
    batch as (select * replace (score1 + 1 as score1, last_updated_at + interval 9 day as last_updated_at,
      last_inserted_at + interval 9 day as last_inserted_at, event || '!' as event)
      from matches where date >= timestamp '{FROM}'),
    {_full_outer(["match_id"], _MATCH_NEW, ["last_inserted_at"], "date")}""", "matches")
def _(spark, sf):
    rows = m_rows = adapter.matches(spark, sf).drop("map_links", "demo_links")
    later = F.expr("interval 9 day")
    batch = m_rows.filter(_since("date")).withColumns({
        "score1": F.col("score1") + 1, "last_updated_at": F.col("last_updated_at") + later,
        "last_inserted_at": F.col("last_inserted_at") + later, "event": F.concat("event", F.lit("!"))})
    return u.upsert(rows.filter(_before("date")), batch, ["match_id"], {"last_inserted_at": "keep"})


_MAP_NEW = ["match_id", "map_url", "map_order", "map_name", "team1_score", "team2_score", "map_winner", "date",
            "last_scraped_at", "last_updated_at", "data_complete"]
_MAP_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
_MAP_SQL = f"""
    with target as (select * from (select *, row_number() over (partition by map_id order by
        l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc) as rn
      from map_rows where date < timestamp '{CUT}') where rn = 1),
    batch as (select * replace (team2_score + 1 as team2_score) from map_rows where date >= timestamp '{FROM}'),
    {_full_outer(["map_id"], _MAP_NEW, ["inserted_at"], " ".join(_MAP_ORDER))}"""


def _map_target_and_batch(spark, sf):
    rows = adapter.map_rows(spark, sf)
    target = latest_by(rows.filter(_before("date")), ["map_id"], [F.col(c).desc() for c in _MAP_ORDER])
    batch = rows.filter(_since("date")).withColumn("team2_score", F.col("team2_score") + 1)
    return target.select(*MAPS.names), batch


def _upsert_maps(target, batch):
    return u.upsert(target, batch, ["map_id"], {"inserted_at": "keep"}, [F.col(c) for c in _MAP_ORDER])


@query("upsert_maps", _MAP_SQL, "map_rows")
def _(spark, sf):
    return _upsert_maps(*_map_target_and_batch(spark, sf))


@query("upsert_idempotent", _MAP_SQL, "map_rows")
def _(spark, sf):
    target, batch = _map_target_and_batch(spark, sf)
    return _upsert_maps(_upsert_maps(target, batch), batch)


_PLAYER_ORDER = ["l_shipdate", "l_partkey", "l_quantity", "l_extendedprice"]
_PLAYER_NEW = [c for c in PLAYERS.names if c not in ("map_id", "player_id", "last_inserted_at")]


@query("upsert_players", f"""
    with target as (select * from (select *, row_number() over (partition by map_id, player_id order by
        l_shipdate desc, l_partkey desc, l_quantity desc, l_extendedprice desc) as rn
      from player_rows where l_shipdate < timestamp '{CUT}') where rn = 1),
    batch as (select * replace (kills + 1 as kills) from player_rows where l_shipdate >= timestamp '{FROM}'),
    {_full_outer(["map_id", "player_id"], _PLAYER_NEW, ["last_inserted_at"], " ".join(_PLAYER_ORDER))}""", "player_rows")
def _(spark, sf):
    rows = adapter.player_rows(spark, sf)
    target = latest_by(rows.filter(_before("l_shipdate")), ["map_id", "player_id"],
                       [F.col(c).desc() for c in _PLAYER_ORDER])
    batch = rows.filter(_since("l_shipdate")).withColumn("kills", F.col("kills") + 1)
    return u.upsert(target.select(*PLAYERS.names), batch, ["map_id", "player_id"],
                    {"last_inserted_at": "keep"}, [F.col(c) for c in _PLAYER_ORDER])


def map_sightings(spark, sf):
    """Each line as one sighting of a map; some sightings lack their parent context."""
    rows = raw_table(spark, sf, "lineitem")
    map_id = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return rows.select(
        map_id.alias("map_id"), F.concat(F.lit("/mapstatsid/"), map_id, F.lit("/"), F.col("l_suppkey")).alias("map_url"),
        F.when(F.col("l_returnflag") != "R", F.col("l_orderkey")).alias("match_id"),
        F.when(F.col("l_linestatus") == "F", F.col("l_linenumber").cast("bigint")).alias("map_order"),
        F.concat(F.lit("scan"), F.col("l_returnflag")).alias("source"), (F.col("l_partkey") % 10).alias("priority"),
        F.col("l_shipdate").alias("seen"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity"),
        F.col("l_extendedprice"))


_SIGHT_ORDER = ["seen", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "map_url", "source"]
_SIGHT_ARG = "(seen, l_partkey, l_suppkey, l_quantity, l_extendedprice, map_url, source)"


def map_state(spark, sf):
    """Map state after every sighting, recorded in two runs."""
    seen = map_sightings(spark, sf)
    rows = lifecycle.discovery_rows(seen, F.col("seen"), F.col("source"), F.col("priority"))
    order = [F.col(c) for c in [*_SIGHT_ORDER]]
    columns = ["map_id", "map_url", "match_id", "map_order", "status", "first_seen_at", "last_seen_at",
               "failure_count", "source", "priority", "last_updated_at"]
    empty = rows.select(*columns).filter(F.lit(False))
    first = lifecycle.discover(empty, rows.filter(_before("seen")), "map_id", order)
    return lifecycle.discover(first, rows.filter(~_before("seen")), "map_id", order)


MAP_STATE_SQL = f"""
    select map_id, arg_max(map_url, {_SIGHT_ARG}) as map_url, arg_max(match_id, {_SIGHT_ARG}) filter (where match_id is not null) as match_id,
      arg_max(map_order, {_SIGHT_ARG}) filter (where map_order is not null) as map_order, 'discovered' as status,
      min(seen) as first_seen_at, max(seen) as last_seen_at, cast(0 as bigint) as failure_count,
      arg_max(source, {_SIGHT_ARG}) as source, max(priority) as priority, max(seen) as last_updated_at
    from (select l_orderkey * 10 + l_linenumber as map_id,
        concat('/mapstatsid/', l_orderkey * 10 + l_linenumber, '/', l_suppkey) as map_url,
        case when l_returnflag <> 'R' then l_orderkey end as match_id,
        case when l_linestatus = 'F' then cast(l_linenumber as bigint) end as map_order,
        concat('scan', l_returnflag) as source, l_partkey % 10 as priority, l_shipdate as seen,
        l_partkey, l_suppkey, l_quantity, l_extendedprice from lineitem)
    group by map_id"""


@query("map_discovery_upsert", MAP_STATE_SQL)
def _(spark, sf):
    return map_state(spark, sf)


DELETED_EVENT = "1-URGENT"


@query("cascade_delete", f"""
    with gone as (select match_id from matches where event = '{DELETED_EVENT}')
    select 'matches' as table_name, match_id as k1, cast(null as bigint) as k2 from matches t
      where not exists (select 1 from gone g where g.match_id = t.match_id)
    union all select 'maps', map_id, null from maps t
      where not exists (select 1 from gone g where g.match_id = t.match_id)
    union all select 'players', map_id, player_id from players p where not exists (
      select 1 from maps t join gone g on g.match_id = t.match_id where t.map_id = p.map_id)""", "matches maps players")
def _(spark, sf):
    tables = adapter.base_tables(spark, sf)
    keys = tables["matches"].filter(F.col("event") == DELETED_EVENT).select("match_id")
    left = u.cascade_delete(
        tables, "matches", keys,
        [("maps", "match_id", "matches", "match_id", "cascade"), ("players", "map_id", "maps", "map_id", "cascade")],
        {"matches": ["match_id"], "maps": ["map_id"], "players": ["map_id", "player_id"]})
    none = F.lit(None).cast("bigint").alias("k2")
    parts = [("matches", "match_id", none), ("maps", "map_id", none), ("players", "map_id", F.col("player_id").alias("k2"))]
    first, *rest = [left[t].select(F.lit(t).alias("table_name"), F.col(k1).alias("k1"), k2) for t, k1, k2 in parts]
    for part in rest:
        first = first.unionByName(part)
    return first


@query("set_null_delete", """
    select player_id, case when team_name in ('T3', 'T7', 'T11') then null else team_name end as team_name from (
      select *, row_number() over (partition by player_id order by map_date desc, map_id desc) as rn
      from enriched where team_name is not null) where rn = 1""", "enriched")
def _(spark, sf):
    staged = m.stg_matches(adapter.matches(spark, sf))
    rows = m.int_match_player_stats(
        m.stg_players(adapter.players(spark, sf)), m.stg_maps(adapter.maps(spark, sf)), staged)
    members = m.int_player_current_team(rows).select("player_id", "team_name")
    gone = declared.dim_teams(staged).filter(F.col("team_name").isin("T3", "T7", "T11"))
    return u.null_on_delete(members, "team_name", gone, "team_name")

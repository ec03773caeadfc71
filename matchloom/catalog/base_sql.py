"""The adapter formulas once more, as portable SQL for the expected results."""

from __future__ import annotations

SITE = "https://example.test"

MATCHES = f"""
select o_orderkey as match_id,
  concat('{SITE}/matches/', o_orderkey, '/a-vs-b') as match_url,
  concat('T', o_custkey % 25) as team1,
  concat('T', (o_custkey % 25 + 1 + o_orderkey % 24) % 25) as team2,
  o_orderkey % 3 as score1, (o_orderkey * 7 + o_custkey) % 3 as score2,
  case when o_orderkey % 3 > (o_orderkey * 7 + o_custkey) % 3 then concat('T', o_custkey % 25)
       else concat('T', (o_custkey % 25 + 1 + o_orderkey % 24) % 25) end as winner,
  o_orderpriority as event,
  case o_orderkey % 3 when 0 then 'bo1' when 1 then 'bo3' else 'bo5' end as match_type,
  o_orderstatus = 'P' as forfeit, o_orderdate as date,
  o_orderdate + interval 1 day as last_inserted_at, o_orderdate + interval 2 day as last_scraped_at,
  o_orderdate + interval 2 day as last_updated_at, o_orderkey % 11 <> 0 as data_complete
from orders
"""

MAP_ROWS = f"""
select l_orderkey * 10 + l_linenumber as map_id, l_orderkey as match_id,
  concat('{SITE}/stats/matches/mapstatsid/', l_orderkey * 10 + l_linenumber, '/x') as map_url,
  cast(l_linenumber as bigint) as map_order, p_type as map_name,
  cast(round(l_quantity) as bigint) as team1_score, l_partkey % 20 as team2_score,
  case when cast(round(l_quantity) as bigint) > l_partkey % 20 then m.team1 else m.team2 end as map_winner,
  l_shipdate as date, l_shipdate + interval 1 day as inserted_at,
  l_shipdate + interval 2 day as last_scraped_at, l_shipdate + interval 2 day as last_updated_at,
  true as data_complete, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice
from lineitem join part on l_partkey = p_partkey join matches m on m.match_id = l_orderkey
"""

MAPS = """
select map_id, match_id, map_url, map_order, map_name, team1_score, team2_score, map_winner, date,
  inserted_at, last_scraped_at, last_updated_at, data_complete
from (select *, row_number() over (partition by map_id order by l_shipdate desc, l_partkey desc,
        l_suppkey desc, l_quantity desc, l_extendedprice desc) as rn from map_rows) where rn = 1
"""

PLAYER_ROWS = f"""
select l_orderkey * 10 + l_linenumber as map_id, l_suppkey as player_id,
  case when year(l_shipdate) >= 1999 then concat(s_name, '_v2') else s_name end as player_name,
  concat('{SITE}/player/', l_suppkey, '/p') as player_url, p_type as map_name,
  case when l_partkey % 17 = 0 then null else concat('T', (l_suppkey + year(l_shipdate)) % 25) end as team_name,
  cast(round(l_quantity) as bigint) as kills, cast(round(l_quantity) as bigint) % 9 as headshots,
  l_partkey % 11 as assists, l_partkey % 4 as flash_assists, l_partkey % 30 as deaths,
  l_suppkey % 6 as traded_deaths, l_partkey % 7 as opening_kills, l_suppkey % 5 as opening_deaths,
  l_partkey % 5 as multi_kills, l_partkey % 3 as clutches_won,
  cast(40 + l_partkey % 60 as double) / 100 as kast,
  cast(round(l_quantity) as bigint) - l_partkey % 30 as kd_diff,
  cast(300 + l_partkey % 900 as double) / 10 as adr,
  l_partkey % 7 - l_suppkey % 5 as fk_diff,
  cast(l_partkey % 2001 - 1000 as double) / 10000 as round_swing,
  case when l_partkey % 23 = 0 then null
       else cast(50 + (l_partkey * 13 + l_suppkey * 7) % 150 as double) / 100 end as rating,
  l_shipdate + interval 1 day as last_inserted_at, l_shipdate + interval 2 day as last_scraped_at,
  l_shipdate + interval 2 day as last_updated_at, true as data_complete,
  l_shipdate, l_partkey, l_quantity, l_extendedprice
from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
"""

PLAYERS = """
select * exclude (rn, l_shipdate, l_partkey, l_quantity, l_extendedprice)
from (select *, row_number() over (partition by map_id, player_id order by l_shipdate desc,
        l_partkey desc, l_quantity desc, l_extendedprice desc) as rn from player_rows) where rn = 1
"""

ENRICHED = """
select p.map_id, p.player_id, m.match_id, t.team1, t.team2, t.winner as match_winner, t.event, t.match_type,
  t.date as match_date, m.map_order, m.map_name, m.map_winner, m.team1_score as map_team1_score,
  m.team2_score as map_team2_score, m.date as map_date, p.player_name, p.player_url, p.team_name,
  p.kills, p.headshots, p.assists, p.flash_assists, p.deaths, p.traded_deaths, p.opening_kills,
  p.opening_deaths, p.multi_kills, p.clutches_won, p.kast, p.kd_diff, p.adr, p.fk_diff, p.round_swing, p.rating
from players p join maps m on p.map_id = m.map_id join matches t on m.match_id = t.match_id
"""

LOG = f"""
select user_id as id, ts, event_id as seq,
  case event_type when 'signup' then 'discover' when 'view' then 'processing' when 'purchase' then 'processed'
    when 'error' then 'failed' when 'click' then 'skipped' end as op,
  case when event_type in ('error', 'click') then props end as reason,
  case when event_type = 'signup' then concat('{SITE}/matches/', user_id, '/e', event_id) end as url,
  case when event_type = 'signup' then concat('feed', event_id % 3) end as source,
  case when event_type = 'signup' then cast(round(value) as bigint) % 10 end as priority
from events
"""

# Commands from an entity's first discovery on; earlier ones find no row to change.
LIVE_LOG = """
select l.*, f.first_ts from log l
join (select id, min(ts) as first_ts from log where op = 'discover' group by id) f on f.id = l.id
where l.ts >= f.first_ts
"""

# Final state rows: a rediscovery refreshes url, source and priority but keeps the status.
STATE = """
select id, arg_max(url, ts) filter (where op = 'discover') as url,
  arg_max(case when op = 'discover' then 'discovered' else op end, ts)
    filter (where op <> 'discover' or ts = first_ts) as status,
  min(first_ts) as first_seen_at,
  max(ts) filter (where op = 'discover') as last_seen_at,
  max(ts) filter (where op = 'processing') as last_attempted_at,
  max(ts) filter (where op = 'processed') as last_processed_at,
  max(ts) filter (where op = 'failed') as last_failed_at,
  count(*) filter (where op = 'failed') as failure_count,
  arg_max(reason, ts) filter (where op in ('failed', 'skipped')) as last_error_message,
  arg_max(source, ts) filter (where op = 'discover') as source,
  max(priority) as priority, max(ts) as last_updated_at
from live_log group by id
"""

RELATIONS = {
    "matches": (MATCHES, []),
    "map_rows": (MAP_ROWS, ["matches"]),
    "maps": (MAPS, ["map_rows"]),
    "player_rows": (PLAYER_ROWS, []),
    "players": (PLAYERS, ["player_rows"]),
    "enriched": (ENRICHED, ["players", "maps", "matches"]),
    "log": (LOG, []),
    "live_log": (LIVE_LOG, ["log"]),
    "state": (STATE, ["live_log"]),
}


def with_tables(names: list[str], sql: str) -> str:
    """Prefix ``sql`` with the named relations and what they are built from."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for parent in RELATIONS[name][1]:
            add(parent)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return sql.strip()
    ctes = ",\n".join(f"{name} as ({RELATIONS[name][0].strip()})" for name in ordered)
    body = sql.strip()
    joiner = ",\n" if body[:5].lower() == "with " else "\n"
    return f"with {ctes}{joiner}{body[5:] if joiner.startswith(',') else body}"

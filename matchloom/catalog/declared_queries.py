"""Queries over the further models."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.catalog.lifecycle_queries import ATTEMPT_ORDER, attempts, event_state
from matchloom.catalog.model_queries import enriched
from matchloom.catalog.registry import query
from matchloom.operators import quality as q
from matchloom.operators.latest import latest_by
from matchloom.plans import declared as d
from matchloom.plans import models as m
from matchloom.sources import adapter
from matchloom.sources.tables import raw_table


def _matches(spark, sf):
    return m.stg_matches(adapter.matches(spark, sf))


def _mean(column: str, scale: int) -> str:
    """Mean to four places, half up, in whole numbers; ``scale`` makes the values whole."""
    factor = 10000 // scale
    total = f"sum(cast(round({column} * {scale}) as bigint))"
    return (f"case when count({column}) > 0 then cast((2 * {factor} * {total} + count({column})) "
            f"// (2 * count({column})) as double) / 10000 end")


@query("team_match_results", """
    select match_id, event, date as match_date, team1 as team_name, team2 as opponent_team_name,
      winner = team1 as won_match, score1 as score_for, score2 as score_against from matches
    union all select match_id, event, date, team2, team1, winner = team2, score2, score1 from matches""", "matches")
def _(spark, sf):
    return d.team_match_results(_matches(spark, sf))


@query("player_match_stats", f"""
    select match_id, player_id, arg_max(player_name, (map_order, map_id)) as player_name,
      cast(sum(kills) as bigint) as total_kills, cast(sum(deaths) as bigint) as total_deaths,
      cast(sum(assists) as bigint) as total_assists, {_mean('rating', 100)} as avg_rating,
      {_mean('adr', 10)} as avg_adr, {_mean('kast', 100)} as avg_kast, max(event) as event, max(match_date) as match_date
    from enriched group by match_id, player_id""", "enriched")
def _(spark, sf):
    return d.player_match_stats(enriched(spark, sf))


@query("event_matches", "select event as event_name, match_id, date as match_date from matches", "matches")
def _(spark, sf):
    return d.event_matches(_matches(spark, sf))


@query("dim_events", """
    select event as event_name, min(date) as first_seen_date, max(date) as last_seen_date
    from matches group by event""", "matches")
def _(spark, sf):
    return d.dim_events(_matches(spark, sf))


@query("dim_teams", "select team1 as team_name from matches union select team2 from matches", "matches")
def _(spark, sf):
    return d.dim_teams(_matches(spark, sf))


@query("team_map_win_rate", """
    select team_name, map_name, count(*) as maps_played, count(*) filter (where map_winner = team_name) as maps_won,
      cast(count(*) filter (where map_winner = team_name) as double) / count(*) as win_rate
    from maps m join (select match_id, team1 as team_name from matches union all select match_id, team2 from matches) t
      on t.match_id = m.match_id group by team_name, map_name""", "matches maps")
def _(spark, sf):
    return d.team_map_win_rate(_matches(spark, sf), adapter.maps(spark, sf))


@query("player_metrics", """
    select player_id, map_name, cast(sum(kills) as double) / count(kills) as average_kills,
      count(distinct match_id) as matches_played from enriched group by player_id, map_name""", "enriched")
def _(spark, sf):
    return d.player_metrics(enriched(spark, sf))


@query("player_aliases", """
    select player_id, player_name as alias, last_inserted_at as changed_at, map_id from (
      select *, lag(player_name) over (partition by player_id order by last_inserted_at, map_id) as before from players)
    where before is not null and before <> player_name""", "players")
def _(spark, sf):
    return d.player_aliases(m.stg_players(adapter.players(spark, sf)))


_MOVES = """
    moves as (select * from (
      select player_id, player_name, team_name, map_date, map_id,
        lag(team_name) over (partition by player_id order by map_date, map_id) as before
      from enriched where team_name is not null) where before is null or before <> team_name)
"""


@query("player_transfers", f"""with {_MOVES.strip()}
    select player_id, player_name, before as old_team_name, team_name as new_team_name,
      cast(map_date as date) as transfer_date, map_id from moves where before is not null""", "enriched")
def _(spark, sf):
    return d.player_transfers(enriched(spark, sf))


@query("player_team_history", f"""with {_MOVES.strip()}
    select player_id, player_name, team_name, cast(map_date as date) as start_date,
      cast(lead(map_date) over (partition by player_id order by map_date, map_id) as date) as end_date, map_id
    from moves""", "enriched")
def _(spark, sf):
    return d.player_team_history(enriched(spark, sf))


@query("scrape_runs", f"""
    with lines as (select *, date_trunc('month', l_shipdate) as run from lineitem),
    tried as (select *, row_number() over (partition by run, l_orderkey order by {', '.join(ATTEMPT_ORDER)}) as n from lines),
    stop as (select run, l_orderkey, min(n) as n from tried where l_returnflag in ('A', 'N') or n = 3 group by 1, 2),
    final as (select t.run, t.l_orderkey, bool_or(t.n = s.n and l_returnflag = 'A') as ok, s.n is not null as ended
      from tried t left join stop s using (run, l_orderkey) group by t.run, t.l_orderkey, s.n),
    spans as (select run, min(l_shipdate) as started_at, max(l_shipdate) as ended_at from lines group by run)
    select run, any_value(started_at) as started_at, any_value(ended_at) as ended_at, count(*) as total_matches,
      count(*) filter (where ended and ok) as matches_success, count(*) filter (where ended and not ok) as matches_failed
    from final join spans using (run) group by run""")
def _(spark, sf):
    rows = attempts(spark, sf).withColumn(
        "run", F.date_trunc("month", F.col("l_shipdate")).cast("timestamp_ntz"))
    return d.scrape_runs(rows, ["run"], ["l_orderkey"], "l_shipdate", [F.col(c) for c in ATTEMPT_ORDER])


@query("data_complete_rule", """
    select map_id, player_id, team_name is not null and rating is not null as data_complete from players""", "players")
def _(spark, sf):
    return d.with_completeness(adapter.players(spark, sf), "players").select("map_id", "player_id", "data_complete")


@query("match_completeness", """
    with map_state as (select map_id, match_id, s.status from maps
      left join state s on s.id = match_id % (select count(*) from state))
    select t.match_id, count(map_id) as maps, count(*) filter (where s.status in ('processed', 'skipped', 'dead')) as maps_done,
      case when count(map_id) > count(*) filter (where s.status in ('processed', 'skipped', 'dead')) then 'partial'
           else 'processed' end as status
    from matches t left join map_state s on s.match_id = t.match_id group by t.match_id""", "matches maps state")
def _(spark, sf):
    state = event_state(spark, sf).select(F.col("id").alias("slot"), "status")
    size = event_state(spark, sf).agg(F.count(F.lit(1))).scalar()
    maps = adapter.maps(spark, sf).select("map_id", "match_id", (F.col("match_id") % size).alias("slot"))
    return d.match_completeness(_matches(spark, sf), maps.join(state, "slot", "left"))


@query("winner_mismatches", """
    select map_id, m.match_id, map_winner, team1, team2 from (
      select map_id, match_id, case when map_order > 5 then 'T99' else map_winner end as map_winner from maps) m
    join matches t on t.match_id = m.match_id where map_winner not in (team1, team2)""", "matches maps")
def _(spark, sf):
    maps = adapter.maps(spark, sf).withColumn(
        "map_winner", F.when(F.col("map_order") > 5, "T99").otherwise(F.col("map_winner")))
    return d.winner_mismatches(maps, _matches(spark, sf))


@query("incremental_fact", """
    with audited as (select map_id, player_id, map_date, kills, map_date + interval 1 day * (player_id % 3) as written_at from enriched),
    built as (select * from audited where written_at <= timestamp '1999-12-31'),
    edge as (select max(written_at) - interval 1 day as since from built)
    select map_id, player_id, map_date, written_at, case when written_at >= since then kills + 1 else kills end as kills
    from audited, edge""", "enriched")
def _(spark, sf):
    rows = enriched(spark, sf).select("map_id", "player_id", "map_date", "kills", (
        F.col("map_date") + F.make_dt_interval(F.col("player_id") % 3)).alias("written_at"))
    built = rows.filter(F.col("written_at") <= F.expr("timestamp_ntz'1999-12-31 00:00:00'"))
    return d.incremental_fact(built, rows.withColumn("kills", F.col("kills") + 1), ["map_id", "player_id"], "written_at",
                              F.expr("interval 1 day"))


@query("source_freshness", """
    with ages as (
      select 'matches' as source, max(last_scraped_at) as newest from matches
      union all select 'maps', max(last_scraped_at) from maps
      union all select 'players', max(last_scraped_at) from players)
    select *, date_sub('hour', newest, timestamp '2001-11-20') as age_hours,
      case when date_sub('hour', newest, timestamp '2001-11-20') >= 1000 then 'error'
           when date_sub('hour', newest, timestamp '2001-11-20') >= 300 then 'warn' else 'pass' end as status
    from ages""", "matches maps players")
def _(spark, sf):
    tables = {name: (df, "last_scraped_at") for name, df in adapter.base_tables(spark, sf).items()}
    return q.freshness(tables, F.expr("timestamp_ntz'2001-11-20 00:00:00'"), 300, 1000)


@query("severity_report", """
    select 'check:players.rating filled' as test, 'warn' as severity, count(*) filter (where rating is null) as failures,
      case when count(*) filter (where rating is null) = 0 then 'pass' else 'warn' end as status from players
    union all select 'not_null:players.team_name', 'error', count(*) filter (where team_name is null),
      case when count(*) filter (where team_name is null) = 0 then 'pass' else 'fail' end from players""", "players")
def _(spark, sf):
    tests = [q.Test("players", "check", (), predicate=F.col("rating").isNotNull(), label="check:players.rating filled",
                    severity="warn"),
             q.Test("players", "not_null", ("team_name",))]
    return q.run_suite(tests, {"players": adapter.players(spark, sf)})


@query("stat_scopes", """
    select map_id, player_id, 'total' as stat_scope, kills, deaths from players
    union all select map_id, player_id, 'opening', opening_kills, opening_deaths from players""", "players")
def _(spark, sf):
    return d.stat_scopes(adapter.players(spark, sf), ["map_id", "player_id"], {
        "total": {"kills": "kills", "deaths": "deaths"},
        "opening": {"kills": "opening_kills", "deaths": "opening_deaths"}})


@query("map_highlights", """
    with long as (
      select map_id, player_id, player_name, 'most_kills' as highlight_type, cast(kills as double) as value from players
      union all select map_id, player_id, player_name, 'most_assists', assists from players
      union all select map_id, player_id, player_name, 'most_adr', adr from players
      union all select map_id, player_id, player_name, 'most_opening_kills', opening_kills from players
      union all select map_id, player_id, player_name, 'most_rating', rating from players where rating is not null)
    select * exclude (r), r as rank from (
      select *, cast(row_number() over (partition by map_id, highlight_type order by value desc, player_id) as integer) as r
      from long) where r = 1""", "players")
def _(spark, sf):
    return d.map_highlights(adapter.players(spark, sf, by_map=True), ["kills", "assists", "adr", "opening_kills", "rating"])


_LINKS = """
    select match_id, concat('[', string_agg(concat('{"map_id":', match_id * 10 + n, ',"map_url":"',
      'https://example.test/stats/matches/mapstatsid/', match_id * 10 + n, '/x"}'), ',' order by n), ']') as map_links,
      max(case when match_id % 4 = 0 then concat('[{"demo_id":"', match_id,
        '","demo_url":"https://example.test/download/demo/', match_id, '/x"}]') else '[]' end) as demo_links
    from (select match_id, unnest(range(1, 2 + match_id % 3)) as n from matches) group by match_id
"""


@query("links_as_json", _LINKS, "matches")
def _(spark, sf):
    return d.links_to_json(adapter.matches(spark, sf)).select("match_id", "map_links", "demo_links")


@query("links_round_trip", """
    select match_id, 1 + match_id % 3 as maps, case when match_id % 4 = 0 then 1 else 0 end as demos,
      match_id * 10 + 1 + match_id % 3 as last_map_id from matches""", "matches")
def _(spark, sf):
    back = d.links_from_json(d.links_to_json(adapter.matches(spark, sf)))
    return back.select(
        "match_id", F.size("map_links").cast("bigint").alias("maps"), F.size("demo_links").alias("demos"),
        F.element_at("map_links", -1)["map_id"].alias("last_map_id"))


@query("page_snapshots", """
    select url, arg_max(page_id, page_id) as page_id, arg_max(html, page_id) as html from (
      select page_id, html, regexp_replace(url, '[?#].*$', '') as url from pages) group by url""")
def _(spark, sf):
    rows = raw_table(spark, sf, "pages").withColumn("url", F.regexp_replace("url", "[?#].*$", ""))
    return latest_by(rows, ["url"], [F.col("page_id").desc()])


@query("zone_normalised", """
    select match_id, timezone('UTC', timezone('Europe/Copenhagen', last_scraped_at)) as last_scraped_at from matches""",
       "matches")
def _(spark, sf):
    rows = adapter.matches(spark, sf).select("match_id", "last_scraped_at")
    return d.normalise_zone(rows, ["last_scraped_at"], "Europe/Copenhagen")


@query("recent_matches", """
    select match_id, event, team1, team2, winner as match_winner, date from matches where event = '2-HIGH'
      and (date < timestamp '2000-06-01' or (date = timestamp '2000-06-01' and match_id < 900000))
    order by date desc, match_id desc limit 50""", "matches")
def _(spark, sf):
    page = d.recent_matches(_matches(spark, sf), 50, (F.expr("timestamp_ntz'2000-06-01 00:00:00'"), F.lit(900000)), "2-HIGH")
    return page.select("match_id", "event", "team1", "team2", "match_winner", "date")

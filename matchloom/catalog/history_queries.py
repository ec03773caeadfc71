"""History queries: snapshot runs, roster dimension, point-in-time joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.catalog.model_queries import enriched
from matchloom.catalog.registry import query
from matchloom.operators import asof, scd2
from matchloom.plans import models as m
from matchloom.plans.build import roster_observations, roster_runs
from matchloom.session import settle
from matchloom.sources import adapter

YEARS = range(1996, 2003)
RUNS_SQL = "runs as (select make_timestamp(y, 1, 1, 0, 0, 0.0) as run_at from range(1996, 2003) r(y))"

HISTORY_SQL = f"""
with {RUNS_SQL},
seen as (select r.run_at, e.player_id, arg_max(team_name, (map_date, map_id)) as team_name, max(map_date) as observed_map_date
  from runs r join enriched e on e.map_date <= r.run_at where e.team_name is not null and e.player_id is not null
  group by r.run_at, e.player_id),
marked as (select *, lag(team_name) over (partition by player_id order by run_at) as before from seen),
opened as (select * from marked where before is null or before <> team_name),
history as (select player_id, team_name, observed_map_date, md5(concat(player_id, '-', run_at)) as scd_id,
  run_at as valid_from, lead(run_at) over (partition by player_id order by run_at) as valid_to, run_at as updated_at
  from opened)
"""


def observed(spark, sf):
    return roster_observations(enriched(spark, sf), roster_runs(YEARS))


def backfilled(seen):
    return scd2.scd2_backfill(seen, "player_id", ["team_name"])


@query("scd2_history", f"{HISTORY_SQL} select * from history", "enriched")
def _(spark, sf):
    runs = roster_runs(YEARS)
    seen = settle(roster_observations(enriched(spark, sf), runs), "observations")
    history = scd2.empty_history(seen.drop("run_at"), "player_id")
    for now in runs:
        # Each run is a job of its own that reads the table the run before wrote.
        current = scd2.current_at(seen, "player_id", now)
        history = settle(scd2.scd2_apply(history, current, "player_id", ["team_name"], now), "history")
    return history


@query("scd2_backfill", f"{HISTORY_SQL} select * from history", "enriched")
def _(spark, sf):
    return backfilled(observed(spark, sf))


@query("roster_dim", f"""{HISTORY_SQL}
    select scd_id as roster_history_key, player_id, team_name, observed_map_date, valid_from, valid_to,
      valid_to is null as is_current from history""", "enriched")
def _(spark, sf):
    return scd2.roster_dim(backfilled(observed(spark, sf)))


@query("roster_as_of", f"""{HISTORY_SQL}
    select h.player_id, player_name from history h join (
      select player_id, arg_max(player_name, (last_inserted_at, map_id)) as player_name from players group by player_id) p
      on p.player_id = h.player_id
    where team_name = 'T5' and valid_from <= timestamp '1998-06-01'
      and (valid_to > timestamp '1998-06-01' or valid_to is null)""", "enriched")
def _(spark, sf):
    names = m.dim_players(m.stg_players(adapter.players(spark, sf)))
    return asof.roster_as_of(scd2.roster_dim(backfilled(observed(spark, sf))), names, "T5",
                             F.expr("timestamp_ntz'1998-06-01 00:00:00'"))


@query("fact_roster_asof", f"""{HISTORY_SQL}
    select e.map_id, e.player_id, e.map_date, e.team_name, h.team_name as roster_team
    from enriched e join history h on h.player_id = e.player_id
      and h.valid_from <= e.map_date and (h.valid_to > e.map_date or h.valid_to is null)""", "enriched")
def _(spark, sf):
    # The fact is a stored table; the history and both passes of the join read it.
    facts = settle(enriched(spark, sf).select("map_id", "player_id", "map_date", "team_name"), "facts")
    seen = roster_observations(facts, roster_runs(YEARS))
    history = scd2.scd2_backfill(seen, "player_id", ["team_name"]).withColumnRenamed("team_name", "roster_team")
    return asof.interval_join(facts, history, ["player_id"], "map_date", ["roster_team"], ["map_id"])


@query("snapshot_rerun", f"""{HISTORY_SQL}
    select player_id, team_name, valid_from, valid_to from history""", "enriched")
def _(spark, sf):
    # The rerun sees what the runs before it saw; a player has one row per run, so that is small.
    seen = settle(observed(spark, sf), "observations")
    history = settle(backfilled(seen), "history")
    last = roster_runs(YEARS)[-1]
    again = scd2.scd2_apply(history, scd2.current_at(seen, "player_id", last), "player_id", ["team_name"],
                            last + F.expr("interval 1 day"))
    return again.select("player_id", "team_name", "valid_from", "valid_to")

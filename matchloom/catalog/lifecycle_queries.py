"""Lifecycle queries: replay, claims, requeue, outcomes and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.catalog.registry import query
from matchloom.catalog.write_queries import MAP_STATE_SQL, map_state
from matchloom.functions.scalar import recode_down, recode_up
from matchloom.operators import lifecycle as lc
from matchloom.operators.attempts import fold_attempts, run_summary
from matchloom.sources import adapter
from matchloom.sources.tables import raw_table


def event_log(spark, sf):
    return adapter.lifecycle_log(raw_table(spark, sf, "events"))


def event_state(spark, sf):
    return lc.apply_log(event_log(spark, sf), requeues=False)


# Every command of an entity folded one after another, from its first discovery on.
FOLDED = """
folded as (
  select id, list_reduce(list({'op': case when op = 'discover' and ts = first_ts then 'discovered' else op end,
      'expected': expected, 'ts': ts} order by ts),
    lambda a, x: case
      when x.op = 'requeue' and x.expected = a.op then {'op': 'discovered', 'expected': a.expected, 'ts': x.ts}
      when x.op = 'requeue' then a
      when x.op = 'discover' then {'op': a.op, 'expected': a.expected, 'ts': x.ts}
      else x end) as s
  from (select l.* exclude (op), case when op = 'processed' and seq % 3 = 0 then 'requeue' else op end as op,
      case when op = 'processed' and seq % 3 = 0 then
        case seq % 9 when 0 then 'failed' when 3 then 'skipped' else 'discovered' end end as expected
    from live_log l)
  group by id)
"""


@query("state_replay", "select * from state", "state")
def _(spark, sf):
    return event_state(spark, sf)


REQUEUED_SQL = f"""
    with {FOLDED.strip()}
    select s.id, s.url, f.s.op as status, s.first_seen_at, s.last_seen_at, s.last_attempted_at,
      p.last_processed_at, s.last_failed_at, s.failure_count, s.last_error_message, s.source, s.priority,
      f.s.ts as last_updated_at
    from state s join folded f on f.id = s.id
    left join (select id, max(ts) as last_processed_at from live_log where op = 'processed' and seq % 3 <> 0
               group by id) p on p.id = s.id"""


@query("state_replay_requeue", REQUEUED_SQL, "state")
def _(spark, sf):
    return lc.apply_log(adapter.requeue_log(raw_table(spark, sf, "events")))


MID = "2024-01-15 00:00:00"


def _split_log(spark, sf):
    log = event_log(spark, sf)
    early = F.col("ts") < F.expr(f"timestamp_ntz'{MID}'")
    return log.filter(early), log.filter(~early)


@query("state_incremental", "select * from state", "state")
def _(spark, sf):
    early, late = _split_log(spark, sf)
    return lc.apply_log(late, lc.apply_log(early, requeues=False), requeues=False)


@query("discovery_upsert", f"""
    with early as (select * from log where ts < timestamp '{MID}'),
    live as (select l.*, first_ts from early l join (
      select id, min(ts) as first_ts from early where op = 'discover' group by id) f on f.id = l.id where ts >= first_ts),
    old as (select id, arg_max(url, ts) filter (where op = 'discover') as url,
      arg_max(case when op = 'discover' then 'discovered' else op end, ts)
        filter (where op <> 'discover' or ts = first_ts) as status,
      min(first_ts) as first_seen_at, max(ts) filter (where op = 'discover') as last_seen_at,
      count(*) filter (where op = 'failed') as failure_count,
      arg_max(reason, ts) filter (where op in ('failed', 'skipped')) as last_error_message,
      arg_max(source, ts) filter (where op = 'discover') as source, max(priority) as priority,
      max(ts) as last_updated_at from live group by id),
    new as (select id, arg_max(url, ts) as url, min(ts) as first_ts, max(ts) as last_ts,
      arg_max(source, ts) as source, max(priority) as priority
      from log where op = 'discover' and ts >= timestamp '{MID}' group by id)
    select coalesce(o.id, n.id) as id, coalesce(n.url, o.url) as url, coalesce(o.status, 'discovered') as status,
      coalesce(o.first_seen_at, n.first_ts) as first_seen_at, coalesce(n.last_ts, o.last_seen_at) as last_seen_at,
      coalesce(o.failure_count, 0) as failure_count, o.last_error_message, coalesce(n.source, o.source) as source,
      greatest(o.priority, n.priority) as priority, coalesce(n.last_ts, o.last_updated_at) as last_updated_at
    from old o full outer join new n on o.id = n.id""", "log")
def _(spark, sf):
    early, late = _split_log(spark, sf)
    state = lc.apply_log(early, requeues=False)
    seen = late.filter(F.col("op") == "discover").select("id", "url", "source", "priority", "ts", "seq")
    found = lc.discovery_rows(seen, F.col("ts"), F.col("source"), F.col("priority"))
    after = lc.discover(state, found, "id", [F.col("ts"), F.col("seq")])
    return after.drop("last_attempted_at", "last_processed_at", "last_failed_at")


@query("command_batch", """
    with cmd as (select id, arg_max(op, (ts, seq)) as op, arg_max(reason, (ts, seq)) as reason
      from log where op <> 'discover' group by id)
    select s.id, coalesce(c.op, s.status) as status,
      case when c.op = 'processing' then timestamp '2024-02-01' else last_attempted_at end as last_attempted_at,
      case when c.op = 'processed' then timestamp '2024-02-01' else last_processed_at end as last_processed_at,
      case when c.op = 'failed' then timestamp '2024-02-01' else last_failed_at end as last_failed_at,
      failure_count + case when c.op = 'failed' then 1 else 0 end as failure_count,
      case when c.op in ('failed', 'skipped') then c.reason else last_error_message end as last_error_message,
      case when c.op is not null then timestamp '2024-02-01' else last_updated_at end as last_updated_at
    from state s left join cmd c on c.id = s.id""", "state")
def _(spark, sf):
    log = event_log(spark, sf)
    newest = F.max(F.struct("ts", "seq", "op", "reason", "expected")).alias("c")
    commands = log.filter(F.col("op") != "discover").groupBy("id").agg(newest).select("id", "c.op", "c.reason", "c.expected")
    after = lc.apply_commands(event_state(spark, sf), commands, "id", F.expr("timestamp_ntz'2024-02-01 00:00:00'"))
    return after.drop("url", "first_seen_at", "last_seen_at", "source", "priority")


@query("command_dead_partial", """
    select id, case id % 3 when 0 then 'dead' when 1 then 'partial' else status end as status,
      case when id % 3 = 1 then timestamp '2024-02-01' else last_processed_at end as last_processed_at,
      case when id % 3 = 0 then concat('gone ', id) else last_error_message end as last_error_message, failure_count,
      case when id % 3 < 2 then timestamp '2024-02-01' else last_updated_at end as last_updated_at from state""", "state")
def _(spark, sf):
    state = event_state(spark, sf)
    commands = state.filter(F.col("id") % 3 < 2).select(
        "id", F.when(F.col("id") % 3 == 0, "dead").otherwise("partial").alias("op"),
        F.concat(F.lit("gone "), F.col("id").cast("string")).alias("reason"), F.lit(None).cast("string").alias("expected"))
    after = lc.apply_commands(state, commands, "id", F.expr("timestamp_ntz'2024-02-01 00:00:00'"))
    return after.select("id", "status", "last_processed_at", "last_error_message", "failure_count", "last_updated_at")


_RECENT = "timestamp '2024-01-25'"


@query("requeue_cas", f"""
    select id, case when hit then 'discovered' else status end as status, failure_count, last_error_message,
      case when hit then timestamp '2024-02-01' else last_updated_at end as last_updated_at
    from (select *, status = 'failed' and exists (
      select 1 from log l where l.id = s.id and l.op = 'failed' and l.ts >= {_RECENT}) as hit from state s)""", "state")
def _(spark, sf):
    ids = event_log(spark, sf).filter(
        (F.col("op") == "failed") & (F.col("ts") >= F.expr("timestamp_ntz'2024-01-25 00:00:00'"))).select("id")
    after = lc.requeue(event_state(spark, sf), ids, "id", "failed", F.expr("timestamp_ntz'2024-02-01 00:00:00'"))
    return after.select("id", "status", "failure_count", "last_error_message", "last_updated_at")


@query("requeue_count", f"""
    select count(*) as requeued from state s where status = 'failed' and exists (
      select 1 from log l where l.id = s.id and l.op = 'failed' and l.ts >= {_RECENT})""", "state")
def _(spark, sf):
    ids = event_log(spark, sf).filter(
        (F.col("op") == "failed") & (F.col("ts") >= F.expr("timestamp_ntz'2024-01-25 00:00:00'"))).select("id")
    return lc.requeue_count(event_state(spark, sf), ids, "id", "failed")


@query("requeue_candidates", """
    select id, failure_count as failures,
      case when length(last_error_message) > 60 then concat(left(last_error_message, 60), '...')
           else coalesce(last_error_message, '') end as error_preview
    from state where status = 'failed'""", "state")
def _(spark, sf):
    return lc.candidate_listing(lc.requeue_candidates(event_state(spark, sf), "id", "failed"), "id")


@query("claim_batch", f"""
    select map_id, map_url from ({MAP_STATE_SQL}) where status = 'discovered'
    order by priority desc nulls first, first_seen_at nulls last, map_id limit 25""")
def _(spark, sf):
    return lc.claim(map_state(spark, sf), "map_id", "map_url")


@query("claim_with_context", f"""
    select map_id, map_url, match_id, map_order from ({MAP_STATE_SQL}) where status = 'discovered'
    order by priority desc nulls first, first_seen_at nulls last, map_id limit 50""")
def _(spark, sf):
    return lc.claim(map_state(spark, sf), "map_id", "map_url", 50, ["match_id", "map_order"])


@query("status_counts", f"""
    select 'entity_state' as state_table, status, count(*) as entities from state group by status
    union all select 'map_state', status, count(*) from ({MAP_STATE_SQL}) group by status""", "state")
def _(spark, sf):
    return lc.status_counts({"entity_state": event_state(spark, sf), "map_state": map_state(spark, sf)})


@query("status_recode_down", """
    select id, case when status in ('dead', 'partial') then 'failed' when status = 'discovered' then 'pending'
      else status end as status from state""", "state")
def _(spark, sf):
    return event_state(spark, sf).select("id", recode_down(F.col("status")).alias("status"))


@query("status_recode_up", """
    select seq, case when op = 'pending' then 'discovered' else op end as status
    from (select seq, case op when 'discover' then 'pending' else op end as op from log)""", "log")
def _(spark, sf):
    older = F.when(F.col("op") == "discover", "pending").otherwise(F.col("op"))
    return event_log(spark, sf).select("seq", recode_up(older).alias("status"))


@query("stage_outcome", """
    select match_id, count(map_id) as child_rows, case when count(map_id) = 0 then 'failed' else 'processed' end as op,
      case when count(map_id) = 0 then 'Parsing returned no player records' end as reason
    from matches left join maps using (match_id) group by match_id""", "matches maps")
def _(spark, sf):
    return lc.stage_outcome(adapter.matches(spark, sf), adapter.maps(spark, sf), "match_id").drop("expected")


def attempts(spark, sf):
    """Order lines as attempts on their order: A succeeds, R may be retried, N may not."""
    rows = raw_table(spark, sf, "lineitem")
    flag = F.col("l_returnflag")
    error = F.when(flag != "A", F.concat(F.lit("part "), F.col("l_partkey"), F.lit(" "), F.repeat(F.lit("ab"), 300)))
    return rows.select(
        "l_orderkey", (flag == "A").alias("ok"), (flag == "R").alias("retryable"), error.alias("error"),
        *ATTEMPT_ORDER)


ATTEMPT_ORDER = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]


def folded(spark, sf):
    return fold_attempts(attempts(spark, sf), ["l_orderkey"], [F.col(c) for c in ATTEMPT_ORDER])


_FOLD_SQL = f"""
    with tried as (select *, row_number() over (partition by l_orderkey order by {', '.join(ATTEMPT_ORDER)}) as n from lineitem),
    stop as (select l_orderkey, min(n) as n from tried where l_returnflag in ('A', 'N') or n = 3 group by l_orderkey),
    outcome as (select t.l_orderkey,
      case when s.n is null then 'processing' when bool_or(t.n = s.n and l_returnflag = 'A') then 'processed' else 'failed' end as status,
      coalesce(s.n, count(*)) as attempts,
      count(*) filter (where l_returnflag = 'R' and (s.n is null or t.n < s.n)) as retries,
      left(max(case when t.n = s.n and l_returnflag <> 'A' then concat('part ', l_partkey, ' ', repeat('ab', 300)) end), 500) as reason
    from tried t left join stop s on s.l_orderkey = t.l_orderkey group by t.l_orderkey, s.n)
"""


@query("attempt_outcome", f"{_FOLD_SQL} select * from outcome")
def _(spark, sf):
    return folded(spark, sf)


@query("run_summary", f"""{_FOLD_SQL}
    select o_orderpriority as batch, count(*) as selected, count(*) filter (where status = 'processed') as succeeded,
      count(*) filter (where status = 'failed') as failed, cast(sum(retries) as bigint) as retries
    from outcome join orders on o_orderkey = l_orderkey group by o_orderpriority""")
def _(spark, sf):
    batches = raw_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("batch"))
    return run_summary(folded(spark, sf).join(batches, "l_orderkey"), ["batch"])

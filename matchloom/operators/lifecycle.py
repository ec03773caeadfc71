"""Lifecycle of discovered entities: discovery, transitions, claims, requeue, replay.

A state row is keyed by its entity. ``EFFECTS`` states what each command writes;
single commands, command batches and whole logs all read that one table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.scalar import clip, preview
from matchloom.operators.latest import latest_by
from matchloom.operators.skew import attach
from matchloom.operators.upsert import upsert


@dataclass(frozen=True)
class Effect:
    """What a command sets besides status and ``last_updated_at``."""

    stamp: str | None = None
    keeps_reason: bool = False
    counts_failure: bool = False


# The columns each command touches.
EFFECTS = {
    "processing": Effect(stamp="last_attempted_at"),
    "processed": Effect(stamp="last_processed_at"),
    "failed": Effect(stamp="last_failed_at", keeps_reason=True, counts_failure=True),
    "dead": Effect(keeps_reason=True),
    "skipped": Effect(keeps_reason=True),
    "partial": Effect(stamp="last_processed_at"),
}
STAMPS = ("last_attempted_at", "last_processed_at", "last_failed_at")
NO_CHILDREN = "Parsing returned no player records"

DISCOVERY_POLICY = {
    "status": "keep", "first_seen_at": "keep", "failure_count": "keep", "priority": "greatest",
    "match_id": "coalesce", "map_order": "coalesce",
}


def discovery_rows(items: DataFrame, now: Column, source: Column | str = "unknown",
                   priority: Column | int = 0) -> DataFrame:
    """Found items as full state rows with status ``discovered``."""
    source = F.lit(source) if isinstance(source, str) else source
    priority = F.lit(priority) if isinstance(priority, int) else priority
    return items.withColumns({
        "status": F.lit("discovered"), "source": source, "priority": priority.cast("bigint"),
        "failure_count": F.lit(0).cast("bigint"),
        "first_seen_at": now, "last_seen_at": now, "last_updated_at": now})


def discover(state: DataFrame, found: DataFrame, key: str, ordinal: Sequence[Column] = (),
             probe: bool = False) -> DataFrame:
    """State after recording ``found`` rows (see ``discovery_rows``).

    A known entity gets its url, source, last-seen time and a priority that
    never falls; its status, first sight and failures stay.
    """
    return upsert(state, found, [key], DISCOVERY_POLICY, ordinal, {"failure_count": F.lit(0)}, probe)


def apply_commands(state: DataFrame, commands: DataFrame, key: str, now: Column,
                   order_by: Sequence[Column] = ()) -> DataFrame:
    """State after one command per entity: columns key, op, reason, expected.

    Of several commands on one entity the first under ``order_by`` counts (ties
    go by the commands' own values), so the state keeps one row per key. ``requeue``
    applies only while the row still has the ``expected`` status; it keeps
    failures and the last error as history.
    """
    orders = latest_by(commands, [key], [*order_by, F.col("op"), F.col("reason"), F.col("expected")]).select(
        key, "op", "reason", "expected")
    joined = state.join(orders, key, "left")
    op = F.col("op")
    # A command without an expected status is unconditional; a requeue always names one.
    applies = F.when(op == "requeue", F.coalesce(F.col("status") == F.col("expected"), F.lit(False))).otherwise(
        op.isin(*EFFECTS))
    applies = F.coalesce(applies, F.lit(False))
    reason = F.coalesce("reason", F.lit("unknown"))
    return joined.select(*[
        _after(name, applies, op, reason, now).alias(name) for name in state.columns])


def _after(name: str, applies: Column, op: Column, reason: Column, now: Column) -> Column:
    before = F.col(name)
    if name == "status":
        return F.when(applies, F.when(op == "requeue", "discovered").otherwise(op)).otherwise(before)
    if name == "last_updated_at":
        return F.when(applies, now).otherwise(before)
    if name in STAMPS:
        ops = [o for o, e in EFFECTS.items() if e.stamp == name]
        return F.when(applies & op.isin(*ops), now).otherwise(before)
    if name == "failure_count":
        ops = [o for o, e in EFFECTS.items() if e.counts_failure]
        return F.when(applies & op.isin(*ops), F.coalesce(before, F.lit(0)) + 1).otherwise(before)
    if name == "last_error_message":
        ops = [o for o, e in EFFECTS.items() if e.keeps_reason]
        return F.when(applies & op.isin(*ops), reason).otherwise(before)
    return before


def mark(state: DataFrame, ids: DataFrame, key: str, op: str, now: Column,
         reason: Column | None = None) -> DataFrame:
    """One command for many entities."""
    if op not in EFFECTS:
        raise ValueError(f"unknown command {op}")
    commands = ids.select(key).distinct().withColumns({
        "op": F.lit(op), "reason": reason if reason is not None else F.lit("unknown"),
        "expected": F.lit(None).cast("string")})
    return apply_commands(state, commands, key, now)


def requeue(state: DataFrame, ids: DataFrame, key: str, expected: str, now: Column) -> DataFrame:
    """Compare-and-set back to ``discovered`` for the listed entities still in ``expected``."""
    commands = ids.select(key).distinct().withColumns({
        "op": F.lit("requeue"), "reason": F.lit(None).cast("string"), "expected": F.lit(expected)})
    return apply_commands(state, commands, key, now)


def requeue_count(state: DataFrame, ids: DataFrame, key: str, expected: str) -> DataFrame:
    """One row: how many rows ``requeue`` changes."""
    hits = state.filter(F.col("status") == expected).join(ids.select(key), key, "left_semi")
    return hits.agg(F.count(F.lit(1)).alias("requeued"))


def _work_order(key: str) -> list[Column]:
    return [F.col("priority").desc_nulls_first(), F.col("first_seen_at").asc_nulls_last(), F.col(key).asc()]


def claim(state: DataFrame, key: str, url: str = "url", limit: int = 25,
          context: Sequence[str] = ()) -> DataFrame:
    """Next entities to work on: highest priority first, then oldest discovery."""
    ready = state.filter(F.col("status") == "discovered")
    return ready.orderBy(*_work_order(key)).limit(limit).select(key, url, *context)


def requeue_candidates(state: DataFrame, key: str, status: str, only: object = None,
                       limit: int | None = None) -> DataFrame:
    """Preview of a requeue, in work order."""
    rows = state.filter(F.col("status") == status)
    if only is not None:
        rows = rows.filter(F.col(key) == only)
    rows = rows.orderBy(*_work_order(key))
    if limit is not None:
        rows = rows.limit(limit)
    return rows.select(key, "failure_count", "last_error_message")


def candidate_listing(candidates: DataFrame, key: str) -> DataFrame:
    """Candidates as shown to an operator: counts default to 0, errors are cut."""
    return candidates.select(
        key, F.coalesce("failure_count", F.lit(0)).alias("failures"),
        preview(F.col("last_error_message")).alias("error_preview"))


def status_counts(states: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per state table and status. An empty table is listed once, with a null status and 0."""
    spark = next(iter(states.values())).sparkSession
    counts = reduce(DataFrame.unionByName, [
        df.groupBy("status").agg(F.count(F.lit(1)).alias("entities")).withColumn("state_table", F.lit(name))
        for name, df in states.items()])
    names = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in states])).alias("state_table"))
    return names.join(counts, "state_table", "left").select(
        "state_table", "status", F.coalesce("entities", F.lit(0)).alias("entities"))


def stage_outcome(parents: DataFrame, children: DataFrame, key: str, reason: str = NO_CHILDREN) -> DataFrame:
    """Processed where a parent has child rows, failed with ``reason`` where it has none."""
    counts = children.groupBy(key).agg(F.count(F.lit(1)).alias("child_rows"))
    n = F.coalesce("child_rows", F.lit(0))
    return parents.select(key).join(counts, key, "left").select(
        key, n.alias("child_rows"), F.when(n == 0, "failed").otherwise("processed").alias("op"),
        F.when(n == 0, reason).alias("reason"), F.lit(None).cast("string").alias("expected"))


def failure_reason(error: Column) -> Column:
    return clip(error)


def apply_log(log: DataFrame, state: DataFrame | None = None, key: str = "id",
              requeues: bool = True) -> DataFrame:
    """State after a whole command log, applied in (ts, seq) order.

    Log columns: key, ts, seq, op, reason, expected, url, source, priority.
    Commands on an entity nobody has discovered yet change nothing.

    No entity's commands are ever gathered. Everything but a requeue is a
    plain max, min or count. A requeue counts only if it follows the last
    unconditional status L and expects what is there: the first one that
    expects L turns the row to ``discovered``, and from then on only those that
    expect ``discovered`` touch it again. So two more aggregates decide it.
    """
    here = F.struct("ts", "seq")
    found = F.col("op") == "discover"
    births = log.filter(found).groupBy(key).agg(F.min(here).alias("_born"))
    if state is None:
        births = births.withColumn("_known", F.lit(False))
    else:
        known = state.select(key, F.lit(True).alias("_known"))
        births = births.join(known, key, "full_outer").withColumn("_known", F.coalesce("_known", F.lit(False)))
    live = attach(log, births, [key], F.col("seq")).filter(F.col("_known") | (here >= F.col("_born")))

    op = F.col("op")
    born_now = found & ~F.col("_known") & (here == F.col("_born"))
    sets = op.isin(*EFFECTS) | born_now

    def last(when: Column, *values: Column) -> Column:
        return F.max(F.when(when, F.struct("ts", "seq", *values)))

    reason = F.coalesce("reason", F.lit("unknown")).alias("reason")
    status = F.when(found, "discovered").otherwise(op).alias("status")
    with_reason = [o for o, e in EFFECTS.items() if e.keeps_reason]
    counting = [o for o, e in EFFECTS.items() if e.counts_failure]
    stamps = {s: [o for o, e in EFFECTS.items() if e.stamp == s] for s in STAMPS}
    changes = live.groupBy(key).agg(
        last(sets, status).alias("_set"),
        last(found, F.col("url"), F.col("source")).alias("_found"),
        F.min(F.when(found, F.struct("ts", "seq", "priority"))).alias("_first_found"),
        F.max(F.when(found, F.col("priority"))).alias("_top_priority"),
        F.count_if(found).alias("_sightings"),
        *[F.max(F.when(op.isin(*ops), F.col("ts"))).alias(f"_{s}") for s, ops in stamps.items()],
        F.count_if(op.isin(*counting)).alias("_failures"),
        last(op.isin(*with_reason), reason).alias("_error"),
        F.max(F.when(op != "requeue", F.col("ts"))).alias("_touched"))
    if state is not None:
        old = state.select(key, F.struct(*state.columns).alias("_old"))
        changes = changes.join(old, key, "full_outer")
        before = {c: F.col(f"_old.{c}") for c in state.columns}
        existed = F.col("_old").isNotNull()
    else:
        before, existed = {}, F.lit(False)

    def old_value(name: str, kind: str) -> Column:
        return before[name] if before else F.lit(None).cast(kind)

    zero = F.lit(0).cast("bigint")
    first_priority = F.col("_first_found.priority")
    fresh_priority = F.when(
        F.col("_sightings") > 1, F.greatest(F.coalesce(first_priority, zero), F.col("_top_priority"))
    ).otherwise(first_priority)
    grown = F.when(F.col("_sightings") > 0, F.greatest(
        F.coalesce(old_value("priority", "bigint"), zero), F.col("_top_priority"))).otherwise(
            old_value("priority", "bigint"))
    rows = changes.select(
        key,
        F.when(F.col("_found").isNotNull(), F.col("_found.url")).otherwise(old_value("url", "string")).alias("url"),
        F.coalesce(F.col("_set.status"), old_value("status", "string")).alias("status"),
        F.coalesce(old_value("first_seen_at", "timestamp_ntz"), F.col("_first_found.ts")).alias("first_seen_at"),
        F.coalesce(F.col("_found.ts"), old_value("last_seen_at", "timestamp_ntz")).alias("last_seen_at"),
        *[F.coalesce(F.col(f"_{s}"), old_value(s, "timestamp_ntz")).alias(s) for s in STAMPS],
        (F.coalesce(old_value("failure_count", "bigint"), zero) + F.coalesce("_failures", zero)).alias("failure_count"),
        F.when(F.col("_error").isNotNull(), F.col("_error.reason")).otherwise(
            old_value("last_error_message", "string")).alias("last_error_message"),
        F.when(F.col("_found").isNotNull(), F.col("_found.source")).otherwise(
            old_value("source", "string")).alias("source"),
        F.when(existed, grown).otherwise(fresh_priority).alias("priority"),
        F.coalesce(F.col("_touched"), old_value("last_updated_at", "timestamp_ntz")).alias("last_updated_at"),
        F.col("_set"))
    if not requeues:
        return rows.drop("_set")

    basis = rows.select(key, F.col("status").alias("_status"),
                        F.struct(F.col("_set.ts"), F.col("_set.seq")).alias("_set_at"), F.col("_set.ts").alias("_set_ts"))
    # What precedes the last status cannot matter, and that is never before the birth.
    asked = log.filter(op == "requeue").select(key, "ts", "seq", here.alias("_here"), "expected")
    late = attach(asked, basis, [key], F.col("seq"))
    late = late.filter(F.col("_set_ts").isNull() | (F.col("_here") > F.col("_set_at")))
    hits = late.groupBy(key).agg(
        F.min(F.when(F.col("expected") == F.col("_status"), F.col("ts"))).alias("_first_hit"),
        F.max(F.when(F.col("expected") == "discovered", F.col("ts"))).alias("_last_idle"))
    final = rows.join(hits, key, "left")
    hit = F.col("_first_hit").isNotNull()
    touched = F.greatest("last_updated_at", "_first_hit", "_last_idle")
    return final.select(*[
        F.when(hit, "discovered").otherwise(F.col(c)).alias(c) if c == "status"
        else F.when(hit, touched).otherwise(F.col(c)).alias(c) if c == "last_updated_at"
        else F.col(c) for c in rows.columns if c != "_set"])


def apply_batch(log: DataFrame, state: DataFrame, key: str = "id", requeues: bool = True) -> DataFrame:
    """``apply_log`` for a log that touches few of the state's entities.

    Only those entities go through the joins of the replay. While Spark finds
    their keys small enough to broadcast, the rest of the state is not shuffled.
    """
    touched = log.select(key).distinct()
    changed = apply_log(log, state.join(touched, key, "left_semi"), key, requeues)
    return changed.unionByName(state.join(touched, key, "left_anti").select(*changed.columns))

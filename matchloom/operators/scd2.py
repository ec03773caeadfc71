"""Slowly changing history with check-strategy change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.functions.scalar import surrogate_key


def _changed(pairs: Sequence[tuple[Column, Column]]) -> Column:
    same = F.lit(True)
    for old, new in pairs:
        same = same & old.eqNullSafe(new)
    return ~same


def empty_history(current: DataFrame, key: str) -> DataFrame:
    """History of a snapshot that has not run yet."""
    return current.select(
        *current.columns, F.lit("").alias("scd_id"),
        *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("valid_from", "valid_to", "updated_at")],
    ).filter(F.lit(False))


def scd2_apply(history: DataFrame, current: DataFrame, key: str, check_cols: Sequence[str],
               now: Column) -> DataFrame:
    """One snapshot run.

    A new key opens an interval at ``now``. A changed key closes its open
    interval and opens another. Unchanged keys keep their row as it is, and
    keys missing from ``current`` stay open. ``updated_at`` is the run that
    opened the interval; closing sets ``valid_to`` only.
    """
    values = [c for c in current.columns if c != key]
    closed = history.filter(F.col("valid_to").isNotNull())
    opened = history.filter(F.col("valid_to").isNull())
    old = opened.select(key, F.struct(*opened.columns).alias("old"))
    new = current.select(key, F.struct(*current.columns).alias("new"))
    both = old.join(new, key, "full_outer")

    known, seen = F.col("old").isNotNull(), F.col("new").isNotNull()
    moved = known & seen & _changed([(F.col(f"old.{c}"), F.col(f"new.{c}")) for c in check_cols])
    layout = [key, *values, "scd_id", "valid_from", "valid_to", "updated_at"]
    kept = F.struct(*[
        (F.when(moved, now) if c == "valid_to" else F.col(f"old.{c}")).alias(c) for c in layout])
    fresh = F.struct(
        *[F.col(f"new.{c}").alias(c) for c in [key, *values]],
        surrogate_key(F.col(f"new.{key}"), now).alias("scd_id"),
        now.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"), now.alias("updated_at"))
    rows = F.array_compact(F.array(F.when(known, kept), F.when(seen & (~known | moved), fresh)))
    live = both.select(F.explode(rows).alias("r")).select("r.*")
    return closed.select(*layout).unionByName(live)


def first_run_from(moment: Column, runs: Sequence[Column]) -> Column:
    """First run at or after ``moment``; null when no run has seen it yet."""
    return F.array_min(F.filter(F.array(*runs), lambda run: run >= moment))


def observe(facts: DataFrame, key: str, values: Sequence[str], order: Sequence[str], run: Column,
            as_name: dict[str, str] | None = None) -> DataFrame:
    """Newest values per key and run bucket: what each snapshot run would newly see.

    ``run`` is the first run at or after the row. One row per key and run
    leaves the map side, however many facts a key has.
    """
    as_name = as_name or {}
    newest = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"_v_{c}") for c in values]))
    return (facts.groupBy(F.col(key), run.alias("run_at")).agg(newest.alias("n"))
            .filter(F.col("run_at").isNotNull())
            .select(key, "run_at", *[F.col(f"n._v_{c}").alias(as_name.get(c, c)) for c in values]))


def current_at(observations: DataFrame, key: str, run_at: Column) -> DataFrame:
    """Current values per key as one run sees them."""
    values = [c for c in observations.columns if c not in (key, "run_at")]
    newest = F.max_by(F.struct(*values), "run_at").alias("v")
    return observations.filter(F.col("run_at") <= run_at).groupBy(key).agg(newest).select(key, "v.*")


def scd2_backfill(observations: DataFrame, key: str, check_cols: Sequence[str]) -> DataFrame:
    """The history that a sequence of runs would build, in one pass.

    A key has at most one observation per run, which bounds the window.
    """
    values = [c for c in observations.columns if c not in (key, "run_at")]
    by_run = Window.partitionBy(key).orderBy("run_at")
    before = {c: F.lag(c).over(by_run) for c in check_cols}
    first = F.row_number().over(by_run) == 1
    marked = observations.withColumn(
        "_opens", first | _changed([(before[c], F.col(c)) for c in check_cols]))
    opened = marked.filter("_opens").withColumn("valid_to", F.lead("run_at").over(by_run))
    return opened.select(
        key, *values, surrogate_key(F.col(key), F.col("run_at")).alias("scd_id"),
        F.col("run_at").alias("valid_from"), "valid_to", F.col("run_at").alias("updated_at"))


def roster_dim(history: DataFrame) -> DataFrame:
    """Presentation form with a surrogate key and a current flag."""
    return history.select(
        surrogate_key(F.col("player_id"), F.col("valid_from")).alias("roster_history_key"),
        "player_id", "team_name", "observed_map_date", "valid_from", "valid_to",
        F.col("valid_to").isNull().alias("is_current"))

"""Keyed writes: upsert with a conflict policy per column, delete with cascade or set-null.

Policies on conflict:

* ``new``      the batch value replaces the old one, null included
* ``keep``     the old value stays
* ``greatest`` the larger of old (null counts as 0) and new
* ``coalesce`` the batch value unless it is null

A batch is applied as if its rows were written one after another in ``ordinal``
order. Columns the batch does not carry are left alone on conflict and take
their default on insert.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.operators.skew import attach

POLICIES = ("new", "keep", "greatest", "coalesce")


def reduce_batch(batch: DataFrame, keys: Sequence[str], rules: Mapping[str, str],
                 ordinal: Sequence[Column]) -> DataFrame:
    """One row per key holding what the ordered batch amounts to.

    Only max and min aggregates are used, so repeats of a key are folded
    before the shuffle.
    """
    turn = F.struct(*ordinal) if ordinal else F.lit(0)
    named = {p: [c for c, rule in rules.items() if rule == p] for p in POLICIES}
    last = F.max_by(F.struct(F.lit(True).alias("_row"), *named["new"]), turn).alias("last")
    first = F.min_by(F.struct(F.lit(True).alias("_row"), *named["keep"], *named["greatest"]), turn).alias("first")
    folded = [F.max(c).alias(f"_max_{c}") for c in named["greatest"]]
    folded += [F.max_by(c, F.when(F.col(c).isNotNull(), turn)).alias(f"_last_{c}") for c in named["coalesce"]]
    return batch.groupBy(*keys).agg(last, first, F.count(F.lit(1)).alias("_writes"), *folded)


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str],
           policy: Mapping[str, str] | None = None, ordinal: Sequence[Column] = (),
           defaults: Mapping[str, Column] | None = None, probe: bool = False) -> DataFrame:
    """Target after the batch.

    By default both sides are shuffled once, on the key, and meet once. With
    ``probe``, meant for batches far smaller than the target, the batch is
    looked up from the target instead: while Spark finds the batch small
    enough to broadcast, the target is scanned twice (once for its keys only)
    and not shuffled at all. The result is the same either way.

    It is a plan over ``target``; write it to a new path, never over the files
    it reads.
    """
    policy, defaults, keys = dict(policy or {}), dict(defaults or {}), list(keys)
    carried = [c for c in target.columns if c not in keys and c in batch.columns]
    rules = {c: policy.get(c, "new") for c in carried}
    unknown = {r for r in rules.values() if r not in POLICIES}
    if unknown:
        raise ValueError(f"unknown conflict policy {sorted(unknown)}")
    changes = reduce_batch(batch, keys, rules, ordinal)
    old = target.select(*keys, F.struct(F.lit(True).alias("_row"), *target.columns).alias("old"))
    if probe:
        present = target.select(*keys).join(changes.select(*keys), keys, "left_semi")
        fresh_rows = changes.join(present, keys, "left_anti")
        none = F.lit(None).cast(old.schema["old"].dataType)
        both = old.join(changes, keys, "left").unionByName(fresh_rows.withColumn("old", none))
    else:
        both = old.join(changes, keys, "full_outer")
    exists, written = F.col("old").isNotNull(), F.col("last").isNotNull()

    def resolve(name: str) -> Column:
        before = F.col(f"old.{name}")
        rule = rules.get(name)
        if rule == "new":
            value = F.when(written, F.col(f"last.{name}")).otherwise(before)
        elif rule == "keep":
            value = F.when(exists, before).otherwise(F.col(f"first.{name}"))
        elif rule == "coalesce":
            value = F.coalesce(F.col(f"_last_{name}"), before)
        elif rule == "greatest":
            top, opening, zero = F.col(f"_max_{name}"), F.col(f"first.{name}"), F.lit(0)
            grown = F.greatest(F.coalesce(before, zero), top)
            # The first write of a new key is taken as it is, later ones compare with it.
            fresh = F.when(F.col("_writes") > 1, F.greatest(F.coalesce(opening, zero), top)).otherwise(opening)
            value = F.when(exists & written, grown).when(exists, before).otherwise(fresh)
        else:
            value = F.when(exists, before)
        if name in defaults:
            value = F.when(~exists & value.isNull(), defaults[name]).otherwise(value)
        return value.cast(target.schema[name].dataType).alias(name)

    return both.select(*[F.col(c) if c in keys else resolve(c) for c in target.columns])


def delete_keys(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return df.join(keys, on, "left_anti")


def null_on_delete(df: DataFrame, column: str, gone: DataFrame, field: str) -> DataFrame:
    """Clear references to deleted parents, of which many rows may name the same one."""
    lost = gone.select(F.col(field).alias(column)).distinct().withColumn("_gone", F.lit(True))
    joined = attach(df, lost, [column], F.struct(*[c for c in df.columns if c != column]), "left")
    return joined.select(*[
        F.when(F.col("_gone").isNull(), F.col(c)).alias(c) if c == column else F.col(c) for c in df.columns])


def cascade_delete(tables: Mapping[str, DataFrame], root: str, keys: DataFrame,
                   links: Sequence[tuple[str, str, str, str, str]],
                   primary: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Delete ``keys`` from ``root`` and follow its links, parents before children.

    A link is (child, child column, parent, parent column, ``cascade`` or
    ``set_null``); ``primary`` names the key columns of each table.
    """
    result = dict(tables)
    gone = {root: tables[root].join(keys, list(primary[root]), "left_semi")}
    result[root] = delete_keys(tables[root], keys, list(primary[root]))
    for child, column, parent, field, action in links:
        if parent not in gone:
            continue
        if action == "cascade":
            lost = gone[parent].select(F.col(field).alias(column))
            gone[child] = tables[child].join(lost, column, "left_semi")
            result[child] = delete_keys(result[child], lost, column)
        else:
            result[child] = null_on_delete(result[child], column, gone[parent], field)
    return result

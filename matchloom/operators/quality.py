"""Data-quality tests: failing rows per test, and a one-row-per-test report.

A test passes when it has no failing rows. Row-level tests of one table share
one scan; key tests pre-aggregate before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.operators.skew import attach


def unique_failures(df: DataFrame, columns: str | Sequence[str], skip_null: bool = True) -> DataFrame:
    """Key values that occur more than once. Rows with a null key do not compete."""
    keys = [columns] if isinstance(columns, str) else list(columns)
    if skip_null:
        for key in keys:
            df = df.filter(F.col(key).isNotNull())
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def unique_combination_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once; nulls count as values."""
    return unique_failures(df, columns, skip_null=False)


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, field_name: str) -> DataFrame:
    """Child values without a parent row, with their number of child rows.

    Both sides are reduced to one row per value before they meet.
    """
    keys = parent.select(F.col(field_name).alias(column)).filter(F.col(column).isNotNull()).distinct()
    used = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return used.join(keys, column, "left_anti")


def relationship_failures(child: DataFrame, column: str, parent: DataFrame, field_name: str) -> DataFrame:
    """Child rows whose non-null value has no parent row."""
    orphans = orphan_keys(child, column, parent, field_name).select(column)
    return attach(child, orphans, [column], F.struct(*child.columns), "left_semi")


def check_failures(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is false; unknown passes, as in SQL CHECK."""
    return df.filter(~F.coalesce(predicate, F.lit(True)))


def accepted(column: Column, values: Sequence[str]) -> Column:
    return column.isin(*values)


@dataclass(frozen=True)
class Test:
    """One declared test. ``kind`` is unique, unique_combo, not_null, relationships or check."""

    table: str
    kind: str
    columns: tuple[str, ...]
    parent: str | None = None
    parent_field: str | None = None
    predicate: Column | None = field(default=None, compare=False)
    label: str | None = None
    severity: str = "error"

    __test__ = False  # not a pytest class

    @property
    def name(self) -> str:
        return self.label or f"{self.kind}:{self.table}.{'+'.join(self.columns)}"


def failures(test: Test, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Failing rows of one test."""
    df = tables[test.table]
    if test.kind == "unique":
        return unique_failures(df, test.columns)
    if test.kind == "unique_combo":
        return unique_combination_failures(df, test.columns)
    if test.kind == "not_null":
        return not_null_failures(df, test.columns[0])
    if test.kind == "relationships":
        return relationship_failures(df, test.columns[0], tables[test.parent], test.parent_field)
    if test.kind == "check":
        return check_failures(df, test.predicate)
    raise ValueError(f"unknown test kind {test.kind}")


def _row_failure(test: Test) -> Column | None:
    if test.kind == "not_null":
        return F.col(test.columns[0]).isNull()
    if test.kind == "check":
        return ~F.coalesce(test.predicate, F.lit(True))
    return None


def _row_level_counts(df: DataFrame, tests: Sequence[Test]) -> DataFrame:
    counts = df.agg(*[F.count_if(_row_failure(t)).alias(f"c{i}") for i, t in enumerate(tests)])
    pairs = F.array(*[
        F.struct(F.lit(t.name).alias("test"), F.col(f"c{i}").alias("failures")) for i, t in enumerate(tests)])
    return counts.select(F.explode(pairs).alias("r")).select("r.*")


def _failure_count(test: Test, tables: Mapping[str, DataFrame]) -> DataFrame:
    if test.kind == "relationships":
        orphans = orphan_keys(tables[test.table], test.columns[0], tables[test.parent], test.parent_field)
        return orphans.agg(F.coalesce(F.sum("n_records"), F.lit(0)).alias("failures"))
    return failures(test, tables).agg(F.count(F.lit(1)).alias("failures"))


def run_suite(tests: Sequence[Test], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Report with test, severity, failures and status (pass, warn or fail)."""
    counted: list[DataFrame] = []
    for table in dict.fromkeys(t.table for t in tests):
        row_level = [t for t in tests if t.table == table and _row_failure(t) is not None]
        if row_level:
            counted.append(_row_level_counts(tables[table], row_level))
    for test in tests:
        if _row_failure(test) is None:
            found = _failure_count(test, tables)
            counted.append(found.select(F.lit(test.name).alias("test"), "failures"))
    report = reduce(DataFrame.unionByName, counted)
    warns = [t.name for t in tests if t.severity == "warn"]
    severity = F.when(F.col("test").isin(*warns), "warn").otherwise("error") if warns else F.lit("error")
    status = (F.when(F.col("failures") == 0, "pass")
               .when(F.col("severity") == "warn", "warn").otherwise("fail"))
    return report.withColumn("severity", severity).select("test", "severity", "failures", status.alias("status"))


def store_failures(tests: Sequence[Test], tables: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """Write the failing rows of every test to a folder of its own; returns the paths."""
    paths = {}
    for test in tests:
        path = f"{root}/{test.name.replace(':', '_').replace('.', '_').replace('+', '_')}"
        failures(test, tables).write.mode("errorifexists").parquet(path)
        paths[test.name] = path
    return paths


def grain_flow(levels: Sequence[tuple[str, DataFrame, Sequence[str]]],
               links: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rows against distinct keys per grain, and child keys without a parent.

    ``levels`` holds (name, frame, key columns); ``links`` holds
    (child, column, parent) with the same column name on both sides.
    """
    frames = {name: df for name, df, _ in levels}
    parts = []
    for name, df, keys in levels:
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct_keys"),
        ).select(F.lit(f"grain:{name}").alias("check"), "total",
                 F.col("distinct_keys").alias("matching")))
    for child, column, parent in links:
        keys = frames[child].select(column).filter(F.col(column).isNotNull()).distinct()
        known = frames[parent].select(column).distinct().withColumn("_known", F.lit(1))
        parts.append(keys.join(known, column, "left").agg(
            F.count(F.lit(1)).alias("total"), F.count("_known").alias("matching"),
        ).select(F.lit(f"keys:{child}.{column}->{parent}").alias("check"), "total", "matching"))
    return reduce(DataFrame.unionByName, parts).withColumn("ok", F.col("total") == F.col("matching"))


def split_errors(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Good rows without the error column, and rejected rows with it."""
    return df.filter(F.col(error).isNull()).drop(error), df.filter(F.col(error).isNotNull())


def freshness(tables: Mapping[str, tuple[DataFrame, str]], now: Column, warn_hours: int,
              error_hours: int) -> DataFrame:
    """Age of the newest row of each source against two thresholds."""
    parts = [df.agg(F.max(column).alias("newest")).select(F.lit(name).alias("source"), "newest")
             for name, (df, column) in tables.items()]
    age = F.timestamp_diff("HOUR", F.col("newest"), now)
    status = (F.when(F.col("age_hours").isNull() | (F.col("age_hours") >= error_hours), "error")
               .when(F.col("age_hours") >= warn_hours, "warn").otherwise("pass"))
    return reduce(DataFrame.unionByName, parts).withColumn("age_hours", age).withColumn("status", status)

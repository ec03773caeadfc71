"""Physical plans of the registered queries, and their results against the expected SQL."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import compare  # noqa: E402

from matchloom.catalog import EXPECTED, QUERIES  # noqa: E402
from matchloom.sources import adapter  # noqa: E402

SF = os.environ.get("MATCHLOOM_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")

# Each of these writes tables or runs a stream before it returns its result.
WRITING = {"dq_suite_report", "dq_base_rules", "dq_grain_flow", "scd2_history", "snapshot_rerun", "fact_roster_asof", "stored_failures", "stream_state_replay",
           "stream_upsert", "ingest_match_pages", "mart_refresh", "page_snapshot_append", "page_snapshot_replay",
           "paged_discovery", "paged_discovery_cap", "page_chain", "map_page_stream", "ingest_map_pages"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_expected_sql(spark, name):
    assert name in EXPECTED
    line = compare.compare(spark, compare.database(SF), name, SF)
    assert line.startswith("ok") and "TYPES" not in line, line


@needs_data
@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_pairwise_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text


@needs_data
@pytest.mark.parametrize("name", ["dim_players", "int_player_current_team", "stg_players", "attempt_outcome", "map_highlights"])
def test_ranks_are_pruned_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "row_number(), 1, Partial" in text or "row_number(), 3, Partial" in text


@needs_data
@pytest.mark.parametrize("name", ["top_players", "claim_batch", "recent_matches"])
def test_top_n_keeps_no_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF))


@needs_data
def test_scans_read_only_what_they_need(spark):
    text = plan(QUERIES["dim_teams"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan(
        adapter.matches(spark, SF).filter("date < timestamp_ntz'1998-01-01 00:00:00'"))


def test_adaptive_skew_split_reaches_salted_joins(spark):
    from pyspark.sql import functions as F

    from matchloom.operators.skew import attach
    small = {"spark.sql.shuffle.partitions": "40", "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB"}
    before = {key: spark.conf.get(key, None) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        log = spark.range(0, 120_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
        first = log.groupBy("k").agg(F.min("id").alias("first"))
        out = attach(log, first, ["k"], F.col("id"), salts=2).groupBy("k").agg(
            F.count_if(F.col("id") > F.col("first")).alias("n"), F.max("v").alias("v"))
        assert out.agg(F.sum("n")).first()[0] == 120_000 - 600
        out.collect()
        assert "skew=true" in plan(out)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_small_batches_leave_the_target_unshuffled(spark, tmp_path):
    from pyspark.sql import functions as F

    from matchloom.operators.upsert import upsert
    spark.range(0, 50_000).select("id", F.lit("old").alias("v")).write.parquet(str(tmp_path / "target"))
    spark.range(49_000, 51_000).select("id", F.lit("new").alias("v")).write.parquet(str(tmp_path / "batch"))
    target, batch = (spark.read.schema("id long, v string").parquet(str(tmp_path / n)) for n in ("target", "batch"))
    # Long paths are cut in plan texts unless told otherwise.
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        out = upsert(target, batch, ["id"], probe=True)
        text = plan(out)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    # The only exchanges on the key are those of the folded batch.
    assert text.count("Exchange hashpartitioning") == text.count("/batch]") == 3
    assert out.count() == 51_000 and out.filter("v = 'new'").count() == 2_000

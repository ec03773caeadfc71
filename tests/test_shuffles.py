"""How wide rows are shuffled, and in how many pieces."""

from pyspark.sql import functions as F

from matchloom import schemas
from matchloom.catalog import QUERIES
from matchloom.plans import models as m


def _rows(spark, schema, rows):
    """Rows of a base table from their known columns; others are null."""
    return spark.createDataFrame([tuple(row.get(name) for name in schema.names) for row in rows], schema)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_player_rows_shuffle_once_at_most(spark):
    players = _rows(spark, schemas.PLAYERS, [{"map_id": i, "player_id": p} for i, p in ((11, 1), (11, 2), (11, 2), (21, 1), (31, 1), (None, 1))])
    maps = _rows(spark, schemas.MAPS, [{"map_id": i, "match_id": match} for i, match in ((11, 1), (21, 2), (21, 2), (31, 3), (None, 1))])
    matches = _rows(spark, schemas.MATCHES, [{"match_id": 1, "team1": "A"}, {"match_id": 2, "team1": "B"}, {"match_id": None, "team1": "C"}])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        enriched = m.int_match_player_stats(
            m.stg_players(players.repartition("map_id")), m.stg_maps(maps), m.stg_matches(matches))
        plan = _plan(enriched)
        got = sorted((r["map_id"], r["player_id"], r["team1"]) for r in enriched.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [(11, 1, "A"), (11, 2, "A"), (11, 2, "A"), (21, 1, "B"), (21, 1, "B")]
    # Nothing is shuffled above the join that brings the players in, and they are laid by map already.
    top = plan.index("SortMergeJoin [map_id")
    assert "Exchange" not in plan[:top]
    assert plan.count("Exchange hashpartitioning") == 4


def test_shuffles_of_a_query_start_with_many_partitions(spark):
    plan = QUERIES["map_highlights"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    pieces = [line for line in _plan(plan).splitlines() if "Exchange hashpartitioning" in line]
    assert pieces and all(", 600)" in line for line in pieces)


def test_ids_of_a_well_compressed_file_are_not_broadcast(spark, tmp_path):
    """A wide file that compresses well: its ids alone are many times larger than their share of the file."""
    QUERIES["map_highlights"](spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "wide")
    fill = [F.lit("the same text in every row").alias(f"c{n}") for n in range(20)]
    spark.range(0, 40_000, 1, 2).select("id", *fill).write.parquet(path)
    wide = spark.read.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "wide").glob("*.parquet"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(size // 10))
    try:
        few = spark.range(50).join(wide.select("id"), "id", "left_anti")
        assert "BroadcastHashJoin" not in few._jdf.queryExecution().sparkPlan().toString()
        assert few.count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_rerun_of_the_snapshot_observes_once(spark):
    again = QUERIES["snapshot_rerun"](spark, "/root/testdata/sf0.001")
    # The rerun reads the settled observations, not the lines a second time.
    assert again.inputFiles() and not any("lineitem" in name for name in again.inputFiles())

import datetime as dt

from pyspark.sql import functions as F

from matchloom.operators import quality as q
from matchloom.plans.star_tests import star_tests, status_rule


def test_key_tests_treat_nulls_as_declared(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, None)], "k int, v string")
    assert rows(q.unique_failures(df, "k")) == [(1, 2)]
    assert rows(q.unique_combination_failures(df, ["k", "v"])) == [(1, "a", 2), (None, "b", 2)]
    assert q.not_null_failures(df, "v").count() == 1


def test_null_children_pass(spark, rows):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "id int")
    assert rows(q.relationship_failures(child, "k", parent, "id")) == [(9,), (9,)]


def test_check_passes_on_null(spark, rows):
    df = spark.createDataFrame([(1,), (7,), (None,)], "n int")
    assert rows(q.check_failures(df, F.col("n").between(1, 5))) == [(7,)]


def test_suite_and_stored_failures(spark, rows, tmp_path):
    tables = {"a": spark.createDataFrame([(1, "dead"), (1, "odd"), (2, None)], "k int, status string"),
              "b": spark.createDataFrame([(1,)], "k int")}
    tests = [q.Test("a", "unique", ("k",)), q.Test("a", "not_null", ("status",), severity="warn"),
             q.Test("a", "relationships", ("k",), "b", "k"), q.Test("b", "unique", ("k",)), status_rule("a")]
    report = rows(q.run_suite(tests, tables))
    assert report == [
        ("check:a.status accepted", "error", 1, "fail"), ("not_null:a.status", "warn", 1, "warn"),
        ("relationships:a.k", "error", 1, "fail"), ("unique:a.k", "error", 1, "fail"), ("unique:b.k", "error", 0, "pass")]
    paths = q.store_failures(tests, tables, str(tmp_path / "audit"))
    stored = {name: spark.read.parquet(path).count() for name, path in paths.items()}
    assert stored == {name: failures for name, _s, failures, _st in report}


def test_declared_suite_size():
    tests = star_tests()
    kinds = [t.kind for t in tests]
    assert len(tests) == 63 and kinds.count("relationships") == 7 and kinds.count("unique_combo") == 6
    assert len({t.name for t in tests}) == 63


def test_grain_flow(spark, rows):
    matches = spark.createDataFrame([(1,)], "match_id int")
    maps = spark.createDataFrame([(10, 1), (11, 1), (11, 2)], "map_id int, match_id int")
    out = q.grain_flow([("matches", matches, ["match_id"]), ("maps", maps, ["map_id"])], [("maps", "match_id", "matches")])
    assert rows(out) == [
        ("grain:maps", 3, 2, False), ("grain:matches", 1, 1, True), ("keys:maps.match_id->matches", 2, 1, False)]


def test_freshness_of_an_empty_source_is_an_error(spark, rows):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "at timestamp_ntz")
    now = F.expr("timestamp_ntz'2024-01-02 00:00:00'")
    out = q.freshness({"full": (df, "at"), "empty": (df.limit(0), "at")}, now, 12, 48)
    assert rows(out, "source", "status") == [("empty", "error"), ("full", "warn")]

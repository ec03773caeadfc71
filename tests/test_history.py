import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from matchloom.operators import asof, ordered, scd2

T0 = dt.datetime(2024, 1, 1)


def at(day):
    return T0 + dt.timedelta(days=day)


def now(day):
    return F.lit(at(day)).cast("timestamp_ntz")


def sparse_rows(seed, size):
    """(key, ts, id, value); one key holds a third, times repeat, some keys and values are null."""
    rng = random.Random(seed)
    return [(rng.choice([1] * 5 + [None, 2, 3, 4, 5, 6, 7, 8, 9]), at(rng.randint(0, 90)), n, rng.choice([None, "a", "b", "c"]))
            for n in range(size)]


@pytest.mark.parametrize("unit", ["day", "month"])
def test_previous_equals_plain_window(spark, rows, unit):
    df = spark.createDataFrame(sparse_rows(1, 400), "k int, ts timestamp_ntz, id int, v string")
    out = ordered.with_previous(df, ["k"], ["ts", "id"], F.date_trunc(unit, F.col("ts")), ["v"])
    by_key = Window.partitionBy("k").orderBy("ts", "id")
    plain = df.withColumn("prev_seen", F.row_number().over(by_key) > 1).withColumn("prev_v", F.lag("v").over(by_key))
    assert rows(out) == rows(plain)


@pytest.mark.parametrize("unit", ["day", "month"])
def test_carry_forward_equals_plain_window(spark, rows, unit):
    df = spark.createDataFrame(sparse_rows(2, 400), "k int, ts timestamp_ntz, id int, v string")
    out = ordered.carry_forward(df, ["k"], ["ts", "id"], F.date_trunc(unit, F.col("ts")), "v")
    by_key = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(out) == rows(df.withColumn("v", F.last("v", ignorenulls=True).over(by_key)))


def test_snapshot_runs(spark, rows):
    schema = "player_id long, team_name string, observed_map_date timestamp_ntz"

    def current(*members):
        return spark.createDataFrame(list(members), schema)

    history = scd2.empty_history(current((1, "A", at(0))), "player_id")
    history = scd2.scd2_apply(history, current((1, "A", at(0)), (2, "B", at(0))), "player_id", ["team_name"], now(1))
    # Player 1 plays on for A, player 2 moves, player 3 appears.
    second = current((1, "A", at(5)), (2, "C", at(5)), (3, "A", at(5)))
    history = scd2.scd2_apply(history, second, "player_id", ["team_name"], now(6))
    expected = [
        (1, "A", at(0), at(1), None), (2, "B", at(0), at(1), at(6)), (2, "C", at(5), at(6), None),
        (3, "A", at(5), at(6), None)]
    columns = ["player_id", "team_name", "observed_map_date", "valid_from", "valid_to"]
    assert rows(history, *columns) == sorted(expected, key=repr)
    # A rerun on the same input adds nothing, and a missing player stays open.
    again = scd2.scd2_apply(history, second.filter("player_id <> 3"), "player_id", ["team_name"], now(7))
    assert rows(again) == rows(history)
    assert again.select("scd_id").distinct().count() == 4


def test_null_to_value_is_a_change(spark, rows):
    schema = "player_id long, team_name string"
    one = spark.createDataFrame([(1, None)], schema)
    history = scd2.scd2_apply(scd2.empty_history(one, "player_id"), one, "player_id", ["team_name"], now(1))
    history = scd2.scd2_apply(history, one, "player_id", ["team_name"], now(2))
    assert history.count() == 1
    history = scd2.scd2_apply(history, spark.createDataFrame([(1, "A")], schema), "player_id", ["team_name"], now(3))
    assert rows(history, "team_name", "valid_to") == [("A", None), (None, at(3))]


def test_backfill_equals_run_by_run_and_intervals_do_not_overlap(spark, rows):
    rng = random.Random(3)
    facts = [(rng.choice([1, 1, 1, 2, 3, 4]), rng.choice("AB"), at(rng.randint(0, 59)), n) for n in range(120)]
    df = spark.createDataFrame(facts, "player_id long, team_name string, map_date timestamp_ntz, map_id long")
    runs = [now(d) for d in (10, 20, 30, 40, 50)]
    seen = scd2.observe(df, "player_id", ["team_name", "map_date"], ["map_date", "map_id"],
                        scd2.first_run_from(F.col("map_date"), runs), {"map_date": "observed_map_date"}).cache()
    history = scd2.empty_history(seen.drop("run_at"), "player_id")
    for run in runs:
        history = scd2.scd2_apply(history, scd2.current_at(seen, "player_id", run), "player_id", ["team_name"], run)
    bulk = scd2.scd2_backfill(seen, "player_id", ["team_name"])
    assert rows(bulk) == rows(history.select(*bulk.columns))
    a, b = bulk.alias("a"), bulk.alias("b")
    overlap = a.join(b, (F.col("a.player_id") == F.col("b.player_id")) & (F.col("a.valid_from") < F.col("b.valid_from"))
                     & (F.col("a.valid_to").isNull() | (F.col("a.valid_to") > F.col("b.valid_from"))))
    assert overlap.count() == 0
    dim = scd2.roster_dim(bulk)
    assert dim.filter("is_current").groupBy("player_id").count().filter("count > 1").count() == 0


def intervals(spark):
    return spark.createDataFrame(
        [(1, "A", at(1), at(6)), (1, "B", at(6), None), (2, "C", at(2), at(3)), (2, "D", at(40), None)],
        "player_id long, team_name string, valid_from timestamp_ntz, valid_to timestamp_ntz")


def test_point_in_time_is_half_open(spark, rows):
    teams = lambda day: rows(asof.as_of(intervals(spark), now(day)), "team_name")
    assert teams(0) == [] and teams(1) == [("A",)] and teams(6) == [("B",)] and teams(3) == [("A",)]


def test_roster_as_of(spark, rows):
    names = spark.createDataFrame([(1, "Ann"), (2, "Bo")], "player_id long, player_name string")
    assert rows(asof.roster_as_of(intervals(spark), names, "B", now(7))) == [(1, "Ann")]


def test_interval_join_equals_range_join(spark, rows):
    rng = random.Random(4)
    facts = spark.createDataFrame(
        [(rng.choice([1, 1, 1, 2, 9]), at(rng.randint(0, 60)), n) for n in range(150)],
        "player_id long, map_date timestamp_ntz, map_id long")
    history = intervals(spark)
    out = asof.interval_join(facts, history, ["player_id"], "map_date", ["team_name"], ["map_id"])
    brute = facts.join(history, "player_id").filter(
        asof.covers(F.col("map_date"), F.col("valid_from"), F.col("valid_to"))).select(*out.columns)
    assert out.count() > 0 and rows(out) == rows(brute)

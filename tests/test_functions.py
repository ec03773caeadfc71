import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchloom.functions import cells, dates, scalar, text


def one(spark, value, *exprs):
    df = spark.createDataFrame([(value,)], "x string")
    return tuple(df.select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).first())


X = F.col("x")


@pytest.mark.parametrize("raw, expected", [
    ("19(10)", (19, 10)), ("20 (12)", (20, 12)), ("19", (19, 0)), ("-", (None, None)), ("", (None, None))])
def test_pair(spark, raw, expected):
    assert one(spark, raw, *cells.pair(X)) == expected


@pytest.mark.parametrize("raw, expected", [
    ("5 : 0", (5, 0, False)), ("5:2", (5, 2, False)), ("", (0, 0, True)), ("n/a", (0, 0, True))])
def test_colon_pair(spark, raw, expected):
    assert one(spark, raw, *cells.colon_pair(X)) == expected


@pytest.mark.parametrize("raw, expected", [("3", (3, False)), ("-2", (-2, False)), ("", (0, True))])
def test_int_cell(spark, raw, expected):
    assert one(spark, raw, *cells.int_cell(X)) == expected


@pytest.mark.parametrize("raw, expected", [
    ("+14.68%", (0.1468, False)), ("-3.00 %", (-0.03, False)), ("n/a", (0.0, True)), ("14.68", (0.0, True))])
def test_percent_cell(spark, raw, expected):
    assert one(spark, raw, *cells.percent_cell(X)) == expected


@pytest.mark.parametrize("raw, ratio, rating", [
    ("70.0%", 0.7, 70.0), ("N/A", None, None), ("-1.24", -0.012, 1.24), ("1.1d", None, None), ("", None, None)])
def test_required_numbers(spark, raw, ratio, rating):
    assert one(spark, raw, cells.ratio(X), cells.rating(X)) == (ratio, rating)


@pytest.mark.parametrize("raw, expected", [
    ("Results for May 5th 2025", dt.date(2025, 5, 5)), ("Results for August 1st 2025", dt.date(2025, 8, 1)),
    ("Results for august 22nd 2024", dt.date(2024, 8, 22)), ("Results for not-a-date", None),
    ("Results for February 30th 2025", None)])
def test_headline_date(spark, raw, expected):
    assert one(spark, raw, dates.headline_date(X)) == (expected,)


@pytest.mark.parametrize("raw, expected", [
    ("played 2025-08-05 14:30 in", "2025-08-05 14:30:00"), ("on 2025-08-05.", "2025-08-05"),
    ("2025-08-05 9:05", "2025-08-05 9:05:00"), ("none", None)])
def test_text_date(spark, raw, expected):
    assert one(spark, raw, dates.text_date(X)) == (expected,)


@pytest.mark.parametrize("raw, expected", [
    ("1704067200000", dt.datetime(2024, 1, 1)), ("999999999999999999999", None), ("soon", None),
    ("-1000", dt.datetime(1969, 12, 31, 23, 59, 59))])
def test_millis(spark, raw, expected):
    assert one(spark, raw, dates.from_millis(dates.millis_attr(X))) == (expected,)


def test_millis_ignore_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, "1704067200000", dates.from_millis(dates.millis_attr(X))) == (dt.datetime(2024, 1, 1),)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("raw, expected", [
    ("best of 3\nand 5", "bo3"), ("Best of 5", "bo5"), ("BO1", "bo1"), ("final", None), ("Best of 35", "bo3")])
def test_best_of(spark, raw, expected):
    assert one(spark, raw, text.best_of(X)) == (expected,)


@pytest.mark.parametrize("raw, match, first", [
    ("/matches/111/a-vs-b", 111, "111"), ("/results/not-a-match", None, "/results/not-a-match")])
def test_url_keys(spark, raw, match, first):
    assert one(spark, raw, text.key_from_url(X, text.MATCH_KEY), text.text_key_from_url(X)) == (match, first)


@pytest.mark.parametrize("raw, expected", [("K (hs)", "khs"), ("Op. K-D", "op.kd"), ("Rating 3.0", "rating3.0")])
def test_header_key(spark, raw, expected):
    assert one(spark, raw, text.header_key(X)) == (expected,)


def test_preview_and_clip(spark):
    long = "e" * 61
    shown = one(spark, long, scalar.preview(X), scalar.clip(F.repeat(X, 10)))
    assert shown == ("e" * 60 + "...", "e" * 500)
    assert one(spark, "e" * 60, scalar.preview(X)) == ("e" * 60,)
    assert one(spark, None, scalar.preview(X)) == ("",)


def test_winner_and_loser(spark, rows):
    df = spark.createDataFrame([("A", "B", 2, 1), ("A", "B", 1, 1), ("A", "B", None, 1)], "a string, b string, s int, t int")
    won = scalar.winner_of(F.col("a"), F.col("b"), F.col("s"), F.col("t"))
    out = df.select(won.alias("w"), scalar.loser_of(won, F.col("a"), F.col("b")).alias("l"))
    assert [tuple(r) for r in out.collect()] == [("A", "B"), ("B", "A"), (None, None)]
    other = df.limit(1).select(scalar.loser_of(F.lit("C"), F.col("a"), F.col("b")).alias("l"))
    assert other.first()[0] is None


def test_recodes(spark):
    df = spark.createDataFrame([(s,) for s in ["pending", "dead", "partial", "discovered", "failed"]], "s string")
    out = df.select(scalar.recode_up(F.col("s")), scalar.recode_down(F.col("s"))).collect()
    assert [tuple(r) for r in out] == [
        ("discovered", "pending"), ("dead", "failed"), ("partial", "failed"), ("discovered", "pending"),
        ("failed", "failed")]


def test_surrogate_key_tells_null_from_text(spark):
    df = spark.createDataFrame([(1, None), (1, ""), (1, "x")], "a int, b string")
    assert df.select(scalar.surrogate_key(F.col("a"), F.col("b"))).distinct().count() == 3


def test_mean_rounds_half_up_whatever_the_order(spark):
    df = spark.createDataFrame([(1.0,), (1.01,), (1.0,), (1.01,)], "v double")
    assert df.agg(scalar.exact_mean(F.col("v"), scale=2)).first()[0] == 1.01
    fine = spark.createDataFrame([(0.0000001,), (0.0000003,), (None,)], "v double")
    assert fine.agg(scalar.exact_mean(F.col("v"), 7, scale=7)).first()[0] == 0.0000002
    assert fine.filter("v > 1").agg(scalar.exact_mean(F.col("v"), scale=2)).first()[0] is None
    assert spark.createDataFrame([(1e15,)], "v double").agg(scalar.exact_mean(F.col("v"), scale=2)).first()[0] == 1e15


def test_markers_and_required_element(spark):
    page = '<title>Just a moment...</title> Checking  your\n BROWSER checking your browser'
    assert one(spark, page, F.array_join(text.markers_in(X), ","), text.holds_element(X, "div", "match-info-box"),
               text.snippet(X, 20)) == ("checking_your_browser,just_a_moment", False, "<title>Just a moment")
    assert one(spark, '<DIV id=a class="a match-info-box">', text.holds_element(X, "div", "match-info-box")) == (True,)
    assert one(spark, '<div class="match-info-boxes">', text.holds_element(X, "div", "match-info-box")) == (False,)

import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchloom import schemas
from matchloom.operators.leaderboard import ranked, top_players
from matchloom.plans import build as b
from matchloom.plans import declared as d
from matchloom.plans import models as m
from matchloom.sources import tables as t

T0 = dt.datetime(2025, 5, 1)


def match(key=1, winner="NAVI", **over):
    row = dict(match_id=key, match_url=f"/matches/{key}", map_links=[], demo_links=[], team1="NAVI", team2="G2", score1=2,
               score2=0, winner=winner, event="Open", match_type="bo3", forfeit=False, date=T0, last_inserted_at=T0,
               last_scraped_at=T0, last_updated_at=T0, data_complete=True)
    return tuple({**row, **over}.values())


def game(key, match_id, order, name="Nuke", winner="NAVI"):
    return (key, match_id, f"/m/{key}", order, name, 13, 7, winner, T0, T0, T0, T0, True)


def player(map_id, key, name="ann", team="NAVI", rating=1.1, inserted=T0, kills=20):
    return (map_id, key, name, f"/p/{key}", "parsed", team, kills, 9, 3, 1, 15, 2, 4, 2, 5, 1, 0.7, 5, 80.5, 2, 0.03, rating,
            inserted, inserted, inserted, True)


@pytest.fixture
def base(spark):
    return {
        "matches": spark.createDataFrame([match(1), match(2, winner="Nobody"), match(3)], schemas.MATCHES),
        "maps": spark.createDataFrame([game(10, 1, 1), game(11, 1, 2, "Train", "G2"), game(20, 2, 1)], schemas.MAPS),
        "players": spark.createDataFrame(
            [player(10, 5), player(11, 5, name="ann2", team=None), player(10, 6, team="G2"), player(99, 6)], schemas.PLAYERS)}


def test_grains_and_derivations(spark, rows, base):
    staged = m.stg_matches(base["matches"])
    assert "map_links" not in staged.columns and "match_winner" in staged.columns and len(staged.columns) == 15
    enriched = m.int_match_player_stats(m.stg_players(base["players"]), m.stg_maps(base["maps"]), staged)
    assert len(enriched.columns) == 34
    assert rows(enriched, "map_id", "player_id", "map_name", "match_winner") == [
        (10, 5, "Nuke", "NAVI"), (10, 6, "Nuke", "NAVI"), (11, 5, "Train", "NAVI")]
    assert rows(m.fact_matches(staged, base["maps"]), "match_id", "losing_team", "map_count") == [
        (1, "G2", 2), (2, None, 1), (3, "G2", 0)]
    # Same insert time: the higher map id decides; a map without a team does not count for the team.
    assert rows(m.dim_players(m.stg_players(base["players"])), "player_id", "player_name") == [(5, "ann2"), (6, "ann")]
    assert rows(m.int_player_current_team(enriched), "player_id", "team_name") == [(5, "NAVI"), (6, "G2")]
    assert rows(m.dim_maps(base["maps"])) == [("Nuke",), ("Train",)]


def test_build_writes_marts_and_passes_views_through(spark, rows, base, tmp_path):
    clean = {**base, "players": base["players"].filter("map_id <> 99")}
    clean["matches"] = base["matches"].filter("match_id <> 2")
    clean["maps"] = base["maps"].filter("match_id <> 2")
    now = F.lit(T0).cast("timestamp_ntz")
    tables, report = b.build_and_test(**clean, root=str(tmp_path / "b"), now=now)
    assert {r["status"] for r in report.collect()} == {"pass"}
    assert spark.read.parquet(str(tmp_path / "b" / "fact_matches")).count() == 2
    b.publish_views(tables)
    assert t.missing_tables(spark, ["fact_matches", "dim_players", "no_such", "also_not"]) == ["also_not", "no_such"]
    assert spark.sql("select count(*) from dim_maps").first()[0] == 2
    again = b.build(**clean, root=str(tmp_path / "c"), now=now, history=tables[b.SNAPSHOT])
    assert rows(again[b.SNAPSHOT]) == rows(tables[b.SNAPSHOT])


def test_views_with_joins_are_written_once(spark, base, tmp_path):
    tables = b.build(**base, root=str(tmp_path / "b"), now=F.lit(T0).cast("timestamp_ntz"))
    for name in ("int_match_player_stats", "int_player_current_team"):
        read = tables[name].inputFiles()
        assert read and all(f"/b/{name}/" in file for file in read)


def test_leaderboard(spark):
    rows_ = [("a", 1.005), ("a", 1.015), ("b", None), ("b", None), ("c", 9.9), ("d", 1.01), ("d", None), ("e", 1.01), ("e", 1.01)]
    df = spark.createDataFrame(rows_, "player_name string, rating double")
    board = top_players(df, min_maps=2, limit=10)
    assert [tuple(r) for r in board.collect()] == [("b", 2, None), ("a", 2, 1.01), ("d", 2, 1.01), ("e", 2, 1.01)]
    kept = top_players(df, min_maps=2, limit=2, drop_null_means=True)
    assert [tuple(r) for r in ranked(kept).collect()] == [(1, "a", 2, "1.01"), (2, "d", 2, "1.01")]
    assert t.as_json_rows(kept).first()[0] == '{"player_name":"a","maps_played":2,"avg_rating":1.01}'
    for bad in (dict(limit=0), dict(limit=101), dict(min_maps=0)):
        with pytest.raises(ValueError):
            top_players(df, **bad)


def test_stints_transfers_and_aliases(spark, rows):
    def day(n):
        return T0 + dt.timedelta(days=n)
    plays = [(1, "x", "A", day(0), 1), (1, "x", "A", day(40), 2), (1, "y", "B", day(41), 3), (1, "y", "A", day(90), 4), (2, "z", "A", day(3), 5)]
    df = spark.createDataFrame(plays, "player_id long, player_name string, team_name string, map_date timestamp_ntz, map_id long")
    as_day = lambda n: day(n).date()
    assert rows(d.player_team_history(df), "player_id", "team_name", "start_date", "end_date") == sorted([
        (1, "A", as_day(0), as_day(41)), (1, "B", as_day(41), as_day(90)), (1, "A", as_day(90), None), (2, "A", as_day(3), None)], key=repr)
    assert rows(d.player_transfers(df), "player_id", "old_team_name", "new_team_name", "transfer_date") == sorted([
        (1, "A", "B", as_day(41)), (1, "B", "A", as_day(90))], key=repr)
    named = df.withColumnRenamed("map_date", "inserted_at")
    assert rows(d.player_aliases(named), "player_id", "alias", "changed_at") == [(1, "y", day(41))]


def test_incremental_fact_from_nothing_and_again(spark, rows):
    full = spark.createDataFrame([(1, T0, 5), (2, T0 + dt.timedelta(1), 6)], "k int, at timestamp_ntz, v int")
    first = d.incremental_fact(full.limit(0), full, ["k"], "at")
    assert rows(first) == rows(full)
    changed = full.withColumn("v", F.col("v") + 1)
    assert rows(d.incremental_fact(full.filter("k = 1"), changed, ["k"], "at"), "k", "v") == [(1, 6), (2, 7)]


def test_incremental_fact_takes_ties_and_late_rows(spark, rows):
    fact = spark.createDataFrame([(1, T0, 5)], "k int, at timestamp_ntz, v int")
    found = spark.createDataFrame([(1, T0, 6), (2, T0, 7), (3, T0 - dt.timedelta(1), 8), (4, T0 - dt.timedelta(3), 9)], fact.schema)
    assert rows(d.incremental_fact(fact, found, ["k"], "at"), "k", "v") == [(1, 6), (2, 7)]
    late = d.incremental_fact(fact, found, ["k"], "at", F.expr("interval 2 days"))
    assert rows(late, "k", "v") == [(1, 6), (2, 7), (3, 8)]


def test_runs_count_items_by_their_final_outcome(spark, rows):
    tries = [("r1", 1, 1, False, True, "busy"), ("r1", 1, 2, True, False, None), ("r1", 2, 1, False, False, "gone"),
             ("r1", 3, 1, False, True, "busy"), ("r2", 1, 1, True, False, None)]
    log = spark.createDataFrame(tries, "run string, match_id int, n int, ok boolean, retryable boolean, error string")
    out = d.scrape_runs(log, ["run"], ["match_id"], "n", [F.col("n")])
    assert rows(out, "run", "total_matches", "matches_success", "matches_failed", "started_at", "ended_at") == [
        ("r1", 3, 1, 1, 1, 2), ("r2", 1, 1, 0, 1, 1)]


def test_completeness_needs_valid_values(spark, rows):
    maps = spark.createDataFrame([
        (1, 1, "u", 1, "Nuke", 13, 5, "A", T0), (2, 1, "u", 7, "Nuke", 13, 5, "A", T0), (3, 1, "u", 2, "Nuke", -1, 5, "A", T0),
        (4, 1, "u", 2, None, 1, 5, "A", T0)],
        "map_id int, match_id int, map_url string, map_order int, map_name string, team1_score int, team2_score int, map_winner string, date timestamp_ntz")
    assert rows(d.with_completeness(maps, "maps"), "map_id", "data_complete") == [(1, True), (2, False), (3, False), (4, False)]


def test_completeness(spark, rows):
    matches = spark.createDataFrame([(1,), (2,), (3,)], "match_id int")
    state = spark.createDataFrame([(1, "processed"), (1, "failed"), (2, "dead")], "match_id int, status string")
    assert rows(d.match_completeness(matches, state)) == [(1, 2, 1, "partial"), (2, 1, 1, "processed"), (3, 0, 0, "processed")]


def test_keyset_pages_cover_everything_once(spark):
    df = spark.createDataFrame([match(i, date=T0 + dt.timedelta(i // 3)) for i in range(10)], schemas.MATCHES)
    shown, after = [], None
    while True:
        page = d.recent_matches(df, 4, after, team="G2").collect()
        if not page:
            break
        shown += [r["match_id"] for r in page]
        after = (F.lit(page[-1]["date"]).cast("timestamp_ntz"), F.lit(page[-1]["match_id"]))
    assert shown == sorted(range(10), key=lambda i: (i // 3, i), reverse=True)


def test_sources_are_read_by_declared_schema(spark, rows, base, tmp_path):
    base["maps"].write.parquet(str(tmp_path / "maps"))
    assert rows(t.scan(spark, str(tmp_path / "maps"), schemas.MAPS)) == rows(base["maps"])
    with pytest.raises(Exception):
        t.materialise(base["maps"], str(tmp_path / "maps"))

"""The log of fetched pages against a dictionary, and parsers on past pages."""

import hashlib
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from matchloom.operators import pages as pg
from matchloom.streaming import jobs, snapshots

PAGE = "url string, seen_at timestamp_ntz, html string"
DAY = datetime(2024, 5, 1)


def digest(html):
    return hashlib.sha256((html or "").encode()).hexdigest()


def frame(spark, fetched):
    return spark.createDataFrame(fetched, PAGE)


def at(moment):
    return F.lit(moment).cast("timestamp_ntz")


def stood(fetched, moment):
    newest = {}
    for url, seen, html in fetched:
        if url is not None and seen is not None and seen <= moment:
            newest[url] = max(newest.get(url, (datetime.min, "", "")), (seen, digest(html), html or ""))
    return sorted(((url, *found) for url, found in newest.items()), key=repr)


def files_of(root, table):
    return sorted(p for p in (root / table).rglob("*.parquet"))


def test_repeated_changed_and_returning_bodies_in_any_order(spark, rows, tmp_path):
    rng = random.Random(4)
    fetched = [(f"/p/{rng.randint(0, 6)}", DAY + timedelta(days=rng.randint(0, 5)), rng.choice(["alpha", "beta", "ä gamma", "", None])) for _ in range(60)]
    fetched += [(None, DAY, "no url"), ("/p/1", None, "no moment"), ("/p/late", DAY - timedelta(days=9), "alpha")]
    log = snapshots.open_log(spark, str(tmp_path / "log"), 3)
    for n, first in enumerate((42, 0, 21)):
        for _again in range(2):
            snapshots.append_pages(log, frame(spark, fetched[first:first + 21]), n)
    for days in (-20, -5, 0, 2, 4, 5):
        moment = DAY + timedelta(days=days)
        assert rows(snapshots.pages_at(log, at(moment))) == stood(fetched, moment)
    assert rows(log.read("bodies")) == sorted([(digest(x), x) for x in ("alpha", "beta", "ä gamma", "")], key=repr)
    named = {(u, s, digest(h)) for u, s, h in fetched if u is not None and s is not None}
    expected = {}
    for url, seen, found in named:
        expected.setdefault((url, found), []).append(seen)
    assert rows(snapshots.page_versions(log)) == sorted([(u, d, min(s), max(s), len(s)) for (u, d), s in expected.items()], key=repr)


def test_known_bodies_are_not_written_again(spark, rows, tmp_path):
    log = snapshots.open_log(spark, str(tmp_path / "log"), 2)
    big = ["x" * 50_000 + str(n) for n in range(20)]
    snapshots.append_pages(log, frame(spark, [(f"/p/{n}", DAY, html) for n, html in enumerate(big)]), 0)
    before = {p: p.stat().st_size for p in files_of(tmp_path / "log", "bodies")}
    snapshots.append_pages(log, frame(spark, [(f"/p/{n}", DAY + timedelta(days=1), html) for n, html in enumerate(big)] + [("/p/0", DAY + timedelta(days=2), "new")]), 1)
    new = [p for p in files_of(tmp_path / "log", "bodies") if p not in before]
    assert spark.read.parquet(*map(str, new)).count() == 1
    assert log.read("bodies").count() == 21 and log.read("fetches").count() == 41


def test_stream_of_fetches_and_a_parser_on_a_past_day(spark, rows, tmp_path):
    folder = str(tmp_path / "fetched")
    for day, link in enumerate(("/a/1/x", "/b/2/x", "/a/1/x")):
        frame(spark, [("/p", DAY + timedelta(days=day), f'<a href="{link}">l</a>')]).coalesce(1).write.mode("append").parquet(folder)
    log = snapshots.open_log(spark, str(tmp_path / "log"), 2)
    snapshots.append_stream(log, jobs.file_stream(spark, folder, spark.read.parquet(folder).schema, files_per_batch=1))
    assert log.last_batch("fetches") == 2 and log.read("bodies").count() == 2
    for day, link in ((0, "/a/1/x"), (1, "/b/2/x"), (7, "/a/1/x")):
        past = snapshots.pages_at(log, at(DAY + timedelta(days=day))).withColumn("page_id", F.lit(1))
        assert rows(pg.page_links(past), "href") == [(link,)]


def test_empty_batches(spark, rows, tmp_path):
    log = snapshots.open_log(spark, str(tmp_path / "log"), 2)
    snapshots.append_pages(log, frame(spark, []), 0)
    assert rows(snapshots.pages_at(log, at(DAY))) == [] and rows(snapshots.page_versions(log)) == []

"""Log of fetched pages: one body per content, one small row per fetch, and the pages of any past moment.

A fetch names a URL, a moment and the body found there. Bodies lie in a table of their own under the SHA-256 of their
bytes, so a page that is fetched again unchanged, or returns to what it was, costs a row without a body. Batches may come
in any order and more than once. Parsers run on ``pages_at`` as they do on fresh pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.operators.latest import latest_by
from matchloom.schemas import TEXT, WALL
from matchloom.session import settle
from matchloom.streaming import jobs
from matchloom.streaming.deltas import DeltaStore
from matchloom.streaming.store import Change

FETCHES = T.StructType([T.StructField("url", TEXT), T.StructField("seen_at", WALL), T.StructField("digest", TEXT)])
BODIES = T.StructType([T.StructField("digest", TEXT), T.StructField("html", TEXT)])


def open_log(spark: SparkSession, root: str, buckets: int = 16) -> DeltaStore:
    """Fetches are placed by URL and bodies by digest; both tables only grow."""
    return DeltaStore(spark, root, {"fetches": FETCHES, "bodies": BODIES}, {"fetches": ["url", "seen_at", "digest"], "bodies": ["digest"]},
                      buckets, {"fetches": ["url"]})


def append_pages(log: DeltaStore, pages: DataFrame, batch_id: int, writer: str = "fetches") -> None:
    """Add fetched pages (url, seen_at, html; further columns are not kept) as one batch.

    A null body is kept as an empty one. Rows without a URL or a moment name no fetch and are not added. Equal rows are one
    fetch; different bodies of one URL and moment are all kept. Bodies that the log holds are not written again.
    """
    if log.is_done(writer, batch_id):
        return
    html = F.coalesce("html", F.lit(""))
    named = pages.filter(F.col("url").isNotNull() & F.col("seen_at").isNotNull()).select("url", "seen_at", html.alias("html"), F.sha2(html, 256).alias("digest"))
    fetches = settle(named.select("url", "seen_at", "digest").distinct(), "fetches")
    digests = fetches.select("digest").distinct()

    def unseen(old: DataFrame) -> DataFrame:
        """Only new bodies: what is left out of a store of deltas stays as it is."""
        new = digests.join(old.select("digest"), "digest", "left_anti")
        return named.select("digest", "html").join(new, "digest", "left_semi").groupBy("digest").agg(F.first("html").alias("html"))

    log.publish(writer, batch_id, {
        "fetches": Change(fetches, lambda old: fetches.join(old, FETCHES.names, "left_anti")),
        "bodies": Change(digests, unseen)})


def append_stream(log: DeltaStore, pages: DataFrame, writer: str = "fetches") -> None:
    """Add what is available of a stream of fetched pages, micro-batch by micro-batch."""
    jobs.run_available(pages, log, writer, lambda batch, batch_id: append_pages(log, batch, batch_id, writer))


def pages_at(log: DeltaStore, moment: Column) -> DataFrame:
    """Pages as they stood at ``moment``: url, seen_at, digest, html of each URL's newest fetch until then.

    Of several bodies at that fetch's moment the one with the largest digest stands. Bodies are joined to what is chosen, never to the log.
    """
    newest = latest_by(log.read("fetches").filter(F.col("seen_at") <= moment), ["url"], [F.col("seen_at").desc(), F.col("digest").desc()])
    return newest.join(log.read("bodies"), "digest").select("url", "seen_at", "digest", "html")


def page_versions(log: DeltaStore) -> DataFrame:
    """Every content a URL has had: url, digest, ``first_seen``, ``last_seen``, ``n_fetches``."""
    return log.read("fetches").groupBy("url", "digest").agg(
        F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("last_seen"), F.count(F.lit(1)).alias("n_fetches"))

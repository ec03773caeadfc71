"""Players with the most similar stat profiles, by a forest of hash prefixes.

Profiles are rows ``player_id``, ``profile`` (an array of numbers); similarity is
the cosine. Each of ``trees`` trees gives a profile a string of ``BITS`` bits, one
per random hyperplane, and is the array of all profiles sorted by that string:
profiles with a common prefix stand together.

A tree's array is cut into shards by the first bits of the string, about
``SHARD_ROWS`` profiles each; a shard with more (near copies share long
prefixes) is cut again by id. A query first descends in each tree to the longest prefix
it shares with ``k + 1`` profiles. Then all trees ascend together to one prefix
length: the longest at which a profile as near as the k-th one found so far has
a chance below ``miss`` to share the prefix in no tree; with an angle of a, a
bit agrees with chance 1 - a / pi. A prefix shorter than the shards' leads to
all shards below it. At length 0 a query sees every profile, so it always ends.

Defined results: profiles that are null, zero, of another length than the most
common one, or hold null or non-finite numbers take no part; equal profiles are
indexed once, with their ids counted in full for ties (the ``k + 1`` smallest
suffice), and so are profiles that differ by a power of two alone, whose cosines are the same;
finite entries of any magnitude count; several rows of one player with one profile are one candidate, and none of
a player's own rows is a neighbour of that player. Fewer than ``k`` candidates give fewer rows.
Columns besides the two are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.session import Workspace

BITS = 48
TREES = 16
SHARD_ROWS = 2000
SHARD_QUERIES = 1000
MISS = 0.05
SEED = 20240517
SALTS = 64
FOUND_SCHEMA = "query long, profile_key long, score double"


def hyperplanes(width: int, trees: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((width, trees * BITS))


def hash_strings(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Bit strings as integers, one column per tree; the first bit is the highest."""
    bits = (vectors @ planes) >= 0
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    return np.stack([bits[:, k:k + BITS] @ weights for k in range(0, planes.shape[1], BITS)], axis=1)


def unpack(packed: Iterator[bytes]) -> np.ndarray:
    data = list(packed)
    return np.frombuffer(b"".join(data), "<f8").reshape(len(data), -1)


def usable(profiles: DataFrame) -> DataFrame:
    values = F.col("profile").cast("array<double>")
    fine = F.forall("profile", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return profiles.select(F.col("player_id").cast("long").alias("player_id"), values.alias("profile")).where(
        F.col("player_id").isNotNull() & F.col("profile").isNotNull() & fine & F.exists("profile", lambda v: v != 0))


def scaled(profile: np.ndarray) -> np.ndarray:
    """The profile with its largest entry between a half and one, by a power of two: cosines stay, and no square overflows."""
    return np.ldexp(profile, -np.frexp(np.abs(profile).max())[1])


def pack_profiles(profiles: DataFrame, work: Workspace) -> tuple[DataFrame, int]:
    """Settled ``player_id``, ``packed`` (little-endian doubles), ``content`` hash; and the common length."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scaled(np.asarray(v, "<f8") + 0.0) for v in batch.column("profile").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("player_id"), pa.array([r.tobytes() for r in rows], pa.binary()),
                                              pa.array([len(r) for r in rows], pa.int32())],
                                             names=["player_id", "packed", "width"])
    packed = work.settle(usable(profiles).mapInArrow(pack, "player_id long, packed binary, width int")
                         .withColumn("content", F.concat(F.xxhash64("packed").cast("string"), F.lit("/"), F.xxhash64(F.lit(1), "packed"))),
                         "packed")
    widths = packed.groupBy("width").count().orderBy(F.desc("count"), "width").limit(1).collect()
    width = widths[0]["width"] if widths else 0
    return packed.where(F.col("width") == width), width


def distinct_profiles(packed: DataFrame, k: int, work: Workspace) -> DataFrame:
    """One row per different profile: ``content``, ``profile_key`` (its smallest id), ``ids`` (the k + 1 smallest), ``packed``.

    Ids are ranked within salts first, so the ids of a very common profile are
    cut down in many tasks, and only short lists meet.
    """
    salted = packed.select("content", "player_id").distinct().withColumn("salt", F.pmod(F.xxhash64("player_id"), F.lit(SALTS)))
    rank = F.row_number().over(Window.partitionBy("content", "salt").orderBy("player_id"))
    short = salted.withColumn("place", rank).where(F.col("place") <= k + 1)
    keys = work.settle(short.groupBy("content").agg(
        F.slice(F.array_sort(F.collect_list("player_id")), 1, k + 1).alias("ids"))
        .withColumn("profile_key", F.element_at("ids", 1)), "keys")
    holders = packed.select(F.col("player_id").alias("profile_key"), "content", "packed")
    return work.settle(keys.join(holders, ["profile_key", "content"]).dropDuplicates(["profile_key", "content"]), "profiles")


def forest(profiles: DataFrame, width: int, trees: int, work: Workspace) -> DataFrame:
    """Profiles with their bit string in each tree, settled."""
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = hyperplanes(width, trees)
        for batch in batches:
            if batch.num_rows:
                rows = hash_strings(unpack(batch.column("packed").to_pylist()), planes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("profile_key"), batch.column("packed"), pa.array(rows.tolist(), pa.list_(pa.int64()))],
                    names=["profile_key", "packed", "strings"])
    return work.settle(profiles.select("profile_key", "packed").mapInArrow(
        strings, "profile_key long, packed binary, strings array<bigint>"), "forest")


def in_trees(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(*columns, F.posexplode("strings").alias("tree", "string"))


def prefix(string: Column, depth: Column | int) -> Column:
    return F.floor(string / F.pow(F.lit(2.0), F.lit(BITS) - depth)).cast("long")


def prefix_range(strings: np.ndarray, string: int, depth: int) -> tuple[int, int]:
    """Rows of the sorted array that share the first ``depth`` bits."""
    first = (string >> (BITS - depth)) << (BITS - depth)
    return int(np.searchsorted(strings, first)), int(np.searchsorted(strings, first + (1 << (BITS - depth))))


def longest_match(strings: np.ndarray, string: int, least: int) -> tuple[int, int]:
    """Rows under the longest prefix of ``string`` that at least ``least`` rows share."""
    low, high = 0, BITS
    while low < high:
        depth = (low + high + 1) // 2
        lo, hi = prefix_range(strings, string, depth)
        low, high = (depth, high) if hi - lo >= least else (low, depth - 1)
    return prefix_range(strings, string, low)


def search_piece(k: int):
    """Search of one piece of a shard: a tree's sorted array, and the queries sent there with their prefix length."""
    def search(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(rows) and len(queries):
            rows = rows.sort_values("string", kind="stable")
            strings, keys = rows["string"].to_numpy(), rows["profile_key"].to_numpy()
            vectors, wanted = unpack(rows["packed"]), unpack(queries["packed"])
            lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
            own = np.sqrt(np.einsum("ij,ij->i", wanted, wanted))
            cosines = (vectors @ wanted.T) / lengths[:, None] / own
            for q, (query, string, depth) in enumerate(zip(queries["query"], queries["string"], queries["depth"], strict=True)):
                lo, hi = longest_match(strings, int(string), k + 1) if depth < 0 else prefix_range(strings, int(string), int(depth))
                cosine = cosines[lo:hi, q]
                if len(cosine) > k + 1:
                    near = np.flatnonzero(cosine >= np.partition(cosine, -(k + 1))[-(k + 1)] - 1e-9) + lo
                else:
                    near = np.arange(lo, hi)
                exact = np.einsum("ij,j->i", vectors[near], wanted[q]) / (lengths[near] * own[q])
                parts.append(pd.DataFrame({"query": query, "profile_key": keys[near], "score": exact}))
        return pd.concat(parts) if parts else pd.DataFrame({"query": [], "profile_key": [], "score": []}).astype(
            {"query": "int64", "profile_key": "int64", "score": "float64"})
    return search


def search_round(rows: DataFrame, row_counts: DataFrame, level: int, targets: DataFrame, k: int, work: Workspace) -> DataFrame:
    """Candidates of the queries in ``targets`` (``query``, ``packed``, ``tree``, ``shard``, ``string``, ``depth``).

    A shard with many profiles or many queries is cut on both sides and every
    piece meets every block of queries, so no task holds more than a bounded block of each.
    """
    plan = work.settle(
        targets.groupBy("tree", "shard").agg(F.count("*").alias("queries")).join(row_counts, ["tree", "shard"])
        .select("tree", "shard", F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("row_pieces"),
                F.ceil(F.col("queries") / SHARD_QUERIES).cast("int").alias("query_pieces")), "plan")
    piece = ["tree", "shard", "row_piece", "query_piece"]

    def dealt(side: DataFrame, key: str, own: str, other: str) -> DataFrame:
        return side.join(plan, ["tree", "shard"]).withColumn(
            f"{own}_piece", F.pmod(F.xxhash64(key), F.col(f"{own}_pieces")).cast("int")).withColumn(
            f"{other}_piece", F.explode(F.sequence(F.lit(0), F.col(f"{other}_pieces") - 1)))
    stored = dealt(in_trees(rows, "profile_key", "packed").withColumn("shard", prefix(F.col("string"), level)),
                   "profile_key", "row", "query").select(*piece, "profile_key", "packed", "string")
    asked = dealt(targets, "query", "query", "row").select(*piece, "query", "packed", "string", "depth")
    found = stored.groupBy(*piece).cogroup(asked.groupBy(*piece)).applyInPandas(search_piece(k), FOUND_SCHEMA)
    # Near profiles turn up in many trees.
    return work.settle(found.groupBy("query", "profile_key").agg(F.max("score").alias("score")), "found")


def similar_players(profiles: DataFrame, queries: DataFrame, work: Workspace, *, k: int = 5, trees: int = TREES,
                    miss: float = MISS) -> DataFrame:
    """The ``k`` most similar other players of each player in ``queries``: ``player_id``, ``rank``, ``similar_id``, ``score``.

    Round one descends in every tree to the longest prefix that ``k + 1`` profiles share. The cosine of
    the k-th profile found so gives the prefix length that all trees ascend to in round two. Where that
    many trees under so short a prefix hold as many rows as the whole table, the query goes to the root of one tree.
    """
    packed, width = pack_profiles(profiles, work)
    known = distinct_profiles(packed, k, work)
    rows = forest(known, width, trees, work)
    level = max(0, math.ceil(math.log2(max(known.count(), 1) / SHARD_ROWS)))
    row_counts = work.settle(in_trees(rows).groupBy("tree", prefix(F.col("string"), level).alias("shard"))
                             .agg(F.count("*").alias("n")), "shards")
    asking = work.settle(queries.select(F.col("player_id").cast("long").alias("player_id")).distinct()
                         .join(packed.select("player_id", "content").distinct(), "player_id")
                         .join(known.select("content", "profile_key"), "content"), "asking")
    wanted = rows.join(asking.select("profile_key").distinct(), "profile_key", "left_semi")
    points = work.settle(in_trees(wanted.withColumnRenamed("profile_key", "query"), "query", "packed"), "points")
    first = search_round(rows, row_counts, level,
                         points.withColumn("shard", prefix(F.col("string"), level)).withColumn("depth", F.lit(-1)), k, work)

    by_query = Window.partitionBy("query").orderBy(F.desc("score"), "profile_key")
    kth = (first.withColumn("place", F.row_number().over(by_query)).where(F.col("place") <= k + 1)
           .groupBy("query").agg(F.min("score").alias("kth"), F.count("*").alias("n")))
    agree = F.lit(1.0) - F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("kth")))) / math.pi
    needed = 1.0 - miss ** (1.0 / trees)
    depth = F.when(F.col("n") <= k, 0).when(agree >= 1.0 - 1e-12, BITS).otherwise(
        F.least(F.lit(BITS), F.floor(F.log(F.lit(needed)) / F.log(F.greatest(agree, F.lit(1e-9))))).cast("int"))
    # At depth d all trees together look at trees / 2^d of the rows.
    levels = work.settle(kth.select("query", depth.alias("depth")).withColumn(
        "depth", F.when(F.pow(F.lit(2.0), F.col("depth")) <= trees, 0).otherwise(F.col("depth")).cast("int")), "levels")
    ascending = points.join(levels, "query").where((F.col("depth") > 0) | (F.col("tree") == 0))
    shorter = F.least(F.col("depth"), F.lit(level))
    under = F.pow(F.lit(2.0), F.lit(level) - shorter).cast("long")
    base = prefix(F.col("string"), shorter) * under
    second = search_round(rows, row_counts, level, ascending.withColumn(
        "shard", F.explode(F.sequence(base, base + under - 1))), k, work)

    best = (first.unionByName(second).groupBy("query", "profile_key").agg(F.max("score").alias("score"))
            .withColumn("place", F.rank().over(Window.partitionBy("query").orderBy(F.desc("score"))))
            .where(F.col("place") <= k + 1))
    listed = work.settle(best.join(known.select("profile_key", "ids"), "profile_key")
                         .select(F.col("query").alias("profile_key"), "score", F.explode("ids").alias("similar_id")), "listed")
    pairs = asking.select("player_id", "profile_key").join(listed, "profile_key").where(F.col("similar_id") != F.col("player_id"))
    nearest = pairs.groupBy("player_id", "similar_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("player_id").orderBy(F.desc("score"), "similar_id"))
    return nearest.withColumn("rank", rank).where(F.col("rank") <= k).select("player_id", "rank", "similar_id", "score")

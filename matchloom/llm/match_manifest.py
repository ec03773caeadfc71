"""Merkle manifest of the matches, with a proof per match.

A leaf is the digest of a match's ``fields``. Per ``group`` (the event), leaves stand in the order of
``key``; while more than one node is left, each run of ``FAN`` nodes becomes one, and what is left is the event's root.
The events' roots, in order of the event, become one root in the same way.

A proof is a path: per run on the way up, the digests before the match's node and those after it.
Paths are found by pointer jumping: every node knows the siblings on the way to an ancestor ``stride`` runs above it; one
self-join appends that ancestor's own siblings and doubles the stride, so a tree of
depth d takes log2(d) joins, whatever the size of the event.

Defined results: ``H`` is sha256 over concatenated text, digests as lower-case hex; a field is ``-`` if null, else its
UTF-8 byte count, ``:`` and the value as text; null keys and the null event come first, text sorts bytewise; matches
with equal keys stand in the order of their leaves, so repeated rows are leaves of their own; an empty table gives no row. Columns that
``fields`` do not name are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.running import NUMBER, before_each
from matchloom.session import Workspace

FAN = 3
FIELDS = ("match_id", "event", "match_type", "team1", "team2", "score1", "score2", "winner", "match_url")
STEP = "struct<before:binary,after:binary>"
COLUMNS = ("match", "leaf", "claimed_leaf", "subroot", "root", "path")


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of the values, each with its byte count, as bytes."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def fold(leaf: Column, path: Column) -> Column:
    """Root (hex) that a leaf (hex) has under a path."""
    return F.aggregate(path, leaf, lambda node, run: F.sha2(F.concat(hexed(run["before"]), node, hexed(run["after"])), 256))


def path_digest(path: Column) -> Column:
    """Digest of all siblings, level by level and left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda run: F.concat(hexed(run["before"]), hexed(run["after"]))), ""), 256)


def match_manifest(matches: DataFrame, work: Workspace, *, fields: Sequence[str] = FIELDS, key: str = "match_id",
                   group: str = "event", claims: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per match: ``match`` (its key), ``leaf``, ``claimed_leaf``, ``subroot`` and ``root`` in hex, ``path``.

    ``claims`` replaces fields by what someone else holds for the match; ``claimed_leaf`` is the leaf of that. The holder's
    copy is right if ``fold(claimed_leaf, path)`` is the root.
    """
    claims = claims or {}
    leaves = work.settle(matches.select(
        F.col(key).alias("match"), F.col(group).cast("string").alias("tree_name"), leaf_digest([F.col(c) for c in fields]).alias("leaf"),
        leaf_digest([claims.get(c, F.col(c)) for c in fields]).alias("claimed")), "leaves")
    order = [F.col("tree_name").asc_nulls_first(), F.col("match").asc_nulls_first(), F.col("leaf")]
    numbered = work.settle(before_each(leaves, work, "dealt", order, {}).select("match", "tree_name", "leaf", "claimed", NUMBER), "numbered")
    trees = work.settle(numbered.groupBy("tree_name").agg(F.min(NUMBER).alias("first"), F.count("*").alias("size")), "tree_sizes")
    trees = work.settle(before_each(trees, work, "tree_order", order[:1], {}).select(
        "tree_name", "first", "size", F.col(NUMBER).alias("tree")), "trees")
    rows = numbered.join(trees.withColumnRenamed("tree_name", "name"), F.col("tree_name").eqNullSafe(F.col("name"))).select(
        "tree", "size", (F.col(NUMBER) - F.col("first")).alias("place"), F.col("leaf").alias("digest"),
        F.struct("match", "claimed").alias("row"))
    many = trees.agg(F.max("size").alias("largest"), F.count("*").alias("trees")).first()
    paths, subroots = climb(rows, work, "leaf", many.largest or 1)
    tops, root = climb(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(many.trees).cast("long").alias("size"),
                                       F.col("tree").alias("place"), F.col("digest"), F.lit(True).alias("row")),
                       work, "top", many.trees)
    upper = work.settle(tops.join(root.select("tree", F.col("digest").alias("root")), "tree").select(
        F.col("place").alias("tree"), F.col("digest").alias("subroot"), F.col("path").alias("rest"), "root"), "upper")
    return paths.join(upper, "tree").select(
        F.col("row.match").alias("match"), hexed(F.col("digest")).alias("leaf"), hexed(F.col("row.claimed")).alias("claimed_leaf"),
        hexed(F.col("subroot")).alias("subroot"), hexed(F.col("root")).alias("root"), F.concat("path", "rest").alias("path"))


def climb(leaves: DataFrame, work: Workspace, name: str, largest: int) -> tuple[DataFrame, DataFrame]:
    """Paths of all leaves to the roots of their trees, and the roots.

    ``leaves`` are rows ``tree``, ``size`` (leaves of the tree), ``place`` (from 0), ``digest``, ``row`` (kept beside
    the leaf). A run holds at most ``FAN`` nodes, so no group grows with the data.
    """
    level, size, nodes, hops, roots = 0, largest, leaves, [], []
    while True:
        runs = work.settle(with_parent(nodes), f"{name}_runs{level}")
        hops.append(with_siblings(runs, level))
        roots.append(runs.where(F.col("size") <= FAN).select("tree", "digest"))
        if size <= FAN:
            break
        nodes = runs.where(F.col("size") > FAN).select(
            "tree", F.ceil(F.col("size") / FAN).alias("size"), "place", "digest", F.lit(None).cast(leaves.schema["row"].dataType).alias("row"))
        level, size = level + 1, -(-size // FAN)
    paths, stride = hops[0], 1
    for more in hops[1:]:
        paths = paths.unionByName(more)
    while stride <= level:
        ahead = work.settle(paths.where(F.col("level") % (2 * stride) == stride).select(
            F.col("tree").alias("up_tree"), (F.col("level") - stride).alias("up_level"), F.col("place").alias("up_place"),
            F.col("path").alias("up_path")), f"{name}_ahead{stride}")
        below = paths.where(F.col("level") % (2 * stride) == 0)
        ancestor = F.expr(f"place div {FAN ** stride}")
        joined = below.join(ahead, (F.col("tree") == F.col("up_tree")) & (F.col("level") == F.col("up_level"))
                            & (ancestor == F.col("up_place")), "left")
        paths = work.settle(joined.select("tree", "level", "place", "digest", "row", F.concat(
            "path", F.coalesce("up_path", F.array().cast(f"array<{STEP}>"))).alias("path")), f"{name}_paths{stride}")
        if stride > 1:
            work.drop(f"{name}_paths{stride // 2}")
        stride *= 2
    every = roots[0]
    for more in roots[1:]:
        every = every.unionByName(more)
    return paths.where("level = 0"), work.settle(every, f"{name}_roots")


def with_parent(nodes: DataFrame) -> DataFrame:
    """Runs of ``FAN`` nodes in order, with the digest of their parent; a tree of one node is its own root."""
    member = F.struct("place", "digest", "row")
    runs = nodes.groupBy("tree", "size", F.expr(f"place div {FAN}").alias("parent")).agg(F.collect_list(member).alias("members"))
    runs = runs.withColumn("members", F.array_sort("members", lambda a, b: (a["place"] - b["place"]).cast("int")))
    joined = F.array_join(F.transform("members", lambda m: hexed(m["digest"])), "")
    return runs.select("tree", "size", F.col("parent").alias("place"), "members", F.when(
        F.col("size") > 1, F.unhex(F.sha2(joined, 256))).otherwise(F.col("members")[0]["digest"]).alias("digest"))


def with_siblings(runs: DataFrame, level: int) -> DataFrame:
    """The runs' nodes, each with a path of one step: the digests before and after it in its run."""
    digests = F.transform("members", lambda m: m["digest"])

    def joined(side: Column) -> Column:
        return F.aggregate(side, F.lit(b""), lambda done, digest: F.concat(done, digest))

    def step(k: Column) -> Column:
        return F.struct(joined(F.slice(digests, 1, k)).alias("before"), joined(F.slice(digests, k + 2, FAN)).alias("after"))

    nodes = runs.select("tree", "size", F.explode(F.transform("members", lambda m, k: F.struct(m.alias("member"), step(k).alias("step")))).alias("n"))
    return nodes.select("tree", F.lit(level).alias("level"), F.col("n.member.place").alias("place"), F.col("n.member.digest").alias("digest"),
                        F.col("n.member.row").alias("row"), F.when(F.col("size") > 1, F.array("n.step")).otherwise(
                            F.array().cast(f"array<{STEP}>")).alias("path"))

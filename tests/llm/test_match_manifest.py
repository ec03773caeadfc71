"""Manifests against a plain tree: proofs, tampering, tree shapes, odd rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from matchloom.llm import match_manifest as manifest
from matchloom.session import Workspace
from matchloom.sources import adapter

MATCHES = "match_id long, event string, winner string"
FIELDS = ("match_id", "event", "winner")


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(values):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """Root of a list of digests, and each one's siblings on the way."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k:k + 3] for k in range(0, len(nodes), 3)]
        for n, at in enumerate(place):
            paths[n].append((runs[at // 3][:at % 3], runs[at // 3][at % 3 + 1:]))
            place[n] = at // 3
        nodes = [digest(*run) for run in runs]
    return nodes[0], paths


def brute(rows):
    events = {}
    for row in rows:
        events.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row[0]))
    names = sorted(events, key=lambda e: (e is not None, (e or "").encode()))
    trees = [climb([leaf for _, _, leaf, _ in sorted(events[e], key=lambda r: r[:3])]) for e in names]
    root, tops = climb([subroot for subroot, _ in trees])
    out = []
    for e, (subroot, paths), top in zip(names, trees, tops, strict=True):
        for (_, _, leaf, key), path in zip(sorted(events[e], key=lambda r: r[:3]), paths, strict=True):
            siblings = [d for before, after in path + top for d in before + after]
            out.append((key, leaf, subroot, root, digest(*siblings)))
    return sorted(out, key=repr)


def found(spark, matches, fields=FIELDS, **options):
    out = manifest.match_manifest(matches, Workspace(spark, "t"), fields=fields, **options).withColumns({
        "proof": manifest.path_digest(F.col("path")), "folded": manifest.fold(F.col("claimed_leaf"), F.col("path"))})
    return out.select("match", "leaf", "subroot", "root", "proof", "claimed_leaf", "folded").collect()


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [1, 1], [28, 1, 9, 10, 3], [1] * 11, [200, 82]])
def test_trees_of_any_shape(spark, sizes):
    rows = [(k, f"event {e}", "é") for e, n in enumerate(sizes) for k in range(1000 * e, 1000 * e + n)]
    got = found(spark, spark.createDataFrame(rows, MATCHES).repartition(3))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(rows)
    assert all(r.folded == r.root and r.claimed_leaf == r.leaf for r in got)


def test_a_changed_copy_is_found(spark):
    rows = [(k, f"e{k % 2}", f"team\n{k}" if k % 5 else None) for k in range(40)]
    changed = F.when(F.col("match_id") % 2 == 0, F.replace("winner", F.lit("\n"), F.lit(""))).otherwise(F.col("winner"))
    for r in found(spark, spark.createDataFrame(rows, MATCHES), claims={"winner": changed}):
        copy = rows[r.match][2].replace("\n", "") if rows[r.match][2] and r.match % 2 == 0 else rows[r.match][2]
        assert r.claimed_leaf == leaf_of((r.match, rows[r.match][1], copy))
        assert (r.folded == r.root) == (copy == rows[r.match][2])


def test_odd_rows(spark):
    rows = [(None, None, None), (None, None, None), (1, None, ""), (1, None, "x"), (1, "", "x"), (2, "Z", None), (2, "a", "1:2"), (3, "é", "long " * 20_000), (2, "Z", None)]
    got = found(spark, spark.createDataFrame(rows, MATCHES))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(rows)
    assert found(spark, spark.createDataFrame([], MATCHES)) == []
    wide = spark.createDataFrame([(1, "e", "w", "l", "t", 3)], MATCHES + ", leaf string, tree string, part_ int")
    assert [tuple(r)[:5] for r in found(spark, wide)] == brute([(1, "e", "w")])


def test_matches_of_the_library(spark):
    matches = adapter.matches(spark, "/root/testdata/sf0.001")
    got = found(spark, matches, fields=manifest.FIELDS)
    rows = [(r.match_id, r.event, *[r[f] for f in manifest.FIELDS[2:]]) for r in matches.collect()]
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(rows)
    assert all(r.folded == r.root for r in got)

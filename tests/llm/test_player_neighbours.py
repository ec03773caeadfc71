"""Similar players against brute force: recall, ties, odd profiles."""

import numpy as np

from matchloom.llm import player_neighbours as forest
from matchloom.session import Workspace

SCHEMA = "player_id long, profile array<double>"


def brute(rows, k):
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, v in fine:
        scored = {}
        for i, w in fine:
            if i != q:
                cosine = round(float(v @ w / np.sqrt(v @ v) / np.sqrt(w @ w)), 9)
                scored[i] = max(scored.get(i, -2), cosine)
        out[q] = sorted(scored.items(), key=lambda s: (-s[1], s[0]))[:k]
    return out


def found(spark, rows, queries, k=5):
    profiles = spark.createDataFrame(rows, SCHEMA)
    asked = spark.createDataFrame([(q,) for q in queries], "player_id long")
    out = {}
    for r in forest.similar_players(profiles, asked, Workspace(spark, "t"), k=k).orderBy("player_id", "rank").collect():
        out.setdefault(r.player_id, []).append((r.similar_id, round(r.score, 9)))
        assert r["rank"] == len(out[r.player_id])
    return out


def test_recall_through_deep_prefixes(spark, monkeypatch):
    monkeypatch.setattr(forest, "SHARD_ROWS", 60)
    monkeypatch.setattr(forest, "SHARD_QUERIES", 7)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((40, 16))
    rows = [(k, [float(x) for x in centres[k % 40] + 0.15 * rng.standard_normal(16)]) for k in range(1200)]
    queries = list(range(0, 1200, 20))
    wanted, got = brute(rows, 5), found(spark, rows, queries)
    hits = sum(len({i for i, _ in wanted[q]} & {i for i, _ in got[q]}) for q in queries)
    assert hits / (5 * len(queries)) >= 0.9
    assert all(len(got[q]) == 5 for q in queries)


def test_copies_ties_and_unusable_profiles(spark):
    rng = np.random.default_rng(2)
    base = [[float(x) for x in rng.standard_normal(4)] for _ in range(12)]
    rows = [(k, base[k]) for k in range(12)] + [(100 + k, base[0]) for k in range(20)] + [(50, [2 * x for x in base[1]])]
    odd = [(60, None), (61, []), (62, [0.0] * 4), (63, [1.0, None, 2.0, 3.0]), (64, [1.0, float("nan"), 2.0, 3.0]),
           (65, [1.0, float("inf"), 2.0, 3.0]), (66, [1.0, 2.0]), (None, base[2]), (3, base[3]), (3, base[4])]
    queries = [0, 1, 3, 50, 60, 62, 64, 66, 110, 999]
    usable = [r for r in rows + odd if r[0] not in (66,)]
    wanted, got = brute(usable, 5), found(spark, rows + odd, queries)
    assert set(got) == {0, 1, 3, 50, 110}
    for q in (0, 1, 50, 110):
        assert got[q] == wanted[q]
    assert 3 not in [i for i, _ in got[3]] and len(got[3]) == 5


def test_few_candidates_and_empty_table(spark):
    assert found(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])], [1, 2]) == {1: [(2, 0.0)], 2: [(1, 0.0)]}
    assert found(spark, [(1, [1.0, 0.0])], [1]) == {} and found(spark, [], [1]) == {}
    wide = spark.createDataFrame([(1, [1.0], 2, "x"), (2, [3.0], 2, "x")], SCHEMA + ", rank int, packed string")
    assert forest.similar_players(wide, wide, Workspace(spark, "t")).count() == 2


def test_extreme_magnitudes(spark):
    plain = [(1, [2.0, 1.0]), (2, [1.0, 1.0]), (3, [1.0, 2.0]), (4, [-1.0, 0.5])]
    size = {1: 1e200, 2: 1e-200, 3: 1e307, 4: 5e-324}
    rows = [(i, [x * size[i] for x in v]) for i, v in plain[:3]] + [(4, [-5e-324, 0.0])]
    wanted = {1: [2, 3, 4], 2: [1, 3, 4], 3: [2, 1, 4], 4: [3, 2, 1]}
    got = found(spark, rows, [1, 2, 3, 4])
    assert {q: [i for i, _ in near] for q, near in got.items()} == wanted
    assert abs(got[1][0][1] - 3 / np.sqrt(10)) < 1e-9 and got[4][0][1] == round(-1 / np.sqrt(5), 9)

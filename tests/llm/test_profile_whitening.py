"""Whitened profiles against a plain eigendecomposition; odd profiles."""

import numpy as np

from matchloom.llm import profile_whitening as whitening
from matchloom.session import Workspace
from matchloom.sources import adapter

SCHEMA = "player_id long, profile array<double>"


def brute(rows, components=16):
    usable = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) and abs(c) < whitening.LARGEST for c in v)]
    sizes = [len(v) for _, v in usable]
    width = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    cells = [(i, tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v)) for i, v in usable if len(v) == width]
    fit = np.array(sorted(set(x for _, x in cells)), dtype=object).reshape(-1, width)
    n, sums = len(fit), fit.sum(0)
    centred = ((fit * n - sums) / n).astype(float) if n else np.zeros((0, width))
    covariance = centred.T @ centred / max(n, 1)
    values, vectors = np.linalg.eigh(covariance) if n > 1 else (np.zeros(0), np.zeros((width, 0)))
    order = [k for k in np.argsort(-values) if values[k] > 1e-12 * max(values.max(), 1e-300)][:components]
    out = {}
    for i, x in cells:
        off = np.array(x, object) * n - sums
        for c, k in enumerate(order):
            out.setdefault((i, c + 1), []).append((n, int((off * off).sum()), float((off / n).astype(float) @ vectors[:, k] / np.sqrt(values[k])),
                                                   values[k] / np.trace(covariance)))
    return out


def whitened(spark, rows, components=16):
    out = {}
    frame = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, SCHEMA)
    for r in whitening.whiten_profiles(frame.repartition(3), Workspace(spark, "t"), components=components).collect():
        out.setdefault((r.player_id, r.component), []).append((r.n_profiles, r.deviation, r.whitened, r.explained))
        assert r.identity_error <= 1e-9
    return out


def alike(got, wanted):
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in wanted.items()}
    for component in {c for _, c in wanted}:
        keys = sorted((k for k in wanted if k[1] == component), key=repr)
        far = max(keys, key=lambda k: abs(wanted[k][0][2]))
        sign = np.sign(wanted[far][0][2]) * np.sign(got[far][0][2])
        for k in keys:
            for g, w in zip(sorted(got[k], key=lambda r: (r[1] is None, r[1], sign * r[2])), sorted(wanted[k], key=lambda r: (r[1], r[2])), strict=True):
                assert g[0] == w[0] and g[1] == (w[1] if w[1] < 2 ** 62 else g[1])
                assert abs(sign * g[2] - w[2]) < 1e-7 and abs(g[3] - w[3]) < 1e-9


def test_against_eigendecomposition(spark, monkeypatch):
    monkeypatch.setattr(whitening, "SLICE", 37)
    rng = np.random.default_rng(3)
    mix = rng.standard_normal((9, 9))
    rows = [(k, [float(c) for c in mix @ rng.standard_normal(9)]) for k in range(300)]
    rows += [(1000 + k, rows[0][1]) for k in range(200)]  # one profile holds two fifths of all rows
    alike(whitened(spark, rows, 6), brute(rows, 6))


def test_flat_and_dependent_dimensions(spark):
    rng = np.random.default_rng(4)
    rows = [(k, [float(a), 5.0, float(b), float(a)]) for k, (a, b) in enumerate(rng.integers(0, 50, (60, 2)))]
    got, wanted = whitened(spark, rows), brute(rows)
    assert {c for _, c in got} == {1, 2}
    alike(got, wanted)


def test_odd_profiles(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(c) for c in rng.standard_normal(3)]) for k in range(12)]
    rows += [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, float("nan"), 0.0]), (54, [float("-inf"), 0.0, 0.0]),
             (55, [1e300, 0.0, 0.0]), (56, [1.0, 2.0]), (None, [0.5, 0.25, -3.0]), (3, [0.0, 0.0, 0.0]), (4, rows[4][1])]
    alike(whitened(spark, rows), brute(rows))
    huge = rows[:12] + [(99, [2.0 ** 39, 0.0, 0.0])]
    got = whitened(spark, huge)
    assert got[(99, 1)][0][1] is None and got[(0, 1)][0][1] is None and len(got) == 13 * len({c for _, c in got})
    assert whitened(spark, []) == {} and whitened(spark, [(1, None)]) == {}
    assert whitened(spark, [(1, [1.0, 2.0])]) == {} and whitened(spark, [(k, [1.0, 2.0]) for k in range(5)]) == {}
    wide = spark.createDataFrame([(1, [1.0], 3, 2), (2, [2.0], 3, 2)], SCHEMA + ", cells int, component int")
    assert {k: round(v[0][2] ** 2, 9) for k, v in whitened(spark, wide).items()} == {(1, 1): 1.0, (2, 1): 1.0}


def test_stat_lines_of_the_library(spark):
    profiles = whitening.stat_profiles(adapter.players(spark, "/root/testdata/sf0.001")).limit(2000).cache()
    rows = [(r.player_id, list(r.profile)) for r in profiles.collect()]
    got = whitening.whiten_profiles(profiles, Workspace(spark, "t"), components=3).collect()
    wanted = brute(rows, 3)
    assert len(got) == sum(len(v) for v in wanted.values()) and {r.component for r in got} == {1, 2, 3}
    assert abs(got[0].explained - wanted[(got[0].player_id, got[0].component)][0][3]) < 1e-9 and got[0].identity_error < 1e-9

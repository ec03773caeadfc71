"""Whitening of player profiles: uncorrelated components of variance one.

Profiles are rows ``player_id``, ``profile`` (numbers of one stat line each; ``stat_profiles`` makes them from the
base table of players). Entries become whole numbers ``floor(64 * entry) + 1000000``; the fit list is each distinct whole-number
profile once. Its scatter, centred before multiplying, is factored by Cholesky with
diagonal pivoting; one-sided Jacobi rotations make the factor's columns orthogonal, so their squared norms are the
eigenvalues and the normalised columns the components.

Tasks send sums and products of a profile's entries only; what comes to the driver is one table of dimensions x dimensions
numbers, whatever the number of rows.

Defined results: a profile that is null or empty, or holds a null, a non-finite entry or one of ``LARGEST`` or more
in size, is dropped, and so is one whose length is not the most frequent (of equally frequent ones, the longest);
repeated rows all get results but count once in the fit; eigenvalues below ``RANK`` of the largest pivot count as 0, and
their components are left out, so equal profiles, a single profile or an empty table give no row; components are numbered by falling eigenvalue, equal
ones in the order Jacobi leaves them; a deviation beyond a long is null. Columns besides the two are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.session import Workspace

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
LARGEST = 2.0 ** 40
RANK = 1e-13
SLICE = 1024
STATS = ("kills", "headshots", "assists", "flash_assists", "deaths", "traded_deaths", "opening_kills", "opening_deaths",
         "multi_kills", "clutches_won", "kast", "kd_diff", "adr", "fk_diff", "round_swing", "rating")
COLUMNS = "player_id long, component int, n_profiles long, deviation long, whitened double, explained double"


def stat_profiles(players: DataFrame, stats: Sequence[str] = STATS) -> DataFrame:
    """Stat lines of the base table ``players`` as profiles."""
    return players.select("player_id", F.array(*[F.col(c).cast("double") for c in stats]).alias("profile"))


def whole_profiles(profiles: DataFrame) -> DataFrame:
    """``player_id``, ``cells``: usable profiles as whole numbers."""
    entries = F.col("profile").cast("array<double>")
    usable = (F.size(entries) > 0) & F.forall(entries, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))  # NaN is the largest
    rows = profiles.where(F.col("profile").isNotNull() & usable).select(
        F.col("player_id").cast("long").alias("player_id"), F.transform(entries, lambda c: F.floor(c * SCALE) + SHIFT).alias("cells"))
    common = rows.groupBy(F.size("cells").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return rows.where(F.size("cells") == (common.width if common else 0))


def task_sums(rows: DataFrame, measure: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """Sum of ``measure`` over all rows' ``cells``, as one flat array: each task adds up its own, Spark adds the tasks'."""
    number, width = (pa.int64(), np.int64) if kind == "long" else (pa.float64(), np.float64)
    slice_rows = SLICE

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for begin in range(0, batch.num_rows, slice_rows):
                cells = batch.column(0).slice(begin, slice_rows)
                part = measure(cells.flatten().to_numpy(zero_copy_only=False).reshape(len(cells), -1))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total.astype(width), number)], names=["k", "v"])

    parts = rows.select("cells").mapInArrow(add, f"k long, v {kind}")
    exact = F.sum(F.col("v").cast("decimal(38,0)")) if kind == "long" else F.sum("v")
    found = parts.groupBy("k").agg(exact.alias("v")).orderBy("k").toArrow()
    return np.array([int(v) if kind == "long" else v for v in found["v"].to_pylist()], object if kind == "long" else float)


def pivoted_cholesky(scatter: np.ndarray) -> np.ndarray:
    """Columns L with ``L @ L.T == scatter``; rows keep their places, so L is triangular up to the order of pivots."""
    rest, columns = scatter.copy(), []
    left = np.diag(scatter).copy()
    least = RANK * max(left.max(initial=0.0), 0.0)
    for _ in range(len(scatter)):
        pivot = int(np.argmax(left))
        if not left[pivot] > least:
            break
        column = rest[:, pivot] / np.sqrt(rest[pivot, pivot])
        columns.append(column)
        rest -= np.outer(column, column)
        rest[pivot, :] = rest[:, pivot] = 0.0
        left = np.diag(rest).copy()
    return np.array(columns).T.reshape(len(scatter), len(columns))


def jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors of ``factor @ factor.T``, by rotating pairs of columns until all are orthogonal.

    A round rotates disjoint pairs at once; the rounds of a sweep meet every pair.
    """
    work = np.hstack([factor, np.zeros((len(factor), factor.shape[1] % 2))])
    n = work.shape[1]
    seats = np.arange(n)
    for _ in range(sweeps):
        largest = 0.0
        for _ in range(max(n - 1, 1)):
            i, j = seats[:n // 2], seats[n // 2:][::-1]
            a, b = work[:, i], work[:, j]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            scale = np.sqrt(aa * bb)
            cosine = np.divide(np.abs(ab), scale, out=np.zeros_like(ab), where=scale > 0)
            largest = max(largest, cosine.max(initial=0.0))
            turn = cosine > 1e-16
            zeta = np.divide(bb - aa, 2 * ab, out=np.zeros_like(ab), where=turn)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.sqrt(1 + t * t)
            s = c * t
            work[:, i], work[:, j] = c * a - s * b, s * a + c * b
            seats = np.concatenate([seats[:1], np.roll(seats[1:], 1)])
        if largest < 1e-15:
            break
    norms = np.sqrt((work * work).sum(0))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    return norms[order] ** 2, work[:, order] / norms[order]


def whiten_profiles(profiles: DataFrame, work: Workspace, *, components: int = COMPONENTS) -> DataFrame:
    """Per usable profile and component: ``player_id``, ``component`` (from 1), ``n_profiles`` in the fit, ``deviation``, ``whitened``,
    ``explained`` (the component's share of all variance) and ``identity_error``.

    ``deviation`` is the exact sum over entries of (n x - S) squared; ``identity_error`` the largest absolute difference between the
    covariance of ``whitened`` over the fit list and the identity.
    """
    rows = whole_profiles(profiles)
    # The fit list is read five times; equal profiles fold before the shuffle.
    fit = work.settle(rows.select("cells").distinct(), "fit")
    n = fit.count()
    # High and low halves keep a task's sums of any cells within a long.
    halves = task_sums(fit, lambda x: np.concatenate([(x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)]), "long")
    d = len(halves) // 2
    sums = [int(hi) * (1 << 32) + int(lo) for hi, lo in zip(halves[:d], halves[d:], strict=True)]
    # n x - S in longs is exact wherever it fits one, also if n x or S alone do not.
    wrapped = np.array([(s + (1 << 63)) % (1 << 64) - (1 << 63) for s in sums], np.int64)
    near = np.array(sums, float)

    def centred(x: np.ndarray) -> np.ndarray:
        fits = np.abs(x.astype(float) * n - near).max(initial=0.0) < 2.0 ** 62
        return (x * np.int64(n) - wrapped) / float(n) if fits else x.astype(float) - near / n

    upper = np.triu_indices(d)
    scatter = np.zeros((d, d))
    if n:
        scatter[upper] = task_sums(fit, lambda x: (lambda y: (y.T @ y)[upper])(centred(x)), "double")
        scatter += np.triu(scatter, 1).T
    values, vectors = jacobi(pivoted_cholesky(scatter))
    kept = min(components, len(values))
    values, vectors, trace = values[:kept] / max(n, 1), vectors[:, :kept], np.trace(scatter) / max(n, 1)
    project = vectors / np.sqrt(values)
    pairs = np.triu_indices(kept)
    error = 0.0
    if kept:
        middle = task_sums(fit, lambda x: (centred(x) @ project).sum(0), "double") / n
        spread = task_sums(fit, lambda x: (lambda w: (w.T @ w)[pairs])(centred(x) @ project - middle), "double") / n
        error = float(np.abs(spread - (pairs[0] == pairs[1])).max())
    share = values / trace if trace > 0 else values

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows if kept else 0, SLICE):
                part = batch.slice(begin, SLICE)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                off = x * np.int64(n) - wrapped
                far = (x.astype(float) * n - near) ** 2
                beyond = (far.sum(1) >= 2.0 ** 62.99)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(np.arange(part.num_rows), kept))),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), part.num_rows)),
                    pa.array(np.full(part.num_rows * kept, n)),
                    pa.array(np.repeat((off * off).sum(1), kept), pa.int64(), mask=np.repeat(beyond, kept)),
                    pa.array((centred(x) @ project).ravel()),
                    pa.array(np.tile(share, part.num_rows))],
                    names=["player_id", "component", "n_profiles", "deviation", "whitened", "explained"])

    return rows.mapInArrow(whiten, COLUMNS).withColumn("identity_error", F.lit(error))

"""Quality of page texts by a generalised additive model with pairwise interactions.

Page texts are rows ``match_id``, ``page_text``; outcomes are rows ``match_id``,
``data_complete`` (1 where the page gave a complete record, else 0). Text
features are binned; boosting goes round the features again and again and fits
a tree of at most three leaves to one feature's bins at a time, so each feature ends up
with a table of bin values. The pairs that explain most of what is left get
two-way tables in the same manner. A score is the sum of a page's bin values.

Fitting uses about ``SAMPLE_PAGES`` outcomes at most (chosen by hash), whose
features, ``len(FEATURES)`` numbers each, come to the driver. Scoring covers every page.

Defined results: a null text scores as an empty one; null outcomes and outcomes
without a page teach nothing; a page with several outcomes counts once for each;
without outcomes of both kinds the score is the share of complete ones (0.5 when
there are none). Columns besides the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.session import Workspace

SAMPLE_PAGES = 20_000
BINS, PAIR_BINS = 32, 12
ROUNDS, RATE = 250, 0.1
PAIRS, PAIR_ROUNDS = 8, 60
RIDGE = 1.0
FEATURES = ("log_bytes", "log_words", "word_bytes", "lower", "upper", "digits", "marks", "symbols", "beyond_ascii",
            "line_breaks", "line_bytes", "distinct_words", "repeated_triples", "doubled_words", "distinct_lines",
            "sentence_words", "symbols_per_word", "bars", "exclamations", "commonest_byte")
MARKS, SYMBOLS = b".,;:!?'\"()-", b"#$%&*+/<=>@[\\]^_`{|}~"


def features(text: bytes) -> list[float]:
    """The measures of ``FEATURES`` over a whole text, from its bytes, words and lines."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = max(len(text), 1)
    words, lines = text.split(), text.split(b"\n")
    n = max(len(words), 1)
    solid = max(size - int(counts[32]) - int(counts[10]), 1)
    symbols = int(counts[list(SYMBOLS)].sum())
    triples = max(len(words) - 2, 1)
    return [
        np.log1p(len(text)), np.log1p(len(words)), solid / n, counts[97:123].sum() / solid, counts[65:91].sum() / solid,
        counts[48:58].sum() / solid, counts[list(MARKS)].sum() / solid, symbols / solid, counts[128:].sum() / solid,
        counts[10] / size, size / len(lines), len(set(words)) / n,
        1.0 - len(set(zip(words, words[1:], words[2:], strict=False))) / triples if len(words) > 2 else 0.0,
        sum(map(eq, words, words[1:])) / n, len(set(lines)) / len(lines),
        n / max(int(counts[46] + counts[33] + counts[63]), 1), symbols / n, counts[124] / n, counts[33] / n,
        counts[33:].max() / solid]


class AdditiveModel:
    """Bin edges, one table per feature and one per chosen pair."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        self.base = float(np.log(share / (1 - share)))
        self.edges = [cuts(x[:, k], BINS) for k in range(x.shape[1])] if len(y) else [np.zeros(0)] * len(FEATURES)
        self.pair_edges = [cuts(x[:, k], PAIR_BINS) for k in range(x.shape[1])] if len(y) else self.edges
        self.tables = [np.zeros(len(edges) + 1) for edges in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        if 0 < y.sum() < len(y):
            self.fit(x, y)

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        bins = self.bins(x, self.edges)
        margin = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            for k, table in enumerate(self.tables):
                step = RATE * leaf_values(*folded(y, margin, bins[k], len(table)))
                table += step
                margin += step[bins[k]]
        coarse = self.bins(x, self.pair_edges)
        sizes = [len(edges) + 1 for edges in self.pair_edges]
        gains = [(pair_gain(*folded_pair(y, margin, coarse, sizes, i, j)), i, j) for i, j in combinations(range(len(sizes)), 2)]
        self.pairs = [(i, j) for gain, i, j in sorted(gains, key=lambda g: (-g[0], g[1:]))[:PAIRS] if gain > 0]
        self.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
                step = RATE * quadrant_values(*folded_pair(y, margin, coarse, sizes, i, j))
                table += step
                margin += step[coarse[i], coarse[j]]

    @staticmethod
    def bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(edges[k], x[:, k], side="right") for k in range(len(edges))]

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        for table, places in zip(self.tables, self.bins(x, self.edges), strict=True):
            margin += table[places]
        coarse = self.bins(x, self.pair_edges)
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            margin += table[coarse[i], coarse[j]]
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30)))


def cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def folded(y: np.ndarray, margin: np.ndarray, place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums per bin of the log-loss slope and curvature."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return (np.bincount(place, y - p, size), np.bincount(place, p * (1 - p), size))


def folded_pair(y, margin, coarse, sizes, i, j) -> tuple[np.ndarray, np.ndarray]:
    slope, curve = folded(y, margin, coarse[i] * sizes[j] + coarse[j], sizes[i] * sizes[j])
    return slope.reshape(sizes[i], sizes[j]), curve.reshape(sizes[i], sizes[j])


def best_cut(slope: np.ndarray, curve: np.ndarray) -> tuple[int, float]:
    """Bins left of the best cut, and the gain over no cut."""
    a, b = np.cumsum(slope), np.cumsum(curve)
    gain = a[:-1] ** 2 / (b[:-1] + RIDGE) + (a[-1] - a[:-1]) ** 2 / (b[-1] - b[:-1] + RIDGE) - a[-1] ** 2 / (b[-1] + RIDGE)
    return (int(gain.argmax()) + 1, float(gain.max())) if len(gain) else (0, 0.0)


def leaf_values(slope: np.ndarray, curve: np.ndarray) -> np.ndarray:
    """A tree over ordered bins: the best cut, then the better of a second cut on either side."""
    first, gain = best_cut(slope, curve)
    parts = [slice(0, len(slope))]
    if gain > 0:
        parts = [slice(0, first), slice(first, len(slope))]
        (left, left_gain), (right, right_gain) = (best_cut(slope[p], curve[p]) for p in parts)
        if max(left_gain, right_gain) > 0:
            at = left if left_gain >= right_gain else first + right
            parts = [slice(0, min(first, at)), slice(min(first, at), max(first, at)), slice(max(first, at), len(slope))]
    values = np.zeros(len(slope))
    for p in parts:
        values[p] = slope[p].sum() / (curve[p].sum() + RIDGE)
    return values


def quadrants(slope: np.ndarray, curve: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each crossing of a row cut and a column cut: sums over the four quadrants, and their gain."""
    def four(table: np.ndarray) -> np.ndarray:
        below = table.cumsum(0).cumsum(1)
        top, left, all_ = below[:-1, -1:], below[-1:, :-1], below[-1, -1]
        corner = below[:-1, :-1]
        return np.stack([corner, top - corner, left - corner, all_ - top - left + corner])
    a, b = four(slope), four(curve)
    return a, b, (a ** 2 / (b + RIDGE)).sum(0) - slope.sum() ** 2 / (curve.sum() + RIDGE)


def pair_gain(slope: np.ndarray, curve: np.ndarray) -> float:
    gain = quadrants(slope, curve)[2]
    return float(gain.max()) if gain.size else 0.0


def quadrant_values(slope: np.ndarray, curve: np.ndarray) -> np.ndarray:
    a, b, gain = quadrants(slope, curve)
    r, c = np.unravel_index(gain.argmax(), gain.shape)
    leaf = a[:, r, c] / (b[:, r, c] + RIDGE)
    values = np.empty(slope.shape)
    values[:r + 1, :c + 1], values[:r + 1, c + 1:], values[r + 1:, :c + 1], values[r + 1:, c + 1:] = leaf
    return values


def as_bytes(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("match_id").cast("long").alias("match_id"),
                        F.coalesce("page_text", F.lit("")).cast("binary").alias("page_text"))


def fit_quality(pages: DataFrame, outcomes: DataFrame, work: Workspace, *, sample: int = SAMPLE_PAGES) -> AdditiveModel:
    """Model of ``data_complete`` given the text. The sampled outcomes are settled, so Spark knows their size."""
    known = outcomes.where("match_id is not null and data_complete is not null").select(
        F.col("match_id").cast("long").alias("match_id"), F.col("data_complete").cast("int").alias("data_complete"))
    total = known.count()
    rank = F.shiftrightunsigned(F.xxhash64("match_id"), 1) / F.lit(float(1 << 63))
    chosen = work.settle(known.where(rank * F.lit(float(total)) < sample), "outcomes")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(text.as_py()) for text in batch.column("page_text")]
            yield pa.RecordBatch.from_arrays([batch.column("match_id"), batch.column("data_complete"), pa.array(rows, pa.list_(pa.float64()))],
                                             names=["match_id", "data_complete", "x"])
    found = (as_bytes(pages).join(chosen, "match_id")
             .mapInArrow(measure, "match_id long, data_complete int, x array<double>").toArrow().sort_by("match_id"))
    x = np.array(found["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    return AdditiveModel(x, found["data_complete"].to_numpy().astype(float))


def score_quality(pages: DataFrame, model: AdditiveModel) -> DataFrame:
    """One row per page: ``match_id``, ``quality_score`` (0 to 1). Pages do not shuffle."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(text.as_py()) for text in batch.column("page_text")], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("match_id"), pa.array(model.score(x))],
                                             names=["match_id", "quality_score"])
    return as_bytes(pages).mapInArrow(score, "match_id long, quality_score double")

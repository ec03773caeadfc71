"""Languages of a page text, as a mixture.

Page texts are rows ``match_id``, ``page_text``; training rows carry ``language``
too. Each language has a table of character trigram probabilities. A page's
words are drawn from a mixture of languages whose shares are found by
expectation-maximisation; the set of languages is the one with the best
likelihood less a penalty of ``PENALTY * log(words)`` per further language.

Fitting uses whole texts of at most about ``SAMPLE_PAGES`` pages per language
(those with the smallest hashes of id and text), counts trigrams in the tasks
and brings the tables, ``2 ** HASH_BITS`` cells per language, to the driver.
Every language of the training labels is told apart, however many there are; the model takes a
quarter of a megabyte per language in each task.

A text counts as its distinct words and their numbers, and texts are worked off in chunks of
``CHUNK_CELLS`` characters x languages, so a task's memory follows neither its batch nor a long text's repetitions. No result
depends on the chunks.

Defined results: a null text, or one without a letter, is ``und`` with share 0,
and so is every text when no training row has a language; texts with letters of no
known language get the likeliest one. Repeated ids are separate rows. Columns
besides the named ones are ignored.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.session import settle

UNKNOWN = "und"
HASH_BITS = 16
SAMPLE_PAGES = 3000
PENALTY = 4.0
SMOOTHING = 0.1
FLOOR = -20.0
LEAST_SHARE = 0.5
FULL_STEPS, SET_STEPS = 10, 6
CHUNK_CELLS = 1_600_000
RUNS = re.compile(r"[^\W\d_]+")
MODEL_SCHEMA = "language string, cell int, n long"
GUESS_SCHEMA = "match_id long, language_pred string, share double, languages array<string>, shares array<double>"

# Executors get these functions with the job; they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def page_words(text: str | None) -> Counter[str]:
    """Distinct words of a text and how often each occurs."""
    return Counter(m.group() for m in RUNS.finditer(text.lower())) if text else Counter()


def trigram_cells(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of the words, edges included, and the word each belongs to."""
    code = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    mixed = (code[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ code[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
             ^ code[2:] * np.uint64(0x165667B19E3779F9))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    cells = (mixed >> np.uint64(64 - HASH_BITS)).astype(np.int64)
    inner = code[1:-1] != 32
    owner = np.cumsum(code[1:-1] == 32)
    return cells[inner], owner[inner]


def sample_for_training(pages: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` whole pages per language, chosen by hash. Counts are settled first; no text is shuffled."""
    counts = settle(pages.groupBy("language").agg(F.count("*").alias("n")), "language_counts")
    rank = F.shiftrightunsigned(F.xxhash64("match_id", "page_text"), 1) / F.lit(float(1 << 63))
    return pages.join(counts, "language").where(rank * F.col("n") < sample).select("language", "page_text")


class LanguageModel:
    """Trigram log-probabilities: one row per language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + SMOOTHING
        self.log_p = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32)

    def word_likelihoods(self, words: list[str]) -> np.ndarray:
        """Likelihood of each word in each language, relative to its best language."""
        cells, owner = trigram_cells(words)
        starts = np.searchsorted(owner, np.arange(len(words)))
        total = np.add.reduceat(self.log_p[cells], starts, axis=0)
        return np.exp(np.maximum(total - total.max(axis=1, keepdims=True), FLOOR)).astype(np.float64)

    def shares(self, texts: list[Counter[str]]) -> np.ndarray:
        """Language shares of each text (none empty) over its selected set; other languages are 0."""
        distinct = list(dict.fromkeys(w for text in texts for w in text))
        place = dict(zip(distinct, range(len(distinct)), strict=True))
        words = np.fromiter((place[w] for text in texts for w in text), np.int64)
        counts = np.fromiter((n for text in texts for n in text.values()), np.float64)
        sizes = np.array([len(text) for text in texts], np.int64)
        return select_languages(self.word_likelihoods(distinct)[words], counts, sizes)


def em(likelihood: np.ndarray, sizes: np.ndarray, shares: np.ndarray, steps: int, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Shares after ``steps`` rounds, and each text's log-likelihood under them; a row is a word of a text, which has it ``counts`` times."""
    counts = np.ones(len(likelihood)) if counts is None else counts
    owner = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.cumsum(sizes) - sizes
    totals = np.add.reduceat(counts, starts)
    for _ in range(steps):
        joint = likelihood * shares[owner]
        joint *= (counts / joint.sum(axis=1))[:, None]
        shares = np.add.reduceat(joint, starts, axis=0) / totals[:, None]
    mixed = np.maximum((likelihood * shares[owner]).sum(axis=1), 1e-300)
    return shares, np.add.reduceat(counts * np.log(mixed), starts)


def select_languages(likelihood: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Add languages in the order of their full-mixture shares while the penalised likelihood grows."""
    texts, languages = len(sizes), likelihood.shape[1]
    full, _ = em(likelihood, sizes, np.full((texts, languages), 1.0 / languages), FULL_STEPS, counts)
    order = np.argsort(-full, axis=1, kind="stable")
    best = np.zeros((texts, languages))
    best[np.arange(texts), order[:, 0]] = 1.0
    score = em(likelihood, sizes, best, 0, counts)[1]
    cost = PENALTY * np.log(np.add.reduceat(counts, np.cumsum(sizes) - sizes) + 1.0)
    owner = np.repeat(np.arange(texts), sizes)
    active = np.arange(texts)
    for size in range(2, languages + 1):
        chosen = np.zeros(texts, bool)
        chosen[active] = True
        start = np.zeros((len(active), languages))
        rows = np.arange(len(active))[:, None]
        start[rows, order[active, :size]] = full[active][rows, order[active, :size]] + 1e-9
        start /= start.sum(axis=1, keepdims=True)
        shares, found = em(likelihood[chosen[owner]], sizes[active], start, SET_STEPS, counts[chosen[owner]])
        found -= cost[active] * (size - 1)
        better = found > score[active]
        improved = active[better]
        best[improved] = shares[better]
        score[improved] = found[better]
        active = improved
        if not len(active):
            break
    return best


def fit_languages(pages: DataFrame, *, sample: int = SAMPLE_PAGES) -> LanguageModel:
    """Model of the languages of ``pages`` (``match_id``, ``page_text``, ``language``)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, text in zip(*batch.columns, strict=True):
                words, language = page_words(text.as_py()), language.as_py()
                if words:
                    cells, owner = trigram_cells(list(words))
                    times = np.fromiter(words.values(), np.float64)[owner]
                    found = np.bincount(cells, times, minlength=1 << HASH_BITS).astype(np.int64)
                    tables[language] = tables[language] + found if language in tables else found
        for language, table in tables.items():
            cells = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(cells)), pa.array(cells, pa.int32()),
                                              pa.array(table[cells], pa.int64())], names=["language", "cell", "n"])
    labelled = pages.where("language is not null and page_text is not null").select("match_id", "page_text", "language")
    counted = (sample_for_training(labelled, sample).mapInArrow(count, MODEL_SCHEMA)
               .groupBy("language", "cell").agg(F.sum("n").alias("n")))
    found = counted.toArrow()
    languages = sorted(set(found["language"].to_pylist()))
    counts = np.zeros((len(languages), 1 << HASH_BITS))
    if languages:
        rows = np.searchsorted(np.array(languages), np.array(found["language"].to_pylist()))
        counts[rows, found["cell"].to_numpy()] = found["n"].to_numpy()
    return LanguageModel(languages, counts)


def guess_languages(pages: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per page: ``match_id``, ``language_pred``, its ``share``, and all ``languages`` with their ``shares``.

    The model is bounded, so each task gets it whole; pages do not shuffle.
    """
    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in chunks(model, *batch.columns):
                yield pa.RecordBatch.from_pylist(guesses(model, ids, texts), schema=pa.schema([
                    ("match_id", pa.int64()), ("language_pred", pa.string()), ("share", pa.float64()),
                    ("languages", pa.list_(pa.string())), ("shares", pa.list_(pa.float64()))]))
    texts = pages.select(F.col("match_id").cast("long").alias("match_id"), "page_text")
    return texts.mapInArrow(guess, GUESS_SCHEMA)


def keep_known_languages(pages: DataFrame, model: LanguageModel, *, least_share: float = LEAST_SHARE) -> DataFrame:
    """The pages, with all their columns, whose main language is known and holds ``least_share`` of the text.

    Rows are tested where they are read and never shuffle.
    """
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("page_text")
            found = [row["language_pred"] != UNKNOWN and row["share"] >= least_share
                     for ids, part in chunks(model, pa.nulls(len(texts)), texts) for row in guesses(model, ids, part)]
            yield batch.filter(pa.array(found, pa.bool_()))
    return pages.mapInArrow(keep, pages.schema)


def chunks(model: LanguageModel, ids: Iterable, texts: Iterable) -> Iterator[tuple[list, list[Counter[str]]]]:
    """Ids and words of the texts, a bounded number of characters x languages at a time."""
    held, words, size = [], [], 0
    for match_id, text in zip(ids, texts, strict=True):
        text = text.as_py()
        held.append(match_id.as_py())
        words.append(page_words(text))
        size += (len(text or "") + 1) * max(len(model.languages), 4)
        if size >= CHUNK_CELLS:
            yield held, words
            held, words, size = [], [], 0
    if held:
        yield held, words


def guesses(model: LanguageModel, ids: list, words: list[Counter[str]]) -> list[dict]:
    # The pattern also takes numerals such as fractions; a text of those alone has no letter.
    known = [bool(model.languages) and any(c.isalpha() for w in found for c in w) for found in words]
    spoken = [found for found, ok in zip(words, known, strict=True) if ok]
    mixtures = iter(model.shares(spoken) if spoken else ())
    out = []
    for match_id, ok in zip(ids, known, strict=True):
        if not ok:
            out.append({"match_id": match_id, "language_pred": UNKNOWN, "share": 0.0, "languages": [], "shares": []})
            continue
        mixture = next(mixtures)
        chosen = [k for k in np.argsort(-mixture, kind="stable") if mixture[k] > 0]
        out.append({"match_id": match_id, "language_pred": model.languages[chosen[0]],
                    "share": min(1.0, float(mixture[chosen[0]])), "languages": [model.languages[k] for k in chosen],
                    "shares": [min(1.0, float(mixture[k])) for k in chosen]})
    return out

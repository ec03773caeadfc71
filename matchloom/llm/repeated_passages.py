"""Passages of several sentences that occur again on other pages, or later on the same page.

Page texts are rows ``match_id``, ``page_text``. Every run of ``run`` consecutive
sentences is hashed; runs are counted over all pages; a run's first occurrence,
in the order of ``match_id`` and position, stays, and every sentence that lies in
a later occurrence of some run is removed.

With ``extend``, ``run`` is the least number of sentences: a run grows from each
start, and back from each end, until it also holds ``min_words``. So every repeat of
at least ``run`` whole sentences and ``min_words`` words goes, be they few long or many short
sentences. A repeat with fewer whole sentences than that stays.

Defined results: sentences end at ``.``, ``!`` or ``?`` before white space, or at
a line break, and are compared in lower case without outer white space; runs of
fewer than ``min_words`` words are too common to count; untouched texts come
back unchanged; a null text stays null. Pages are told apart by ``match_id`` and
text, so an identical row with the same id is the same page and each copy of it
gets the same result. Columns besides the two are ignored.

Sentences are cut and hashed where the texts are read; a run's 128-bit hash comes from prefix sums over its page's
sentence hashes. Runs move as hashes and places; of the texts, only those of pages that may lose something are shuffled.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.session import Workspace

RUN = 3
MIN_WORDS = 12
END = re.compile(r"[.!?]+[ \t\r\n]+|\n+")
BLANKS = re.compile(r"[ \t\r\n]+")
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
CHUNK_RUNS = 50_000
# Pages are marked as touched by the rest of their hash, so that what every task is sent has at most so many rows.
TOUCH_MARKS = 1 << 20

# Executors get these functions with the job; they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def sentence_ends(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each sentence with the white space after it; together they are the whole text."""
    start = 0
    while start < len(text):
        found = END.search(text, start + 1)
        end = found.end() if found else len(text)
        yield start, end
        start = end


def sentence_marks(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes and the number of words of each sentence."""
    hashes, words = bytearray(), []
    for start, end in sentence_ends(text):
        key = text[start:end].strip(" \t\r\n").lower()
        hashes += xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass"))
        words.append(len(BLANKS.findall(key)) + 1)
    return np.frombuffer(bytes(hashes), "<u8").reshape(-1, 2), np.array(words, np.int64)


def spans(words: np.ndarray, run: int, min_words: int, extend: bool) -> tuple[np.ndarray, np.ndarray]:
    """First sentence, and sentence behind the last, of each run."""
    upto = np.concatenate([[0], np.cumsum(words)])
    n = len(words)
    starts = np.arange(n)
    if not extend:
        starts = starts[:max(n - run + 1, 0)]
        starts = starts[upto[starts + run] - upto[starts] >= min_words]
        return starts, starts + run
    grown = np.maximum(np.searchsorted(upto, upto[:-1] + min_words), starts + run)
    forward = starts[grown <= n]
    ends = np.arange(run, n + 1)
    back = np.minimum(np.searchsorted(upto, upto[ends] - min_words, "right") - 1, ends - run)
    new = (back >= 0) & (grown[np.maximum(back, 0)] != ends)
    return np.concatenate([forward, back[new]]), np.concatenate([grown[forward], ends[new]])


def run_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each run: a polynomial in its sentences' hashes, the same wherever the run stands."""
    out = []
    for k, base in enumerate(BASES):
        powers, inverses = np.ones((2, len(hashes) + 1), np.uint64)
        powers[1:], inverses[1:] = base, pow(base, -1, 1 << 64)
        np.cumprod(powers, out=powers)
        np.cumprod(inverses, out=inverses)
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes[:, k] * powers[:-1], out=sums[1:])
        value = (sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64) * np.uint64(BASES[1 - k])
        value ^= value >> np.uint64(31)
        out.append((value * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64))
    return out


def sentence_runs(pages: DataFrame, run: int, min_words: int, extend: bool) -> DataFrame:
    """``match_id``, ``page``, ``position``, ``length`` and a 128-bit hash of each run."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, rows, size = [], [], 0
            for row in range(batch.num_rows):
                hashes, words = sentence_marks(batch.column(2)[row].as_py() or "")
                starts, ends = spans(words, run, min_words, extend)
                if len(starts):
                    held.append((starts + 1, (ends - starts).astype(np.int32), *run_hashes(hashes, starts, ends)))
                    rows.append(np.full(len(starts), row))
                    size += len(starts)
                if held and (size >= CHUNK_RUNS or row + 1 == batch.num_rows):
                    at = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at), batch.column(1).take(at), *[pa.array(np.concatenate(c)) for c in zip(*held, strict=True)]],
                        names=["match_id", "page", "position", "length", "run_a", "run_b"])
                    held, rows, size = [], [], 0

    schema = T.StructType([pages.schema["match_id"], *T._parse_datatype_string(
        "page long, position long, length int, run_a long, run_b long").fields])
    return pages.select("match_id", "page", "page_text").mapInArrow(mark, schema)


def without_sentences(pages: DataFrame) -> DataFrame:
    """Texts without the sentences of ``removed`` (runs of a page, or null)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, gone = [], [], []
            for row in range(batch.num_rows):
                text, removed = batch.column(1)[row].as_py(), batch.column(2)[row].as_py()
                ends = list(sentence_ends(text or ""))
                drop = np.zeros(len(ends), bool)
                for r in removed or ():
                    drop[r["position"] - 1:r["position"] - 1 + r["length"]] = True
                counts.append(len(ends))
                gone.append(int(drop.sum()))
                texts.append("".join(text[a:b] for (a, b), d in zip(ends, drop, strict=True) if not d) if removed else text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64())],
                                             names=["match_id", "page_text", "n_sentences", "n_removed"])

    schema = T.StructType([pages.schema["match_id"], *T._parse_datatype_string("page_text string, n_sentences long, n_removed long").fields])
    return pages.select("match_id", "page_text", "removed").mapInArrow(cut, schema)


def drop_repeated_passages(pages: DataFrame, work: Workspace, *, run: int = RUN, min_words: int = MIN_WORDS,
                           extend: bool = False) -> DataFrame:
    """Pages without later occurrences: ``match_id``, ``page_text``, ``n_sentences``, ``n_removed``.

    A run's count and first place are one aggregate, folded before the shuffle, so copies cost nothing extra. The table of
    repeated runs grows with the corpus and so does the table of runs: they meet in a merge join at every size, where Spark splits the
    occurrences of a very common run. Removal gathers runs of one page, never pages of a run.
    """
    rows = pages.select("match_id", "page_text", F.xxhash64("match_id", "page_text").alias("page"))
    runs = work.settle(sentence_runs(rows, run, min_words, extend), "runs")
    place = F.struct(F.col("match_id").isNull().alias("unknown"), "match_id", "page", "position")
    firsts = work.settle(runs.groupBy("run_a", "run_b").agg(F.count("*").alias("n"), F.min(place).alias("first"))
                         .where("n > 1").drop("n"), "firsts")
    later = runs.join(firsts.hint("merge"), ["run_a", "run_b"]).where(
        ~((F.col("first.page") == F.col("page")) & (F.col("first.position") == F.col("position"))
          & F.col("first.match_id").eqNullSafe(F.col("match_id"))))
    removed = work.settle(later.groupBy("page").agg(F.collect_set(F.struct("position", "length")).alias("removed")), "removed")
    mark = F.pmod("page", F.lit(TOUCH_MARKS)).alias("mark")
    touched = F.broadcast(removed.select(mark).distinct())  # at most TOUCH_MARKS rows
    marked = rows.withColumn("mark", mark)
    same = marked.join(touched, "mark", "left_anti").withColumn("removed", F.lit(None).cast(removed.schema["removed"].dataType))
    changed = marked.join(touched, "mark", "left_semi").join(removed.hint("merge"), "page", "left")
    return without_sentences(same.unionByName(changed))

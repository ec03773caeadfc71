"""Token sequences of power-of-two length, none of which crosses pages.

Page texts are rows ``match_id``, ``page_text``. A page's ids end with ``END_ID``
and are cut into pieces of ``MAX_LENGTH`` and then the binary digits of what is
left, largest first. Each piece is a sequence of its own; equal lengths form a
bucket to draw batches from, so nothing is padded and no sequence mixes pages.

Defined results: a null or blank text has the end id alone; every row is a
page, repeated ids included. Columns besides the two are ignored.

The tokenizer's vocabulary file is a parameter and is read where tasks run.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.workers import kept

MAX_LENGTH = 4096
END_ID = 2
CACHED_WORDS = 600_000
WORDS_PER_LINE = 500
LINES_AT_ONCE = 16
CHUNK_BYTES = 1 << 20
PIECE_SCHEMA = ("match_id long, start long, length long, token_ids binary, page_tokens long, sequence_id long, "
                "offset long")


class WordTokens:
    """Ids of words, kept for the words seen before.

    The tokenizer's own rules never look across white space, so a text's ids are
    those of its words, parted at ASCII white space, one after another. The
    memory is bounded by ``CACHED_WORDS``; further words last for one chunk.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    def learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Little-endian ids of new words, from lines of many words; token places tell the words apart.

        A few lines at a time: the tokenizer's own results take hundreds of bytes a token.
        """
        found: dict[bytes, bytes] = {}
        lines = [words[k:k + WORDS_PER_LINE] for k in range(0, len(words), WORDS_PER_LINE)]
        for first in range(0, len(lines), LINES_AT_ONCE):
            some = lines[first:first + LINES_AT_ONCE]
            texts = [[w.decode() for w in line] for line in some]
            encodings = self.tokenizer.encode_batch(["\n".join(text) for text in texts], add_special_tokens=False)
            for line, text, encoding in zip(some, texts, encodings, strict=True):
                starts = np.cumsum([0, *(len(w) + 1 for w in text)])
                begins = np.array([a for a, _ in encoding.offsets], np.int64)
                cuts = np.searchsorted(begins, starts) * 4
                raw = np.array(encoding.ids, "<u4").tobytes()
                found.update((w, raw[a:b]) for w, a, b in zip(line, cuts.tolist(), cuts[1:].tolist(), strict=False))
        return found

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian ids of each text, ended by ``END_ID``."""
        split = [text.split() for text in texts]
        new = [w for w in set().union(*split) if w not in self.known]
        self.known.update(self.learn(new))
        ids_of, end = self.known.__getitem__, END_ID.to_bytes(4, "little")
        out = [b"".join(map(ids_of, words)) + end for words in split]
        if len(self.known) > CACHED_WORDS:
            for word in new:
                del self.known[word]
        return out


def word_tokens(path: str) -> WordTokens:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; idle threads would only hold memory
    return kept(("word_tokens", path), lambda: WordTokens(path))


def binary_lengths(tokens: int, longest: int = MAX_LENGTH) -> list[int]:
    """Full pieces first, then the binary digits of the rest from the largest down."""
    rest = tokens % longest
    return [longest] * (tokens // longest) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def chunks(ids: Iterable, texts: Iterable) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts, about ``CHUNK_BYTES`` of text at a time; a batch is never held as Python objects."""
    held, some, size = [], [], 0
    for match_id, text in zip(ids, texts, strict=True):
        held.append(match_id.as_py())
        some.append(text.as_py())
        size += len(some[-1])
        if size >= CHUNK_BYTES:
            yield held, some
            held, some, size = [], [], 0
    if held:
        yield held, some


def pack_pages(pages: DataFrame, vocabulary: str, *, longest: int = MAX_LENGTH) -> DataFrame:
    """One row per piece: ``match_id``, ``start``, ``length``, ``token_ids`` (little-endian unsigned 32-bit),
    ``page_tokens``, ``sequence_id``, ``offset``.

    ``longest`` is a power of two. Nothing shuffles: a sequence is one piece, and
    its id is the task's number and a count within the task, which a repeated
    task gives again.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine, sequence = word_tokens(vocabulary), TaskContext.get().partitionId() << 36
        for batch in batches:
            for match_ids, texts in chunks(*batch.columns):
                ids = engine.encode(texts)
                counts = np.array([len(x) // 4 for x in ids], np.int64)
                per_page = [binary_lengths(n, longest) for n in counts.tolist()]
                lengths = np.array([n for page in per_page for n in page], np.int64)
                pieces = np.array([len(page) for page in per_page], np.int64)
                ends = np.cumsum(lengths)
                page_starts = np.cumsum(counts) - counts
                offsets = np.concatenate([[0], ends * 4]).astype(np.int32)
                total = len(lengths)
                yield pa.RecordBatch.from_arrays([
                    pa.array(match_ids, pa.int64()).take(pa.array(np.repeat(np.arange(len(pieces)), pieces))),
                    pa.array(ends - lengths - np.repeat(page_starts, pieces)), pa.array(lengths),
                    pa.Array.from_buffers(pa.binary(), total, [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(ids))]),
                    pa.array(np.repeat(counts, pieces)), pa.array(sequence + np.arange(total)),
                    pa.array(np.zeros(total, np.int64))],
                    names=["match_id", "start", "length", "token_ids", "page_tokens", "sequence_id", "offset"])
                sequence += total
    texts = pages.select(F.col("match_id").cast("long").alias("match_id"),
                         F.coalesce("page_text", F.lit("")).cast("binary").alias("page_text"))
    return texts.mapInArrow(pack, PIECE_SCHEMA)


def write_buckets(pieces: DataFrame, folder: str) -> None:
    """Write the sequences with one folder per length, ready to draw batches of equal length from."""
    pieces.write.mode("errorifexists").partitionBy("length").parquet(folder)

"""Pages that contain held-back evaluation passages, up to a few edits.

Pages are rows ``match_id``, ``page_text``; passages are rows ``item_id``,
``passage``. Both are compared in lower case with every run of characters that
are neither letters nor digits as one blank. A passage of m characters may
differ from a stretch of the page by ``floor(error_rate * m)`` edits (insert,
delete, replace one character): cut into one piece more than that, at least one
piece is untouched, so exact piece hits find every candidate. Each candidate
window is then measured with Myers' bit-parallel distance.

Defined results: null, empty and letterless passages match nothing; a null text
holds nothing; matches begin and end at word borders of the page when no edit
is left for them; a repeated passage id is reported once per page with its
smallest distance. Columns besides the named ones are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR_RATE = 0.05
BLOCK_CHARS = 2_000_000
MATCH_SCHEMA = "match_id long, item_id long, distance int, passage_chars int"
OTHER = re.compile(r"[\W_]+")


def plain(text: str | None) -> str:
    """Letters and digits in lower case, parted and enclosed by single blanks."""
    words = OTHER.sub(" ", (text or "").lower()).strip()
    return f" {words} " if words else ""


def pieces(passage: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length, each with its place."""
    cuts = [len(passage) * k // (budget + 1) for k in range(budget + 2)]
    return [(a, passage[a:b]) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def myers_distance(pattern: str, text: str) -> int:
    """Least edit distance between ``pattern`` and any stretch of ``text``.

    The pattern's column of the distance table is held as bit vectors of
    vertical differences, so a text character costs a few integer operations
    however long the pattern is.
    """
    size = len(pattern)
    full, top = (1 << size) - 1, 1 << (size - 1)
    where: dict[str, int] = {}
    for k, char in enumerate(pattern):
        where[char] = where.get(char, 0) | 1 << k
    up, down, score, best = full, 0, size, size
    for char in text:
        equal = where.get(char, 0)
        cross = equal | down
        flat = (((equal & up) + up) ^ up) | equal
        right = down | (full & ~(flat | up))
        left = up & flat
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        right = (right << 1) & full
        left = (left << 1) & full
        up = left | (full & ~(cross | right))
        down = right & cross
        best = min(best, score)
    return best


class PassageFinder:
    """Piece automaton over one block of passages."""

    def __init__(self, passages: list[tuple[int, str]], error_rate: float):
        import ahocorasick
        self.items: list[tuple[int, str, int]] = []
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, raw in passages:
            text = plain(raw)
            if text:
                budget = int(error_rate * len(text))
                for start, piece in pieces(text, budget):
                    places.setdefault(piece, []).append((len(self.items), start))
                self.items.append((item_id, text, budget))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, raw: str | None) -> dict[int, tuple[int, int]]:
        """Passages in a text: least distance and length by item id."""
        text = plain(raw)
        found: dict[int, tuple[int, int]] = {}
        if not text or not self.items:
            return found
        windows: dict[int, list[tuple[int, int]]] = {}
        for last, (length, where) in self.automaton.iter(text):
            for item, start in where:
                _, passage, budget = self.items[item]
                begin = last + 1 - length - start - budget
                end = begin + len(passage) + 2 * budget
                open_windows = windows.setdefault(item, [])
                if open_windows and begin <= open_windows[-1][1] and end >= open_windows[-1][0]:
                    open_windows[-1] = (min(begin, open_windows[-1][0]), max(end, open_windows[-1][1]))
                else:
                    open_windows.append((begin, end))
        for item, spans in windows.items():
            item_id, passage, budget = self.items[item]
            distance = min(myers_distance(passage, text[max(0, a):max(0, b)]) for a, b in spans)
            if distance <= budget:
                found[item_id] = min(found.get(item_id, (distance, len(passage) - 2)), (distance, len(passage) - 2))
        return found


def passage_blocks(passages: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The stated passages in blocks of at most ``block_chars`` characters (one longer passage alone)."""
    block, chars = [], 0
    rows = passages.where("passage is not null and passage <> ''").select(F.col("item_id").cast("long"), "passage")
    for item_id, passage in rows.toLocalIterator():
        if block and chars + len(passage) > block_chars:
            yield block
            block, chars = [], 0
        block.append((item_id, passage))
        chars += len(passage)
    if block:
        yield block


def find_leaks(pages: DataFrame, passages: DataFrame, *, error_rate: float = ERROR_RATE,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per page and passage it contains: ``match_id``, ``item_id``, ``distance``, ``passage_chars``.

    The passages are a stated set, held in a task one bounded block at a time;
    with more than one block the pages are read once per block. Pages never
    shuffle. Several blocks can report a passage id that repeats, so the least
    distance per page and id is taken in the end, over hits alone.
    """
    spark = pages.sparkSession
    texts = pages.select(F.col("match_id").cast("long").alias("match_id"), "page_text").where("page_text is not null")

    def finder(block: list[tuple[int, str]]):
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            engine = PassageFinder(block, error_rate)
            for batch in batches:
                hits = [(match_id.as_py(), item_id, distance, chars)
                        for match_id, text in zip(batch.column("match_id"), batch.column("page_text"), strict=True)
                        for item_id, (distance, chars) in engine.find(text.as_py()).items()]
                ids, items, distances, lengths = zip(*hits, strict=True) if hits else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(items, pa.int64()), pa.array(distances, pa.int32()),
                     pa.array(lengths, pa.int32())], names=["match_id", "item_id", "distance", "passage_chars"])
        return find

    hits = spark.createDataFrame([], MATCH_SCHEMA)
    for block in passage_blocks(passages, block_chars):
        hits = hits.unionByName(texts.mapInArrow(finder(block), MATCH_SCHEMA))
    return hits.groupBy("match_id", "item_id").agg(F.min("distance").alias("distance"),
                                                   F.min("passage_chars").alias("passage_chars"))


def drop_leaks(pages: DataFrame, passages: DataFrame, *, error_rate: float = ERROR_RATE,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The pages, with all their columns, that contain none of the passages. Rows never shuffle."""
    def tester(block: list[tuple[int, str]]):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            engine = PassageFinder(block, error_rate)
            for batch in batches:
                yield batch.filter(pa.array([not engine.find(text.as_py()) for text in batch.column("page_text")], pa.bool_()))
        return keep
    for block in passage_blocks(passages, block_chars):
        pages = pages.mapInArrow(tester(block), pages.schema)
    return pages

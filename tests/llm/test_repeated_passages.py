"""Repeated runs of sentences against a brute-force removal."""

import random
import re

from matchloom.llm.repeated_passages import drop_repeated_passages
from matchloom.session import Workspace

SCHEMA = "match_id long, page_text string"
COLUMNS = ["match_id", "page_text", "n_sentences", "n_removed"]
PIECES = re.compile(r"(?s).+?(?:[.!?]+[ \t\r\n]+|\n+|\Z)")


def brute(pages, run, least):
    places = {}
    cut = {(m, t): PIECES.findall(t) if t is not None else [] for m, t in pages}
    for (match_id, text), pieces in cut.items():
        keys = [p.strip(" \t\r\n").lower() for p in pieces]
        for k in range(len(keys) - run + 1):
            if sum(len(re.split("[ \t\r\n]+", x)) for x in keys[k:k + run]) >= least:
                places.setdefault(tuple(keys[k:k + run]), []).append(((match_id is None, match_id or 0), text, k))
    gone = {key: set() for key in cut}
    for found in places.values():
        for match_id, text, k in sorted(found)[1:]:
            gone[match_id[1] if not match_id[0] else None, text].update(range(k, k + run))
    return sorted([(m, t if not gone[m, t] else "".join(p for k, p in enumerate(cut[m, t]) if k not in gone[m, t]),
                    len(cut[m, t]), len(gone[m, t])) for m, t in pages], key=repr)


def sentence(rng):
    return " ".join(rng.choice("round map site bomb smoke flash entry trade clutch eco".split()) for _ in range(rng.randint(3, 9))) + rng.choice(". ,! ,? ,.\n,\n".split(","))


def test_matches_brute_force(spark, rows):
    rng = random.Random(3)
    shared = ["".join(sentence(rng) for _ in range(n)) for n in (4, 6, 9)]
    pages = []
    for k in range(40):
        parts = [sentence(rng) for _ in range(rng.randint(0, 12))]
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(shared))
        pages.append((k, "".join(parts)))
    pages += [(50, None), (51, ""), (52, shared[1] + "Between. " + shared[1]), (53, "One sentence"), (None, shared[2]),
              (54, shared[0].upper()), (54, shared[0].upper()), (55, "word " * 30_000)]
    for run, least in ((3, 12), (2, 1)):
        found = drop_repeated_passages(spark.createDataFrame(pages, SCHEMA), Workspace(spark, "t"), run=run, min_words=least)
        assert rows(found, *COLUMNS) == brute(pages, run, least)


def brute_spans(pages, run, least):
    """Every maximal or smaller repeat of at least ``run`` sentences and ``least`` words, tried out in full."""
    places, cut = {}, {m: PIECES.findall(t) for m, t in pages}
    for match_id, pieces in cut.items():
        keys = [p.strip(" \t\r\n").lower() for p in pieces]
        for i in range(len(keys)):
            for j in range(i + run, len(keys) + 1):
                if sum(len(re.split("[ \t\r\n]+", x)) for x in keys[i:j]) >= least:
                    places.setdefault(tuple(keys[i:j]), []).append((match_id, i))
    gone = {m: set() for m in cut}
    for keys, found in places.items():
        for match_id, i in sorted(found)[1:]:
            gone[match_id].update(range(i, i + len(keys)))
    return sorted([(m, "".join(p for k, p in enumerate(cut[m]) if k not in gone[m]), len(cut[m]), len(gone[m])) for m, _ in pages], key=repr)


def test_extended_runs_find_few_long_and_many_short_sentences(spark, rows):
    rng = random.Random(5)
    long_one = " ".join(f"w{k}" for k in range(25)) + ". " + " ".join(f"v{k}" for k in range(25)) + ". "
    shouts = "".join(f"{rng.choice('abcdefgh')}{k}!! " for k in range(40))
    column = "".join(f"item{k}\n" for k in range(20))
    shared = [long_one, shouts, column, *("".join(sentence(rng) for _ in range(n)) for n in (2, 3, 5))]
    pages = [(1, shouts), (2, shouts), (3, column), (4, column), (5, "Alone one two. " + long_one), (6, long_one + "Other end here. ")]
    for k in range(10, 40):
        parts = [sentence(rng) for _ in range(rng.randint(0, 8))]
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(shared))
        pages.append((k, "".join(parts)))
    frame = spark.createDataFrame(pages, SCHEMA)
    found = rows(drop_repeated_passages(frame, Workspace(spark, "t"), run=2, extend=True), *COLUMNS)
    assert found == brute_spans(pages, 2, 12)
    text = {r[0]: r[1] for r in found}
    assert text[2] == "" and text[4] == "" and text[6] == "Other end here. "


def test_empty_table_and_clashing_columns(spark, rows):
    assert drop_repeated_passages(spark.createDataFrame([], SCHEMA), Workspace(spark, "t")).count() == 0
    wide = spark.createDataFrame([(1, "A b c.", 1, "x")], SCHEMA + ", position int, page string")
    assert rows(drop_repeated_passages(wide, Workspace(spark, "t")), *COLUMNS) == [(1, "A b c.", 1, 0)]

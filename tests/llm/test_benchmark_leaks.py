"""Held-back passages in pages: distances, hits, odd rows."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from matchloom.llm import benchmark_leaks as leaks

PAGES, PASSAGES = "match_id long, page_text string", "item_id long, passage string"
WORDS = "inferno mirage nuke ancient dust train vertigo anubis pistol force save rotate retake crossfire".split()


def table_distance(pattern, text):
    """Least edit distance of a pattern to any stretch of a text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (a != b)))
    return min(row)


@given(st.text("abc ", min_size=1, max_size=90), st.text("abc ", max_size=120))
@settings(max_examples=300, deadline=None)
def test_bit_parallel_distance(pattern, text):
    assert leaks.myers_distance(pattern, text) == table_distance(pattern, text)


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        k = rng.randrange(len(chars))
        rng.choice([lambda: chars.pop(k), lambda: chars.insert(k, rng.choice("abcdefgh")), lambda: chars.__setitem__(k, "q")])()
    return "".join(chars)


def brute(pages, passages, rate):
    out = {}
    for match_id, text in pages:
        page = leaks.plain(text)
        for item_id, passage in passages:
            wanted = leaks.plain(passage)
            if wanted and page:
                distance = table_distance(wanted, page)
                if distance <= int(rate * len(wanted)):
                    key = match_id, item_id
                    out[key] = min(out.get(key, 999), distance)
    return sorted(((m, i, d) for (m, i), d in out.items()), key=repr)


def test_matches_brute_force(spark, rows):
    rng = random.Random(5)
    words = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "x", "y", "zz"]) for _ in range(n))
    passages = [(k, words(rng.randint(3, 25)).capitalize() + ".") for k in range(12)]
    passages += [(50, None), (51, ""), (52, "?!"), (53, "ok"), (3, "Another text of item three, at some length indeed.")]
    pages = []
    for k in range(30):
        text = passages[k % 12][1]
        pages.append((k, words(20) + " " + edited(rng, text, k % 7) + "\n" + words(20)))
    pages += [(40, None), (41, ""), (42, passages[0][1].upper().replace(" ", ",\n")), (43, "it is ok so"), (44, "token"),
              (45, words(3000) + passages[5][1]), (40, passages[1][1]), (46, "Another text of item three at some length indeed")]
    for block in (10, 2_000_000):
        found = leaks.find_leaks(spark.createDataFrame(pages, PAGES), spark.createDataFrame(passages, PASSAGES), block_chars=block)
        assert rows(found, "match_id", "item_id", "distance") == brute(pages, passages, leaks.ERROR_RATE)
        kept = leaks.drop_leaks(spark.createDataFrame(pages, PAGES), spark.createDataFrame(passages, PASSAGES), block_chars=block)
        clean = sorted((p for p in pages if not brute([p], passages, leaks.ERROR_RATE)), key=repr)
        assert rows(kept) == clean


def test_empty_tables_and_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "some page", 3, "t")], PAGES + ", item_id int, passage string")
    none, passages = spark.createDataFrame([], PASSAGES), spark.createDataFrame([(1, "some page here", 2)], PASSAGES + ", match_id int")
    assert leaks.find_leaks(pages, none).count() == 0
    assert leaks.find_leaks(pages.limit(0), passages).count() == 0
    assert leaks.drop_leaks(pages, none).columns == pages.columns
    assert leaks.drop_leaks(pages, passages).count() == 1

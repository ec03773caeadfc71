"""Overlap groups against brute force, the signature guarantee, and components."""

import random
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from matchloom.llm import page_overlap as overlap
from matchloom.session import Workspace

SCHEMA = "match_id long, page_text string"
WORDS = [a + b for a in ("de", "cs", "ak", "awp", "nade", "smoke", "eco") for b in ("", "x", "rush", "hold", "peek", "trade")]


def shingles(text, words):
    found = (text or "").encode().lower().split()
    return {tuple(found[k:k + words]) for k in range(max(1, len(found) - words + 1))} if found else set()


def brute(pages, words, percent):
    sets = [shingles(t, words) for _, t in pages]
    parent = list(range(len(pages)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for i, j in combinations(range(len(pages)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    out = []
    for k, (match_id, _) in enumerate(pages):
        ids = [m for j, (m, _) in enumerate(pages) if find(j) == find(k) and m is not None]
        out.append((match_id, len(sets[k]), (min(ids) if ids else None) if sets[k] else match_id))
    return sorted(out, key=repr)


def mutated(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        k = rng.randrange(len(words))
        rng.choice([lambda: words.pop(k) if len(words) > 1 else None, lambda: words.insert(k, rng.choice(WORDS)),
                    lambda: words.__setitem__(k, rng.choice(WORDS))])()
    return words


def family_pages(seed):
    rng = random.Random(seed)
    pages = []
    for _ in range(12):
        base = [rng.choice(WORDS) for _ in range(rng.choice([3, 7, 9, 15, 40, 120, 300]))]
        for _ in range(rng.randint(1, 9)):
            base = base if rng.random() < 0.5 else mutated(rng, base, rng.randint(0, 2))
            pages.append(" ".join(mutated(rng, base, rng.randint(0, max(1, len(base) // 60)))))
    rng.shuffle(pages)
    rows = [(k * 3, t) for k, t in enumerate(pages)]
    return rows + [(1, None), (2, ""), (4, " \t\n"), (5, pages[0].upper()), (5, pages[1]), (0, pages[0]), (0, pages[0]), (None, pages[2]),
                   (None, "only here and unknown"), (7, "word"), (8, "WORD"), (10, "ÄÖ word"), (11, "äö word"),
                   (13, " ".join(WORDS[k % 42] + str(k) for k in range(20_000))), (14, " ".join(WORDS[k % 42] + str(k) for k in range(19_000)))]


@pytest.mark.parametrize(("words", "percent", "centres"), [(4, 85, 16), (5, 80, 1)])
def test_matches_brute_force(spark, rows, monkeypatch, words, percent, centres):
    monkeypatch.setattr(overlap, "CENTRES", centres)
    pages = family_pages(words)
    found = overlap.page_groups(spark.createDataFrame(pages, SCHEMA), Workspace(spark, "t"), words=words, percent=percent)
    assert rows(found, "match_id", "n_shingles", "group_id") == brute(pages, words, percent)


def test_first_pages_stay_whole(spark, rows):
    pages = family_pages(9)
    frame = spark.createDataFrame([(*p, f"site {p[0]}") for p in pages], SCHEMA + ", site string")
    kept = overlap.keep_first_pages(frame, Workspace(spark, "t"), words=5, percent=80)
    assert kept.columns == frame.columns
    sets = [(m, t, shingles(t, 5)) for m, t in pages]
    groups = brute(pages, 5, 80)
    spoken = sorted({g for m, n, g in groups if n and g is not None})
    found = kept.collect()
    assert sorted(r.match_id for r in found if shingles(r.page_text, 5) and r.match_id is not None) == spoken
    assert sorted(repr(r.page_text) for r in found if not shingles(r.page_text, 5)) == sorted(repr(t) for _, t, s in sets if not s)
    assert all(r.site == f"site {r.match_id}" for r in found)


@given(st.integers(6, 300), st.integers(0, 60), st.sampled_from([80, 85]), st.integers(0, 10_000))
@settings(max_examples=200, deadline=None)
def test_linked_sets_share_a_signature(size, edits, percent, seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 1 << 63, size, np.int64).astype(np.uint64))
    keep = rng.permutation(len(a))[min(edits, len(a) - 1):]
    extra = rng.integers(0, 1 << 63, rng.integers(0, edits + 1), np.int64).astype(np.uint64)
    b = np.unique(np.concatenate([a[keep], extra]))
    shared = len(np.intersect1d(a, b))
    if 100 * shared >= percent * (len(a) + len(b) - shared):
        assert len(np.intersect1d(overlap.signatures(a, percent), overlap.signatures(b, percent)))


def test_components_of_chains_stars_and_pairs(spark, rows):
    links = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(300, 299), (299, 300), (5, 5)]
    found = overlap.components(spark.createDataFrame(links, "a long, b long"), Workspace(spark, "t"))
    assert rows(found, "page", "root") == sorted(
        [(k, 0) for k in range(61)] + [(k, 100) for k in range(100, 160)] + [(299, 299), (300, 299)], key=repr)
    assert overlap.components(spark.createDataFrame([(4, 4)], "a long, b long"), Workspace(spark, "t")) is None


def test_empty_table_and_clashing_columns(spark, rows):
    assert overlap.page_groups(spark.createDataFrame([], SCHEMA), Workspace(spark, "t")).count() == 0
    wide = spark.createDataFrame([(2, "a b c", 1, "x"), (1, "A  b c", 1, "x")], SCHEMA + ", page int, root string")
    assert rows(overlap.page_groups(wide, Workspace(spark, "t")), "match_id", "n_shingles", "group_id") == [(1, 1, 1), (2, 1, 1)]

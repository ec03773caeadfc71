"""Language mixtures and quality scores: held-out accuracy and odd rows."""

import random

import numpy as np
import pytest

from matchloom.llm import page_language as language
from matchloom.llm import page_quality as quality
from matchloom.llm.queries import documents, hash_rest, table
from matchloom.session import Workspace

SF = "/root/testdata/sf0.01"
LANGUAGES = "match_id long, page_text string, language string"
SYLLABLES = {"da": "rød grød med fløde hyg spil kamp hold".split(), "pl": "szcz ść rzy mecz gra wy pro dru".split(), "fi": "ää yö pel i otte lu joukk ue".split()}


def prose(rng, tongue, words):
    return " ".join("".join(rng.choice(SYLLABLES[tongue]) for _ in range(rng.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="module")
def trained(spark):
    rng = random.Random(1)
    rows = [(k, prose(rng, tongue, 60), tongue) for k, tongue in enumerate(list(SYLLABLES) * 30)]
    rows += [(900, None, "da"), (901, "text", None), (902, "", "pl")]
    return language.fit_languages(spark.createDataFrame(rows, LANGUAGES))


def guesses(spark, model, rows):
    return {r.match_id: r for r in language.guess_languages(spark.createDataFrame(rows, "match_id long, page_text string"), model).collect()}


def test_single_and_mixed_pages(spark, trained):
    rng = random.Random(2)
    rows = [(k, prose(rng, tongue, 40)) for k, tongue in enumerate(list(SYLLABLES) * 10)]
    mixed = " ".join([prose(rng, "da", 120), prose(rng, "fi", 60)])
    got = guesses(spark, trained, [*rows, (100, mixed), (101, prose(rng, "pl", 30_000))])
    assert all(got[k].language_pred == list(SYLLABLES)[k % 3] and got[k].languages == [got[k].language_pred] for k in range(30))
    assert got[100].languages == ["da", "fi"] and abs(got[100].share - 2 / 3) < 0.08
    assert got[101].language_pred == "pl" and 0 <= got[101].share <= 1


def test_em_reaches_the_likeliest_shares():
    likelihood = np.array([[1.0, 0.1]] * 30 + [[0.2, 1.0]] * 10)
    sizes = np.array([40])
    shares, _ = language.em(likelihood, sizes, np.full((1, 2), 0.5), 400)
    grid = np.linspace(0.001, 0.999, 999)
    best = grid[np.argmax([np.log(likelihood @ [g, 1 - g]).sum() for g in grid])]
    assert abs(shares[0, 0] - best) < 0.005


def test_unknown_texts_repeats_and_no_model(spark, trained):
    got = guesses(spark, trained, [(1, None), (2, ""), (3, "123 ½ !? _"), (4, "漢字"), (None, "grød"), (5, "grød"), (5, "grød")])
    assert [got[k].language_pred for k in (1, 2, 3)] == ["und"] * 3 and got[3].share == 0
    assert got[4].language_pred in SYLLABLES and got[None].language_pred == "da"
    none = language.fit_languages(spark.createDataFrame([(1, "text", None)], LANGUAGES))
    assert guesses(spark, none, [(1, "grød")])[1].language_pred == "und"
    kept = language.keep_known_languages(spark.createDataFrame([(1, "grød med fløde", 7), (2, None, 8)], "match_id long, page_text string, share int"), trained)
    assert [tuple(r) for r in kept.collect()] == [(1, "grød med fløde", 7)]
    assert language.guess_languages(spark.createDataFrame([], "match_id long, page_text string"), trained).count() == 0


def test_held_out_languages(spark):
    pages = documents(spark, SF)
    model = language.fit_languages(pages.where(hash_rest("match_id", 5) != 0))
    out = language.guess_languages(pages.where(hash_rest("match_id", 5) == 0), model).join(pages.select("match_id", "language"), "match_id").collect()
    assert np.mean([r.language == r.language_pred for r in out]) > 0.98


def test_held_out_quality(spark):
    pages = documents(spark, SF)
    outcomes = table(spark, SF, "labels").selectExpr("doc_id as match_id", "quality as data_complete")
    held = hash_rest("match_id", 4) == 2
    model = quality.fit_quality(pages, outcomes.where(~held), Workspace(spark, "t"))
    assert model.pairs and len(model.tables) == len(quality.FEATURES)
    scored = quality.score_quality(pages, model)
    assert scored.count() == pages.count() and scored.where("quality_score < 0 or quality_score > 1").count() == 0
    rows = scored.join(outcomes.where(held), "match_id").collect()
    good = [r.quality_score for r in rows if r.data_complete == 1]
    bad = [r.quality_score for r in rows if r.data_complete == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = quality.AdditiveModel(x, y)
    assert (2, 5) in model.pairs and ((model.score(x) > 0.5) == y).mean() > 0.95


def test_quality_of_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "word " * 40_000, 3), (3, "again", 4), (None, "x", 5)], "match_id long, page_text string, x int")
    known = "match_id long, data_complete int"
    for outcomes, expected in (([], 0.5), ([(1, 1), (2, None), (9, 0), (None, 0)], 0.75)):
        model = quality.fit_quality(pages, spark.createDataFrame(outcomes, known), Workspace(spark, "t"))
        scores = quality.score_quality(pages, model).collect()
        assert len(scores) == 5 and all(abs(r.quality_score - expected) < 1e-9 for r in scores)
    assert quality.score_quality(pages.limit(0), model).count() == 0


def test_chunks_change_nothing(spark, trained, monkeypatch):
    rng = random.Random(6)
    rows = [(k, " ".join(prose(rng, tongue, rng.randint(1, 80)) for tongue in rng.sample(list(SYLLABLES), rng.randint(1, 3)))) for k in range(60)]
    usual = guesses(spark, trained, rows)
    for cells in (1, 3000):
        monkeypatch.setattr(language, "CHUNK_CELLS", cells)
        small = guesses(spark, trained, rows)
        assert all(small[k].languages == usual[k].languages and np.allclose(small[k].shares, usual[k].shares, atol=1e-9) for k in usual)


def test_language_sets_against_every_set(trained):
    """The chosen set is the one with the best penalised likelihood among all sets of languages."""
    rng = random.Random(7)
    texts = [" ".join(prose(rng, tongue, rng.randint(40, 90)) for tongue in rng.sample(list(SYLLABLES), size)) for size in (1, 2, 3) for _ in range(6)]
    for text in texts:
        words = language.page_words(text)
        likelihood = np.repeat(trained.word_likelihoods(list(words)), list(words.values()), axis=0)
        total = len(likelihood)
        scores = {}
        for mask in range(1, 8):
            members = [k for k in range(3) if mask >> k & 1]
            start = np.zeros((1, 3))
            start[0, members] = 1 / len(members)
            found = language.em(likelihood, np.array([total]), start, 200)[1][0]
            scores[mask] = found - language.PENALTY * np.log(total + 1) * (len(members) - 1)
        best = max(scores, key=scores.get)
        shares = trained.shares([words])[0]
        assert sum(1 << k for k in range(3) if shares[k] > 0) == best


def test_more_labels_than_a_few_hundred(spark):
    rows = [(k, f"{'bcdfghklmnprstvz'[k % 16]}{'aeiou'[k // 16 % 5]}{'bcdfg'[k // 80]}o " * 20, f"label{k:03d}") for k in range(300)]
    model = language.fit_languages(spark.createDataFrame(rows, LANGUAGES))
    assert len(model.languages) == 300
    got = guesses(spark, model, [r[:2] for r in rows[::30]])
    assert all(got[k].language_pred == f"label{k:03d}" for k in got)


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(8)
    x = rng.random((600, len(quality.FEATURES)))
    model = quality.AdditiveModel(x, ((x[:, 1] > 0.4) ^ (x[:, 3] > 0.7)).astype(float))
    for row, score in zip(x[:80], model.score(x[:80]), strict=True):
        margin = model.base
        for value, edges, table in zip(row, model.edges, model.tables, strict=True):
            margin += table[sum(edge <= value for edge in edges)]
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            margin += table[sum(e <= row[i] for e in model.pair_edges[i])][sum(e <= row[j] for e in model.pair_edges[j])]
        assert abs(score - 1 / (1 + np.exp(-max(-30, min(30, margin))))) < 1e-12

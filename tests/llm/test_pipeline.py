"""The pipeline over a small fixture, stage by stage against brute force; the registered queries."""

import random

import __spark_entry__ as entry
import corpus_pipeline as pipeline
import public_tokenizers
import pytest
from test_benchmark_leaks import brute as leaks_of
from test_page_overlap import shingles
from test_site_lines import brute as lines_of
from tokenizers import Tokenizer

from matchloom.llm import benchmark_leaks, site_lines
from matchloom.llm.token_packing import END_ID

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the round was lost on the last save of map two".split(), "da": "kampen blev tabt på den sidste bane af to".split()}


def text_of(rng, lang, words):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "s", "en", "er", "ing"]) for _ in range(words))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(4)
    rows = []
    for k in range(60):
        lang = ("en", "da")[k % 2]
        rows.append([k, "Vote for this match\n" + text_of(rng, lang, 60) + "\n" + text_of(rng, lang, 30), lang, f"site{k % 3}", 0])
    passage = text_of(rng, "en", 15)
    rows += [[100, rows[4][1], "en", "site9", 0], [101, rows[6][1] + " plus", "en", "site9", 0], [102, "12 %% 34", None, None, 0], [103, None, "en", "site1", 0],
             [104, "", "en", "site1", 0], [105, text_of(rng, "en", 40) + " " + passage.upper() + " " + text_of(rng, "en", 40), "en", "site8", 0],
             [106, "a b", "en", "site8", 0], [100, rows[4][1], "en", "site9", 0], [None, text_of(rng, "da", 50), None, None, None],
             [107, text_of(rng, "en", 20_000), "en", "site7", 0]]
    rows = [(a, b, c, d, len(b or "")) for a, b, c, d, _ in rows]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(*r, "extra") for r in rows], DOCUMENTS + ", page_text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, [(1, passage), (2, None)]


def test_each_stage_against_brute_force(spark, corpus, tmp_path):
    folder, _, passages = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    given = [tuple(r)[:5] for r in docs.collect()]
    for name, stage in pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        out = [tuple(r) for r in docs.collect()]
        if name != "packing":
            assert tuple(docs.columns) == pipeline.COLUMNS
        if name == "language_id":
            assert sorted(out, key=repr) == sorted((r for r in given if any(c.isalpha() for c in r[1] or "")), key=repr)
        elif name == "line_dedup":
            expected = lines_of([(r[0], r[3], r[1]) for r in given], site_lines.RATIO, site_lines.MIN_PAGES)
            assert sorted((r[:2] for r in out), key=repr) == sorted((r[:2] for r in expected), key=repr)
            assert all(r[4] == len(r[1]) for r in out if r[0] is not None)
        elif name == "near_duplicates":
            near = [(i, j) for i, a in enumerate(given) for j, b in enumerate(given) if i < j
                    and 100 * len(shingles(a[1], 5) & shingles(b[1], 5)) >= 80 * len(shingles(a[1], 5) | shingles(b[1], 5))]
            leader = list(range(len(given)))
            for _ in given:
                for i, j in near:
                    leader[i] = leader[j] = min(leader[i], leader[j], key=lambda k: (given[k][0] is None, given[k][0] or 0, k))
            assert sorted(map(repr, out)) == sorted(repr(given[k]) for k in set(leader))
        elif name == "decontamination":
            assert sorted(map(repr, out)) == sorted(
                repr(r) for r in given if not leaks_of([(0, r[1])], passages, benchmark_leaks.ERROR_RATE))
            assert {r[0] for r in given} - {r[0] for r in out} == {105}
        else:
            whole = Tokenizer.from_file(public_tokenizers.path(pipeline.VOCABULARY))
            sizes = {r[0]: len(whole.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in given}
            packed = {}
            for doc_id, _, length, *_ in out:
                packed[doc_id] = packed.get(doc_id, 0) + length
            assert packed == sizes and END_ID == 2
        given = out


def test_run_gives_the_last_stage(spark, corpus, tmp_path):
    folder, rows, _ = corpus
    out = pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == {r[0] for r in rows} - {100, 101, 102, 103, 104, 105}


def test_registered_queries():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()


def test_stages_hand_python_small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        pipeline.pack_sequences(spark, spark.createDataFrame([(1, "a b", "en", "s", 3)], DOCUMENTS), "")
        assert int(spark.conf.get(name)) <= 1000
    finally:
        spark.conf.set(name, before)

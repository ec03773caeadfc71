"""Packed pieces against the tokenizer run on whole texts."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from matchloom.llm import token_packing as packing

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
ENGINE = packing.WordTokens(PATH)
SCHEMA = "match_id long, page_text string"
ODD = ["", "  ", None, "Hello  World don't I'LL", "x ̈y ΣΑΣ ½ H̱a İstanbul <|endoftext|> a", "a\tb\x0bc\x0cd\x1ce\x85f\xa0g", "日本 語 テスト🙂🙂 ok",
       "﻿x ​ y　z", "word " * 9000, "q" * 20_000]


def ids_of(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


@given(st.lists(st.text(max_size=60), max_size=4))
@settings(max_examples=150, deadline=None)
def test_words_give_the_ids_of_whole_texts(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    found = ENGINE.encode([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [ids_of(t) for t in texts]


@given(st.integers(1, 50_000))
def test_binary_lengths(tokens):
    lengths = packing.binary_lengths(tokens)
    assert sum(lengths) == tokens and lengths == sorted(lengths, reverse=True)
    assert all(n & (n - 1) == 0 and n <= packing.MAX_LENGTH for n in lengths)
    rest = [n for n in lengths if n < packing.MAX_LENGTH]
    assert len(rest) == len(set(rest))


@pytest.mark.parametrize("cached", [600_000, 3])
def test_pieces_tile_every_page(spark, monkeypatch, cached):
    monkeypatch.setattr(packing, "CACHED_WORDS", cached)
    rows = [(k, t) for k, t in enumerate(ODD)] + [(3, ODD[3]), (None, "no id")]
    found = packing.pack_pages(spark.createDataFrame(rows, SCHEMA).repartition(3), PATH).collect()
    assert len({r.sequence_id for r in found}) == len(found) and {r.offset for r in found} == {0}
    pages = {}
    for r in sorted(found, key=lambda r: (r.sequence_id)):
        ids = np.frombuffer(r.token_ids, "<u4").tolist()
        assert len(ids) == r.length
        pages.setdefault((r.match_id, r.page_tokens), []).append((r.start, ids))
    for match_id, text in rows:
        wanted = ids_of(text)
        pieces = sorted(pages[match_id, len(wanted)])[:: 2 if match_id == 3 else 1]
        assert [i for _, ids in pieces for i in ids] == wanted
        assert [s for s, _ in pieces] == [sum(len(x) for _, x in pieces[:k]) for k in range(len(pieces))]


def test_buckets_empty_table_and_clashing_columns(spark, tmp_path):
    wide = spark.createDataFrame([(1, "a b c d e", 5, "x")], SCHEMA + ", start int, token_ids string")
    packing.write_buckets(packing.pack_pages(wide, PATH), str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").glob("length=*")) == ["length=2", "length=4"]
    assert packing.pack_pages(spark.createDataFrame([], SCHEMA), PATH).count() == 0

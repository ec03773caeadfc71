"""Perspective views of dialogues: rendering, masks, parts."""

import hashlib
import random
import time

from matchloom.llm import dialogue_views as views
from matchloom.session import Workspace

SCHEMA = "conv_id long, turn long, speaker string, text string"


def in_order(turns, conv):
    def digest(speaker, text):
        return "".join(hashlib.md5(x.encode()).hexdigest() for x in (speaker, text))
    return sorted((r for r in turns if r[0] == conv), key=lambda r: (r[1], digest(r[2], r[3])))


def brute(turns):
    """Whole views, joined over their parts: text, and the words the model learns."""
    clean = {(c, -1 if t is None else t, s or "unknown", x or "") for c, t, s, x in turns}
    out = {}
    for conv, who in {(c, s) for c, _, s, _ in clean if s != "system"}:
        segments = []
        for _, _t, s, x in in_order(clean, conv):
            head = "<|assistant|>" if s == who else "<|system|>" if s == "system" else f"<|user name={s}|>"
            segments.append((f"{head}\n{x}<|end|>\n", f"{x}<|end|>" if s == who else None))
        out[conv, who] = [t for t, _ in segments], [t for _, t in segments if t]
    return out


def joined(found):
    out = {}
    for r in found.orderBy("part").collect():
        text, learned = out.setdefault((r.conv_id, r.perspective), ([], []))
        text += [s + "<|end|>\n" for s in r.rendered.split("<|end|>\n")[:-1]]
        learned += [r.rendered[a:b] for a, b in r.loss_spans]
    return out


def test_matches_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    turns = [(c, t, rng.choice(["coach", "igl", "awper", "system"]), f"call {rng.randint(0, 9)}") for c in range(8) for t in range(rng.randint(1, 150))]
    turns += [(20, 0, "system", "alone"), (21, None, None, None), (21, 1, "igl", ""), (None, 0, "igl", "x"), (22, 0, "a", "x"), (22, 0, "a", "x"),
              (22, 0, "b", "y" * 50_000)] + [(23, 5, "a", f"tie {k}") for k in range(60)]
    frame = spark.createDataFrame(turns, SCHEMA)
    assert joined(views.perspective_views(frame, Workspace(spark, "t"))) == brute(turns)
    monkeypatch.setattr(views, "PART_ROWS", 10)
    small = views.perspective_views(frame, Workspace(spark, "t"))
    assert joined(small) == brute(turns)
    assert small.agg({"n_turns": "max"}).first()[0] == 10


def test_a_large_dialogue_without_id_is_cut(spark):
    turns = [(None, k % 5 if k % 2 else None, "ab"[k % 3 % 2], f"call {k}") for k in range(400)]
    found = views.perspective_views(spark.createDataFrame(turns, SCHEMA), Workspace(spark, "t"))
    assert joined(found) == brute(turns)
    assert [r.n_turns for r in found.where("perspective = 'a'").orderBy("part").collect()] == [64] * 6 + [16]


def test_long_turns_take_time_in_proportion(spark):
    def seconds(count):
        frame = spark.range(count).selectExpr("1L conv_id", "id turn", "'a' speaker", "repeat(cast(id as string), 5000) text")
        begin = time.monotonic()
        assert views.perspective_views(frame, Workspace(spark, "t")).selectExpr("sum(n_turns)", "sum(length(rendered))").first()[0] == count
        return time.monotonic() - begin
    seconds(10)
    assert seconds(4000) < 30  # about 75 MB of text


def test_order_within_a_view(spark):
    found = views.perspective_views(spark.createDataFrame(
        [(1, 2, "b", "third"), (1, 0, "system", "first"), (1, 1, "a", "second")], SCHEMA), Workspace(spark, "t"))
    text = {r.perspective: r.rendered for r in found.collect()}
    assert text["a"] == "<|system|>\nfirst<|end|>\n<|assistant|>\nsecond<|end|>\n<|user name=b|>\nthird<|end|>\n"


def test_empty_table_and_clashing_columns(spark):
    assert views.perspective_views(spark.createDataFrame([], SCHEMA), Workspace(spark, "t")).count() == 0
    wide = spark.createDataFrame([(1, 0, "a", "x", 1, "p", 3)], SCHEMA + ", part int, perspective string, rows int")
    assert views.perspective_views(wide, Workspace(spark, "t")).count() == 1

import tracemalloc

import pyarrow as pa
import pytest

from matchloom.operators import markup as k

WELL_FORMED = ('<!DOCTYPE html><html><head><title>A &amp; B</title><script>if (a < b) x = "</p>";</script></head><body><!-- top -->'
               '<p class="a b">one<br>two &lt; <b>three</b></p><img src="x"/><a HREF="/q?a=1&amp;b=2" data-unix="5">go</a> </DIV><i>open')


def nodes_of(page):
    return k.outline.func(pa.array([page])).to_pylist()[0]


def test_well_formed_pages_are_not_given_to_the_tolerant_parser(monkeypatch):
    expected = nodes_of("<x-y>" + WELL_FORMED)[1:]  # a tag name with a hyphen needs the tolerant parser

    def refuse(*_args):
        raise AssertionError("tolerant parser")
    monkeypatch.setattr(k._Outliner, "feed", refuse)
    found = nodes_of(WELL_FORMED)
    assert [(n["tag"], n["classes"], n["text"], n["href"]) for n in found] == [(n["tag"], n["classes"], n["text"], n["href"]) for n in expected]
    assert [n["end"] - n["i"] for n in found] == [n["end"] - n["i"] for n in expected]
    with pytest.raises(AssertionError):
        nodes_of("<p>a < b</p>")


@pytest.mark.parametrize("page", ["<p class=x>a</p>", "a < b", "<b", "<script>x</script >", "<title>a<b>c</b></title>", "&am", "<p/a>", "<noscript><p></noscript>"])
def test_either_way_of_reading_gives_the_same_nodes(monkeypatch, page):
    page = f'<div class="c">{page}</div><p>end</p>'
    found = nodes_of(page)
    monkeypatch.setattr(k._Outliner, "_simple", lambda *_args: False)
    assert nodes_of(page) == found


def test_nodes_of_many_pages_are_not_held_as_objects():
    """A batch of pages takes memory for a bounded number of nodes, beyond its Arrow result."""
    page = "<p><a href=\"/x\">t</a></p>" * 100

    def peak(n):
        pages = pa.array([page] * n)
        tracemalloc.start()
        k.outline.func(pages)
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return top
    assert peak(3000) < 2 * peak(500)

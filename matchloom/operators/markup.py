"""HTML as a column of nodes, and selectors over it.

Python only walks the markup: ``outline`` turns a page into a flat list of
nodes in document order, each with its parent and the end of its subtree.
Every choice of element, text or attribute is a column expression.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Sequence
from html import parser, unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from matchloom.functions.text import strip

# Elements that never have content, and ones whose text is not shown.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SILENT = {"script", "style", "template"}

NODE = T.StructType([
    T.StructField("i", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("up", T.IntegerType()),
    T.StructField("tag", T.StringType()), T.StructField("classes", T.ArrayType(T.StringType())),
    *[T.StructField(name, T.StringType()) for name in ("text", "shown", "href", "unix", "demo")]])
_FIELDS = [to_arrow_type(f.dataType) for f in NODE.fields]

# Executors get the walker with the job; they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# Tags, declarations and comments as well-formed pages write them. Where anything else follows a "<", the page goes through the tolerant parser.
_ATTRIBUTES = r'((?:[ \t\n]+[a-zA-Z][-a-zA-Z0-9]*="[^"]*")*)[ \t\n]*'
_TOKEN = re.compile(
    rf"<(?:/([a-zA-Z][a-zA-Z0-9]*)>|(script|style|title){_ATTRIBUTES}>([^<]*(?:<(?!/[sStT])[^<]*)*)</\2>"
    rf"|([a-zA-Z][a-zA-Z0-9]*){_ATTRIBUTES}(/?)>|![dD][oO][cC][tT][yY][pP][eE][^<>]*>|!--[^<>-]+-->)")
# What stands between "<" and ">" in such a tag, declaration or comment.
_TAG = re.compile(rf"/([a-zA-Z][a-zA-Z0-9]*)|([a-zA-Z][a-zA-Z0-9]*){_ATTRIBUTES}(/?)|![dD][oO][cC][tT][yY][pP][eE][^<>]*|!--[^<>-]+--")
_ATTRIBUTE = re.compile(r'([-a-zA-Z0-9]+)="([^"]*)"')
_unescape_value = getattr(parser, "_unescape_attrvalue", unescape)
# Elements whose content is not plain markup; they too need the tolerant parser.
SPECIAL = SILENT | {"iframe", "noembed", "noframes", "noscript", "plaintext", "svg", "math", "textarea", "title", "xmp"}
# Nodes and distinct elements held as Python objects at a time, and pages read at a time.
MOST_NODES, MOST_KINDS, SOME_PAGES = 100_000, 10_000, 64
# What a tag does. A whole element runs up to its end tag without markup in between.
OPENS, STANDS, CLOSES, NOTHING, WHOLE, UNKNOWN = range(6)


class _Outliner(HTMLParser):
    """Appends the nodes of each page column by column. A kind is a tag with its classes and attributes; texts are of kind 0."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.clear()

    def clear(self) -> None:
        self.places: list[int] = []
        self.kinds: list[tuple] = [(None,) * 5]
        self.known: dict = {}
        self.raw_known: dict = {}
        self.tags: dict = {}
        self.clear_nodes()

    def clear_nodes(self) -> None:
        """Forget the nodes, not the kinds."""
        self.ends: list[int] = []
        self.ups: list[int] = []
        self.of_kind: list[int] = []
        self.texts: list[str | None] = []
        self.open: list[int] = []
        self.start = 0

    def is_full(self) -> bool:
        return max(len(self.raw_known), len(self.tags)) >= MOST_KINDS

    def page(self, html: str) -> None:
        self.start, self.open = len(self.ends), []
        if not self._simple(html):
            self._again()
            self.reset()
            self.feed(html)
            self.close()
        for at in self.open:
            self.ends[at] = len(self.ends) - self.start

    def _again(self) -> None:
        for column in (self.ends, self.ups, self.of_kind, self.texts):
            del column[self.start:]
        self.open = []

    def _simple(self, html: str) -> bool:
        """Walk a well-formed page; false when it needs the tolerant parser."""
        if self._by_tags(html):
            return True
        self._again()
        parts = _TOKEN.split(html)
        return not (any("<" in text for text in parts[::8]) or "&" in parts[-1]) and self._by_pattern(parts)

    def _by_tags(self, html: str) -> bool:
        """Walk a page cut at each "<"; false where one stands in a text or an attribute, or "&" in the last text."""
        pieces = html.split("<")
        if "&" in pieces[-1]:
            return False
        tags, opened, ends, ups, of_kind, texts, start = self.tags, self.open, self.ends, self.ups, self.of_kind, self.texts, self.start
        kinds, n, up = self.kinds, 0, -1
        pieces = iter(pieces)
        if text := next(pieces):
            ends.append(1)
            ups.append(-1)
            of_kind.append(0)
            texts.append(unescape(text))
            n = 1
        for piece in pieces:
            tag, shut, text = piece.partition(">")
            if not shut:
                return False
            does, kind = tags.get(tag) or self._learn(tag)
            if does == OPENS:
                opened.append(start + n)
                ends.append(0)
                ups.append(up)
                of_kind.append(kind)
                texts.append(None)
                up = n
                n += 1
            elif does == CLOSES:
                if opened and kinds[of_kind[opened[-1]]][0] == kind:
                    ends[opened.pop()] = n
                else:
                    self.handle_endtag(kind)
                up = opened[-1] - start if opened else -1
            elif does == STANDS:
                n += 1
                ends.append(n)
                ups.append(up)
                of_kind.append(kind)
                texts.append(None)
            elif does == WHOLE:
                name, rest = kinds[kind][0], next(pieces, "")
                if not rest.startswith(f"/{name}>"):
                    return False
                at = self._add(kind, None)
                if text and name not in SILENT:
                    opened.append(at)
                    self._add(0, unescape(text))
                    ends[opened.pop()] += 1
                n, text = len(ends) - start, rest[len(name) + 2:]
            elif does == UNKNOWN:
                return False
            if text:
                n += 1
                ends.append(n)
                ups.append(up)
                of_kind.append(0)
                texts.append(unescape(text) if "&" in text else text)
        return True

    def _learn(self, tag: str) -> tuple[int, int | str]:
        """What a tag does, with its kind or, for an end tag, its name."""
        found = _TAG.fullmatch(tag)
        if not found:
            learnt = UNKNOWN, 0
        elif closed := found[1]:
            learnt = CLOSES, closed.lower()
        elif not found[2]:
            learnt = NOTHING, 0
        elif found[2] in ("script", "style", "title") and not found[4]:
            learnt = WHOLE, self._kind(found[2], self._given(found[3]))
        else:
            kind, void = self._raw_kind(found[2], found[3])
            learnt = (UNKNOWN, 0) if kind is None else (STANDS if void or found[4] else OPENS, kind)
        self.tags[tag] = learnt
        return learnt

    def _by_pattern(self, parts: list) -> bool:
        """Walk a page cut at its tags; false when it holds an element that needs the tolerant parser."""
        raw_known, opened, ends, of_kind, start = self.raw_known, self.open, self.ends, self.of_kind, self.start
        if parts[0]:
            self.handle_data(unescape(parts[0]))
        pieces = iter(parts)
        next(pieces)
        for closed, whole, whole_attrs, content, name, attrs, slash, text in zip(*[pieces] * 8):
            if name is not None:
                kind, void = raw_known.get((name, attrs)) or self._raw_kind(name, attrs)
                if kind is None:
                    return False
                at = self._add(kind, None)
                if not void:
                    opened.append(at)
                if slash:
                    self.handle_endtag(name.lower())
            elif closed is not None:
                if opened and self.kinds[of_kind[opened[-1]]][0] == closed:
                    ends[opened.pop()] = len(ends) - start
                else:
                    self.handle_endtag(closed.lower())
            elif whole is not None:
                if whole not in SILENT and "<" in content:
                    return False
                self.handle_starttag(whole, self._given(whole_attrs))
                if content:
                    self.handle_data(unescape(content))
                self.handle_endtag(whole)
            if text:
                self._add(0, unescape(text) if "&" in text else text)
        return True

    def _given(self, attrs: str) -> list[tuple[str, str]]:
        return [(key.lower(), _unescape_value(value)) for key, value in _ATTRIBUTE.findall(attrs)]

    def _raw_kind(self, name: str, attrs: str) -> tuple[int | None, bool]:
        tag = name.lower()
        found = (None if tag in SPECIAL else self._kind(tag, self._given(attrs)), tag in VOID)
        self.raw_known[name, attrs] = found
        return found

    def _kind(self, tag: str, attrs: list) -> int:
        # The first of a repeated attribute wins.
        given = {name: value or "" for name, value in reversed(attrs)}
        kind = (tag, tuple(given.get("class", "").split()), *(given.get(name) for name in ("href", "data-unix", "data-demo-link")))
        at = self.known.setdefault(kind, len(self.kinds))
        if at == len(self.kinds):
            self.kinds.append(kind)
        return at

    def updatepos(self, i: int, j: int) -> int:
        """Line numbers are not kept; counting them takes a fifth of the walk."""
        return j

    def _add(self, kind: int, text: str | None) -> int:
        at = len(self.ends)
        self.ends.append(at - self.start + 1)
        self.ups.append(self.open[-1] - self.start if self.open else -1)
        self.of_kind.append(kind)
        self.texts.append(text)
        return at

    def _tag(self, at: int) -> str | None:
        return self.kinds[self.of_kind[at]][0]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        at = self._add(self._kind(tag, attrs), None)
        if tag not in VOID:
            self.open.append(at)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if any(self._tag(at) == tag for at in self.open):
            while True:
                at = self.open.pop()
                self.ends[at] = len(self.ends) - self.start
                if self._tag(at) == tag:
                    break

    def handle_data(self, text: str) -> None:
        if not (self.open and self._tag(self.open[-1]) in SILENT):
            self._add(0, text)

    def nodes(self) -> pa.Array:
        """The nodes since the last ``clear``. Each kind is converted once and then repeated."""
        places = pa.array(self.of_kind, pa.int32())
        kinds = [pa.array(values, type=kind).take(places) for values, kind in zip(zip(*self.kinds), [_FIELDS[n] for n in (3, 4, 7, 8, 9)])]
        own = [pa.array(values, pa.int32()) for values in (self.places, self.ends, self.ups)]
        # Blank characters are the same to Python's strip and to functions.text.
        shown = [text and (text.strip() or None) for text in self.texts]
        return pa.StructArray.from_arrays(
            [*own, *kinds[:2], pa.array(self.texts, pa.string()), pa.array(shown, pa.string()), *kinds[2:]], names=NODE.names)


@F.arrow_udf(T.ArrayType(NODE))
def outline(html: pa.Array) -> pa.Array:
    """Nodes of each page, in document order.

    A batch holds thousands of pages. They are turned into Arrow a bounded number of nodes at a time (or one page).
    """
    walker, ends, done, found = _Outliner(), [0], 0, []
    for first_page in range(0, len(html), SOME_PAGES):
        for page in html.slice(first_page, SOME_PAGES).to_pylist():
            walker.page(page or "")
            walker.places.extend(range(len(walker.ends) - walker.start))
            ends.append(done + len(walker.ends))
            if len(walker.ends) >= MOST_NODES or walker.is_full():
                found.append(walker.nodes())
                done += len(walker.ends)
                walker.clear()
    found.append(walker.nodes())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(found) if len(found) > 1 else found[0])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` worked out once, not once per element it is compared with."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def staged(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Select whose results are worked out once, whatever later steps do with them.

    A plain select would be merged into the steps above it, and a filter pushed
    below it would work its expressions out again.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def inside(nodes: Column, node: Column) -> Column:
    """Nodes below ``node``; none when there is no such node.

    ``nodes`` is a whole page or itself the inside of a node, so the answer is
    one slice of it.
    """
    found = let(node, lambda top: F.slice(
        nodes, top["i"] + 2 - first(nodes)["i"], top["end"] - top["i"] - 1))
    return F.coalesce(found, F.slice(nodes, 1, 0))


def select(nodes: Column, tag: str | Sequence[str], *classes: str) -> Column:
    """Elements with the tag and every one of the classes."""
    def fits(n: Column) -> Column:
        hit = n["tag"] == tag if isinstance(tag, str) else n["tag"].isin(*tag)
        for css_class in classes:
            hit = hit & F.array_contains(n["classes"], css_class)
        return hit

    return F.filter(nodes, fits)


def select_exact(nodes: Column, tag: str, class_text: str) -> Column:
    """Elements whose whole class attribute reads ``class_text``."""
    return F.filter(nodes, lambda n: (n["tag"] == tag) & (F.array_join(n["classes"], " ") == class_text))


def first(nodes: Column) -> Column:
    return F.get(nodes, F.lit(0))


def strings(nodes: Column) -> Column:
    """Trimmed non-empty texts in order."""
    return F.array_compact(F.transform(nodes, lambda n: n["shown"]))


def texts_of(nodes: Column, node: Column) -> Column:
    """Trimmed non-empty texts below ``node``, in order."""
    return strings(inside(nodes, node))


def text_of(nodes: Column, node: Column, separator: str = "") -> Column:
    """Trimmed texts below ``node``, joined; empty for an element without text.

    Most cells hold one text and nothing else; it is looked up in place.
    """
    only = F.get(nodes, node["i"] + 1 - first(nodes)["i"])["shown"]
    return F.when(node["end"] == node["i"] + 2, F.coalesce(only, F.lit(""))).otherwise(
        F.array_join(texts_of(nodes, node), separator))


def raw_text_of(nodes: Column, node: Column) -> Column:
    """Text below ``node`` as written, trimmed at both ends."""
    return strip(F.array_join(F.transform(inside(nodes, node), lambda n: n["text"]), ""))


def later_siblings(nodes: Column, node: Column) -> Column:
    return let(node, lambda left: F.filter(
        nodes, lambda n: (n["i"] > left["i"]) & (n["up"] == left["up"])))

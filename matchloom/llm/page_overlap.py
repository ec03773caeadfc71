"""Groups of pages whose word shingles overlap: an exact Jaccard join by PartEnum signatures.

Page texts are rows ``match_id``, ``page_text``. A page's set holds the distinct
runs of ``words`` words (ASCII letters in lower case, parted at ASCII white
space; a text with fewer words is one run). Two pages link when ``100 * shared >=
percent * union``; the result names each page's connected group.

How it finds every link without comparing everything:

* Equal texts are one candidate; the largest group of copies costs one set.
* A set with too many shingles of its own cannot link and drops out first. Among the rest, the shingles that no
  other set holds bound the size of any partner, and members with no partner in a bucket leave it. A 256-bit
  parity sketch of each set bounds the differences of two sets from below; pairs beyond k are not formed.
* Sizes fall into bands whose ends are ``percent`` apart, so linked sets lie in one
  band or in neighbours, and both write signatures for the band of the larger one.
  Within a band, linked sets differ in at most k shingles.
* The shingle domain is hashed into ``ceil((k + 1) / 2)`` partitions of several parts.
  Some partition holds at most one difference, so all of its parts but one agree; a signature is the
  content of a partition but for one part. Sets with at most k differences
  therefore share a signature, whatever the hashing. Bands of small sets have few
  partitions and get more parts, three to sixteen, so that a signature still covers nearly a whole partition.
* A signature without any shingle would gather unrelated pages. Such a signature is
  written once for each signature of a second, independent partitioning, which linked
  sets share too, so nothing is lost and the gathering is broken up.
* In a signature's bucket only links to its centre are tried at first: the member that shares the most
  signatures with other pages, as the least edited copy does. Then buckets that still
  hold pages of different groups try their next members in that order, until none is left. Pages of one group are
  never compared again, so a bucket of copies costs its length, not its square.

Every candidate pair is measured on its whole sets. Defined results: a null or
blank text has an empty set and no links; rows with equal texts link with each
other; a repeated id is one page per different text, and its rows get their own
set's group; a null id keeps its row, belongs to its text's group, and never
names it unless no other row can. Columns besides the two are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.workers import drop_kept
from matchloom.session import Workspace

WORDS, PERCENT = 5, 80
CENTRES = 32
PAGES_PER_BATCH = 500
BROADCAST_PAGES = 2_000_000
SET_SCHEMA = "text_a long, text_b long, match_id long, n_shingles long, sketch array<bigint>, shingles array<bigint>"
ABOUT = ("page", "n_shingles", "most", "sketch")
SIGNATURE_SCHEMA = "signature long, page long"
ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    size = min(words, len(found))
    runs = len(hashes) - size + 1
    mixed = np.full(runs, np.uint64(size), np.uint64)
    for k in range(size):
        mixed = mix(mixed * ODD[0] + hashes[k:k + runs])
    return np.unique(mixed)


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """For each of 256 cells of the domain, whether an odd number of the shingles falls into it.

    Sets that differ in d shingles have sketches that differ in at most d bits.
    """
    odd = np.bincount((shingles & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def band_tops(percent: int, size: int) -> tuple[int, int, int]:
    """Number and top size of the band ``size`` lies in, and the top of the next one."""
    number, top = 0, 1
    while top < size:
        number, top = number + 1, max(top + 1, top * 100 // percent)
    return number, top, max(top + 1, top * 100 // percent)


def most_differences(percent: int, top: int) -> int:
    """Shingles in which two linked sets of at most ``top`` shingles can differ."""
    return 2 * top * (100 - percent) // (100 + percent)


def salt(number: int) -> np.uint64:
    return np.uint64(number * int(ODD[1]) % (1 << 64))


def parted(shingles: np.ndarray, partitions: int, parts: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of mixed shingles over each part of each partition, and their counts."""
    place = (mix(shingles + salt(seed)) >> np.uint64(33)) % np.uint64(parts * partitions)
    place = place.astype(np.int64)
    order = np.argsort(place, kind="stable")
    counts = np.bincount(place, minlength=parts * partitions)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(shingles * ODD[0] + np.uint64(seed))[order], dtype=np.uint64)])
    ends = np.cumsum(counts)
    return (sums[ends] - sums[ends - counts]).reshape(partitions, parts), counts.reshape(partitions, parts)


def band_signatures(shingles: np.ndarray, number: int, top: int, percent: int) -> np.ndarray:
    """Signatures of one set for one band; none when sets there must be equal to link."""
    differences = most_differences(percent, top)
    if differences == 0:
        return mix(shingles.sum(dtype=np.uint64, keepdims=True) + np.uint64(number)) if len(shingles) > top * percent // 100 else np.zeros(0, np.uint64)
    partitions = (differences + 2) // 2
    parts = max(3, min(16, 48 // partitions))

    def layer(seed: int) -> tuple[np.ndarray, np.ndarray]:
        sums, counts = parted(shingles, partitions, parts, seed)
        but_one = sums.sum(axis=1, keepdims=True) - sums
        label = np.arange(parts * partitions, dtype=np.uint64).reshape(partitions, parts) + np.uint64((number << 40) + (seed << 36))
        return mix(but_one + mix(label * ODD[1])).ravel(), (counts.sum(axis=1, keepdims=True) - counts).ravel() == 0
    plain, empty = layer(1)
    if not empty.any():
        return plain
    second, _ = layer(2)
    return np.concatenate([plain[~empty], mix(plain[empty][:, None] * ODD[0] + second[None, :]).ravel()])


def signatures(shingles: np.ndarray, percent: int) -> np.ndarray:
    number, top, next_top = band_tops(percent, len(shingles))
    return np.concatenate([band_signatures(shingles, number, top, percent),
                           band_signatures(shingles, number + 1, next_top, percent)])


def page_sets(rows: DataFrame, words: int, work: Workspace) -> DataFrame:
    """One settled row per different text: its key, ``page`` (a number given here), smallest id and set.

    Copies fold before the shuffle, which then carries each text about once.
    """
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in batches:
            for first in range(0, batch.num_rows, PAGES_PER_BATCH):
                some = batch.slice(first, PAGES_PER_BATCH)
                sets = [shingle_set(text.as_py(), words) for text in some.column("page_text")]
                sizes = np.array([len(x) for x in sets], np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(name) for name in ("text_a", "text_b", "match_id")), pa.array(sizes),
                     pa.array([parity_sketch(x) for x in sets], pa.list_(pa.int64())), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    names=["text_a", "text_b", "match_id", "n_shingles", "sketch", "shingles"])
    texts = rows.groupBy("text_a", "text_b").agg(F.min("match_id").alias("match_id"),
                                                 F.first("page_text").cast("binary").alias("page_text"))
    return work.settle(texts.mapInArrow(measure, SET_SCHEMA).withColumn("page", F.monotonically_increasing_id()), "sets")


def shared_signatures(sets: DataFrame, sizes: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """Settled members of buckets with more than one page: ``signature``, ``page``, and the bucket's ``centre``: the page that shares most signatures.
    """
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in batches:
            column = batch.column("shingles")
            flat, ends = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
            for first in range(0, batch.num_rows, PAGES_PER_BATCH):
                last = min(first + PAGES_PER_BATCH, batch.num_rows)
                found = [signatures(flat[ends[k]:ends[k + 1]], percent) for k in range(first, last)]
                pages = np.repeat(batch.column("page").to_numpy()[first:last], [len(x) for x in found])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(pages)],
                                                 names=["signature", "page"])
    written = sets.where("n_shingles > 0").select("page", "shingles").mapInArrow(sign, SIGNATURE_SCHEMA)
    bucket = Window.partitionBy("signature")
    members = work.settle(written.withColumn("first", F.min("page").over(bucket)).withColumn("last", F.max("page").over(bucket))
                          .where(F.col("first") < F.col("last")).select("signature", "page"), "shared")
    shares = work.settle(members.groupBy("page").agg((-F.count("*")).cast("int").alias("shared")).join(
        sizes.select("page", F.col("n_shingles").cast("int").alias("size"), F.col("most").cast("int").alias("most")), "page"), "shares")
    placed = work.settle(members.join(shares, "page"), "placed")
    work.drop("shared")
    buckets = work.settle(placed.groupBy("signature").agg(F.min("size").alias("least"), F.min(F.struct("shared", "page")).alias("first"))
                          .select("signature", "least", F.col("first.page").alias("centre")), "buckets")
    # Members whose partners would have to be smaller than any there leave the bucket.
    members = work.settle(placed.join(buckets, "signature").where(F.col("most") >= F.col("least"))
                          .select("signature", "page", "centre"), "members")
    work.drop("placed")
    return members


def may_link(a: Column, b: Column, percent: int) -> Column:
    """False only for sets that cannot link, by their partner sizes and sketches."""
    bits = sum((F.bit_count(a["sketch"][k].bitwiseXOR(b["sketch"][k])) for k in range(1, 4)),
               F.bit_count(a["sketch"][0].bitwiseXOR(b["sketch"][0])))
    return ((a["n_shingles"] <= b["most"]) & (b["n_shingles"] <= a["most"])
            & (bits * (100 + percent) <= (a["n_shingles"] + b["n_shingles"]) * (100 - percent)))


def hopeful(sets: DataFrame, percent: int) -> DataFrame:
    """``page`` of the sets that could link at all.

    A set shares at least ``percent`` of its shingles with a linked one, so a set with more shingles than
    the rest that no other set holds is alone. They are counted over a fixed part of the shingle domain, twice the share
    that may differ, which can only leave more sets in.
    """
    part = F.filter("shingles", lambda s: s.bitwiseAND(F.lit(1023)) < 1024 * 2 * (100 - percent) // 100)
    spoken = sets.where("n_shingles > 0")
    lonely = (spoken.select("page", F.explode(part).alias("shingle")).groupBy("shingle")
              .agg(F.count("*").alias("n"), F.min("page").alias("page")).where("n = 1")
              .groupBy("page").agg(F.count("*").alias("lonely")))
    return (spoken.select("page", "n_shingles").join(lonely, "page", "left")
            .where(F.coalesce("lonely", F.lit(0)) * 100 <= F.col("n_shingles") * (100 - percent)).select("page"))


def partner_sizes(sets: DataFrame, percent: int) -> DataFrame:
    """``page``, ``n_shingles`` and ``most``, the largest set it can link with, for sets with any partner size.

    Linked sets of n and m shingles share ``percent / (100 + percent)`` of n + m, and a set shares none
    of those that only it holds.
    """
    lonely = (sets.select("page", F.explode("shingles").alias("shingle")).groupBy("shingle")
              .agg(F.count("*").alias("n"), F.min("page").alias("page")).where("n = 1")
              .groupBy("page").agg(F.count("*").alias("lonely")))
    common = F.col("n_shingles") - F.coalesce("lonely", F.lit(0))
    return (sets.select("page", "n_shingles", "sketch").join(lonely, "page", "left")
            .withColumn("most", F.floor(common * (100 + percent) / percent).cast("long") - F.col("n_shingles"))
            .where(F.col("most") * 100 >= F.col("n_shingles") * percent).select(*ABOUT))


def of_pages(sets: DataFrame, pages: DataFrame) -> DataFrame:
    """The sets of settled ``pages``, one long each: broadcast up to ``BROADCAST_PAGES``, beyond that both sides shuffle."""
    few = F.broadcast(pages) if pages.count() <= BROADCAST_PAGES else pages
    return sets.select("page", "n_shingles", "sketch", "shingles").join(few, "page", "left_semi")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``a``, ``b`` whose sets overlap enough, measured exactly."""
    sides = [sets.select(F.col("page").alias(k), F.col("n_shingles").alias(f"n_{k}"), F.col("shingles").alias(f"set_{k}"))
             for k in "ab"]
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return (pairs.join(sides[0], "a").join(sides[1], "b")
            .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
            .withColumn("shared", shared)
            .where(F.col("shared") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("shared")) * percent).select("a", "b"))


def components(links: DataFrame, work: Workspace) -> DataFrame | None:
    """Settled ``page``, ``root`` of all pages with links (``a``, ``b``); none without links.

    Each round every page hooks to its smallest neighbour, follows its parent twice, and the links are
    carried over to the parents, so stars vanish in one round and chains shrink to a quarter.
    """
    def undirected(rows: DataFrame) -> DataFrame:
        return work.settle(rows.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")

    def follow(rows: DataFrame, column: str, parents: DataFrame) -> DataFrame:
        return rows.join(parents.select(F.col("page").alias(column), F.col("root").alias("_root")), column).drop(column).withColumnRenamed("_root", column)

    roots = None
    links = undirected(links)
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = work.settle(both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("page"), F.least("a", "b").alias("root")), "hooks")
        parents = work.settle(follow(follow(hooks, "root", hooks), "root", hooks).select("page", "root"), "parents")
        links = undirected(follow(follow(links, "a", parents), "b", parents))
        roots = parents if roots is None else work.settle(relabelled(roots, parents), "roots")
    return roots


def relabelled(labels: DataFrame, moved: DataFrame) -> DataFrame:
    """``page``, ``root`` with the roots that ``moved`` (``page``, ``root``) sends elsewhere."""
    new = moved.select(F.col("page").alias("root"), F.col("root").alias("_root"))
    return labels.join(new, "root", "left").select("page", F.coalesce("_root", "root").alias("root"))


def overlap_groups(sets: DataFrame, percent: int, work: Workspace) -> DataFrame | None:
    """Settled ``page``, ``root`` of the pages that share a signature with another; none if no pages do.

    Tables that later steps do not read are dropped at once, the sets themselves included.
    """
    sets = work.settle(of_pages(sets, work.settle(hopeful(sets, percent), "hopeful")), "hopeful_sets")
    work.drop("sets")
    sizes = work.settle(partner_sizes(sets, percent), "sizes")
    sets = work.settle(of_pages(sets, sizes.select("page")), "partner_sets")
    work.drop("hopeful_sets")
    members = shared_signatures(sets, sizes, percent, work)
    if members.isEmpty():
        return None
    labels = work.settle(members.select("page").distinct().withColumn("root", F.col("page")), "labels")
    candidates = work.settle(of_pages(sets, labels.select("page")), "candidates")
    work.drop("partner_sets")
    about = work.settle(labels.select("page").join(sizes, "page").select("page", F.struct(*ABOUT).alias("about")), "about")

    def side(name: str) -> DataFrame:
        return about.select(F.col("page").alias(name), F.col("about").alias(f"about_{name}"))
    fit = may_link(F.col("about_a"), F.col("about_b"), percent)
    rest = members.where("page <> centre")
    pairs = work.settle(rest.select(F.col("centre").alias("a"), F.col("page").alias("b")).distinct()
                        .join(side("a"), "a").join(side("b"), "b").where(fit).select("a", "b"), "pairs")
    rest, many = rest.drop("centre"), CENTRES
    while True:
        links = work.settle(linked(pairs, candidates, percent), "linked")
        if not links.isEmpty():
            grouped = (links.join(labels.select(F.col("page").alias("a"), F.col("root").alias("root_a")), "a")
                       .join(labels.select(F.col("page").alias("b"), F.col("root").alias("root_b")), "b")
                       .select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
            moved = components(grouped, work)
            labels = labels if moved is None else work.settle(relabelled(labels, moved), "labels")
            rest = work.settle(rest.select("signature", "page").join(labels, "page"), "here")
        elif "root" not in rest.columns:
            rest = work.settle(rest.join(labels, "page"), "here")
        mixed = work.settle(rest.groupBy("signature").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
                            .where("low < high").select("signature", "n"), "mixed")
        if mixed.isEmpty():
            return labels
        # The same pages are centres of all their buckets of like size: about ``many`` of each, all of a small one.
        rank = F.shiftrightunsigned(F.xxhash64("page"), 1) / F.lit(float(1 << 63))
        here = work.settle(rest.join(mixed, "signature").withColumn("central", rank * F.col("n") < many).drop("n")
                           .join(about, "page"), "open")
        tried = here.where("central").select("signature", F.col("page").alias("a"), F.col("root").alias("root_a"), F.col("about").alias("about_a"))
        pairs = work.settle(here.withColumnsRenamed({"page": "b", "about": "about_b"}).join(tried, "signature").where(
            (~F.col("central") | (F.col("a") < F.col("b"))) & (F.col("a") != F.col("b")) & (F.col("root") != F.col("root_a")) & fit)
            .select("a", "b").distinct(), "pairs")
        rest, many = here.where("not central").drop("central", "about"), many * 4


def keyed(pages: DataFrame) -> DataFrame:
    """The pages with a 128-bit key of their text; a null text counts as an empty one."""
    text = F.coalesce("page_text", F.lit(""))
    return pages.withColumn("text_a", F.xxhash64(text)).withColumn("text_b", F.xxhash64(F.lit("second"), text))


def text_groups(pages: DataFrame, words: int, percent: int, work: Workspace) -> DataFrame:
    """Settled different texts with their ``page``, smallest ``match_id``, ``n_shingles`` and ``root`` (a page of their group)."""
    rows = keyed(pages.select(F.col("match_id").cast("long").alias("match_id"), F.coalesce("page_text", F.lit("")).alias("page_text")))
    sets = page_sets(rows, words, work)
    known = work.settle(sets.select("text_a", "text_b", "page", "match_id", "n_shingles"), "known")
    labels = overlap_groups(sets, percent, work)
    if labels is None:
        return known.withColumn("root", F.col("page"))
    return work.settle(known.join(labels, "page", "left").withColumn("root", F.coalesce("root", "page")), "grouped")


def page_groups(pages: DataFrame, work: Workspace, *, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per page: ``match_id``, ``n_shingles``, ``group_id`` (the smallest ``match_id`` of its group)."""
    texts = text_groups(pages, words, percent, work)
    smallest = work.settle(texts.groupBy("root").agg(F.min("match_id").alias("group_id"), F.count("*").alias("texts"))
                           .where("texts > 1").drop("texts"), "smallest")
    named = work.settle(texts.join(smallest, "root", "left").select(
        "text_a", "text_b", "n_shingles", F.coalesce("group_id", "match_id").alias("group_id")), "groups")
    rows = keyed(pages.select(F.col("match_id").cast("long").alias("match_id"), "page_text")).drop("page_text")
    return rows.join(named, ["text_a", "text_b"]).select(
        "match_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("match_id")).otherwise(F.col("group_id")).alias("group_id"))


def keep_first_pages(pages: DataFrame, work: Workspace, *, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The pages, with all their columns, that come first in their group; pages without words all stay.

    Of a group the smallest ``match_id`` stays (known ids before null ones), and one row of it.
    """
    columns = pages.columns
    texts = text_groups(pages, words, percent, work)
    place = F.struct(F.col("match_id").isNull().alias("unknown"), "match_id", "page")
    firsts = (texts.where("n_shingles > 0").groupBy("root").agg(F.min(place).alias("first"))
              .select(F.col("first.page").alias("page")))
    kept = work.settle(texts.join(firsts, "page", "left_semi").select(
        "text_a", "text_b", F.col("match_id").alias("_first_id")), "first_texts")
    rows = keyed(pages)
    wordless = ~F.coalesce("page_text", F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    spoken = rows.where(~wordless).join(kept, ["text_a", "text_b"]).where(F.col("match_id").eqNullSafe(F.col("_first_id")))
    return pages.where(wordless).unionByName(spoken.dropDuplicates(["text_a", "text_b"]).select(*columns))

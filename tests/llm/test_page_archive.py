"""Archives of stored pages: round trips, shared payloads, ranges."""

import gzip
import hashlib

from matchloom.llm import page_archive as archive
from matchloom.session import Workspace

SCHEMA = "page_id long, url string, html string"
LONG = "<html>" + "map stats " * 200 + "</html>"
RECORD = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def stored(spark, rows, schema=SCHEMA):
    work = Workspace(spark, "test-archive")
    folder = work.path("archives")
    index = archive.write_archives(spark.createDataFrame(rows, schema), work, folder)
    return index, folder


def expected(rows):
    payloads = [(page_id, (html or "").encode()) for page_id, _, html in rows]
    out = []
    for page_id, payload in payloads:
        same = [p for p, other in payloads if other == payload and p is not None]
        holder = max(same) if same and len(payload) >= 1000 else None
        revisit = holder is not None and holder != page_id
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", holder if revisit else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "https://example.test/matches/1/a", LONG), (2, "https://example.test/matches/2/a", LONG),
    (9, "https://example.test/matches/9/%41\r\nX: y", LONG), (3, None, "short"), (4, "u", "short"), (5, "u", None),
    (6, "u", ""), (7, "u", "ä" * 500), (8, "u", "ä" * 500), (10, "u", "z" * 999), (11, "u", "z" * 999),
    (12, "big", "x" * 300_000), (None, "u", LONG), (2, "again", LONG), (9, "again", LONG),
]


def test_records_match_brute_force(spark, rows):
    index, folder = stored(spark, ROWS)
    assert rows(archive.read_archives(index, folder), *RECORD) == expected(ROWS)


def test_payload_and_url_come_back(spark):
    index, folder = stored(spark, ROWS)
    found = {(r.page_id, r.url): r.payload for r in archive.read_archives(index, folder).collect() if r.record_type == "response"}
    for page_id, url, html in ROWS:
        if (page_id, url) in found:
            assert bytes(found[page_id, url]) == (html or "").encode()
    assert (9, "https://example.test/matches/9/%41\r\nX: y") in found


def test_a_selection_reads_only_its_records(spark):
    index, folder = stored(spark, ROWS)
    picked = archive.read_archives(index.where("page_id in (3, 12)"), folder)
    assert sorted(r.page_id for r in picked.collect()) == [3, 12]


def test_files_are_plain_warc(spark):
    index, folder = stored(spark, ROWS[:3])
    place = index.where("record_type = 'revisit'").first()
    path = folder.removeprefix("file:") + "/" + place.file
    with open(path, "rb") as source:
        whole = source.read()
    assert gzip.decompress(whole).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    record = gzip.decompress(whole[place.offset:place.offset + place.length])
    assert b"WARC-Type: revisit" in record and b"WARC-Refers-To: <urn:uuid:" in record
    assert record.endswith(b"\r\n\r\n")


def test_ranges_merge_neighbours_within_limits():
    places = [(0, 10), (10, 10), (25, 5), (1000, 10), (1010, 100)]
    assert list(archive.merged_ranges(places, gap=5, limit=60)) == [(0, 30, [0, 1, 2]), (1000, 1010, [3]), (1010, 1110, [4])]
    assert list(archive.merged_ranges([], 5, 60)) == []


def test_empty_table_and_clashing_columns(spark, rows):
    index, folder = stored(spark, [])
    assert archive.read_archives(index, folder).count() == 0
    index, folder = stored(spark, [(1, "u", LONG, "x", 5), (2, "u", LONG, "y", 6)],
                           SCHEMA + ", payload_digest string, holder int")
    assert rows(archive.read_archives(index, folder), *RECORD) == expected([(1, "u", LONG), (2, "u", LONG)])

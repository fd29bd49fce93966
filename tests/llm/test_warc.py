import gzip
import hashlib
import os

import pytest

from stepledger.llm import warc
from stepledger.llm._shared import scratch

LONG = "<p>é</p>" * 200


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://a", LONG), (2, "http://b", LONG), (9, None, LONG), (9, "again", LONG), (3, "http://c\r\nX: y", None), (4, "http://d", ""), (5, "e", "short"), (6, "e", "short"), (None, "n", LONG), (None, "n", LONG + "x"), (7, "w", LONG + "\r\n\r\nWARC/1.1\r\n\r\n"), (8, "b", "x" * 3_000_000)]
    return spark.createDataFrame([(*r, "keep", "d") for r in rows], "page_id long, url string, html string, record_type string, digest string")


def expected(pages):
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    largest = {}
    for i, p in rows:
        if i is not None:
            largest[p] = max(largest.get(p, i), i)
    out = []
    for i, p in rows:
        refers = largest.get(p) if len(p) >= 1000 and largest.get(p) not in (None, i) else None
        out.append((str(i), len(p), hashlib.sha1(p).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_round_trip(pages):
    got = [(str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect()]
    assert sorted(got, key=str) == expected(pages)


def test_archives_are_plain_warc_and_ranges_stand_alone(spark, pages):
    folder = scratch(spark, "warc-test")
    index = warc.write(warc.roles(pages), folder).collect()
    files = {name: open(os.path.join(folder, name), "rb").read() for name in {r["file"] for r in index}}
    text = b"".join(gzip.decompress(f) for f in files.values())
    assert text.startswith(b"WARC/1.1\r\n") and text.count(b"WARC-Record-ID: ") == 12
    for r in index:
        fields, payload, length = warc.parse(gzip.decompress(files[r["file"]][r["offset"] : r["offset"] + r["length"]]))
        assert fields["warc-type"] == r["record_type"]
        if r["record_type"] == "response":
            assert hashlib.sha1(payload).hexdigest() == r["digest"] and length == len(payload)
        else:
            assert payload == b"" and length == len(LONG.encode())
    ids = [line for line in text.split(b"\r\n") if line.startswith(b"WARC-Refers-To: ")]
    assert len(set(ids)) == 1 and ids[0].split(b": ")[1] in {line.split(b": ")[1] for line in text.split(b"\r\n") if line.startswith(b"WARC-Record-ID: ")}


def test_selected_records_with_payloads(spark, pages):
    folder = scratch(spark, "warc-test")
    index = warc.write(warc.roles(pages), folder)
    rows = warc.read(index.where("page_id IN (7, 8)"), folder, payloads=True).collect()
    want = {r["page_id"]: r["html"].encode() for r in pages.collect() if r["page_id"] in (7, 8)}
    assert {r["page_id"]: bytes(r["payload"]) for r in rows} == want


def test_ranges_join_neighbours():
    entries = [("a", 0, 10), ("a", 10, 5), ("a", 40, 5), ("a", 1000, 1), ("b", 0, 3)]
    assert [[e[1] for e in g] for g in warc.ranges(entries, gap=30, most=100)] == [[0, 10, 40], [1000], [0]]
    assert [len(g) for g in warc.ranges(entries, gap=30, most=15)] == [2, 1, 1, 1]


def test_changed_payload_is_an_error(spark, pages):
    folder = scratch(spark, "warc-test")
    index = warc.write(warc.roles(pages.where("page_id = 5")), folder)
    name = index.first()["file"]
    path = os.path.join(folder, name)
    raw = gzip.compress(gzip.decompress(open(path, "rb").read()).replace(b"short", b"shirt"))
    with open(path, "wb") as f:
        f.write(raw)
    moved = index.selectExpr("file", "offset", f"{len(raw)}L AS length")
    with pytest.raises(Exception, match="another digest"):
        warc.read(moved, folder).collect()


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0

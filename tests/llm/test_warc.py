"""WARC source: round trip, pushdown, skipping, broken files."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from tillcast.llm import warc

PAGES = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (9, None, "same"), (3, "http://a/3\nx", "other é€"), (4, "http://a/4", ""), (5, "http://a/5", None),
         (6, "http://a/6", "WARC/1.1\r\n\r\n" * 50), (7, "http://a/7", "x" * 3_000_000), (7, "http://a/7", "x" * 3_000_000), (None, "http://a/n", "same")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit("clash")).withColumn("row_id", F.lit(0))


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("gzip", [False, True])
def test_round_trip(spark, pages, tmp_path, gzip):
    path = str(tmp_path / "w")
    warc.write_warc(warc.archive_records(pages), path, gzip=gzip, file_bytes=1 << 20)
    rows = warc.read_warc(spark, path).collect()
    assert len(rows) == len(PAGES) and all(r.digest_ok for r in rows if r.warc_type == "response")
    got = sorted((r.record_id, r.warc_type, r.refers_to, r.payload_digest, r.payload_length, None if r.payload is None else bytes(r.payload).decode()) for r in rows)
    last = {"same": 9, "": 5}
    want = []
    for i, _, html in PAGES:
        text = html or ""
        to = last.get(text, i)
        revisit = to != i
        want.append((f"<urn:page:{'' if i is None else i}>", "revisit" if revisit else "response", f"<urn:page:{to}>" if revisit else None, digest(text),
                     len(text.encode()), None if revisit else text))
    assert got == sorted(want)
    assert {r.record_id: r.target_uri for r in rows}["<urn:page:3>"] == "http://a/3%0Ax"


def test_salted_join_gives_the_same_records(pages, monkeypatch):
    key = lambda df: sorted(map(str, df.collect()))
    one = key(warc.archive_records(pages))
    monkeypatch.setattr(warc, "small_enough", lambda df: False)
    assert key(warc.archive_records(pages, salts=3)) == one


def test_small_payloads_are_not_revisits(pages):
    rows = warc.archive_records(pages, least_bytes=5).collect()
    assert {r.record_id for r in rows if r.warc_type == "revisit"} == set()


def test_predicates_are_pushed_and_payloads_skipped(spark, pages, tmp_path, monkeypatch):
    path = str(tmp_path / "w")
    warc.write_warc(warc.archive_records(pages), path)
    read = warc.read_warc(spark, path)
    plan = read.where("warc_type = 'revisit' and target_uri like 'http://a/1%'")
    assert [r.record_id for r in plan.collect()] == ["<urn:page:1>"]
    reader = warc.WarcReader({"path": path, "payloads": "true"}, read.schema)
    left = list(reader.pushFilters([warc.EqualTo(("warc_type",), "revisit"), warc.EqualTo(("payload_length",), 4)]))
    assert len(left) == 1 and len(reader.pushed) == 1
    taken = []
    monkeypatch.setattr(warc._Plain, "take", lambda self, n: taken.append(n))
    n = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
    assert n == 4 and not taken  # no block of a record that is not wanted was read
    headers_only = warc.read_warc(spark, path, payloads=False).collect()
    assert len(headers_only) == len(PAGES) and all(r.payload is None and r.payload_length is not None for r in headers_only)


def test_leftover_files_are_ignored_and_broken_ones_fail(spark, pages, tmp_path):
    path = tmp_path / "w"
    warc.write_warc(warc.archive_records(pages.where("page_id = 6")), str(path))
    file = next(path.glob("*.warc"))
    (path / "part-lost-attempt.warc").write_bytes(file.read_bytes())
    assert warc.read_warc(spark, str(path)).count() == 1
    cut = tmp_path / "cut.warc"
    cut.write_bytes(file.read_bytes()[:-60])
    for payloads in (True, False):
        with pytest.raises(Exception, match="cut off"):
            warc.read_warc(spark, str(cut), payloads).collect()


def test_foreign_records(spark, tmp_path):
    body = b"plain block"
    raw = (b"WARC/1.0\r\nWARC-Type: resource\r\nwarc-target-uri: http://x/\r\n folded\r\nContent-Type: text/plain\r\nContent-Length: 11\r\n\r\n" + body + b"\r\n\r\n"
           + b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
    (tmp_path / "f.warc").write_bytes(raw)
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert [(r.warc_type, r.target_uri, bytes(r.payload)) for r in rows] == [("resource", "http://x/ folded", body), ("warcinfo", None, b"")]


def test_no_pages(spark, pages, tmp_path):
    warc.write_warc(warc.archive_records(pages.limit(0)), str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).count() == 0

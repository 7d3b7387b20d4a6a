"""Archives written and read back, and archives from elsewhere."""

import gzip
import hashlib
from collections import Counter

import pytest

from tallyspark.llm import warc
from tallyspark.llm.common import ship_package

SCHEMA = "page_id long, url string, html string, type string, row int, payload int, key string"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


LARGE = "<p>é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n</p>" * 40
ROWS = [
    (1, "http://a/1", LARGE),
    (2, "http://a/2 x\r\ny", LARGE),
    (3, None, LARGE),
    (3, "http://a/3", LARGE),  # a row of the same id
    (4, "http://a/4", "small"),
    (5, "http://a/5", "small"),
    (6, "http://b/é", None),
    (7, "", ""),
    (8, "http://a/8", "x" * 999),
    (9, "http://a/9", "x" * 999),
    (10, "http://a/10", "x" * 1000),
    (11, "http://a/11", "x" * 1000),
    (None, "http://a/none", "x" * 1000),
    (None, "http://a/lost", "y" * 1001),
    (None, "http://a/lost", "y" * 1001),
    (12, "http://a/12", "z\n" * 3_000_000),
    (13, "http://a/13", "\r\n"),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "t", 1, 2, "k") for r in rows], SCHEMA)


def expected(rows):
    best, found = {}, []
    for number, (page, _, html) in enumerate(rows):
        data = (html or "").encode()
        if len(data) >= 1000:
            best[data] = max(best.get(data, (False, 0, 0)), (page is not None, page or 0, number))
    for number, (page, _, html) in enumerate(rows):
        data = (html or "").encode()
        there, first, row = best.get(data, (True, 0, number))
        again = row != number
        found.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", first if again and there else None))
    return Counter(found)


@pytest.mark.parametrize("file_bytes", [1 << 25, 3000])
def test_report(spark, monkeypatch, file_bytes):
    monkeypatch.setattr(warc.write_archives, "__kwdefaults__", warc.write_archives.__kwdefaults__ | {"file_bytes": file_bytes})
    got = Counter(map(tuple, warc.archive_report(pages(spark).repartition(3)).collect()))
    want = expected(ROWS)
    assert got == want


def test_captures_keep_payloads_and_addresses(spark, tmp_path):
    path = str(tmp_path / "archives")
    warc.write_archives(warc.captures(pages(spark)), path)
    assert len(list((tmp_path / "archives").glob("*.gz"))) >= 1
    rows = warc.assemble(warc.read_records(spark, path, payloads=True)).collect()
    assert len(rows) == len(ROWS)
    got = Counter()
    for r in rows:
        body = r["original"] if r["type"] == "revisit" else r["response"]
        assert r["request"]["head"].startswith("GET ")
        assert r["response"]["digest"] == body["payload_sha1"] == hashlib.sha1(body["payload"]).hexdigest()
        assert r["response"]["payload_bytes"] == (0 if r["type"] == "revisit" else len(body["payload"]))
        got[body["payload"].decode()] += 1
    assert got == Counter(html or "" for _, _, html in ROWS)
    facts = spark.createDataFrame([(r["metadata"]["payload"].decode(),) for r in rows], "j string")
    back = facts.selectExpr("from_json(j, 'page_id long, url string') as f").select("f.*").collect()
    assert Counter(map(tuple, back)) == Counter((p, u) for p, u, _ in ROWS)


def record(kind, name, block, *headers):
    lines = [b"WARC/1.0", b"WARC-Type: " + kind, b"warc-record-id: " + name, b"Content-Length: %d" % len(block), *headers]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_foreign_archives_and_orphans(spark, tmp_path):
    http = b"Content-Type: application/http;\r\n msgtype=response"
    records = [
        record(b"warcinfo", b"<i>", b"software: x"),
        record(b"request", b"<q2>", b"GET /b HTTP/1.0\r\n\r\n", b"WARC-Concurrent-To: <r>", http),
        record(b"response", b"<r>", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\r\n\r\n", http),
        record(b"request", b"<q1>", b"GET /a HTTP/1.0\r\n\r\n", b"WARC-Concurrent-To: <r>", http),
        record(b"metadata", b"<m>", b"{}", b"WARC-Concurrent-To: <gone>"),
        record(b"request", b"<q3>", b"GET /c HTTP/1.0\r\n\r\n", b"WARC-Concurrent-To: <lost>", http),
        record(b"revisit", b"<v>", b"", b"WARC-Refers-To: <nowhere>"),
    ]
    (tmp_path / "plain.warc").write_bytes(b"".join(records[:3]))
    (tmp_path / "members.warc.gz").write_bytes(b"".join(map(gzip.compress, records[3:])))
    rows = {r["capture_id"]: r for r in warc.assemble(warc.read_records(spark, str(tmp_path), payloads=True)).collect()}
    assert set(rows) == {"<r>", "<gone>", "<lost>", "<v>"}
    assert rows["<r>"]["response"]["payload"] == b"body\r\n\r\n" and rows["<r>"]["response"]["head"].startswith("HTTP/1.0 200")
    assert rows["<r>"]["request"]["record_id"] == "<q1>" and rows["<r>"]["metadata"] is None
    assert rows["<gone>"]["response"] is None and rows["<gone>"]["metadata"]["payload"] == b"{}"
    assert rows["<lost>"]["request"]["record_id"] == "<q3>" and rows["<lost>"]["type"] is None
    assert rows["<v>"]["original"] is None


def test_an_archive_that_ends_early_is_an_error():
    whole = record(b"response", b"<r>", b"0123456789")
    with pytest.raises(ValueError):
        list(warc.parse(whole[:-9]))
    with pytest.raises(ValueError):
        list(warc.parse(b"not an archive\r\n"))


def test_empty_table(spark):
    assert warc.archive_report(spark.createDataFrame([], SCHEMA)).count() == 0

from __future__ import annotations

import base64
import gzip
import hashlib
import re

import duckdb
import pytest

from lineledger.llm.queries import ORACLES, QUERIES
from lineledger.llm.shared import Staged
from lineledger.llm.warc import archive_and_read, assemble, page_digests, parse, read_warc, write_warc

SF = "/root/testdata/sf0.001"


def record(kind, name, block, **headers):
    lines = [b"WARC/1.0", f"WARC-Type: {kind}".encode(), f"WARC-Record-ID: <{name}>".encode()]
    for key, values in headers.items():
        for value in values if isinstance(values, list) else [values]:
            lines.append(f"{key.replace('_', '-')}: {value}".encode())
    lines.append(f"content-length: {len(block)}".encode())
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    cursor = con.execute(ORACLES["op2_warc"])
    found = QUERIES["op2_warc"](spark, SF)
    assert found.columns == [d[0] for d in cursor.description]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(cursor.fetchall(), key=str)


def test_copies_and_odd_rows(spark):
    long, trap = "ä" * 600, "x" * 1200 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    rows = [(1, "http://a/x y\n", long), (5, "http://b", long), (3, None, long), (7, "u", "short"), (8, "u", "short")]
    rows += [(9, "u", None), (10, "u", ""), (11, "u", trap), (12, "u", trap), (12, "u", trap), (None, "u", long), (None, "v", "z")]
    odd = spark.createDataFrame(rows, "page_id int, url string, html string").selectExpr("*", "1 AS n", "2 AS sha1", "3 AS kept")
    back = page_digests(archive_and_read(odd)).collect()
    assert len(back) == len(rows)
    found = {(r.page_id, r.payload_digest): r for r in back}
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    expected = {
        (1, sha(long)): (1200, "revisit", 5), (5, sha(long)): (1200, "response", None), (3, sha(long)): (1200, "revisit", 5),
        (None, sha(long)): (1200, "revisit", 5), (7, sha("short")): (5, "response", None), (8, sha("short")): (5, "response", None),
        (9, sha("")): (0, "response", None), (10, sha("")): (0, "response", None),
        (11, sha(trap)): (len(trap), "revisit", 12), (12, sha(trap)): (len(trap), "response", None), (None, sha("z")): (1, "response", None),
    }
    assert {k: (r.payload_bytes, r.record_type, r.refers_to) for k, r in found.items()} == expected
    assert page_digests(archive_and_read(odd.where("false"))).collect() == []


def test_repeated_rows_equal_sql(spark, tmp_path):
    """A third of all rows is one row, others are there a few times."""
    rows = [(1, "http://a", "copy " * 300)] * 200 + [(2, "http://b", "copy " * 300)] + [(3, "u", "short")] * 3
    rows += [(n, f"http://h/{n}", f"page {n} " * 200) for n in range(10, 300)] * 2 + [(4, None, None)] * 2
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    expected = con.execute(ORACLES["op2_warc"]).fetchall()
    found = QUERIES["op2_warc"](spark, str(tmp_path)).collect()
    assert len(found) == len(rows) and sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_files_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr("lineledger.llm.warc.FILES", ((100, 10), (1000, 2), (1 << 62, 1)))
    rows = [(n, "http://a/", "x" * size) for n, size in enumerate([20, 100] * 30 + [900, 1000] * 9 + [5000] * 4)]
    staged = Staged(spark, "t")
    write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), f"{staged.folder}/a", staged)
    records = read_warc(spark, f"{staged.folder}/a")
    assert records.where("record_type <> 'request' AND record_type <> 'metadata'").count() == len(rows)
    files = [gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").load(f"{staged.folder}/a").collect()]
    for file in files:
        longest = max(map(len, re.findall(b"x+", file)))
        assert file.count(b"WARC-Type: metadata") <= (10 if longest <= 100 else 2 if longest <= 1000 else 1)


def test_payloads_round_trip(spark):
    staged = Staged(spark, "t")
    pages = spark.read.parquet(f"{SF}/pages.parquet").limit(20)
    write_warc(pages, f"{staged.folder}/a", staged)
    records = read_warc(spark, f"{staged.folder}/a", with_payload=True)
    assert records.count() == 60
    found = sorted(bytes(r.payload).decode() for r in records.where("record_type = 'response'").collect())
    assert found == sorted(r.html for r in pages.collect())


def test_long_payload_and_a_third_of_copies(spark):
    rows = [(i, f"http://h/{i}", "copy " * 300 if i % 3 else f"page {i} " * 200) for i in range(300)] + [(1000, "u", "é" * 3_000_000)]
    found = {r.page_id: r for r in page_digests(archive_and_read(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()}
    assert len(found) == 301 and found[1000].payload_bytes == 6_000_000
    assert all(found[i].refers_to == (299 if i % 3 and i != 299 else None) for i in range(300))


def test_foreign_archives():
    body = b"HTTP/1.1 200 OK\r\n\r\nhello"
    digest = base64.b32encode(hashlib.sha1(b"hello").digest()).decode()
    blocks = [
        record("warcinfo", "i", b"software: x\r\n", Content_Type="application/warc-fields"),
        record("response", "a", body, Content_Type="application/http; msgtype=response", WARC_Concurrent_To=["<q>", "<m>"]),
        record("revisit", "b", b"", WARC_Payload_Digest=f"sha1:{digest}", WARC_Refers_To="<a>"),
    ]
    plain = b"".join(blocks)
    for data in (plain, gzip.compress(plain), b"".join(map(gzip.compress, blocks))):
        info, response, revisit = parse(data, with_payload=True)
        assert info["fields"] == [("software", "x")]
        assert response["payload"] == b"hello" and response["concurrent_to"] == ["<q>", "<m>"]
        assert response["payload_digest"] == revisit["payload_digest"] == hashlib.sha1(b"hello").hexdigest()
    for broken in (plain[:-3], plain[:-9], plain + b"WARC/1.0\r\nx", b"HTTP\r\n\r\n"):
        with pytest.raises(ValueError):
            list(parse(broken))


def test_links_of_all_shapes(spark):
    rows = [
        ("h1", "response", ["q1"]), ("q1", "request", []), ("m1", "metadata", ["q1"]),  # head names the request
        ("h2", "revisit", []), ("q2", "request", ["h2"]), ("m2", "metadata", ["q2"]), ("n2", "metadata", ["h2"]),
        ("h3", "resource", []), ("q9", "request", ["gone"]), ("i", "warcinfo", []), ("h3", "resource", []),
        ("h4", "response", []), ("q4", "request", ["h4", "c1"]), *((f"c{k}", "metadata", [f"c{k + 1}"]) for k in range(6)), ("c6", "metadata", ["q4"]),
    ]
    frame = spark.createDataFrame(rows, "record_id string, record_type string, concurrent_to array<string>")
    found = {r.capture_id: r for r in assemble(frame).collect()}
    shown = {k: (r.record_type, r.request and r.request.record_id, r.metadata and r.metadata.record_id, r.n_requests, r.n_metadata) for k, r in found.items()}
    assert shown == {
        "h1": ("response", "q1", "m1", 1, 1),
        "h2": ("revisit", "q2", "m2", 1, 2),
        "h3": ("resource", None, None, 0, 0),
        "h4": ("response", "q4", "c0", 1, 7),  # a chain of seven, which is a ring, too
    }
    assert {k: r.n_heads for k, r in found.items()} == {"h1": 1, "h2": 1, "h3": 2, "h4": 1}

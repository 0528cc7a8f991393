"""WARC archives: writing captures, reading records, and assembling the records of one transaction."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineledger.llm.shared import Staged, ship_package, spark_to_arrow

LEAST_REVISIT = 1000  # bytes from which equal payloads are stored once
# Payloads of up to so many bytes share a file with so many others: a file holds some 300 MB before compression, or a
# single long payload.
FILES = ((1 << 14, 20_000), (1 << 18, 1_250), (1 << 22, 80), (1 << 26, 5), (1 << 62, 1))
_FLUSH = 8 << 20  # bytes of payloads and blocks that a reader gathers before it hands rows on
_CRLF = "\r\n"
HEADS = ("response", "revisit", "resource")
RECORD = (
    "record_id string, record_type string, concurrent_to array<string>, refers_to string, target_uri string, "
    "warc_date string, content_type string, block_bytes bigint, payload_bytes bigint, payload_digest string, "
    "fields map<string, string>"
)


# --- writing ---------------------------------------------------------------------------------------------------


def _header_text(value: Column) -> Column:
    """Line ends and blanks would end a header or a URI; they are percent-encoded."""
    for sign, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        value = F.replace(value, F.lit(sign), F.lit(code))
    return value


def _record(kind: str, record_id: Column, uri: Column, date: str, headers: list[Column], block: Column) -> Column:
    """Text of a record but for its last line feed, which the text writer adds."""
    lines = [
        F.lit(f"WARC/1.1{_CRLF}WARC-Type: {kind}{_CRLF}WARC-Date: {date}{_CRLF}WARC-Record-ID: "),
        record_id,
        F.lit(_CRLF),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), uri, F.lit(_CRLF)), F.lit("")),
        *headers,
        F.lit("Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(_CRLF * 2),
        block,
        F.lit("\r\n\r"),
    ]
    return F.concat(*lines)


def _header(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(_CRLF))


def _id(capture: Column, part: str) -> Column:
    return F.concat(F.lit("<urn:capture:"), capture, F.lit(f":{part}>"))


def page_of(record_id: Column) -> Column:
    """The page that a record id written by :func:`write_warc` names."""
    return F.regexp_extract(record_id, "^<urn:capture:(-?[0-9]+):", 1).try_cast("bigint")


def captures(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``(capture, uri, payload, n, sha1)`` per row; a capture is a page id with a hash of its URL and payload."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    page, url = F.col(id_col).cast("bigint"), F.col(url_col).cast("string")
    mark = F.lower(F.hex(F.xxhash64(F.coalesce(url, F.lit("")), payload)))
    rows = pages.select(
        page.alias("page"),
        F.concat(F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"), mark).alias("capture"),
        _header_text(url).alias("uri"),
        payload.alias("payload"),
    )
    return rows.withColumn("n", F.octet_length("payload")).withColumn("sha1", F.sha1(F.col("payload").cast("binary")))


def write_warc(
    pages: DataFrame,
    folder: str,
    staged: Staged,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: str = "2000-01-01T00:00:00Z",
) -> None:
    """Writes a request, a response or revisit, and a metadata record per page to compressed archives in ``folder``.

    Of pages with equal payloads of at least :data:`LEAST_REVISIT` bytes the one with the largest id is the
    response and the others revisit it. Null payloads are empty. Pages are joined with one row per payload that
    occurs more than once, not with each other, and that table's size decides how.
    """
    rows = captures(pages, id_col, url_col, html_col)
    kept = rows.where(F.col("n") >= LEAST_REVISIT).groupBy("sha1", "n")
    kept = kept.agg(F.max(F.struct("page", "capture")).alias("kept"), F.min("capture").alias("other"))
    kept = staged(kept.where(F.col("kept.capture") != F.col("other")).select("sha1", "n", "kept"), "payloads")
    rows = rows.join(kept, ["sha1", "n"], "left")
    again = F.coalesce(F.col("kept.capture") != F.col("capture"), F.lit(False))
    capture, uri = F.col("capture"), F.col("uri")
    digest = F.concat(F.lit("sha1:"), F.col("sha1"))
    head_id = F.when(again, _id(capture, "revisit")).otherwise(_id(capture, "response"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "),
        F.col("n").cast("string"),
        F.lit(_CRLF * 2),
    )
    is_http = _header("Content-Type", "application/http; msgtype=response")
    response = _record(
        "response", head_id, uri, date, [is_http, _header("WARC-Payload-Digest", digest)], F.concat(http, "payload")
    )
    revisit = _record(
        "revisit",
        head_id,
        uri,
        date,
        [
            is_http,
            _header("WARC-Payload-Digest", digest),
            _header("WARC-Refers-To", _id(F.col("kept.capture"), "response")),
            _header("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ],
        http,
    )
    asked = F.coalesce(F.nullif(F.regexp_replace("uri", "^[a-zA-Z]+://[^/]*", ""), F.lit("")), F.lit("/"))
    host = F.coalesce(F.regexp_extract("uri", "^[a-zA-Z]+://([^/?#]*)", 1), F.lit(""))
    request = _record(
        "request",
        _id(capture, "request"),
        uri,
        date,
        [_header("Content-Type", "application/http; msgtype=request"), _header("WARC-Concurrent-To", head_id)],
        F.concat(F.lit("GET "), asked, F.lit(f" HTTP/1.1{_CRLF}Host: "), host, F.lit(_CRLF * 2)),
    )
    metadata = _record(
        "metadata",
        _id(capture, "metadata"),
        uri,
        date,
        [_header("Content-Type", "application/warc-fields"), _header("WARC-Concurrent-To", head_id)],
        F.concat(F.lit("payload-length: "), F.col("n").cast("string"), F.lit(_CRLF)),
    )
    text = F.explode(F.array(request, F.when(again, revisit).otherwise(response), metadata)).alias("value")
    # the writer counts records, so payloads of different sizes go to files of their own
    size = F.lit(len(FILES) - 1)
    for k in reversed(range(len(FILES) - 1)):
        size = F.when(F.col("n") <= FILES[k][0], k).otherwise(size)
    found = captures(pages, id_col, url_col, html_col).select(size.alias("k")).distinct().collect()
    for (k,) in sorted(found) or [(0,)]:
        writer = rows.where(size == k).select(text).write.mode("append").option("lineSep", "\n").option("compression", "gzip")
        writer.option("maxRecordsPerFile", 3 * FILES[k][1]).text(folder)


# --- reading ---------------------------------------------------------------------------------------------------


class _Stream:
    """Bytes of a plain or gzipped archive, decompressed as far as they are asked for; members may follow members."""

    def __init__(self, data: bytes):
        self.data, self.at, self.left, self.start = data, 0, bytearray(), 0
        self.gzip = data[:2] == b"\x1f\x8b"
        self.unzip = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.at >= len(self.data):
            return False
        if self.start > 1 << 20:
            del self.left[: self.start]
            self.start = 0
        piece = self.data[self.at : self.at + (1 << 18)]
        self.at += len(piece)
        while self.gzip and piece:
            self.left += self.unzip.decompress(piece)
            piece = self.unzip.unused_data if self.unzip.eof else b""
            if self.unzip.eof:
                self.unzip = zlib.decompressobj(31)
        if not self.gzip:
            self.left += piece
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before ``mark``, which is passed over; None if there is no more of it."""
        seen = self.start
        while (found := self.left.find(mark, seen)) < 0:
            seen_left = len(self.left) - self.start
            if not self._more():
                return None
            seen = self.start + max(0, seen_left - len(mark) + 1)
        out = bytes(self.left[self.start : found])
        self.start = found + len(mark)
        return out

    def take(self, n: int) -> bytes:
        while len(self.left) - self.start < n and self._more():
            pass
        if len(self.left) - self.start < n:
            raise ValueError("a record is shorter than its Content-Length")
        out = bytes(self.left[self.start : self.start + n])
        self.start += n
        return out

    def rest(self) -> bytes:
        while self._more():
            pass
        return bytes(self.left[self.start :])


def _fields(head: bytes) -> tuple[dict[str, str], list[str]]:
    fields, concurrent = {}, []
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b":")
        name, value = name.strip().lower().decode("utf-8", "replace"), value.strip().decode("utf-8", "replace")
        if name == "warc-concurrent-to":
            concurrent.append(value)
        elif name:
            fields[name] = value
    return fields, concurrent


def _hex_digest(value: str | None) -> str | None:
    """A ``sha1:`` header in hexadecimal, whether it is written so or in base 32."""
    kind, _, digest = (value or "").partition(":")
    if kind.lower() != "sha1":
        return None
    return base64.b32decode(digest.upper()).hex() if len(digest) == 32 else digest.lower()


def parse(data: bytes, with_payload: bool = False) -> Iterator[dict]:
    """Records of an archive. The digest of a response is taken from its payload, that of a revisit from its header."""
    stream = _Stream(data)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        version, _, head = head.partition(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields, concurrent = _fields(head)
        block = stream.take(int(fields["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record is longer than its Content-Length")
        kind, media = fields.get("warc-type"), fields.get("content-type", "")
        row = {
            "record_id": fields.get("warc-record-id"),
            "record_type": kind,
            "concurrent_to": concurrent,
            "refers_to": fields.get("warc-refers-to"),
            "target_uri": fields.get("warc-target-uri"),
            "warc_date": fields.get("warc-date"),
            "content_type": media or None,
            "block_bytes": len(block),
            "payload_bytes": None,
            "payload_digest": _hex_digest(fields.get("warc-payload-digest")),
            "fields": [],
        }
        payload = None
        if kind in ("response", "resource"):
            payload = block.partition(b"\r\n\r\n")[2] if media.startswith("application/http") else block
            row |= {"payload_bytes": len(payload), "payload_digest": hashlib.sha1(payload).hexdigest()}
        if media.startswith("application/warc-fields"):
            row["fields"] = list(_fields(block)[0].items())
        if with_payload:
            row["payload"] = payload
        yield row
    if stream.rest().strip():
        raise ValueError("an archive ends inside a header")


def read_warc(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """A row of :data:`RECORD` per record of the archives, and its ``payload`` if wanted.

    Archives are read by Spark, so they may lie wherever Spark reads; a task takes whole files, whose size the
    writer bounds, and unpacks them piece by piece.
    """
    schema = RECORD + (", payload binary" if with_payload else "")
    arrow = spark_to_arrow(spark, schema)
    ship_package(spark)

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for files in batches:
            for content in files.column(0):
                for row in parse(content.as_py(), with_payload):
                    rows.append(row)
                    size += 1000 + (row["block_bytes"] if with_payload else 0)
                    if size > _FLUSH:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(run, schema)


# --- assembling ------------------------------------------------------------------------------------------------


def members_of(records: DataFrame, staged: Staged) -> DataFrame:
    """``(member, head_id)``: which records belong to which capture, by concurrent-to ids in chains of any length.

    A round adds what is concurrent to the records that the round before added; the first one that adds nothing is
    the last. Records of a usual archive name their capture, which takes one round and an empty one.
    """
    is_head = F.col("record_type").isin(*HEADS)
    heads = records.where(is_head).select(F.col("record_id").alias("head_id")).distinct()
    linked = records.select("record_id", is_head.alias("head"), F.explode("concurrent_to").alias("to"))
    ahead = linked.where("NOT head").select(F.col("record_id").alias("member"), "to")
    back = linked.where("head").select(F.col("to").alias("member"), F.col("record_id").alias("to"))
    links = ahead.unionByName(back).join(heads.withColumnRenamed("head_id", "member"), "member", "left_anti").distinct()
    links = staged(links, "links")
    new = links.join(heads, F.col("to") == F.col("head_id")).select("member", "head_id")
    members = heads.select(F.col("head_id").alias("member"), "head_id")
    for step in count(1):
        new = staged(new, f"members-{step}")
        members = members.unionByName(new)
        via = new.select(F.col("member").alias("to"), "head_id")
        new = links.join(via, "to").select("member", "head_id").distinct().join(members, ["member", "head_id"], "left_anti")
        if new.isEmpty():
            return members


def assemble(records: DataFrame, staged: Staged | None = None) -> DataFrame:
    """One row per capture: ``capture_id``, ``record_type``, and the structs ``head``, ``request`` and ``metadata``.

    A capture is a response, revisit or resource record. Other records belong to it if they are concurrent to it,
    if it is concurrent to them, or if they are concurrent to a record that belongs to it. Of several requests or
    metadata records that with the smallest id is shown and ``n_requests`` and ``n_metadata`` count them. Records
    that repeat an id count once, but for the capture itself: ``n_heads`` says how many records have its id.
    ``records`` is read several times, so it should be a stored table.
    """
    members = members_of(records, staged or Staged(records.sparkSession, "assembly"))
    row = F.struct(*(c for c in records.columns))
    own = records.select(F.col("record_id").alias("member"), "record_type", row.alias("record")).join(members, "member")
    role = F.when(F.col("member") == F.col("head_id"), "head").otherwise(F.col("record_type"))
    own = own.withColumn("role", role)

    def first(kind: str) -> Column:
        one = F.col("role") == kind
        return F.min_by(F.when(one, F.col("record")), F.when(one, F.col("member")))

    def number(kind: str) -> Column:
        return F.count_distinct(F.when(F.col("role") == kind, F.col("member")))

    grouped = own.groupBy(F.col("head_id").alias("capture_id")).agg(
        first("head").alias("head"),
        first("request").alias("request"),
        first("metadata").alias("metadata"),
        number("request").alias("n_requests"),
        number("metadata").alias("n_metadata"),
        F.count_if(F.col("role") == "head").alias("n_heads"),
    )
    return grouped.withColumn("record_type", F.col("head.record_type"))


def archive_and_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the pages to archives in the shared folder and returns their assembled captures, read back.

    Rows that repeat a page's id, URL and payload are one capture with as many heads. Pages with the same id and
    another URL or payload are captures of their own.
    """
    staged = Staged(pages.sparkSession, "warc")
    write_warc(pages, f"{staged.folder}/archives", staged, id_col, url_col, html_col)
    return assemble(staged(read_warc(pages.sparkSession, f"{staged.folder}/archives"), "records"), staged)


def page_digests(assembled: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` per page that this module wrote."""
    told = F.col("metadata.fields")["payload-length"].cast("bigint")
    copies = F.explode(F.array_repeat(F.lit(1), F.col("n_heads").cast("int")))
    return assembled.withColumn("copy", copies).select(
        page_of(F.col("capture_id")).alias("page_id"),
        F.coalesce("head.payload_bytes", told).alias("payload_bytes"),
        F.col("head.payload_digest").alias("payload_digest"),
        "record_type",
        page_of(F.col("head.refers_to")).alias("refers_to"),
    )

"""Web archives: captures written as WARC records, and read back into one row per capture.

A capture is written as three records: the response, or a revisit that refers to it, and a
request and a metadata record that name it in ``WARC-Concurrent-To``. Spark's text sink
writes them, with the blank lines that end a record as its line separator, so files are
committed as any other output of Spark, compressed, and bounded in size.

Reading takes whole archive files, parses them record by record by their stated lengths (a
payload may hold blank lines), and assembles transactions: requests and metadata join their
response by the identifier that they name, and revisits join what they refer to. Payloads
are measured and hashed where they are read; they only move if the caller wants them.

Of rows with equal payloads of ``least`` bytes or more (told by SHA-256 and length), the one with the
largest id is the response; of several of that id, one of them. Nulls: a null payload
is empty; a null id is the smallest, and stays null; a null address is empty in the header
and null again when read. Repeated rows are captures of their own. An empty table writes no
record and gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.materialize import new_path
from .common import as_table, materialize

VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST = 1000
# bytes of records in an archive file, about
FILE_BYTES = 32 << 20
END = "\r\n"

RECORDS = (
    "record_id string, type string, concurrent_to string, refers_to string, uri string, date string, digest string, "
    "head string, payload_bytes long, payload_sha1 string, payload binary"
)
_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
_RECORDS = pa.schema([(n, _KINDS[k]) for n, k in (f.split() for f in RECORDS.split(", "))])


def _lines(*lines: Column | str) -> Column:
    return F.concat(*[x for line in lines for x in (F.lit(line) if isinstance(line, str) else line, F.lit(END))])


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def _id(row: Column, kind: str) -> Column:
    """A record's identifier: the capture's number and the kind of record."""
    return F.concat(F.lit("<urn:capture:"), row.cast("string"), F.lit(f":{kind}>"))


def _record(kind: Column | str, record_id: Column, uri: Column, date: str, content_type: str, block: Column, *more: Column) -> Column:
    """Header and block; the sink adds the end."""
    return F.concat(
        _lines(
            VERSION,
            _header("WARC-Type", F.lit(kind) if isinstance(kind, str) else kind),
            _header("WARC-Record-ID", record_id),
            _header("WARC-Date", F.lit(date)),
            _header("WARC-Target-URI", uri),
            *more,
            _header("Content-Type", F.lit(content_type)),
            _header("Content-Length", F.octet_length(block).cast("string")),
            "",
        ),
        block,
    )


def captures(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST) -> DataFrame:
    """(row, page_id, url, payload, bytes, sha1, first): ``first`` is the row of the response that a capture repeats, if any."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"),
        F.sha1(payload).alias("sha1"),
        F.when(F.octet_length(payload) >= least, F.sha2(payload, 256)).alias("sha256"),
    )
    rows = materialize(rows, "captures")  # from here on a row keeps its number
    key = ["sha256", "bytes"]
    groups = (
        rows.filter("sha256 is not null")
        .groupBy(*key)
        .agg(F.max(F.struct("page_id", "row")).alias("best"), F.count("*").alias("times"))
        .filter("times > 1")
        .select(*key, F.col("best.row").alias("best"))
    )
    groups = materialize(groups, "repeated-payloads")  # a row for each payload that occurs again
    first = F.when(F.col("best") != F.col("row"), F.col("best")).alias("first")
    return rows.join(groups, key, "left").select("row", "page_id", "url", "payload", "bytes", "sha1", first)


def write_archives(found: DataFrame, path: str, *, date: str = "2000-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> None:
    """Write what ``captures`` returns as gzipped archives of about ``file_bytes`` each, before compression."""
    # an address in a header has no blanks or line ends; the metadata record has it as it is
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    row = F.col("row")
    capture, revisit = _id(row, "capture"), F.col("first").isNotNull()
    digest = _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1")))
    page = _lines("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", _header("Content-Length", F.col("bytes").cast("string")), "")
    response = _record("response", capture, uri, date, "application/http; msgtype=response", F.concat(page, F.col("payload")), digest)
    again = _record(
        "revisit",
        capture,
        uri,
        date,
        "application/http; msgtype=response",
        page,
        digest,
        _header("WARC-Profile", F.lit(REVISIT)),
        _header("WARC-Refers-To", _id(F.col("first"), "capture")),
    )
    concurrent = _header("WARC-Concurrent-To", capture)
    asked = _lines(F.concat(F.lit("GET "), uri, F.lit(" HTTP/1.1")), "")
    request = _record("request", _id(row, "request"), uri, date, "application/http; msgtype=request", asked, concurrent)
    facts = F.to_json(F.struct("page_id", "url"))
    metadata = _record("metadata", _id(row, "metadata"), uri, date, "application/json", facts, concurrent)
    value = F.concat_ws(END + END, request, F.when(revisit, again).otherwise(response), metadata)
    sizes = found.agg(F.count("*").alias("rows"), F.sum(F.col("bytes") + 1200).alias("bytes")).first()
    each = max(1, int(sizes["rows"] * file_bytes // max(1, sizes["bytes"] or 1)))
    (
        found.select(value.alias("value"))
        .write.option("lineSep", END + END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", each)
        .text(path)
    )


def parse(data: bytes) -> Iterator[tuple[dict[str, str], io.BufferedIOBase, int]]:
    """(headers, stream, length) of each record of an archive, gzipped as a whole or by record, or plain.

    The caller may read up to ``length`` bytes of the block from the stream. Header names are in lower case.
    """
    stream: io.BufferedIOBase = io.BytesIO(data)
    if data[:2] == b"\x1f\x8b":
        stream = gzip.GzipFile(fileobj=stream)  # type: ignore[assignment]
    while line := stream.readline():
        if not line.strip():
            continue  # the end of the record before
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:80]!r}")
        headers: dict[str, str] = {}
        name = ""
        while (line := stream.readline()).strip():
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[0] in " \t" and name:  # goes on
                headers[name] += " " + text.strip()
                continue
            name, _, value = text.partition(":")
            name = name.strip().lower()
            headers[name] = value.strip()
        length = int(headers.get("content-length", 0))
        block = _Block(stream, length)
        yield headers, block, length
        block.skip()


class _Block:
    """The part of a stream that is one record's block."""

    def __init__(self, stream, length: int):
        self.stream, self.left = stream, length

    def read(self, size: int = 1 << 20) -> bytes:
        part = self.stream.read(min(size, self.left))
        if self.left and not part:
            raise ValueError("an archive ends within a record")
        self.left -= len(part)
        return part

    def readline(self) -> bytes:
        line = self.stream.readline(self.left)
        self.left -= len(line)
        return line

    def skip(self) -> None:
        while self.left:
            self.read()


def read_records(spark: SparkSession, path: str, *, payloads: bool = False) -> DataFrame:
    """The records of all archives below a path, other than ``warcinfo``; ``payloads`` keeps their bytes.

    ``head`` has the lines before the payload of a request or response; the payload of other
    records is their block. A task holds one archive file, and one payload.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("content"):
                held, size = [], 0
                for headers, block, _ in parse(file.as_py()):
                    kind = headers.get("warc-type", "")
                    if kind == "warcinfo":
                        continue
                    head = b""
                    if headers.get("content-type", "").startswith("application/http"):
                        while block.left and (line := block.readline()).strip():
                            head += line
                    digest, count, kept = hashlib.sha1(), 0, []
                    while block.left:
                        part = block.read()
                        digest.update(part)
                        count += len(part)
                        if payloads or kind == "metadata":
                            kept.append(part)
                    names = ("warc-record-id", "warc-type", "warc-concurrent-to", "warc-refers-to", "warc-target-uri", "warc-date")
                    declared = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    held.append(
                        (
                            *[headers.get(n) for n in names],
                            declared,
                            head.decode("utf-8", "replace"),
                            count,
                            digest.hexdigest(),
                            b"".join(kept) if payloads or kind == "metadata" else None,
                        )
                    )
                    size += count if payloads else 0
                    if len(held) >= 4096 or size >= 1 << 24:
                        yield as_table(_RECORDS, list(zip(*held)))
                        held, size = [], 0
                if held:
                    yield as_table(_RECORDS, list(zip(*held)))

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(records, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """(capture_id, type, uri, date, request, response, metadata, original): one nested row per capture.

    ``original`` is the response that a revisit refers to. Of several requests or metadata
    records of one capture, that of the least identifier is taken. Those that name no
    capture that is there give a row with a null response.
    """
    kept = materialize(records, "warc-records")
    http = F.struct("record_id", "head", "payload_bytes", "payload_sha1", "digest", "payload")

    def of(kind: str, value: Column) -> DataFrame:
        one = kept.filter((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
        return one.groupBy(F.col("concurrent_to").alias(f"{kind}_to")).agg(F.min_by(value, "record_id").alias(kind))

    main = kept.filter(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("capture"), F.col("type"), "uri", "date", "refers_to", http.alias("response")
    )
    request, metadata = of("request", F.struct("record_id", "head")), of("metadata", F.struct("record_id", "payload"))
    whole = main.join(request, F.col("capture") == F.col("request_to"), "full")
    whole = whole.withColumn("capture_id", F.coalesce("capture", "request_to")).drop("capture", "request_to")
    whole = whole.join(metadata, F.col("capture_id") == F.col("metadata_to"), "full")
    whole = whole.withColumn("capture_id", F.coalesce("capture_id", "metadata_to")).drop("metadata_to")
    # few responses are referred to, by any number of revisits
    wanted = kept.filter("type = 'revisit' and refers_to is not null").select(F.col("refers_to").alias("wanted")).distinct()
    facts = of("metadata", F.col("payload")).select(F.col("metadata_to").alias("facts_to"), F.col("metadata").alias("facts"))
    original = (
        kept.filter("type = 'response'")
        .join(wanted, F.col("record_id") == F.col("wanted"), "left_semi")
        .join(facts, F.col("record_id") == F.col("facts_to"), "left")
        .select(
            F.col("record_id").alias("original_id"),
            F.struct("record_id", "payload_bytes", "payload_sha1", "payload", F.col("facts").alias("metadata")).alias("original"),
        )
    )
    original = materialize(original, "warc-originals")
    return whole.join(original, F.col("refers_to") == F.col("original_id"), "left").select(
        "capture_id", "type", "uri", "date", "request", "response", "metadata", "original"
    )


def page_id(metadata: Column) -> Column:
    """The page's id in the bytes of a metadata record."""
    return F.get_json_object(F.decode(metadata, "UTF-8"), "$.page_id").cast("long")


def archive_report(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write all pages, read the archives back: (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(captures(pages, id_col=id_col, url_col=url_col, payload_col=payload_col), path)
    found = assemble(read_records(spark, path))
    revisit = F.col("type") == "revisit"
    return found.filter("type is not null").select(
        page_id(F.col("metadata.payload")).alias("page_id"),
        F.when(revisit, F.col("original.payload_bytes")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("original.payload_sha1")).otherwise(F.col("response.payload_sha1")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(revisit, page_id(F.col("original.metadata"))).alias("refers_to"),
    )

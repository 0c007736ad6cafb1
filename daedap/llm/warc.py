"""WARC archives of pages: writing, reading, and putting captures together.

A capture is what one visit to a page left: a response, or a revisit that refers to
an earlier response with the same payload, with the request and metadata that name it
(or one another) in WARC-Concurrent-To.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daedap.llm.folders import create, new_folder, reading
from daedap.llm.graph import components
from daedap.session import materialize

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Payloads of fewer bytes are stored each time.
LEAST_REVISIT = 0

# A file is closed when it holds so many bytes.
FILE_BYTES = 64_000_000

# Tasks that read files, a file or more each.
MOST_TASKS = 50_000

# Records of these types begin a capture.
CAPTURED = ("response", "revisit", "resource")

FILES = "address string, n_records long, n_bytes long"
RECORDS = (
    "record_id string, type string, target string, date string, concurrent_to array<string>, "
    "refers_to string, payload_digest string, payload_bytes long, digest_ok boolean, "
    "request string, fields map<string,string>"
)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(*parts: object) -> str:
    """The same for the same parts, so that a task that is run again writes the same."""
    name = hashlib.md5("\0".join(map(str, parts)).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name, version=4)}>"


def capture_id(page_id: int, url: str | None, key: str) -> str:
    """Pages with equal ids but other URLs or payloads are captures of their own."""
    return record_id("capture", page_id, key, "" if url is None else f"={url}")


def record(headers: dict[str, str | None], block: bytes) -> bytes:
    """A record as a gzip member of its own; header values never break their line."""
    lines = ["WARC/1.1"]
    for name, value in headers.items():
        if value is not None:
            lines.append(f"{name}: " + re.sub(r"[\x00-\x1f\x7f]", lambda m: quote(m.group()), value))
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"])
    pack = zlib.compressobj(4, wbits=31)
    return pack.compress(head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def capture(
    page_id: int | None, url: str | None, payload: bytes, key: str, first: tuple | None
) -> list[bytes]:
    """Request, response or revisit, and metadata of a page.

    ``key`` names the payload; ``first`` holds the page id and URL of the response that a
    revisit refers to. A page without an id is referred to by none and has a new record id.
    """
    own = f"<urn:uuid:{uuid.uuid4()}>" if page_id is None else capture_id(page_id, url, key)
    target, digest = url or None, f"sha1:{digest_of(payload)}"
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    parts = urlsplit(re.sub(r"[\x00-\x20\x7f\[\]]", lambda m: quote(m.group()), url or ""))
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    asked = f"GET {path} HTTP/1.1\r\nHost: {parts.netloc}\r\n\r\n".encode()
    shared = {"WARC-Date": DATE, "WARC-Target-URI": target}
    main = {"WARC-Type": "response" if first is None else "revisit", "WARC-Record-ID": own, **shared}
    if first is not None:
        main |= {"WARC-Profile": PROFILE, "WARC-Refers-To": capture_id(*first, key)}
    main |= {"WARC-Payload-Digest": digest, "Content-Type": "application/http;msgtype=response"}
    linked = {**shared, "WARC-Concurrent-To": own}
    return [
        record(
            {
                "WARC-Type": "request",
                "WARC-Record-ID": record_id("request", own),
                **linked,
                "Content-Type": "application/http;msgtype=request",
            },
            asked,
        ),
        record(main, http + (payload if first is None else b"")),
        record(
            {
                "WARC-Type": "metadata",
                "WARC-Record-ID": record_id("metadata", own),
                **linked,
                "Content-Type": "application/warc-fields",
            },
            b"" if page_id is None else f"page-id: {page_id}\r\n".encode(),
        ),
    ]


def write_archives(
    pages: DataFrame, least_revisit: int = LEAST_REVISIT, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives; one row per file.

    Of pages with equal payloads of at least ``least_revisit`` bytes, that with the
    smallest id is a response and the others revisit it; rows that repeat this id
    and payload are responses too, and that with the smallest URL is referred to. Rows
    equal in all columns repeat a record, each without an id has one of its own. Null html is an empty payload. A row without an id
    revisits a page with one. Payloads are shuffled once, by their hash, and Spark
    splits those that very many pages share. Only files of finished tasks are in the table.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload)
    rows = rows.withColumn("key", F.sha2("payload", 256))
    same = rows.filter(F.length("payload") >= least_revisit).groupBy("key")
    named = F.when(F.col("page_id").isNotNull(), F.struct(F.col("page_id").alias("first_id"), "url"))
    firsts = same.agg(F.min(named).alias("first"), F.count("*").alias("n"))
    shared = firsts.filter("n > 1").select("key", "first")
    joined = rows.join(shared, "key", "left")
    first = F.when(~F.col("page_id").eqNullSafe(F.col("first.first_id")), F.col("first.first_id"))
    marked = joined.select(
        "page_id", "url", "payload", "key", first.alias("first_id"),
        F.col("first.url").alias("first_url"), first.isNotNull().alias("again"),
    )
    folder = new_folder(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i in range(0, batch.num_rows, 500):
                    yield from zip(*(c.to_pylist() for c in batch.slice(i, 500).columns))

        written, more, pending = [], True, rows()
        row = next(pending, None)
        while row is not None:
            address, n_records, n_bytes = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
            with create(address) as out:
                while row is not None and n_bytes < file_bytes:
                    page_id, url, payload, key, first_id, first_url, again = row
                    first = (first_id, first_url) if again else None
                    for data in capture(page_id, url, payload, key, first):
                        out.write(data)
                        n_records, n_bytes = n_records + 1, n_bytes + len(data)
                    row = next(pending, None)
            written.append((address, n_records, n_bytes))
        if written:
            types = (pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(zip(*written), types)]
            yield pa.RecordBatch.from_arrays(arrays, names=["address", "n_records", "n_bytes"])

    return materialize(marked.mapInArrow(run, FILES))


def archives(spark: SparkSession, path: str) -> DataFrame:
    """The addresses of existing archives, plain or compressed, below a path."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select(F.col("path").alias("address"))


def _headers(data: bytes) -> list[tuple[str, str]]:
    lines = data.decode("utf-8", "replace").split("\r\n")
    pairs = (line.partition(":") for line in lines if ":" in line)
    return [(name.strip().lower(), value.strip()) for name, _, value in pairs]


def parsed(stream) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Headers and block of each record of an open archive, one at a time."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the begin of a record: {line[:40]!r}")
        head = b""
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            head += line
        headers = _headers(head)
        length = int(dict(headers)["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError("the archive ends inside a record")
        yield headers, block


def _as_row(headers: list[tuple[str, str]], block: bytes) -> tuple[tuple, bytes | None]:
    """A row of RECORDS, and the payload of what has one."""
    one = dict(headers)
    kind, http, payload, length = one.get("warc-type"), b"", None, None
    if one.get("content-type", "").startswith("application/http"):
        http, _, body = block.partition(b"\r\n\r\n")
        if kind == "response":
            payload, length = body, len(body)
        elif kind == "revisit":
            stated = dict(_headers(http)).get("content-length", "")
            length = int(stated) if stated.isdigit() else None
    elif kind == "resource":
        payload, length = block, len(block)
    digest = one.get("warc-payload-digest")
    ok = None if payload is None or digest is None else digest == f"sha1:{digest_of(payload)}"
    is_fields = one.get("content-type") == "application/warc-fields"
    row = (
        one.get("warc-record-id"),
        kind,
        one.get("warc-target-uri"),
        one.get("warc-date"),
        [v for n, v in headers if n == "warc-concurrent-to"],
        one.get("warc-refers-to"),
        digest and digest.removeprefix("sha1:"),
        length,
        ok,
        http.split(b"\r\n")[0].decode("utf-8", "replace") if kind == "request" else None,
        _headers(block) if is_fields else None,
    )
    return row, payload


def read_archives(files: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the archives at ``files(address)``.

    Files are streamed; a task holds one record and some rows at a time. ``digest_ok``
    compares the payload with its stated digest. An archive that ends inside a record
    or holds something else raises an error.
    """
    schema = RECORDS + (", payload binary" if with_payload else "")
    names = StructType.fromDDL(schema).names
    types = [
        pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(),
        pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.map_(pa.string(), pa.string()),
        pa.binary(),
    ]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows)
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address in batch.column(0).to_pylist():
                rows, held = [], 0
                with reading(address) as source:
                    packed = source.read(2) == b"\x1f\x8b"
                    source.seek(0)
                    buffered = io.BufferedReader(source, 1 << 20)
                    stream = gzip.GzipFile(fileobj=buffered) if packed else buffered
                    for headers, block in parsed(stream):
                        row, payload = _as_row(headers, block)
                        rows.append((*row, payload) if with_payload else row)
                        held += len(block) if with_payload else 0
                        if len(rows) >= 5000 or held >= 16_000_000:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    tasks = min(max(files.count(), 1), MOST_TASKS)
    spread = files.select("address").repartition(tasks, "address")
    return spread.mapInArrow(run, schema)


def _captures_of(records: DataFrame) -> DataFrame:
    """(record_id, capture_id) of all records that begin no capture themselves."""
    links = records.select("record_id", F.explode("concurrent_to").alias("other"))
    links = materialize(
        links.union(links.select("other", "record_id")).filter("record_id != other").distinct()
    )
    begins = records.filter(F.col("type").isin(*CAPTURED)).select("record_id").distinct()
    others = records.filter(~F.coalesce(F.col("type").isin(*CAPTURED), F.lit(False)))
    others = others.select("record_id").distinct()
    known = begins.select(F.col("record_id").alias("other"), F.col("record_id").alias("capture_id"))
    placed, waiting = None, links.join(others, "record_id", "left_semi")
    while True:
        found = materialize(
            waiting.join(known, "other")
            .groupBy("record_id")
            .agg(F.min("capture_id").alias("capture_id"))
        )
        placed = found if placed is None else placed.union(found)
        waiting = materialize(waiting.join(found, "record_id", "left_anti"))
        if found.isEmpty() or waiting.isEmpty():
            break
        known = found.withColumnRenamed("record_id", "other")
    if not waiting.isEmpty():
        ends = F.col("record_id").alias("a"), F.col("other").alias("b")
        groups = components(waiting.select(*ends))
        left = groups.select(F.col("node").alias("record_id"), F.col("component").alias("capture_id"))
        placed = placed.union(left.join(others, "record_id", "left_semi"))
    return placed


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, copies, main, requests, metadata, others.

    ``main`` is the response, revisit or resource, ``copies`` how often the very same
    record is there (repeated rows of a table give it), the rest are arrays of different
    records. A record that begins no capture belongs to the nearest that its
    concurrent-to links lead to, in either direction and over other records, the
    smallest id if several are as near; records that lead to none form a capture
    without ``main`` and with 0 copies. Records without an id are captures of their own.
    All records of a capture meet in one row, as is asked for; equal ones are merged
    before they are shuffled.
    """
    unnamed = F.concat(F.lit("unnamed "), F.expr("uuid()"))
    records = materialize(records.withColumn("record_id", F.coalesce("record_id", unnamed)))
    begins = F.coalesce(F.col("type").isin(*CAPTURED), F.lit(False))
    placed = _captures_of(records)
    own = records.filter(begins).withColumn("capture_id", F.col("record_id"))
    linked = records.filter(~begins).join(placed, "record_id", "left")
    linked = linked.withColumn("capture_id", F.coalesce("capture_id", "record_id"))
    names = [c for c in records.columns if c != "concurrent_to"]
    # Maps cannot be compared, so fields travel as sorted entries.
    fields = F.array_sort(F.map_entries("fields")).alias("fields")
    whole = F.struct(*[fields if c == "fields" else F.col(c) for c in names])

    def those(condition: Column) -> Column:
        return F.collect_set(F.when(condition, whole))

    kind = F.coalesce("type", F.lit(""))
    return (
        own.unionByName(linked)
        .groupBy("capture_id")
        .agg(
            F.count(F.when(begins, 1)).alias("copies"),
            F.min(F.when(begins, whole)).alias("main"),
            those(kind == "request").alias("requests"),
            those(kind == "metadata").alias("metadata"),
            those(~begins & ~kind.isin("request", "metadata")).alias("others"),
        )
    )


def page_captures(captures: DataFrame) -> DataFrame:
    """Per page of archives that ``write_archives`` made: what was stored, and where it is.

    page_id, payload_bytes, payload_digest, record_type and refers_to, the page id of
    the response that a revisit refers to; and digest_ok of responses.
    """
    entries = F.flatten(F.transform("metadata", lambda m: m["fields"]))
    page_id = F.filter(entries, lambda e: e["key"] == "page-id")
    pages = materialize(
        captures.filter("main IS NOT NULL").select(
            "capture_id",
            "copies",
            F.get(page_id, F.lit(0))["value"].cast("long").alias("page_id"),
            F.col("main.payload_bytes").alias("payload_bytes"),
            F.col("main.payload_digest").alias("payload_digest"),
            F.col("main.type").alias("record_type"),
            F.col("main.refers_to").alias("response_id"),
            F.col("main.digest_ok").alias("digest_ok"),
        )
    )
    responses = pages.filter("record_type = 'response'").select(
        F.col("capture_id").alias("response_id"), F.col("page_id").alias("refers_to")
    )
    each = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    joined = pages.join(responses, "response_id", "left")
    return joined.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok", each
    ).drop("copy")

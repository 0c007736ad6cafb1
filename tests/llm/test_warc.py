"""Archives of pages, read back and put together."""

import base64
import gzip
import hashlib
import io
import uuid

import pytest
from pyspark.sql import functions as F

from daedap.llm import warc
from daedap.llm.folders import create, new_folder, place, reading
from daedap.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"
NAMES = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def plain(rows, least=0):
    """The contract, page by page."""
    rows = [(p, (h or "").encode()) for p, _, h in rows]
    first = {}
    for p, data in rows:
        if p is not None and len(data) >= least:
            first[data] = min(p, first.get(data, p))
    found = []
    for p, data in rows:
        again = len(data) >= least and data in first and p != first[data]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        kind = ("revisit", first[data]) if again else ("response", None)
        found.append((p, len(data), digest, *kind))
    return sorted(found, key=str)


def ours(captures):
    rows = warc.page_captures(captures).collect()
    assert all(r.digest_ok is (True if r.record_type == "response" else None) for r in rows)
    return sorted((tuple(r[n] for n in NAMES) for r in rows), key=str)


PAGES = [
    (5, "http://a.example/x?y=1#z", "<p>same</p>"),
    (3, "https://b.example/é ü", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (7, "not a url\r\nWARC-Type: response", None),
    (8, "http://[bad", ""),
    (None, "http://c.example/", "no id"),
    (None, "http://c.example/", "<p>same</p>"),
    (4, "", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n日本"),
    (6, "http://d.example/", "long " * 100_000),
    (3, "https://b.example/é ü", "<p>same</p>"),
    (3, "https://b.example/other", "different"),
]


def pages(spark, rows=PAGES):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return frame.withColumn("payload", F.lit(1)).withColumn("key", F.lit(2))


@pytest.mark.parametrize("least", [0, 5, 12])
def test_awkward_pages(spark, least):
    files = warc.write_archives(pages(spark), least_revisit=least, file_bytes=1000)
    assert files.agg(F.sum("n_records")).first()[0] == 3 * len(PAGES)
    assert ours(warc.transactions(warc.read_archives(files))) == plain(PAGES, least)


def test_no_pages(spark):
    files = warc.write_archives(pages(spark).limit(0))
    assert ours(warc.transactions(warc.read_archives(files))) == []


def test_whole_table(spark):
    found = [tuple(r[n] for n in NAMES) for r in QUERIES["op1_warc_captures"](spark, SF).collect()]
    rows = [tuple(r) for r in table(spark, SF, "pages").select("page_id", "url", "html").collect()]
    assert sorted(found, key=str) == plain(rows)


def test_archives_are_read_whole(spark):
    files = warc.write_archives(pages(spark))
    records = warc.read_archives(files, with_payload=True)
    payloads = {r.payload.decode() for r in records.filter("type = 'response'").collect()}
    assert payloads == {h or "" for _, _, h in PAGES}
    captures = warc.transactions(records).collect()
    assert all(len(c.requests) == len(c.metadata) == 1 and not c.others for c in captures)
    assert all(c.main.payload is None for c in captures if c.main.type == "revisit")
    address = files.first()["address"]
    folder = address.rsplit("/", 1)[0]
    assert warc.read_archives(warc.archives(spark, folder)).count() == records.count()
    system, path = place(address)
    with reading(address) as source:
        data = gzip.decompress(source.read())
    for line in (b"WARC/1.1\r\n", b"WARC-Refers-To: <urn:uuid:", b"WARC-Concurrent-To: <urn:uuid:"):
        assert line in data


def written(spark, records, packed):
    """An archive of (id, type, concurrent ids) records made elsewhere."""
    data = b""
    for id_, kind, others in records:
        lines = ["WARC/1.0", f"WARC-Record-ID: {id_}" if id_ else "X: y", f"WARC-Type: {kind}"]
        lines += [f"WARC-Concurrent-To: {o}" for o in others] + ["Content-Length: 4"]
        one = "\r\n".join(lines).encode() + b"\r\n\r\nabcd\r\n\r\n"
        data += gzip.compress(one) if packed else one
    address = f"{new_folder(spark, 'made')}/{uuid.uuid4().hex}.warc"
    with create(address) as out:
        out.write(data)
    return spark.createDataFrame([(address,)], "address string")


@pytest.mark.parametrize("packed", [True, False])
def test_links_over_other_records(spark, packed):
    records = [
        ("r1", "response", ["q1"]),
        ("q1", "request", []),  # named by its response only
        ("m1", "metadata", ["q1"]),  # leads to the response over the request
        ("n1", "metadata", ["m1"]),
        ("c1", "conversion", ["n1", "gone"]),
        ("r2", "response", []),
        ("m2", "metadata", ["r2", "r1"]),  # the smaller id of two as near
        ("q3", "request", ["m3"]),  # no response at all
        ("m3", "metadata", []),
        ("m4", "metadata", ["lost"]),
        ("m5", "metadata", []),
        (None, "metadata", []),
        ("i", "warcinfo", []),
    ]
    captures = warc.transactions(warc.read_archives(written(spark, records, packed)))

    def ids(members):
        return sorted(m.record_id for m in members)

    found = sorted(
        (c.copies, c.main.record_id if c.main else "", ids(c.requests), ids(c.metadata), ids(c.others))
        for c in captures.collect()
        if not any(i.startswith("unnamed") for i in ids(c.metadata))
    )
    assert found == sorted(
        [
            (1, "r1", ["q1"], ["m1", "m2", "n1"], ["c1"]),
            (1, "r2", [], [], []),
            (0, "", ["q3"], ["m3"], []),
            (0, "", [], ["m4"], []),
            (0, "", [], ["m5"], []),
            (0, "", [], [], ["i"]),
        ]
    )
    assert captures.count() == len(found) + 1


def test_broken_archives_raise():
    whole = b"WARC/1.0\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    assert [b for _, b in warc.parsed(io.BytesIO(whole * 2))] == [b"abcd"] * 2
    for data in (whole[:-7], b"junk" + whole):
        with pytest.raises(ValueError):
            list(warc.parsed(io.BytesIO(data)))


def test_other_urls_are_captures_of_their_own(spark):
    rows = [(1, f"http://a.example/{i}", "<p>same</p>") for i in range(3)]
    rows += [(None, f"http://b.example/{i // 2}", None) for i in range(6)] + [(2, None, "<p>same</p>")]
    captures = warc.transactions(warc.read_archives(warc.write_archives(pages(spark, rows))))
    assert ours(captures) == plain(rows)
    found = captures.collect()
    assert all(c.copies == len(c.requests) == len(c.metadata) == 1 for c in found)
    assert sorted(c.main.target or "" for c in found) == sorted(u or "" for _, u, _ in rows)

import gzip
import hashlib
import io

import pytest

from fleetvolt.llm import warc
from fleetvolt.llm.common import scratch_path


def brute(rows):
    largest = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and page_id is not None:
            largest[data] = max(page_id, largest.get(data, page_id))
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        top = largest.get(data)
        revisit = top is not None and page_id != top
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    top if revisit else None))
    return sorted(out, key=str)


def got(df):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_pages_round_trip(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert got(warc.archive_round_trip(pages)) == brute(rows)


def test_edge_pages(spark):
    big, other = "<p>é</p>" * 400, "y" * 999
    rows = [(1, "http://a/ü\r\nX: y", big), (5, None, big), (3, "u", big), (3, "u", big), (None, "n", big), (6, "", None), (7, "u", ""),
            (8, "u", other), (9, "u", other), (None, None, None), (10, "u", "z" * 300_000), (11, "u", "HTTP\r\n\r\nWARC/1.1\r\n\r\n" * 90),
            (12, "u", "q" * 1000), (12, "u", "q" * 1000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, refers_to string, digest int")
    assert got(warc.archive_round_trip(df)) == brute(rows)


def test_no_pages(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_archives_are_plain_gzip_members(spark):
    df = spark.createDataFrame([(1, "http://a", "<p>one</p>"), (2, "http://b", "<p>two</p>")], "page_id long, url string, html string")
    files = warc.write_archives(warc.with_revisits(df.coalesce(1)), scratch_path(spark, "t")).collect()
    data = open(files[0]["path"].removeprefix("file://"), "rb").read()
    assert gzip.decompress(data).count(b"WARC/1.1") == 2 and files[0]["records"] == 2
    found = list(warc.read_records(io.BytesIO(data), keep_payload=True))
    assert [r["payload"] for r in found] == [b"<p>one</p>", b"<p>two</p>"]


@pytest.mark.parametrize("damage", ["cut", "digest", "length", "noise"])
def test_damage_is_reported(damage):
    member = warc.page_record(1, "http://a", b"payload " * 50, None)
    plain = gzip.decompress(member)
    if damage == "cut":
        data = member[:-20]
    elif damage == "noise":
        data = member + b"rubbish"
    elif damage == "digest":
        data = gzip.compress(plain.replace(b"payload payload", b"payload puyload", 1))
    else:
        data = gzip.compress(plain.replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 9", 1))
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(data)))


def test_reader_takes_any_piece_size(monkeypatch):
    data = b"".join(warc.page_record(i, f"http://{i}", bytes([65 + i]) * (i * 700), None) for i in range(9))
    whole = [(r["payload_bytes"], r["payload_digest"]) for r in warc.read_records(io.BytesIO(data))]
    for size in (1, 7, 1000):
        monkeypatch.setattr(warc, "PIECE", size)
        assert [(r["payload_bytes"], r["payload_digest"]) for r in warc.read_records(io.BytesIO(data))] == whole
    assert len(whole) == 9


def record(kind, block, **fields):
    head = {"WARC-Type": kind, "WARC-Record-ID": "<urn:uuid:1>", **fields, "Content-Length": str(len(block))}
    return gzip.compress(("WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n").encode() + block + b"\r\n\r\n")


def test_records_of_common_archives():
    """warcinfo first, records without digests, digests of other kinds, blocks without an HTTP header, a revisit without length."""
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
    data = b"".join([
        record("warcinfo", b"software: x\r\n\r\nformat: y", **{"Content-Type": "application/warc-fields"}),
        record("response", http + b"body", **{"Content-Type": "application/http;msgtype=response"}),
        record("response", http + b"body", **{"Content-Type": "application/http", "WARC-Payload-Digest": "md5:abc"}),
        record("resource", b"", **{"Content-Type": "text/plain"}),
        record("metadata", b"via: z", **{"WARC-Block-Digest": "sha1:" + hashlib.sha1(b"via: z").hexdigest()}),
        record("revisit", b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n", **{"Content-Type": "application/http"}),
        warc.page_record(4, "http://a", b"own", None)])
    found = [(r["headers"]["warc-type"], r["payload_bytes"], r["payload"]) for r in warc.read_records(io.BytesIO(data), keep_payload=True)]
    assert found == [("warcinfo", 24, b"software: x\r\n\r\nformat: y"), ("response", 4, b"body"), ("response", 4, b"body"), ("resource", 0, b""),
                     ("metadata", 6, b"via: z"), ("revisit", None, b""), ("response", 3, b"own")]


@pytest.mark.parametrize("fields", [{"WARC-Block-Digest": "sha1:0!"}, {"WARC-Payload-Digest": "sha1:ABCD"}, {"Content-Type": "application/http"}])
def test_malformed_records_are_reported(fields):
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(record("response", b"no header", **fields))))

"""WARC archives: a writer with one gzip member per record, and a sequential reader.

The reader takes an archive's bytes as they come, decompresses them piece by piece, frames every
record by its Content-Length and checks the digests of block and payload while the bytes pass, so a
record is never in memory as a whole unless its payload is asked for. A member must hold exactly one
record; a cut or damaged archive raises ``WarcError`` with the member's offset.

Equal payloads are stored once: the others are ``revisit`` records (identical-payload-digest profile)
with the HTTP header of the page, whose Content-Length tells the payload's size.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetvolt.llm.common import bounded_batches, scratch_path, stored
from fleetvolt.llm.files import new_file, read_stream

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"        # the pages carry no time
LEAST_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
PIECE = 1 << 16
_END = b"\r\n\r\n"


class WarcError(ValueError):
    pass


def _digest(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def _hex(field: str | None, start: int) -> str | None:
    """The digest of a field in hex. The fields are optional, and other kinds than SHA-1 are passed over; one that is
    no base 32 of 20 bytes (or their hex) is an error."""
    kind, _, value = (field or "").partition(":")
    if kind.lower() != "sha1":
        return None
    try:
        raw = bytes.fromhex(value) if len(value) == 40 else base64.b32decode(value.upper())
    except ValueError as e:
        raise WarcError(f"the record at {start} has a malformed digest: {field}") from e
    if len(raw) != 20:
        raise WarcError(f"the record at {start} has a malformed digest: {field}")
    return raw.hex()


# -- writing ---------------------------------------------------------------------------------------

def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A gzip member with the response record of a page, or its revisit record."""
    sha1 = hashlib.sha1(payload).digest()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}").encode() + _END
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", f"<urn:page:{'none' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    fields += [("WARC-Payload-Digest", _digest(sha1)), ("WARC-Block-Digest", _digest(hashlib.sha1(block).digest()))]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(head.encode()) + gz.compress(block) + gz.compress(_END) + gz.flush()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id long, url string, html binary, refers_to long) to archives under
    ``folder`` and return the table of archives: path, records, bytes."""

    def write(batches):
        out, path, records, size = None, "", 0, 0

        def closed():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})
        for batch in batches:
            for page in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to"))):
                page_id, url, html, refers_to = (x.as_py() for x in page)
                if out is None:
                    (path, out), records, size = new_file(folder, ".warc.gz"), 0, 0
                member = page_record(page_id, url, html or b"", refers_to)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    bounded_batches(pages.sparkSession, 200)
    return stored(pages.mapInArrow(write, "path string, records long, bytes long"), "archives")


# -- reading ---------------------------------------------------------------------------------------

def _members(stream) -> Iterator[tuple[int, Iterator[bytes]]]:
    """(offset, pieces of its content) of each gzip member. The pieces must be taken to the end."""
    state = {"left": stream.read(PIECE), "at": 0}

    def content(start: int):
        gz = zlib.decompressobj(31)
        while not gz.eof:
            if not state["left"]:
                state["left"] = stream.read(PIECE)
                if not state["left"]:
                    raise WarcError(f"the member at {start} is cut off")
            data = state["left"]
            try:
                piece = gz.decompress(data, PIECE)
            except zlib.error as e:
                raise WarcError(f"the member at {start} is damaged: {e}") from e
            state["left"] = gz.unused_data if gz.eof else gz.unconsumed_tail
            state["at"] += len(data) - len(state["left"])
            if piece:
                yield piece
            while not gz.eof and not state["left"] and (piece := gz.decompress(b"", PIECE)):
                yield piece

    while state["left"]:
        yield state["at"], content(state["at"])
        if not state["left"]:
            state["left"] = stream.read(PIECE)


def read_records(stream, keep_payload: bool = False) -> Iterator[dict]:
    """Every record of an archive in order: headers (lower-case names), payload_bytes, payload_digest (hex)
    and, on request, payload. For a revisit these are the facts of the payload that it refers to."""
    for start, pieces in _members(stream):
        held = bytearray()

        def more() -> bool:
            piece = next(pieces, None)
            if piece is not None:
                held.extend(piece)
            return piece is not None

        while _END not in held:
            if not more():
                raise WarcError(f"the record at {start} has no header")
        head, _, rest = bytes(held).partition(_END)
        version, *lines = head.decode().split("\r\n")
        if not version.startswith("WARC/1."):
            raise WarcError(f"no WARC record at {start}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        if not fields.get("content-length", "").isdigit():
            raise WarcError(f"the record at {start} has no Content-Length")
        length = int(fields["content-length"])
        # The block: an HTTP header, then the payload.
        block, payload, size, http, kept = hashlib.sha1(), hashlib.sha1(), 0, None, bytearray()
        held, taken, header = bytearray(rest), 0, bytearray()
        while taken < length:
            if not held and not more():
                raise WarcError(f"the record at {start} is shorter than its Content-Length")
            part = bytes(held[:length - taken])
            del held[:len(part)]
            taken += len(part)
            block.update(part)
            if http is None:
                header += part
                if _END not in header:
                    continue
                http, _, part = bytes(header).partition(_END)
            payload.update(part)
            size += len(part)
            if keep_payload:
                kept += part
        while more():
            pass
        if bytes(held) != _END:
            raise WarcError(f"the member at {start} does not end with its record")
        wanted = _hex(fields.get("warc-block-digest"), start)
        if wanted is not None and wanted != block.hexdigest():
            raise WarcError(f"the block of the record at {start} does not fit its digest")
        if http is None and fields.get("content-type", "").startswith("application/http"):
            raise WarcError(f"the record at {start} holds no whole HTTP header")
        if http is None or not fields.get("content-type", "application/http").startswith("application/http"):
            # A block without an HTTP header (warcinfo, metadata, resource, ...) is its own payload.
            payload, size = block, length
            kept = header if http is None else bytearray(http + _END + kept)
        digest = _hex(fields.get("warc-payload-digest"), start)
        if fields.get("warc-type") == "revisit":
            names = dict((k.strip(), v.strip()) for k, _, v in (x.lower().partition(":") for x in (http or b"").decode("utf-8", "replace").split("\r\n")[1:]))
            size = int(names["content-length"]) if names.get("content-length", "").isdigit() else None
        elif digest is not None and digest != payload.hexdigest():
            raise WarcError(f"the payload of the record at {start} does not fit its digest")
        else:
            digest = payload.hexdigest()
        yield {"headers": fields, "payload_bytes": size, "payload_digest": digest, "payload": bytes(kept)}


_PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return None if number in ("", "none") else int(number)


def read_archives(archives: DataFrame) -> DataFrame:
    """The facts of every record of the archives; a task reads whole archives, one after the other."""

    def read(batches):
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                with read_stream(path) as stream:
                    for r in read_records(stream):
                        h = r["headers"]
                        rows.append({"page_id": _page(h["warc-record-id"]), "payload_bytes": r["payload_bytes"],
                                     "payload_digest": r["payload_digest"], "record_type": h["warc-type"],
                                     "refers_to": _page(h.get("warc-refers-to"))})
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    many = max(1, archives.count())
    return archives.select("path").repartitionByRange(many, "path").mapInArrow(read, _PAGES)


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html (bytes; null: empty) and refers_to: the largest page_id with an equal payload
    of at least ``LEAST_BYTES``, null for that page itself and for payloads of which there is one.

    The largest page_id per digest is a combined sum of small rows. Only digests of several rows come
    back; that join is broadcast if it is small and else split at hot payloads by the adaptive join."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"))
    same = (p.where(F.octet_length("html") >= LEAST_BYTES).groupBy(F.sha1("html").alias("digest"))
            .agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).where("n > 1").drop("n"))
    joined = p.join(same, F.when(F.octet_length("html") >= LEAST_BYTES, F.sha1("html")) == F.col("digest"), "left")
    return joined.select("page_id", "url", "html", F.when(
        ~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest")).alias("refers_to"))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) to archives in the shared folder and read
    them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A null html is an empty payload. Among equal payloads all rows with the largest page_id are responses
    (repeated rows too); a row without page_id revisits it like others, and if no row has one, all are
    responses. Only these three columns are read. An empty table gives no archive and no rows."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(with_revisits(pages), folder))

"""Token files: independent zstandard frames, a directory and a trailing seek table.

    frame*       zstandard, each with whole documents:
                 count u32 | count x (has_id u8, doc_id i64, start u64, n u32) | ids u32, little-endian;
                 ``start`` is how many ids of this file come before the document
    directory    skippable frame 0x184D2A5D: per frame (first doc_id i64, last doc_id i64, documents u32)
    seek table   skippable frame 0x184D2A5E of zstandard's seekable format: per frame (compressed size u32,
                 size u32, checksum u32: the low half of XXH64 of the content), then frames u32, 0x80,
                 0x8F92EAB1

Any zstandard tool reads the files, and a reader that wants some documents finds their frames in the
directory, decompresses only those and checks each one's checksum. Documents lie in ascending doc_id
order over the files of a table, nulls first.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetvolt.llm.common import bounded_batches, scratch_path, stored, worker_cache
from fleetvolt.llm.files import new_file, read_file

FRAME_BYTES = 1 << 20
_DIRECTORY, _SEEK, _SEEKABLE = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
_DOC = np.dtype([("has_id", "u1"), ("doc_id", "<i8"), ("start", "<u8"), ("n", "<u4")])
_FRAME = np.dtype([("first", "<i8"), ("last", "<i8"), ("docs", "<u4")])
_PLACE = np.dtype([("packed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
_NULL = -(1 << 63)


class TokenFileError(ValueError):
    pass


def _checksum(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class TokenFileWriter:
    """Writes documents in the order in which they are added."""

    def __init__(self, stream):
        import zstandard

        self.stream, self.packer = stream, zstandard.ZstdCompressor(level=3)
        self.docs: list[tuple] = []
        self.ids: list[bytes] = []
        self.held = self.tokens = self.rows = 0
        self.frames: list[tuple] = []
        self.places: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids``: the document's ids as little-endian unsigned 32-bit integers."""
        self.docs.append((doc_id is not None, doc_id or 0, self.tokens, len(ids) // 4))
        self.ids.append(ids)
        self.tokens += len(ids) // 4
        self.rows += 1
        self.held += len(ids)
        if self.held >= FRAME_BYTES:
            self._frame()

    def _frame(self) -> None:
        if not self.docs:
            return
        docs = np.array(self.docs, _DOC)
        data = struct.pack("<I", len(docs)) + docs.tobytes() + b"".join(self.ids)
        packed = self.packer.compress(data)
        self.stream.write(packed)
        ends = [int(d["doc_id"]) if d["has_id"] else _NULL for d in (docs[0], docs[-1])]
        self.frames.append((*ends, len(docs)))
        self.places.append((len(packed), len(data), _checksum(data)))
        self.docs, self.ids, self.held = [], [], 0

    def close(self) -> None:
        self._frame()
        body = np.array(self.frames, _FRAME).tobytes()
        self.stream.write(struct.pack("<II", _DIRECTORY, len(body)) + body)
        table = np.array(self.places, _PLACE).tobytes() + struct.pack("<IBI", len(self.places), 0x80, _SEEKABLE)
        self.stream.write(struct.pack("<II", _SEEK, len(table)) + table)
        self.stream.close()


class TokenFileReader:
    """Reads a token file from its end; frames are decompressed only as they are asked for."""

    def __init__(self, stream):
        import zstandard

        self.stream, self.unpacker = stream, zstandard.ZstdDecompressor()
        size = stream.seek(0, 2) or stream.tell()
        tail = self._at(max(0, size - 9), 9)
        if len(tail) < 9 or struct.unpack("<IBI", tail)[1:] != (0x80, _SEEKABLE):
            raise TokenFileError("no seek table with checksums at the end")
        many = struct.unpack("<I", tail[:4])[0]
        begin = size - 9 - many * _PLACE.itemsize
        self.places = np.frombuffer(self._at(begin, many * _PLACE.itemsize), _PLACE)
        self.offsets = np.concatenate([[0], np.cumsum(self.places["packed"].astype(np.int64))])
        magic, length = struct.unpack("<II", self._at(int(self.offsets[-1]), 8))
        if magic != _DIRECTORY or length != many * _FRAME.itemsize:
            raise TokenFileError("the directory does not fit the seek table")
        self.frames = np.frombuffer(self._at(int(self.offsets[-1]) + 8, length), _FRAME)

    def _at(self, offset: int, size: int) -> bytes:
        self.stream.seek(offset)
        return self.stream.read(size)

    def frame(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, ids) of a frame."""
        place = self.places[k]
        data = self.unpacker.decompress(self._at(int(self.offsets[k]), int(place["packed"])),
                                        max_output_size=int(place["size"]))
        if len(data) != place["size"] or _checksum(data) != place["checksum"]:
            raise TokenFileError(f"frame {k} does not fit its checksum")
        many = struct.unpack("<I", data[:4])[0]
        end = 4 + many * _DOC.itemsize
        return np.frombuffer(data[4:end], _DOC), np.frombuffer(data[end:], "<u4")

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start, ids) of all documents, or of those with a wanted id: other frames are skipped."""
        need = None if wanted is None else np.array(sorted(wanted), np.int64)
        for k, f in enumerate(self.frames):
            if need is not None and np.searchsorted(need, f["first"], "left") == np.searchsorted(need, f["last"], "right"):
                continue
            docs, ids = self.frame(k)
            base = docs["start"][0] if len(docs) else 0
            for d in docs:
                doc_id = int(d["doc_id"]) if d["has_id"] else None
                if wanted is None or doc_id in wanted:
                    a = int(d["start"] - base)
                    yield doc_id, int(d["start"]), ids[a:a + int(d["n"])]


#: The word tokenizer's pre-tokens of printable ASCII and Latin-1 letters, already lower-cased.
_PIECES = r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^\sa-z0-9\u00df-\u00f6\u00f8-\u00ff]+"
_PLAIN = r"[!-~\u00a1\u00ab\u00bb\u00bf-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"
#: A text of such words and ASCII white space.
_PLAIN_TEXT = r"[\t-\r -~\u00a1\u00ab\u00bb\u00bf-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*"
#: A word that is letters and marks after them: two pre-tokens at most.
_SIMPLE = r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)"
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """The letter that a byte-level model has for each byte: printable Latin-1 stands for itself, the other bytes
    follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(others)}}


class _Encoder:
    """Ids of whole texts as little-endian bytes.

    A tokenizer whose settings are those below works on each word between white space on its own, so the ids of a word
    are found once and kept for the task. A plain word (printable ASCII and Latin-1 letters, which no normalization but
    lower case changes) is cut into pre-tokens by the tokenizer's own pattern, and each distinct pre-token goes to the
    model once. All other words go to the tokenizer as they are, many at a time; texts with the control characters
    that Python, but not the tokenizer, takes for white space, and texts for any other tokenizer, are encoded as a whole.
    A text of plain words only is cut into pre-tokens at once, without its words.
    """

    MEMORY = 250_000         # new words of a generation; the one before it is kept beside it
    PIECES = 500_000         # new pre-tokens of a generation, likewise
    TOGETHER = 2_000

    def __init__(self, path: str):
        import re

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.simple = re.compile(_SIMPLE)
        self.model = self.tokenizer.model
        self.odd = re.compile("[\x1c-\x1f]")
        self.plain, self.cut, self.plain_text = re.compile(_PLAIN), re.compile(_PIECES), re.compile(_PLAIN_TEXT)
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.known_before: dict[str, bytes] = {}
        self.pieces_before: dict[str, bytes] = {}
        self.by_word = self._works_by_word()

    def _works_by_word(self) -> bool:
        import json

        parts = [json.loads(x.__getstate__()) if x is not None else {} for x in
                 (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)]
        normal = [n.get("type") for n in parts[0].get("normalizers", [])]
        cuts = parts[1].get("pretokenizers", [])
        return (normal == ["NFC", "Replace", "Lowercase"] and [c.get("type") for c in cuts] == ["Split", "ByteLevel"]
                and cuts[0]["pattern"] == {"Regex": _PATTERN} and not cuts[1]["add_prefix_space"]
                and self.tokenizer.post_processor is None and self.tokenizer.truncation is None)

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces_before.get(piece)
        if ids is not None:
            self.pieces[piece] = ids
            return ids
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        found = [t.id for t in self.model.tokenize(letters)]
        ids = self.pieces[piece] = struct.pack(f"<{len(found)}I", *found)
        return ids

    def _plain_word(self, word: str) -> bytes | None:
        """Ids of a plain word; None for any other. A special string is found before letters are folded, so what may hold
        one is left to the tokenizer."""
        get = self.pieces.get
        simple = self.simple.fullmatch(word)
        if simple:
            letters, marks = simple.groups()
            letters = letters.lower()
            own = get(letters) or self._piece(letters)
            if not marks:
                return own
            if "<|" not in marks:
                return own + (get(marks) or self._piece(marks))
        if "<|" in word or not self.plain.fullmatch(word):
            return None
        return b"".join([get(p) or self._piece(p) for p in self.cut.findall(word.lower())])

    def _learn(self, words: list[str]) -> None:
        """Encode new words many at a time, as one text with a space between them; the place of each
        token in that text tells its word."""
        for at in range(0, len(words), self.TOGETHER):
            part = words[at:at + self.TOGETHER]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(found.ids, "<u4").tobytes()
            starts = np.cumsum([0, *(len(w) + 1 for w in part)])
            begins = np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids))
            cuts = (np.searchsorted(begins, starts, "left") * 4).tolist()
            for word, a, b in zip(part, cuts[:-1], cuts[1:]):
                self.known[word] = ids[a:b]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.pieces) > self.PIECES:
            self.pieces, self.pieces_before = {}, self.pieces
        cut = [self.cut.findall(t.lower()) if self.by_word and "<|" not in t and self.plain_text.fullmatch(t) else None for t in texts]
        for piece in set().union(*(p for p in cut if p is not None)).difference(self.pieces):
            self._piece(piece)
        others = iter(self._by_words([t for t, p in zip(texts, cut) if p is None]))
        return [next(others) if p is None else b"".join(map(self.pieces.__getitem__, p)) for p in cut]

    def _by_words(self, texts: list[str]) -> list[bytes]:
        words = [None if not self.by_word or self.odd.search(t) else t.split() for t in texts]
        if len(self.known) > self.MEMORY:
            self.known, self.known_before = {}, self.known
        others = []
        for word in set().union(*(w for w in words if w is not None)).difference(self.known):
            ids = self.known_before.get(word)
            if ids is None:
                ids = self._plain_word(word)
            if ids is None:
                others.append(word)
            else:
                self.known[word] = ids
        self._learn(others)
        return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if w is None
                else b"".join(map(self.known.__getitem__, w)) for t, w in zip(texts, words)]


def _encoder(path: str) -> _Encoder:
    """The encoder of this worker process: its tasks share what they have learnt."""
    cache = worker_cache()
    if cache.get("encoder_path") != path:
        cache.update(encoder=_Encoder(path), encoder_path=path)
    return cache["encoder"]


def _portions(texts: pa.Array, chars: int = 2_000_000):
    """Runs of texts of about so many characters, so that a batch of long ones is not cut into words at
    once."""
    held, size = [], 0
    for t in texts:
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = 1) -> DataFrame:
    """Write ``docs`` (doc_id, text; null text: empty) with the tokenizer at ``path`` and ``end_id`` after each
    document. Returns the table of files: part, path, documents, tokens, base (ids in earlier files)."""

    def write(batches):
        from pyspark import TaskContext

        encoder, end, writer = _encoder(path), struct.pack("<I", end_id), None
        for batch in batches:
            if writer is None and batch.num_rows:
                name, stream = new_file(folder, ".tokens.zst")
                writer = TokenFileWriter(stream)
            ids = (i for texts in _portions(batch.column("text")) for i in encoder.encode(texts))
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), ids):
                writer.add(doc_id, own + end)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "path": [name],
                                              "documents": [writer.rows], "tokens": [writer.tokens]})

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The hash breaks ties between rows of one id, so that they too can lie in several ranges.
    ordered = (rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
               .sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))
    files = stored(ordered.mapInArrow(write, "part long, path string, documents long, tokens long"), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long"))


_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document."""

    def read(batches):
        schema = pa.schema([(c.split()[0], pa.int64()) for c in _READ.split(", ")])
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                with read_file(path) as stream:
                    rows = []
                    for doc_id, start, ids in TokenFileReader(stream).documents():
                        rows.append((doc_id, base + start, len(ids), zlib.crc32(ids.tobytes())))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], schema=schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], schema=schema)

    many = max(1, files.count())
    return files.select("path", "base").repartitionByRange(many, "path").mapInArrow(read, _READ)


def token_round_trip(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """Write all of ``docs`` as token files in the shared folder and read them back.

    Rows without doc_id come first; rows that repeat an id lie together, each with a place of its own. A
    null or empty text has the end id only. Only doc_id and text are read. An empty table gives no file and
    no rows. A document's ids must fit a frame of 4 GiB."""
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, path, end_id))

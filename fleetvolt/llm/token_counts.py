"""Token counts without token ids.

A byte-pair tokenizer cuts a text into pre-tokens and each pre-token into pieces on its own. So the
pieces are counted once per distinct pre-token of the corpus, and a document's count is the sum of its
pre-tokens' frequencies times their pieces. The counts of the most frequent short pre-tokens (at most
``FREQUENT``, a bounded table) are broadcast, which takes the hot keys out of the join; the frequencies
of all other pre-tokens are joined to the full table of counts.

Cutting: a text is split into units that no pre-token crosses, and each distinct unit is cut by the pre-token pattern
once. A unit is a run of non-space characters with the space before it, or a run of white space. Where spaces and line
ends stand alone, as in most texts, plain splitting gives the units; other texts are split by a pattern. Where a text has
characters beyond ``PLAIN``, whose classes may differ between Unicode versions, or
the control characters 0x1c-0x1f, the tokenizer's own pre-tokenizer cuts it.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetvolt.llm.common import bounded_batches, stored, worker_cache

FREQUENT = 131_072
SHORT_BYTES = 64
PLAIN = "\u0557"
_RUNS = r" ?[^\s]+|\s+(?!\S)|\s+"
#: A run that is letters and marks after them: two pre-tokens at most, as no mark is an apostrophe.
_SIMPLE = r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)"
#: Runs that a task may hold before it hands on what it counted, and that a generation of looked-up runs holds.
_COUNTED, _MEMORY = 150_000, 60_000
#: Rows of a batch of counts.
_ROWS = 40_000
#: Marks the sum of a run that has pre-tokens beyond the frequent ones.
_RARE = 1 << 40


def _tokenizer(path: str):
    """The tokenizer of this worker process, loaded once. It works in the task's own thread: threads of its own would each hold
    memory of their own."""
    import os

    from tokenizers import Tokenizer

    cache = worker_cache()
    if cache.get("tokenizer_path") != path:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        cache.update(tokenizer=Tokenizer.from_file(path), tokenizer_path=path)
    return cache["tokenizer"]


class _Cutter:
    """Cuts texts into runs, and runs into pre-tokens."""

    def __init__(self, path: str, special: list[str]):
        import regex
        from public_tokenizers import PATTERN

        self.path = path
        self.split = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.runs = re.compile(_RUNS)
        self.pattern = regex.compile(PATTERN)
        self.simple = re.compile(_SIMPLE)
        # Python's own \s also takes the separators 0x1c-0x1f for white space; the tokenizer does not.
        self.odd = re.compile(f"[^\x00-\x1b\x20-{PLAIN}]")
        # Texts without these, and without spaces or line ends side by side, need no pattern.
        self.uneven = re.compile(f"[^\n\x20-\x7e\xa1-{PLAIN}]")

    @cached_property
    def tokenizer(self):
        """Only texts with odd characters need it, and it takes much memory."""
        return _tokenizer(self.path)

    def parts(self, text: str) -> tuple[int, int, list[str]]:
        """(special tokens, line ends, units) of a text. A unit is written without the space before it; one that has no space
        before it begins with a zero character. Line ends that stand alone are only counted."""
        specials, lines, texts = 0, 0, [text]
        if self.split is not None and "<" in text:
            pieces = self.split.split(text)
            specials, texts = len(pieces) // 2, pieces[::2]
        units: list[str] = []
        for t in texts:
            if not t:
                continue
            if not (self.uneven.search(t) or "  " in t or " \n" in t or "\n " in t or "\n\n" in t or t[0] in " \n" or t[-1] in " \n"):
                lines += t.count("\n")
                units += f"\0{t}".replace("\n", " \0").split(" ")
                continue
            if self.odd.search(t):
                runs = [t[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(t)]
            else:
                runs = self.runs.findall(t)
            units += [r[1:] if r[0] == " " and len(r) > 1 else f"\0{r}" for r in runs]
        return specials, lines, units

    def cut_unit(self, unit: str) -> list[str]:
        return self.cut(unit[1:] if unit[0] == "\0" else f" {unit}")

    def cut(self, run: str) -> list[str]:
        simple = self.simple.fullmatch(run)
        if simple:
            word, marks = simple.groups()
            return [word, marks] if marks else [word]
        return [run] if self.odd.search(run) else self.pattern.findall(run)


#: The unit of a line end that stands alone.
_LINE_END = "\0\n"


class _Known(dict):
    """Pieces of each unit's frequent pre-tokens, with ``_RARE`` added if it has others, which ``rare`` lists. Two generations
    of units are kept, so what comes often is looked up once."""

    def __init__(self, cutter: _Cutter, frequent: dict[str, int]):
        super().__init__()
        self.cutter, self.frequent = cutter, frequent
        self.rare: dict[str, list[str]] = {}
        self.before: dict[str, int] = {}
        self.rare_before: dict[str, list[str]] = {}

    def age(self) -> None:
        if len(self) > _MEMORY:
            self.before, self.rare_before, self.rare = dict(self), self.rare, {}
            self.clear()

    def __missing__(self, unit: str) -> int:
        total = self.before.get(unit)
        if total is not None:
            if total & _RARE:
                self.rare[unit] = self.rare_before[unit]
        else:
            total, others = 0, []
            for w in self.cutter.cut_unit(unit):
                n = self.frequent.get(w)
                if n is None:
                    others.append(w)
                else:
                    total += n
            if others:
                self.rare[unit] = others
                total += _RARE
        self[unit] = total
        return total


def special_strings(path: str) -> list[str]:
    from tokenizers import Tokenizer

    return [t.content for t in Tokenizer.from_file(path).get_added_tokens_decoder().values()]


def pretoken_frequencies(texts: DataFrame, path: str) -> DataFrame:
    """(pretoken, freq) of all ``texts`` (column text)."""

    special = special_strings(path)

    def count(batches):
        cutter, seen = _Cutter(path, special), Counter()

        def flushed():
            """The pre-tokens of what was seen, which is given up unit by unit; the shuffle adds up repeated ones."""
            words: Counter = Counter()
            while seen:
                unit, n = seen.popitem()
                for w in cutter.cut_unit(unit):
                    words[w] += n
                if len(words) >= _ROWS or not seen:
                    yield pa.RecordBatch.from_pydict({"pretoken": list(words), "freq": list(words.values())})
                    words.clear()

        for batch in batches:
            for text in batch.column("text"):
                _, lines, units = cutter.parts(text.as_py() or "")
                seen.update(units)
                if lines:
                    seen[_LINE_END] += lines
                if len(seen) > _COUNTED:
                    yield from flushed()
        yield from flushed()

    bounded_batches(texts.sparkSession)
    return (texts.select("text").mapInArrow(count, "pretoken string, freq long")
            .groupBy("pretoken").agg(F.sum("freq").alias("freq")))


def piece_counts(pretokens: DataFrame, path: str) -> DataFrame:
    """Add ``pieces`` to (pretoken, freq): each distinct pre-token is encoded once."""

    def encode(batches):
        tokenizer = _tokenizer(path)
        for batch in batches:
            found = tokenizer.encode_batch_fast(batch.column("pretoken").to_pylist(), add_special_tokens=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column("pretoken"), batch.column("freq"), pa.array([len(e.ids) for e in found], pa.int32())],
                names=["pretoken", "freq", "pieces"])

    return pretokens.mapInArrow(encode, "pretoken string, freq long, pieces int")


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    The counts are those of the tokenizers library for the file at ``path``, without begin, end or added
    special tokens; special strings inside texts count as the one token that they are by default. A null
    text counts as empty (0 tokens). Repeated rows are rows of their own, null ids are ids like others,
    and only doc_id and text are read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = stored(piece_counts(pretoken_frequencies(texts, path), path), "pieces")
    # The least frequency from which on at most FREQUENT pre-tokens are short ones: from a histogram of
    # bounded size, so that no more than those reach the driver.
    short = counts.where(F.octet_length("pretoken") <= SHORT_BYTES)
    level = F.floor(F.log2("freq") * 64)
    total, least = 0, None
    for r in sorted(short.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), reverse=True):
        total += r["n"]
        if total > FREQUENT:
            break
        least = r["level"]
    top = short.where(level >= least if least is not None else F.lit(False)).select("pretoken", "pieces").toArrow()
    table = spark.sparkContext.broadcast(dict(zip(top.column("pretoken").to_pylist(), top.column("pieces").to_pylist())))

    special = special_strings(path)

    def sums(batches):
        known = _Known(_Cutter(path, special), table.value)
        schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_bytes", pa.int64()), ("rows", pa.int64()),
                            ("n", pa.int64()), ("pretoken", pa.string())])
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, key, size, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "size")),
                                               batch.column("text")):
                text = text.as_py() or ""
                n, lines, runs = known.cutter.parts(text)
                others: Counter = Counter()
                if lines:
                    n += lines * (known[_LINE_END] & (_RARE - 1))
                    others.update({w: lines for w in known.rare.get(_LINE_END, ())})
                for at in range(0, len(runs), 100_000):
                    known.age()
                    part = runs[at:at + 100_000]
                    found = np.fromiter(map(known.__getitem__, part), np.int64, len(part))
                    n += int((found & (_RARE - 1)).sum())
                    for k in np.flatnonzero(found >= _RARE).tolist():
                        others.update(known.rare[part[k]])
                rows.append((doc_id, key, size, 1, n, None))
                rows += [(doc_id, key, None, None, c, w) for w, c in others.items()]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    sized = texts.withColumn("key", F.xxhash64("text")).withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)))
    parts = stored(sized.mapInArrow(
        sums, "doc_id long, key long, n_bytes long, rows long, n long, pretoken string"), "parts")
    rest = (parts.where("pretoken IS NOT NULL").join(counts.select("pretoken", "pieces"), "pretoken")
            .select("doc_id", "key", F.lit(None).cast("long").alias("n_bytes"), F.lit(None).cast("long").alias("rows"),
                    (F.col("n") * F.col("pieces")).alias("n")))
    # Rows that repeat an id and a text add up alike, so each of them has its share of the sum.
    whole = (parts.where("pretoken IS NULL").drop("pretoken").unionByName(rest).groupBy("doc_id", "key")
             .agg(F.max("n_bytes").alias("n_bytes"), F.sum("rows").alias("rows"), F.sum("n").alias("n")))
    return (whole.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
            .select("doc_id", "n_bytes", F.expr("n div rows").alias("n_tokens"),
                    (F.expr("n div rows") > limit).alias("over_limit")))

"""Phrases whose words stand together, by Rabin-Karp fingerprints.

A text is cut into pieces at punctuation and line ends, and a piece into words. Prefix polynomials over the
bytes of a span give the number of every word, and prefix polynomials over the words give the fingerprint of every
run of 1 to ``LONGEST`` words, both with numpy over an Arrow batch. Every run has two fingerprints with bases and byte
values of their own.

1. The tasks count the fingerprints of single words, then of pairs, then of all longer runs; the shuffle adds up
   (fingerprint, check fingerprint) -> count, smallest pointer. Both fingerprints include the language and the number of words. A
   pointer is a 32-bit hash of the language and text that holds an occurrence, so most pointers lead to few texts. No
   phrase is text yet, and the shuffled rows are four numbers.
2. A run can be frequent only if the shorter runs inside it are. The frequent words and then the frequent pairs set bits of a
   bitmap of at most ``PLACES`` bits, which the tasks look up before they count longer runs. A bit that two runs share
   only lets a run be counted that was not needed; no frequent run is lost, at any size.
3. Runs whose first fingerprints collide are told apart by the second one. The texts under the pointers of the frequent runs
   are read again, and the run under both fingerprints is cut out of the text: that text is the phrase. Fingerprints that lead
   to one phrase add up; a pointer that several texts share does no harm, as only a text that holds the
   fingerprints counts.
4. The parts of a frequent phrase are frequent too, so scores and the longer phrases around a phrase come from joins
   of the table of frequent phrases with itself, by the phrases' text.

Two different runs of a language are counted as one only if a 64-bit and a 32-bit fingerprint agree, which has a chance of
about 2**-96 for each pair.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetvolt.llm.common import bounded_batches, drop_stored, stored
from fleetvolt.llm.wordhash import _pieces, mix, text_bytes

#: Characters that end a piece, and those that end a word inside a piece.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b" \t"
LONGEST = 4
PLACES = 1 << 27             # bits of a bitmap: 16 MB
SPAN = 1 << 18               # bytes that are hashed at once
HELD = 1 << 20               # runs that a task holds before it adds them up
SALTS = 64

_COUNTED = "fp long, chk int, f long, ptr int"


class _Base:
    """One polynomial over 64 or 32 bits: a random value for each byte (A-Z as a-z), an odd base and its inverse."""

    def __init__(self, seed: int, kind=np.uint64):
        rng = np.random.default_rng(seed)
        self.kind, self.bits = kind, 8 * np.dtype(kind).itemsize
        drawn = rng.integers(1, 1 << 62, 259, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.values = drawn[:256].astype(kind)
        self.values[65:91] = self.values[97:123]
        self.base = int(drawn[256]) % (1 << self.bits) // 8 * 8 + 5
        self.step = kind(int(drawn[257]) % (1 << self.bits) // 8 * 8 + 3)
        self.up = self.down = np.ones(1, kind)

    def grow(self, n: int) -> None:
        if n > len(self.up):
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, self.kind), np.full(max(n, SPAN), b, self.kind)]), dtype=self.kind)
                                  for b in (self.base, pow(self.base, -1, 1 << self.bits)))

    def mixed(self, x: np.ndarray) -> np.ndarray:
        if self.bits == 64:
            return mix(x)
        x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)       # the 32-bit finalizer of MurmurHash3
        x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        return x ^ (x >> np.uint32(16))

    def words(self, part: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers of the words: differences of the prefix polynomial of the span, brought to one power."""
        n = len(part)
        self.grow(n)
        sums = np.zeros(n + 1, self.kind)
        np.cumsum(self.values.take(part) * self.up[:n], dtype=self.kind, out=sums[1:])
        return self.mixed((sums[end] - sums[start]) * self.down[start])

    def runs(self, words: np.ndarray, size: int, begin: np.ndarray | None = None) -> np.ndarray:
        """Fingerprints of the runs of ``size`` words that begin at the places ``begin`` (all): P[i + size] - P[i]
        step^size over the prefix polynomial P of the words, taken as the sum of its ``size`` terms, which is the same."""
        n = len(words) - size + 1
        if n <= 0:
            return np.zeros(0, self.kind)
        out = words[:n].copy() if begin is None else words[begin]
        for k in range(1, size):
            out *= self.step
            out += words[k:k + n] if begin is None else words[begin + k]
        return self.mixed(out + self.kind(size))


class Cutter:
    """Words of texts with both fingerprints and their pieces, span by span."""

    def __init__(self):
        self.one, self.two = _Base(12), _Base(2012, np.uint32)
        self.breaks = np.zeros(256, bool)
        self.breaks[list(BREAKS)] = True
        self.sep = self.breaks.copy()
        self.sep[list(BLANKS)] = True

    def spans(self, column: pa.Array):
        """(first numbers, second numbers, piece, text, begin, end, carried, bytes) of the words of one span after the other.
        Pieces are numbered over the whole column; begin and end are offsets in the column's bytes. Each span begins
        with the last ``LONGEST - 1`` words of the one before it; ``carried`` says how many."""
        data, ends = text_bytes(column)
        held: list[np.ndarray] = []
        pieces = 0
        for a, b in _pieces(data, ends, self.sep, SPAN):
            part = data[a:b]
            n = len(part)
            inside = ~self.sep[part]
            first = np.zeros(n + 1, bool)
            lo, hi = np.searchsorted(ends, (a, b + 1))
            first[ends[lo:hi] - a] = True
            before = np.zeros(n, bool)
            before[1:] = inside[:-1]
            start = np.flatnonzero(inside & (~before | first[:-1]))
            after = np.zeros(n, bool)
            after[:-1] = inside[1:]
            end = np.flatnonzero(inside & (~after | first[1:])) + 1
            cuts = np.flatnonzero(self.breaks[part] | first[:-1])
            piece = pieces + np.searchsorted(cuts, start, "right")
            pieces += len(cuts)
            if not len(start):
                continue
            text = np.searchsorted(ends, start + a, "right") - 1
            new = [self.one.words(part, start, end), self.two.words(part, start, end), piece, text, start + a, end + a]
            carried = len(held[0]) if held else 0
            rows = [np.concatenate(x) for x in zip(held, new)] if held else new
            yield (*rows, carried, data)
            held = [x[-(LONGEST - 1):] for x in rows]

    def begins(self, words: tuple, size: int) -> np.ndarray:
        """Where the runs of ``size`` words inside pieces begin that end in the span's own words."""
        piece, carried = words[2], words[6]
        n = len(piece) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        inside = piece[:n] == piece[size - 1:size - 1 + n]
        inside[:max(0, carried - size + 1)] = False
        return np.flatnonzero(inside)

    def runs(self, words: tuple, size: int, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.one.runs(words[0], size, begin), self.two.runs(words[1], size, begin)


class _Bitmap:
    def __init__(self, bits: int, body: np.ndarray):
        self.bits, self.body = np.uint64(bits - 1), body

    def has(self, fp: np.ndarray) -> np.ndarray:
        place = fp & self.bits
        return (self.body[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def _seed(lang: str) -> tuple[int, int]:
    """What a language adds to the fingerprints of its runs."""
    raw = hashlib.blake2b(lang.encode(), digest_size=12).digest()
    return int.from_bytes(raw[:8], "little"), int.from_bytes(raw[8:], "little")


#: Fingerprints of the empty run, to which the language's are added.
_EMPTY = (0x2545F4914F6CDD1D, 0x9E3779B9)


def _count(sizes: tuple[int, ...], inner: int, sent):
    """Counts of the runs of ``sizes`` words whose runs of ``inner`` words are all in the bitmap ``sent`` (None: every run).
    With single words the empty run counts too: its count is the number of words of the language."""
    schema = pa.schema([("fp", pa.int64()), ("chk", pa.int32()), ("f", pa.int64()), ("ptr", pa.int32())])

    def run(batches):
        cutter = Cutter()
        held: list[tuple] = []

        def added_up():
            fp, chk, f, ptr = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.argsort(fp)
            fp, chk, f, ptr = (x[order] for x in (fp, chk, f, ptr))
            new = np.ones(len(order), bool)
            new[1:] = (fp[1:] != fp[:-1]) | (chk[1:] != chk[:-1])
            at = np.flatnonzero(new)
            f, ptr = np.add.reduceat(f, at), np.minimum.reduceat(ptr, at)
            out = pa.RecordBatch.from_arrays(
                [pa.array(fp[at].view(np.int64)), pa.array(chk[at].view(np.int32)), pa.array(f), pa.array(ptr)], schema=schema)
            for k in range(0, len(at), 1 << 16):
                yield out.slice(k, 1 << 16)

        for batch in batches:
            ptr = batch.column("ptr").to_numpy()
            lang = batch.column("lang").dictionary_encode()
            seeds = [_seed(x) for x in lang.dictionary.to_pylist()]
            code = lang.indices.to_numpy(zero_copy_only=False)
            one = np.array([x for x, _ in seeds], np.uint64)[code]          # of each text
            two = np.array([x for _, x in seeds], np.uint32)[code]
            for words in cutter.spans(batch.column("text")):
                text_of, known = words[3], None
                if sent is not None:            # at every place, also those whose run ends before the span
                    inside = cutter.one.runs(words[0], inner)
                    known = np.zeros(len(words[0]) + max(sizes), bool)
                    known[:len(inside)] = sent.value.has(inside ^ one[text_of[:len(inside)]])
                for size in sizes:
                    begin = cutter.begins(words, size)
                    for k in range(size - inner + 1 if known is not None else 0):
                        begin = begin[known[begin + k]]
                    text = text_of[begin]
                    fp, chk = cutter.runs(words, size, begin)
                    held.append((fp ^ one[text], chk ^ two[text], np.ones(len(fp), np.int64), ptr[text]))
                if sent is None and len(text):
                    mine, some, count = np.unique(code[text], return_index=True, return_counts=True)
                    held.append((one[text[some]] ^ np.uint64(_EMPTY[0]), two[text[some]] ^ np.uint32(_EMPTY[1]), count.astype(np.int64), ptr[text[some]]))
                if sum(len(x[0]) for x in held) >= HELD:
                    yield from added_up()
        if sum(len(x[0]) for x in held):
            yield from added_up()

    return run


def _bitmap(spark, frequent: DataFrame) -> _Bitmap:
    """The fingerprints of a stored table as bits. Spark's bitmap aggregates build it in blocks of 4096 bytes; the driver
    gets at most ``PLACES / 32768`` of them."""
    bits = 1 << 16
    n = frequent.count()
    while bits < 64 * n and bits < PLACES:
        bits *= 2
    place = F.col("fp").bitwiseAND(F.lit(bits - 1))
    blocks = (frequent.select(F.floor(place / 32768).cast("long").alias("block"), (place % 32768).alias("bit"))
              .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("body")).collect())
    body = np.zeros(bits // 8, np.uint8)
    for r in blocks:
        body[r["block"] * 4096:(r["block"] + 1) * 4096] = np.frombuffer(bytes(r["body"]), np.uint8)
    return _Bitmap(bits, body)


def _cut_out(batches):
    """The phrases under the pointers: of each text the runs whose fingerprints are wanted from it. The empty run is that of
    the text's language."""
    cutter = Cutter()
    schema = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("fp", pa.int64()), ("chk", pa.int32()), ("phrase", pa.string())])
    lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    for batch in batches:
        for row, (lang, wanted) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("wanted").to_pylist())):
            open_ = {(w["fp"], w["chk"]) for w in wanted}
            want = np.array([fp for fp, _ in open_], np.int64)
            one, two = (kind(x) for kind, x in zip((np.uint64, np.uint32), _seed(lang)))
            found: dict[tuple, tuple] = {}
            none = (int((one ^ np.uint64(_EMPTY[0])).view(np.int64)), int((two ^ np.uint32(_EMPTY[1])).view(np.int32)))
            if none in open_:
                found[none] = (0, "")
            for words in cutter.spans(batch.column("text").slice(row, 1)):
                body, begins, ends = words[7], words[4], words[5]
                for size in range(1, LONGEST + 1):
                    at = cutter.begins(words, size)
                    fp = (cutter.one.runs(words[0], size, at) ^ one).view(np.int64)
                    hits = np.flatnonzero(np.isin(fp, want))
                    chk = (cutter.two.runs(words[1], size, at[hits]) ^ two).view(np.int32)
                    pairs, once = np.unique(np.stack([fp[hits], chk.astype(np.int64)]), axis=1, return_index=True)
                    for (a, b), k in zip(pairs.T.tolist(), once.tolist()):
                        if (a, b) in open_ and (a, b) not in found:
                            i = int(at[hits[k]])
                            found[a, b] = (size, b" ".join(body[begins[j]:ends[j]].tobytes().translate(lower)
                                                           for j in range(i, i + size)).decode("utf-8", "replace"))
            if found:
                fps, chks = zip(*found)
                sizes, names = zip(*found.values())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(fps), pa.string()), pa.array(sizes, pa.int32()), pa.array(fps, pa.int64()), pa.array(chks, pa.int32()),
                     pa.array(names, pa.string())], schema=schema)


RUN = ["fp", "chk"]


def frequent_phrases(docs: DataFrame, least: int = 30) -> DataFrame:
    """(lang, words, phrase, f): every run of 1 to ``LONGEST`` words that occurs at least ``least`` times in the texts of
    its language, and with words 0 and the empty phrase the number of all words of the language, if it is as many. The
    result is a stored table; see :func:`collocations` for what texts and nulls mean."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("ptr", F.shiftright(F.xxhash64("lang", "text"), 32).cast("int"))
    levels, sent = [], None
    for inner, sizes in enumerate([(1,), (2,), tuple(range(3, LONGEST + 1))]):
        # The tasks have added up what they could: pairs and longer runs hardly repeat within a task, so the rows
        # are dealt out as they are. A run comes at most once for each ``HELD`` runs.
        counted = rows.mapInArrow(_count(sizes, inner, sent), _COUNTED)
        level = stored(counted.repartition(*RUN).groupBy(*RUN).agg(F.sum("f").alias("f"), F.min("ptr").alias("ptr"))
                       .where(F.col("f") >= least), f"runs-{inner + 1}")
        levels.append(level)
        if sent is not None:
            sent.destroy()
        if inner < 2:
            sent = spark.sparkContext.broadcast(_bitmap(spark, level))
    runs = levels[0].unionByName(levels[1]).unionByName(levels[2])
    # The texts under the pointers, once each: at most as many as there are frequent runs, and each asks for at most
    # the runs it holds.
    asked = stored(runs.groupBy("ptr").agg(F.collect_list(F.struct(*RUN)).alias("wanted")), "asked")
    held = (rows.join(asked.select("ptr"), "ptr", "left_semi").dropDuplicates(["ptr", "lang", "text"]).join(asked, "ptr"))
    phrases = (held.select("lang", "text", "wanted").repartition(F.col("lang"), F.xxhash64("text"))
               .mapInArrow(_cut_out, "lang string, words int, fp long, chk int, phrase string"))
    out = stored(runs.select(*RUN, "f").join(phrases, RUN).dropDuplicates([*RUN, "lang", "phrase"])
                 .groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")), "phrases")
    for t in (*levels, asked):
        drop_stored(t)
    return out


def _whole(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = 30, share: int = 80, first: int = 2000) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: the ``first`` phrases of 2 to ``LONGEST`` words of each language that
    occur ``least`` times or more, by score, then a, largest first, then by the phrase's bytes.

    A-Z are lower-cased; texts are cut at ``BREAKS`` into pieces and these at blanks into words. a counts all
    occurrences inside pieces, overlapping ones included, and n all words of the language. Cutting a phrase after
    k words gives l and r, the counts of both parts, and the score floor(2000000 a / (l + r)); the cut with the lowest score
    counts, of equal ones the first. A phrase inside a longer one that has at least ``share`` percent of its
    occurrences is left out. All arithmetic is exact.

    A null language is ``und``, together with rows that say so; a null text is empty, and empty or blank texts add
    nothing. Repeated rows count each time; ids and extra columns are not read. A text of any length is cut in spans of
    about 256 kB that share the words at their borders. An empty table gives an empty result.
    """
    table = frequent_phrases(docs, least)
    known = table.where("words > 0").select("lang", "words", "phrase", "f")
    longer = known.where("words > 1").withColumnRenamed("f", "a")
    words = F.split("phrase", " ")
    # Phrases inside longer ones: a language's phrase and the most occurrences of one around it.
    inner = F.filter(
        F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda size: F.transform(
            F.sequence(F.lit(1), F.col("words") - size + 1), lambda i: F.array_join(F.slice(words, i, size), " ")))),
        lambda x: x.isNotNull())
    around = (longer.where("words > 2").select(F.col("lang").alias("lang_in"), F.explode(inner).alias("inside"), "a")
              .groupBy("lang_in", "inside").agg(F.max("a").alias("most")))
    left_out = (_whole("most") * 100 >= _whole("a") * share)
    kept = (longer.join(around, (F.col("lang") == F.col("lang_in")) & (F.col("phrase") == F.col("inside")), "left")
            .where(~F.coalesce(left_out, F.lit(False))).select("lang", "words", "phrase", "a"))
    cuts = kept.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), words.alias("w"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("head"),
                       F.array_join(F.slice("w", F.col("k") + 1, LONGEST), " ").alias("tail"))
    part = known.select(F.col("lang").alias("lang_p"), F.col("phrase").alias("part"), F.col("f"))
    scored = (cuts.join(part.withColumnRenamed("f", "l"), (F.col("lang") == F.col("lang_p")) & (F.col("head") == F.col("part")))
              .drop("lang_p", "part")
              .join(part.withColumnRenamed("f", "r"), (F.col("lang") == F.col("lang_p")) & (F.col("tail") == F.col("part"))))
    scored = (scored.withColumn("score", F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + r)"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
              .select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    few = (scored.withColumn("__salt", salt)
           .withColumn("__at", F.row_number().over(Window.partitionBy("lang", "__salt").orderBy(*order))).where(F.col("__at") <= first))
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    totals = table.where("words = 0").select(F.col("lang").alias("lang_n"), F.col("f").alias("n"))
    return (ranked.join(totals, F.col("lang") == F.col("lang_n"))
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")))

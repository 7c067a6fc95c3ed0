"""Quality rules with risk-controlled cutoffs; DataFrame functions only.

Fixed base rules reject very short and very repetitive texts. Above them stand scored rules (symbols,
repeated lines, repeated words, capitals, marks, long and short words) whose cutoffs are learnt per
stratum (the language) from labelled documents that pass the base rules:

1. The labelled rows are split by a hash into a tuning and a holdout part.
2. The tuning part proposes configurations, one per tail share in ``TAILS``: the cutoff of each rule is
   the smallest value of a fixed grid that at most that share of the stratum's good tuning rows exceed. A
   rule that a larger share of good than of bad tuning rows exceed there (or none) is left out.
3. On the holdout, k of the n good rows of the stratum are rejected by any rule of a configuration.
   The exact binomial tail P(Bin(n, risk) <= k) is the p-value of "it falsely rejects more than
   ``risk``". Configurations are tested from the mildest to the strictest and testing stops at the first
   that fails (fixed-sequence testing); the level ``delta`` is divided by the number of strata
   (Bonferroni). So with probability 1 - delta no stratum's cutoffs falsely reject more than ``risk``.
4. Of the certified configurations the one that best separates bad from good tuning rows is used; the
   mildest of equals. A stratum without a certified configuration rejects nothing beyond the base rules.

All counts are over all labelled rows and all statistics over whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetvolt.llm.common import stored, whole_row

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = "!?"
#: Shares of good tuning rows that a rule's cutoff may leave above it, mildest first.
TAILS = (0.0, 0.0005, 0.001, 0.002, 0.005, 0.01, 0.02, 0.05)
#: Grid cells of a rule's score.
CELLS = 400
RULES = ("symbols", "dup_lines", "repeats", "capitals", "marks", "long_words", "short_words")
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _count_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(_without(text, chars))).cast("long")


def _windows(words: Column) -> Column:
    """The hash of every 3-word window, in order."""
    return F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    ).otherwise(F.expr("array()").cast("array<bigint>"))


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with the base measures of every whole text (null: empty) and further counts for the
    scored rules. Every added column's name starts with ``m_``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.withColumn("m_words_", F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""))
    d = d.withColumn("m_windows_", _windows(F.col("m_words_")))
    d = d.withColumn("m_lines_", F.filter(F.split(text, "\n"), lambda x: F.length(_without(x, SPACE)) > 0))
    # The windows that are not alone: sorted by hash with their places, a neighbour has the same
    # hash. That is n log n however repetitive the text is, and not needed if all windows differ.
    d = d.withColumn("m_sorted_", F.when(
        F.size(F.array_distinct("m_windows_")) < F.size("m_windows_"),
        F.sort_array(F.transform("m_windows_", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("m_sorted_")
    d = d.withColumn("m_starts_", F.sort_array(F.transform(
        F.filter(s, lambda x, k: F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False))
                 | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False))), lambda x: x["i"])))
    starts = F.col("m_starts_")
    covered = F.aggregate(
        F.transform(starts, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - x, F.lit(3)))),
        F.lit(0), lambda a, x: a + x)
    return (d.withColumn("m_n_words", F.size("m_words_").cast("long"))
            .withColumn("m_word_chars", F.length(_without(text, SPACE)).cast("long"))
            .withColumn("m_n_symbols", _count_of(text, SYMBOLS))
            .withColumn("m_n_dup_lines", (F.size("m_lines_") - F.size(F.array_distinct("m_lines_"))).cast("long"))
            .withColumn("m_n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .withColumn("m_n_lines", F.size("m_lines_").cast("long"))
            .withColumn("m_n_capitals", _count_of(text, CAPITALS))
            .withColumn("m_n_marks", _count_of(text, MARKS))
            .withColumn("m_base_failed", (F.col("m_n_words") < 50)
                        | (100 * F.col("m_n_repeat_words") > 50 * F.col("m_n_words")))
            # Not deterministic for the optimizer: a filter on the measures stays above them. Pushed
            # below, it would write the sorted windows into the functions that run once per window.
            .withColumn("m_barrier_", F.monotonically_increasing_id())
            .drop("m_words_", "m_windows_", "m_lines_", "m_sorted_", "m_starts_"))


def _cells() -> list[Column]:
    """The grid cell of each rule's score, higher meaning worse. Scores are in [0, 1)."""
    def share(a: str, b: str) -> Column:
        return F.col(f"m_{a}") / F.greatest(F.col(f"m_{b}"), F.lit(1))
    mean = share("word_chars", "n_words")
    scores = [F.least(share("n_symbols", "n_words"), F.lit(1.0)), share("n_dup_lines", "n_lines"),
              share("n_repeat_words", "n_words"), share("n_capitals", "word_chars"),
              F.least(share("n_marks", "n_words"), F.lit(1.0)), F.least(mean / F.lit(100.0), F.lit(1.0)),
              F.lit(1.0) / F.greatest(mean, F.lit(1.0))]
    return [F.least(F.floor(x * F.lit(CELLS)), F.lit(CELLS - 1)).cast("int") for x in scores]


def log_gamma(x: Column) -> Column:
    """ln of the gamma function for x >= 1: Stirling's series seven steps further up."""
    z = x + F.lit(7.0)
    up = sum((F.log(x + F.lit(float(k))) for k in range(1, 7)), F.log(x))
    return ((z - 0.5) * F.log(z) - z + F.lit(0.9189385332046727) + 1 / (12 * z) - 1 / (360 * z * z * z)
            + 1 / (1260 * F.pow(z, F.lit(5.0))) - 1 / (1680 * F.pow(z, F.lit(7.0))) - up)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), for k up to n p; above it 1 is returned, which no test passes. The terms fall
    from k downward, and those beyond ten standard deviations are less than rounding."""
    nf, kf = n.cast("double"), k.cast("double")
    first = F.exp(log_gamma(nf + 1) - log_gamma(kf + 1) - log_gamma(nf - kf + 1)
                  + kf * F.log(F.lit(p)) + (nf - kf) * F.log(F.lit(1 - p)))
    terms = F.least(kf, F.ceil(10 * F.sqrt(nf * p * (1 - p))) + 50).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(0), terms), F.struct(first.alias("term"), F.lit(0.0).alias("sum")),
        lambda a, i: F.struct((a["term"] * (kf - i) * (1 - p) / ((nf - kf + i + 1) * p)).alias("term"),
                              (a["sum"] + a["term"]).alias("sum")),
        lambda a: a["sum"])
    return F.when(kf > nf * p, F.lit(1.0)).otherwise(F.least(total, F.lit(1.0)))


def cutoffs(labelled: DataFrame, risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """(stratum, cuts): the certified cutoff cell of every rule, in the order of ``RULES``; a score in a
    higher cell is rejected. ``labelled`` has id, stratum, good (boolean) and cells (one per rule); a
    stratum without a certified configuration has no row."""
    part = F.pmod(F.crc32(F.concat(F.lit("holdout:"), F.col("id").cast("string")).cast("binary")), F.lit(3))
    rows = labelled.select("stratum", "good", "cells", (F.coalesce(part, F.lit(0)) != 0).alias("holdout"))
    # How many good and bad tuning rows lie in each cell of each rule, and from that those above it.
    counts = (rows.where("NOT holdout").select("stratum", "good", F.posexplode("cells").alias("rule", "cell"))
              .groupBy("stratum", "rule", "cell")
              .agg(F.count_if("good").alias("n"), F.count_if(~F.col("good")).alias("bad")))
    w = Window.partitionBy("stratum", "rule")
    over = w.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    def above(c: str) -> Column:
        return F.coalesce(F.sum(c).over(over), F.lit(0))
    shares = (counts.withColumn("lost", above("n")).withColumn("caught", above("bad"))
              .withColumn("all", F.sum("n").over(w)).withColumn("all_bad", F.sum("bad").over(w)).where("all > 0"))
    # The lowest cutoff that the tail share allows; a rule that does not tell bad from good there
    # rejects nothing, so that it does not use up the risk of the others.
    tails = (shares.withColumn("level", F.explode(F.array([F.struct(F.lit(i).alias("at"), F.lit(t).alias("tail"))
                                                           for i, t in enumerate(TAILS)])))
             .where(F.col("lost") <= F.col("level.tail") * F.col("all"))
             .groupBy("stratum", "rule", F.col("level.at").alias("at"))
             .agg(F.min(F.struct("cell", "lost", "caught", "all", "all_bad")).alias("c"))
             .select("stratum", "rule", "at", F.when(
                 F.col("c.caught") * F.col("c.all") > F.col("c.lost") * F.col("c.all_bad"), F.col("c.cell"))
                 .otherwise(F.lit(CELLS)).alias("cut")))
    plans = (tails.groupBy("stratum", "at")
             .agg(F.transform(F.sort_array(F.collect_list(F.struct("rule", "cut"))), lambda x: x["cut"]).alias("cuts"))
             .groupBy("stratum").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "cuts"))),
                                                 lambda x: x["cuts"]).alias("plans")))
    plans = stored(plans, "plans")

    def rejected(cells: Column, cuts: Column) -> Column:
        return F.exists(F.zip_with(cells, cuts, lambda c, t: c > t), lambda x: x)
    # Which configurations reject a row: one number per configuration, summed in one aggregate.
    flags = F.transform("plans", lambda cuts: rejected(F.col("cells"), cuts).cast("int"))
    named = plans.withColumnRenamed("stratum", "of")
    seen = rows.join(named, F.col("stratum").eqNullSafe(F.col("of"))).withColumn("flags", flags)
    sums = seen.groupBy("stratum").agg(
        *[F.sum(F.when(cond, F.get("flags", F.lit(i))).otherwise(0)).alias(f"{name}{i}")
          for i in range(len(TAILS))
          for name, cond in (("k", F.expr("good AND holdout")), ("lost", F.expr("good AND NOT holdout")),
                             ("caught", F.expr("NOT good AND NOT holdout")))],
        F.count_if(F.expr("good AND holdout")).alias("n"), F.count_if(F.expr("good AND NOT holdout")).alias("good"),
        F.count_if(F.expr("NOT good AND NOT holdout")).alias("bad"))
    tests = sums.select("stratum", "n", F.explode(F.array(*[F.struct(
        F.lit(i).alias("at"), F.col(f"k{i}").alias("k"),
        (F.col(f"caught{i}") / F.greatest("bad", F.lit(1)) - F.col(f"lost{i}") / F.greatest("good", F.lit(1))).alias("gain"))
        for i in range(len(TAILS))])).alias("t")).select("stratum", "n", "t.*")
    strata = F.size(F.collect_set(F.coalesce(F.concat(F.lit("s"), F.col("stratum")), F.lit(""))).over(Window.partitionBy()))
    tests = tests.withColumn("p", binomial_tail(F.col("n"), F.col("k"), risk)).withColumn("strata", strata)
    failed = F.max((F.col("p") > F.lit(delta) / F.col("strata")).cast("int")).over(
        Window.partitionBy("stratum").orderBy("at"))
    best = (tests.withColumn("failed", failed).where("failed = 0 AND gain > 0").groupBy("stratum")
            .agg(F.max(F.struct("gain", (-F.col("at")).alias("mild"))).alias("b"))
            .select("stratum", (-F.col("b.mild")).alias("at")))
    return best.join(named, F.col("stratum").eqNullSafe(F.col("of"))).select("stratum", F.get("plans", "at").alias("cuts"))


def labelled_rows(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled rows that pass the base rules, as :func:`cutoffs` takes them. A document labelled
    several times is good if all its labels say so."""
    known = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
             .agg((F.min("quality") == 1).alias("good")).withColumnRenamed("doc_id", "id"))
    rows = measured.where("NOT m_base_failed").select(
        F.col("doc_id").alias("own"), F.col("lang").alias("stratum"), F.array(*_cells()).alias("cells"))
    return rows.join(known, F.col("own") == F.col("id")).select("id", "stratum", "good", "cells")


def judged(measured: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add ``m_kept``: the base rules and the stratum's cutoffs."""
    of = cuts.select(F.col("stratum").alias("m_of"), F.col("cuts").alias("m_cuts"))
    d = measured.withColumn("m_cells", F.array(*_cells()))
    d = d.join(of, F.col("lang").eqNullSafe(F.col("m_of")), "left")
    worse = F.exists(F.zip_with("m_cells", "m_cuts", lambda c, t: c > t), lambda x: x)
    return d.withColumn("m_kept", ~F.col("m_base_failed") & ~F.coalesce(worse, F.lit(False))).drop("m_of", "m_cuts", "m_cells")


def quality_report(docs: DataFrame, labels: DataFrame, risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept. A null text counts as empty and fails the base rules; a null language is a
    stratum of its own; repeated rows are rows of their own. Without labels only the base rules reject. Other
    columns of ``docs`` are not read. An empty table gives an empty result."""
    m = stored(measures(docs.select("doc_id", "text", "lang")).drop("text"), "measures")
    out = judged(m, cutoffs(labelled_rows(m, labels), risk, delta))
    return out.select("doc_id", *[F.col(f"m_{c}").alias(c) for c in MEASURES],
                      F.col("m_base_failed").alias("base_failed"), F.col("m_kept").alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns. The measures are stored beside the rows: they
    cost much more than the copy."""
    rows = docs.select(F.col("doc_id").alias("m_id"), F.col("text").alias("m_text"), F.col("lang").alias("m_lang"), whole_row(docs).alias("m_row"))
    m = stored(measures(rows.withColumnsRenamed({"m_id": "doc_id", "m_text": "text", "m_lang": "lang"})).drop("text"), "measures")
    cuts = stored(cutoffs(labelled_rows(m, labels), risk, delta), "cuts")
    return judged(m, cuts).where("m_kept").select("m_row.*")

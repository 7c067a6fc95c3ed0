"""Report calendar: stored snapshots, sent dates, missing and unsent dates, gaps.

All dates are DateType; text labels such as ``5Jan26`` exist only at the edges, so
``05Jan26`` and ``5Jan26`` are the same date and sorting is by date, not by text.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetvolt import constants as K
from fleetvolt.functions.dates import parse_label
from fleetvolt.functions.timecalc import date_lit

_NAME = (rf"^{K.SNAPSHOT_PREFIX}([^_]+)(?:_({K.SOURCE_CURRENT}|{K.SOURCE_LEGACY}))?"
         + K.SNAPSHOT_SUFFIX.replace(".", r"\.") + "$")
#: Source of a snapshot whose name has no suffix.
UNMARKED = "unmarked"


def catalogue_from_files(files: DataFrame, column: str = "file_name") -> DataFrame:
    """``(report_date, source)`` of snapshot files named ``latest_batt_<label>_<source>.csv``. A name
    without the source suffix counts as a snapshot of the source ``unmarked``; other names are
    ignored."""
    f = F.col(column)
    label = F.regexp_extract(f, _NAME, 1)
    src = F.regexp_extract(f, _NAME, 2)
    out = files.select(parse_label(F.nullif(label, F.lit(""))).alias("report_date"),
                       F.when(src == "", F.lit(UNMARKED)).otherwise(src).alias("source"))
    return out.where("report_date IS NOT NULL AND source IS NOT NULL").distinct()


def catalogue_summary(catalogue: DataFrame, preferred: str = K.SOURCE_CURRENT) -> DataFrame:
    """Per date: which sources exist and the one to read (the preferred source if present)."""
    has = lambda s: F.max(F.when(F.col("source") == s, 1).otherwise(0))
    other = K.SOURCE_LEGACY if preferred == K.SOURCE_CURRENT else K.SOURCE_CURRENT
    agg = catalogue.groupBy("report_date").agg(has(preferred).alias("has_preferred"),
                                              has(other).alias("has_other"))
    return agg.select("report_date", "has_preferred", "has_other",
                      F.when(F.col("has_preferred") == 1, F.lit(preferred))
                      .when(F.col("has_other") == 1, F.lit(other)).otherwise(F.lit(UNMARKED))
                      .alias("read_source"))


def sent_dates(lines: DataFrame, column: str = "value") -> DataFrame:
    """Distinct dates of a sent-date log (one label per line). Blank lines are skipped; a line that is
    no label raises when it is read, as its date would otherwise count as unsent and go out again."""
    t = F.trim(F.col(column))
    unreadable = F.raise_error(F.concat(F.lit("sent-date log: not a date label: "), t)).cast("date")
    return lines.where(t != "").select(F.coalesce(parse_label(t), unreadable).alias("report_date")).distinct()


def _dates_between(start, end) -> F.Column:
    return F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY")))


def missing_since_sent(catalogue: DataFrame, sent: DataFrame, today: date,
                       fallback_days: int = K.WEEK_DAYS) -> DataFrame:
    """Dates from the day after the last sent date (or ``today - fallback_days`` when nothing
    was sent) through ``today`` that have no snapshot in any source."""
    t = date_lit(today)
    bounds = sent.agg(F.max("report_date").alias("_last"))
    start = F.coalesce(F.date_add("_last", 1), F.date_sub(t, fallback_days))
    cal = bounds.select(_dates_between(start, t).alias("report_date"))
    have = catalogue.select("report_date").distinct()
    return cal.join(have, "report_date", "left_anti")


def required_dates(catalogue: DataFrame, today: date, days: int = K.WEEK_DAYS) -> DataFrame:
    """The last ``days`` dates through ``today`` (the weekly report's default window)."""
    t = date_lit(today)
    return catalogue.sparkSession.range(1).select(
        _dates_between(F.date_sub(t, days - 1), t).alias("report_date"))


def missing_in_window(catalogue: DataFrame, today: date, days: int = K.WEEK_DAYS) -> DataFrame:
    have = catalogue.select("report_date").distinct()
    return required_dates(catalogue, today, days).join(have, "report_date", "left_anti")


def unsent_dates(catalogue: DataFrame, sent: DataFrame) -> DataFrame:
    """Dates with a snapshot that are not in the sent log."""
    return (catalogue.select("report_date").distinct()
            .join(sent.select("report_date"), "report_date", "left_anti"))


def snapshot_gaps(catalogue: DataFrame, today: date, days: int = K.WEEK_DAYS,
                  preferred: str = K.SOURCE_CURRENT) -> DataFrame:
    """Required dates that block the weekly report: ``missing`` (no snapshot at all) or
    ``not_preferred`` (only the other source exists, but only the preferred one is read)."""
    summ = catalogue_summary(catalogue, preferred)
    req = required_dates(catalogue, today, days)
    j = req.join(summ, "report_date", "left")
    gap = (F.when(F.col("has_preferred").isNull(), F.lit("missing"))
           .when(F.col("has_preferred") == 0, F.lit("not_preferred")))
    return j.select("report_date", gap.alias("gap")).where("gap IS NOT NULL")

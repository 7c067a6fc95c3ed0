"""The sent-date log: one entry per date, named by its label (``5Jan26``).

Reading takes every line of the log's files: skips blank lines, accepts labels with or without a leading zero and returns
distinct dates; a missing log is an empty log. Appending creates the date's entry if it does not exist yet, so of several
writers exactly one adds a date, and a re-run or a retried job adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from fleetvolt import schemas
from fleetvolt.functions.dates import date_label
from fleetvolt.operators.calendar import sent_dates
from fleetvolt.sources.commits import create_new, names


def read_sent_dates(spark: SparkSession, path: str) -> DataFrame:
    if not names(spark, path) and not path.endswith(".txt"):
        return spark.createDataFrame([], schemas.SENT_DATES)
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        return spark.createDataFrame([], schemas.SENT_DATES)
    return sent_dates(lines)


def append_sent_dates(spark: SparkSession, path: str, dates: DataFrame) -> DataFrame:
    """Add the ``report_date`` values of ``dates`` that the log does not hold yet; returns the dates that this call
    added."""
    new = (dates.select("report_date").where("report_date IS NOT NULL").distinct()
           .join(read_sent_dates(spark, path), "report_date", "left_anti"))
    rows = new.select("report_date", date_label("report_date").alias("label")).collect()  # at most one per calendar day reported
    added = [(r.report_date,) for r in rows
             if create_new(spark, f"{path.rstrip('/')}/{r.report_date.isoformat()}.txt", f"{r.label}\n".encode())]
    return spark.createDataFrame(added, schemas.SENT_DATES)

"""Reader for snapshot CSV files written by the original application.

Each file ``latest_batt_<dMMMyy>_<smbs|debug>.csv`` starts with a preamble::

    ### METADATA ###
    query_time,<seconds>
    ### DATA ###
    <CSV with header>

All files of one source are read in one scan: the preamble and the header line are separated
from the data by their whole content, and the date and
source come from each row's file name (``_metadata.file_name``). The two sources lay out
their columns differently, so each source is read with its own schema.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetvolt import constants as K
from fleetvolt import schemas
from fleetvolt.functions.dates import parse_label
from fleetvolt.operators.payload import parse_time_column

# Column order of the stored files (fixed by the original writer).
CURRENT_FILE_COLUMNS = ["ReportID", "OrganizationId", "CustomerName", "AssetId", "DeviceID",
                        "DeviceName", "EventTimeUTC", "Voltage", "PowerMode"]
LEGACY_FILE_COLUMNS = ["DeviceID", "DeviceName", "EventTimeUTC", "PayloadData", "Voltage", "PowerMode"]


_CORRUPT = "_corrupt_line"


def _raw(spark: SparkSession, folder: str, source: str, columns: list[str], dates: Sequence[date] | None) -> DataFrame:
    """The lines of the files, with the file's name and the text of a line whose number of fields is not the file's. With
    ``dates`` only their files are opened: the predicate on the file name prunes the listing."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, _CORRUPT)])
    pattern = f"{folder.rstrip('/')}/{K.SNAPSHOT_PREFIX}*_{source}{K.SNAPSHOT_SUFFIX}"
    df = (spark.read.schema(schema).option("header", False).option("columnNameOfCorruptRecord", _CORRUPT)
          .option("mode", "PERMISSIVE").option("columnPruning", "false").csv(pattern))
    if dates is not None:
        labels = {label for d in dates for label in (f"{d:%d%b%y}", f"{d.day}{d:%b%y}")}
        df = df.where(F.col("_metadata.file_name").isin([f"{K.SNAPSHOT_PREFIX}{x}_{source}{K.SNAPSHOT_SUFFIX}" for x in sorted(labels)]))
    return df.withColumn("file_name", F.col("_metadata.file_name"))


def _lines(spark: SparkSession, folder: str, source: str, dates: Sequence[date] | None) -> DataFrame:
    """The lines with their ``report_date``, ``source`` and ``kind``: ``seconds``, ``preamble``, ``malformed`` or ``row``."""
    cols = CURRENT_FILE_COLUMNS if source == K.SOURCE_CURRENT else LEGACY_FILE_COLUMNS
    raw = _raw(spark, folder, source, cols, dates)
    label = F.regexp_extract("file_name", rf"^{K.SNAPSHOT_PREFIX}(.+)_{source}", 1)
    # The preamble's lines are told by all that they hold, so a data row that begins with "#", or
    # with nothing, stays a data row.
    first, second, third = (F.col(c) for c in cols[:3])
    timed = F.coalesce((first == "query_time") & third.isNull(), F.lit(False))
    heading = F.coalesce((first == cols[0]) & (second == cols[1]) & (third == cols[2]), F.lit(False))
    marker = F.coalesce(first.isin("### METADATA ###", "### DATA ###") & second.isNull(), F.lit(False))
    kind = (F.when(timed, "seconds").when(heading | marker, "preamble").when(F.col(_CORRUPT).isNotNull(), "malformed").otherwise("row"))
    return raw.withColumns({"report_date": parse_label(label), "source": F.lit(source), "kind": kind})


def malformed_lines(spark: SparkSession, folder: str, source: str, dates: Sequence[date] | None = None) -> DataFrame:
    """``report_date, source, n_lines`` of the files that have lines with too few or too many fields. Such lines are no rows."""
    return (_lines(spark, folder, source, dates).where("kind = 'malformed'").groupBy("report_date", "source")
            .agg(F.count("*").alias("n_lines")))


def read_snapshot_files(spark: SparkSession, folder: str, source: str,
                        dates: Sequence[date] | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns ``(rows, runs)``: typed snapshot rows with ``report_date`` and ``source``,
    and one row per file with ``report_date, source, query_seconds``. ``dates`` restricts the files that are opened."""
    current = source == K.SOURCE_CURRENT
    cols = CURRENT_FILE_COLUMNS if current else LEGACY_FILE_COLUMNS
    lines = _lines(spark, folder, source, dates)
    runs = (lines.where("kind = 'seconds'")
            .select("report_date", "source", F.col(cols[1]).try_cast("double").alias("query_seconds")))
    rows = lines.where("kind = 'row'")
    target = schemas.SNAPSHOT if current else schemas.LEGACY_SNAPSHOT
    types = {f.name: f.dataType for f in target.fields}
    typed = rows.select(*[
        (F.col(c).try_cast(types[c]) if c in types and c != "EventTimeUTC" and types[c] != T.StringType()
         else F.col(c)).alias(c) for c in cols], "report_date", "source")
    typed = parse_time_column(typed, "EventTimeUTC")
    return typed, runs

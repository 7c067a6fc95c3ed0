"""Legacy payload parsing, label quality, whole-column time-format detection, profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetvolt import constants as K
from fleetvolt.config import PowerBands
from fleetvolt.functions.bands import power_band
from fleetvolt.functions.payload import payload_mode, payload_voltage


def parse_payload(df: DataFrame, column: str = "PayloadData") -> DataFrame:
    """Add ``Voltage`` (NULL when the payload has no decimal level) and ``PayloadMode``
    (the label word, or ``None``)."""
    return df.withColumns({"Voltage": payload_voltage(column), "PayloadMode": payload_mode(column)})


def drop_unparsed(parsed: DataFrame) -> DataFrame:
    """Rows whose voltage could be read (the others are rejected, see ``unparsed_count``)."""
    return parsed.where(F.col("Voltage").isNotNull())


def unparsed_count(parsed: DataFrame) -> DataFrame:
    return parsed.agg(F.count_if(F.col("Voltage").isNull()).alias("rejected"),
                      F.count(F.lit(1)).alias("n_rows"))


def label_quality(parsed: DataFrame, valid: Sequence[str] = K.MODES) -> DataFrame:
    """Rows per payload label that is not one of the four band names (the report lists these
    labels and how many devices carry them). The band itself always comes from the voltage."""
    return (parsed.where(~F.col("PayloadMode").isin(list(valid)))
            .groupBy("PayloadMode").agg(F.count(F.lit(1)).alias("n_rows")))


def _is_date(year, month, day):
    """Whether whole numbers are a date of the proleptic Gregorian calendar."""
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    days = F.when(month == 2, F.when(leap, F.lit(29)).otherwise(F.lit(28))).when(month.isin(4, 6, 9, 11), F.lit(30)).otherwise(F.lit(31))
    return (year >= 0) & month.between(1, 12) & (day >= 1) & (day <= days)


def _fitting(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """One row per ``by``, text shape and date text: how many values, and whether the date fits each of ``K.TIME_FORMATS``."""
    c = F.col(column)
    shape = F.when(c.rlike(K.ISO_SHAPE), F.lit(1)).when(c.rlike(K.SLASH_SHAPE), F.lit(2)).when(c.isNotNull(), F.lit(0))
    dates = (df.select(*by, shape.alias("_shape"), F.when(shape > 0, F.substring_index(c, " ", 1)).alias("_date"))
             .groupBy(*by, "_shape", "_date").agg(F.count("_shape").alias("_n")))
    part = F.split("_date", "[-/]")
    a, b, y = (F.get(part, F.lit(i)).try_cast("int") for i in range(3))
    fits = [(F.col("_shape") == 1) & _is_date(a, b, y), (F.col("_shape") == 2) & _is_date(y, b, a),
            (F.col("_shape") == 2) & _is_date(y, a, b)]
    return dates.select(*by, "_n", *[(F.col("_shape").isNull() | F.coalesce(f, F.lit(False))).alias(f"_fits{i}") for i, f in enumerate(fits)])


def time_format_choice(df: DataFrame, column: str, by: Sequence[str] = (),
                       formats: Sequence[str] = K.TIME_FORMATS) -> DataFrame:
    """Which of ``formats`` parses *every* non-NULL value of ``column`` (first one wins):
    one aggregate pass. Returns ``by`` columns plus ``format_index`` (1-based, NULL when no
    format fits all values) and ``n_values`` (non-NULL count).

    For the fixed formats no text is parsed on trial: the pass tests the digits' shape with the ranges of the time of day
    and counts the distinct date texts, and only those (as many as there are days) are held against the calendar.
    Other formats are tried on every value."""
    if tuple(formats) == K.TIME_FORMATS:
        rows = _fitting(df, column, by)
        oks = [F.bool_and(f"_fits{i}").alias(f"_ok{i}") for i in range(len(formats))]
        agg = rows.groupBy(*by).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_values"), *oks)
    else:
        c = F.col(column)
        oks = [F.bool_and(c.isNull() | F.try_to_timestamp(c, F.lit(f)).isNotNull()).alias(f"_ok{i}") for i, f in enumerate(formats)]
        agg = df.groupBy(*by).agg(F.count(c).alias("n_values"), *oks)
    choice = F.lit(None).cast("int")
    for i in reversed(range(len(formats))):
        choice = F.when(F.col(f"_ok{i}"), F.lit(i + 1)).otherwise(choice)
    return agg.select(*by, choice.alias("format_index"), "n_values")


def parse_time_column(df: DataFrame, column: str = "EventTimeUTC",
                      formats: Sequence[str] = K.TIME_FORMATS) -> DataFrame:
    """Convert ``column`` to TIMESTAMP_NTZ if it is not one already.

    Text is parsed with the first format that fits the whole column, decided by one aggregate
    that Spark evaluates once as a scalar subquery; when none fits, Spark's general timestamp
    cast is tried per value (NULL when it fails)."""
    dtype = dict(df.dtypes)[column]
    if dtype == "timestamp_ntz":
        return df
    if dtype in ("timestamp", "date"):
        return df.withColumn(column, F.col(column).cast("timestamp_ntz"))
    idx = time_format_choice(df, column, formats=formats).select("format_index").scalar()
    parsed = F.col(column).try_cast("timestamp_ntz")
    for i in reversed(range(len(formats))):
        parsed = F.when(idx == F.lit(i + 1), F.to_timestamp_ntz(F.col(column), F.lit(formats[i]))) \
            .otherwise(parsed)
    return df.withColumn(column, parsed)


def voltage_profile(snapshot: DataFrame, modes: Sequence[str] = K.MODES + (K.UNKNOWN_MODE,)) -> DataFrame:
    """Row count, voltage min / max / mean (4 decimals) and rows per mode, in one aggregate."""
    return snapshot.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("Voltage").alias("min_voltage"), F.max("Voltage").alias("max_voltage"),
        F.round(F.avg("Voltage"), 4).alias("mean_voltage"),
        *[F.count_if(F.col("PowerMode") == F.lit(m)).alias(f"n_{m}") for m in modes])


def legacy_power_mode(parsed: DataFrame, bands: PowerBands = PowerBands()) -> DataFrame:
    """Band from the parsed voltage (exclusive thresholds), replacing the payload label."""
    return parsed.withColumn("PowerMode", power_band("Voltage", bands))

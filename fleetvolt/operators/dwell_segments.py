"""Segments of operating time, merged level by level.

A segment stands for consecutive readings of one asset: the minute of its first reading, the minute, time, id and band of
its last one, the number of readings and the minutes spent in each band between them. Two segments in a row make one
segment: the minutes between the last reading of the first and the first reading of the second belong to the band of the
first's last reading. That is associative, so readings can be merged in any nesting that keeps their order:

* a minute is one segment by an ordinary aggregate, which every task begins before the shuffle. Only minute boundaries count
  as time, so inside a minute nothing but its last reading matters, however many readings it has;
* the minutes of a day (at most 1,440 rows) are merged, and then the days of an asset.

No level needs to know how the readings are spread over assets or times, so there is no hot-asset table, and the
readings are scanned once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetvolt import constants as K
from fleetvolt.config import PowerBands
from fleetvolt.functions.bands import power_band_code
from fleetvolt.functions.timecalc import minute_index

MINUTES = [f"Minutes{m}" for m in K.MODES]
SEGMENT = ["FirstMinute", "LastMinute", "LastTime", "LastId", "LastBand", "Readings", *MINUTES]
_ORDER = ["FirstMinute", "LastTime", "LastId"]
_DAY = 24 * 60


def minute_segments(readings: DataFrame, bands: PowerBands = PowerBands(), by: Sequence[str] = ("AssetId",)) -> DataFrame:
    """One segment for each minute of each ``by`` with readings. Readings without a time or an asset have no length and are
    left out. Readings that tie on time come by id, null ids first."""
    r = readings.where(F.col("AssetId").isNotNull() & F.col("EventTime").isNotNull()).select(
        *by, minute_index("EventTime").alias("FirstMinute"),
        F.struct(F.col("EventTime").alias("LastTime"), F.col("ID").alias("LastId"),
                 power_band_code("Voltage", bands, inclusive=True).alias("LastBand")).alias("_last"))
    m = r.groupBy(*by, "FirstMinute").agg(F.max("_last").alias("_last"), F.count("*").alias("Readings"))
    return m.select(*by, "FirstMinute", F.col("FirstMinute").alias("LastMinute"), "_last.*", "Readings",
                    *[F.lit(0).cast("long").alias(c) for c in MINUTES])


def merged(segments: DataFrame, by: Sequence[str]) -> DataFrame:
    """One segment for each ``by`` from its segments. All of a group's segments are in one task: pass groups of bounded
    size (the minutes of a day, the days of an asset)."""
    gap = F.lead("FirstMinute").over(Window.partitionBy(*by).orderBy(*_ORDER)) - F.col("LastMinute")
    s = segments.withColumn("_gap", F.coalesce(gap, F.lit(0)))
    spent = [F.sum(F.col(c) + F.when(F.col("LastBand") == i, F.col("_gap")).otherwise(F.lit(0))).alias(c) for i, c in enumerate(MINUTES)]
    m = s.groupBy(*by).agg(F.min("FirstMinute").alias("FirstMinute"), F.sum("Readings").alias("Readings"), *spent,
                           F.max(F.struct("LastTime", "LastId", "LastBand", "LastMinute")).alias("_last"))
    return m.select(*by, "FirstMinute", *[F.col(f"_last.{c}").alias(c) for c in ("LastMinute", "LastTime", "LastId", "LastBand")],
                    "Readings", *MINUTES)


def by_day(segments: DataFrame) -> DataFrame:
    """With the day on which a minute's segment lies."""
    return segments.withColumn("_day", F.expr(f"FirstMinute div {_DAY}"))


def asset_segments(readings: DataFrame, bands: PowerBands = PowerBands()) -> DataFrame:
    """One segment for each asset: all its readings, merged by minute, day and asset."""
    days = merged(by_day(minute_segments(readings, bands)), ["AssetId", "_day"])
    return merged(days, ["AssetId"])


def _new_run(previous: Column, by: Column) -> Column:
    return F.when(previous.eqNullSafe(by), F.lit(0)).otherwise(F.lit(1))


def compacted(runs: DataFrame) -> DataFrame:
    """Neighbouring runs of an asset that carry the same organization made one run."""
    w = Window.partitionBy("AssetId").orderBy(*_ORDER)
    first = F.lag(F.lit(1)).over(w).isNull()
    starts = runs.withColumn("_new", F.when(first, F.lit(1)).otherwise(
        _new_run(F.lag("OrganizationId").over(w), F.col("OrganizationId"))))
    numbered = starts.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return merged(numbered.drop("_new"), ["AssetId", "OrganizationId", "_run"]).drop("_run")


def organization_runs(readings: DataFrame, bands: PowerBands = PowerBands()) -> DataFrame:
    """One segment for each run of an asset's readings that carry the same organization (null is one of its own).

    A minute with readings of several organizations is a run for each of them, in the order of their last readings: inside
    a minute only the last reading of the selected organizations counts, whichever these are. So any choice of organizations
    selects whole runs, and merging them gives what merging the selected readings would."""
    cells = by_day(minute_segments(readings, bands, by=("AssetId", "OrganizationId")))
    day = Window.partitionBy("AssetId", "_day")
    w = day.orderBy(*_ORDER)
    cells = cells.withColumn("_shared", F.count("*").over(day.orderBy("FirstMinute").rangeBetween(0, 0)) > 1)
    new = F.when(F.col("_shared") | F.coalesce(F.lag("_shared").over(w), F.lit(True)), F.lit(1)).otherwise(
        _new_run(F.lag("OrganizationId").over(w), F.col("OrganizationId")))
    numbered = cells.withColumn("_new", new).withColumn(
        "_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    days = merged(numbered.drop("_new", "_shared"), ["AssetId", "_day", "OrganizationId", "_run"])
    return compacted(days.drop("_day", "_run"))

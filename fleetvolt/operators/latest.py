"""Latest state of every device.

* ``latest_reading``      newest valid reading per asset, optionally as of a moment
* ``latest_as_of_moments``, ``latest_as_of_many``   the same for many moments or dates in one pass (weekly backfill)
* ``enrich``              attach device id/name and owner name to the winners
* ``legacy_latest``       newest qualifying raw uplink per device (legacy source)
* ``recent_sample``       newest N uplinks of one customer

Plans: ``row_number() = 1`` over ``(asset ORDER BY time DESC, id DESC)`` is planned by Spark as
a partial WindowGroupLimit before the shuffle and a final one after it, so each map task sends
at most one row per asset: an asset holding a third of all readings costs no more shuffle
than any other. Joins to assets and organizations happen after ranking (one row per asset);
both are left joins on unique keys, so the order change keeps the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetvolt import constants as K
from fleetvolt.config import PowerBands
from fleetvolt.functions.bands import power_band
from fleetvolt.functions.text import equals_ignore_case
from fleetvolt.functions.timecalc import day_at_hour, micros_index, ntz

SNAPSHOT_COLUMNS = ["ReportID", "OrganizationId", "CustomerName", "AssetId", "DeviceID",
                    "DeviceName", "EventTimeUTC", "Voltage"]


def _valid(readings: DataFrame, valid_min: float | None) -> DataFrame:
    """Readings above ``valid_min``. NaN counts as missing; the plain comparison, which alone it would
    pass, is still pushed to the scan."""
    if valid_min is None:
        return readings
    return readings.where((F.col("Voltage") > F.lit(valid_min)) & ~F.isnan("Voltage"))


def time_range(df: DataFrame, ts: str, lo: datetime | F.Column | None = None,
               hi: datetime | None = None, lo_inclusive: bool = True) -> DataFrame:
    """``lo <= ts <= hi`` (either bound optional). When the table is stored partitioned by day
    (a ``event_date`` column), the same bounds are also written on that column, so that whole
    days outside the range are never listed or read (Spark does not derive a partition filter
    from a timestamp bound by itself)."""
    part = K.DATE_PARTITION in df.columns
    if lo is not None:
        lo_c = ntz(lo) if isinstance(lo, datetime) else lo
        df = df.where(F.col(ts) >= lo_c if lo_inclusive else F.col(ts) > lo_c)
        if part:
            df = df.where(F.col(K.DATE_PARTITION) >= F.to_date(lo_c))
    if hi is not None:
        df = df.where(F.col(ts) <= ntz(hi))
        if part:
            df = df.where(F.col(K.DATE_PARTITION) <= F.lit(hi.date().isoformat()).cast("date"))
    return df


def latest_reading(readings: DataFrame, as_of: datetime | None = None,
                   valid_min: float | None = K.VALID_MIN_VOLTS) -> DataFrame:
    """Newest valid reading per asset with ``EventTime <= as_of`` (no bound when None).

    Ties on time go to the larger reading id. Returns ``ReportID, OrganizationId, AssetId,
    EventTimeUTC, Voltage``. The validity and time filters reach the parquet scan.
    """
    r = time_range(_valid(readings, valid_min), "EventTime", hi=as_of)
    w = Window.partitionBy("AssetId").orderBy(F.col("EventTime").desc_nulls_last(),
                                              F.col("ID").desc_nulls_last())
    top = r.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return top.select(F.col("ID").alias("ReportID"), "OrganizationId", "AssetId",
                      F.col("EventTime").alias("EventTimeUTC"), "Voltage")


def latest_reading_incremental(previous: DataFrame, readings: DataFrame, previous_as_of: datetime,
                               as_of: datetime, valid_min: float | None = K.VALID_MIN_VOLTS) -> DataFrame:
    """``latest_reading(readings, as_of)`` computed from the latest state as of
    ``previous_as_of`` (a stored snapshot with ``ReportID, OrganizationId, AssetId,
    EventTimeUTC, Voltage``) and only the readings in ``(previous_as_of, as_of]``.

    Latest-per-asset is a maximum, so it can be maintained incrementally: a daily run then reads
    one day of readings (one partition of a day-partitioned table) plus one row per asset,
    instead of the whole history. The result equals the full computation provided no reading
    with a time at or before ``previous_as_of`` arrived after the previous state was built
    (late data needs a full rebuild: ``latest_reading``)."""
    if previous_as_of >= as_of:
        raise ValueError("previous_as_of must be before as_of")
    new = time_range(_valid(readings, valid_min), "EventTime", previous_as_of, as_of, lo_inclusive=False)
    cols = ["ID", "OrganizationId", "AssetId", "EventTime", "Voltage"]
    old = previous.select(F.col("ReportID").alias("ID"), "OrganizationId", "AssetId",
                          F.col("EventTimeUTC").alias("EventTime"), "Voltage")
    both = old.select(*cols).unionByName(new.select(*cols))
    return latest_reading(both, None, valid_min=None)


def enrich(latest: DataFrame, assets: DataFrame, organizations: DataFrame) -> DataFrame:
    """Attach ``DeviceID`` (the asset's device name), ``DeviceName`` (the asset name) and
    ``CustomerName`` (name of the reading's organization). Left joins: nothing is dropped.

    The join strategy is Spark's: a side is broadcast only when its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run time), else sort-merge.
    """
    a = assets.select(F.col("ID").alias("_aid"), F.col("DeviceName").alias("DeviceID"),
                      F.col("Name").alias("DeviceName"))
    o = organizations.select(F.col("ID").alias("_oid"), F.col("Name").alias("CustomerName"))
    out = (latest.join(a, latest.AssetId == a._aid, "left")
           .join(o, latest.OrganizationId == o._oid, "left"))
    extra = [c for c in latest.columns if c not in SNAPSHOT_COLUMNS]
    return out.select(*SNAPSHOT_COLUMNS, *extra)


def with_power_mode(df: DataFrame, bands: PowerBands = PowerBands(), column: str = "Voltage",
                    inclusive: bool = False, null_band: str = K.UNKNOWN_MODE) -> DataFrame:
    return df.withColumn("PowerMode", power_band(column, bands, inclusive, null_band))


def latest_snapshot(readings: DataFrame, assets: DataFrame, organizations: DataFrame,
                    as_of: datetime | None = None, bands: PowerBands = PowerBands(),
                    valid_min: float | None = K.VALID_MIN_VOLTS) -> DataFrame:
    """Snapshot layout with ``PowerMode`` (the current-source daily snapshot)."""
    snap = enrich(latest_reading(readings, as_of, valid_min), assets, organizations)
    return with_power_mode(snap, bands)


def latest_as_of_moments(readings: DataFrame, moments: Sequence[datetime],
                         valid_min: float | None = K.VALID_MIN_VOLTS) -> DataFrame:
    """Latest valid reading per asset as of each of ``moments`` (any timestamps, in any order), one pass: columns
    ``as_of, ReportID, OrganizationId, AssetId, EventTimeUTC, Voltage``.

    Each reading is assigned to the first moment at or after it (index ``k``); the newest
    reading per ``(asset, k)`` is found with the same partial/final top-1 as
    ``latest_reading``; then each winner stays current from moment ``k`` until the asset's
    next winner, which a window over the small per-asset table of winners gives (at most
    ``len(moments)`` rows per asset, so a hot asset stays small here too). The output has one row
    per (moment, asset that had a reading by then), which is the size of the answer itself;
    no calendar join and no loop over moments.
    """
    cuts = sorted(set(moments))
    if not cuts:
        raise ValueError("moments must not be empty")
    r = time_range(_valid(readings, valid_min), "EventTime", hi=cuts[-1])
    w = Window.partitionBy("AssetId", "_k").orderBy(F.col("EventTime").desc_nulls_last(),
                                                    F.col("ID").desc_nulls_last())
    top = r.withColumn("_k", cut_index(cuts, "EventTime")).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    nxt = F.lead("_k").over(Window.partitionBy("AssetId").orderBy("_k"))
    span = F.sequence(F.col("_k"), F.coalesce(F.col("_next"), F.lit(len(cuts))) - 1)
    every = F.expr("array(" + ", ".join(f"TIMESTAMP_NTZ '{c.isoformat(sep=' ')}'" for c in cuts) + ")")
    out = top.withColumn("_next", nxt).select(
        F.explode(span).alias("_i"), F.col("ID").alias("ReportID"), "OrganizationId", "AssetId",
        F.col("EventTime").alias("EventTimeUTC"), "Voltage")
    return out.select(F.element_at(every, F.col("_i") + 1).alias("as_of"),
                      "ReportID", "OrganizationId", "AssetId", "EventTimeUTC", "Voltage")


def latest_as_of_many(readings: DataFrame, dates: list[date], hour: int = 0,
                      valid_min: float | None = K.VALID_MIN_VOLTS) -> DataFrame:
    """``latest_as_of_moments`` for ``hour``:00 of each date in ``dates``, with the date as ``report_date``."""
    if not dates:
        raise ValueError("dates must not be empty")
    out = latest_as_of_moments(readings, [day_at_hour(d, hour) for d in dates], valid_min)
    return out.select(F.col("as_of").cast("date").alias("report_date"),
                      "ReportID", "OrganizationId", "AssetId", "EventTimeUTC", "Voltage")


def cut_index(cuts: Sequence[datetime], ts: str) -> Column:
    """Index of the first of the ascending ``cuts`` at or after column ``ts`` (= number of cuts before it).

    Evenly spaced cuts (the usual calendar) need only arithmetic: whole steps since the first cut, rounded
    up. Others are searched by halving: log2 steps over one constant array, however many cuts there are."""
    if len(cuts) == 1:
        return F.when(F.col(ts) <= ntz(cuts[0]), F.lit(0)).otherwise(F.lit(1))
    steps = {b - a for a, b in zip(cuts, cuts[1:])}
    if len(steps) == 1:
        step = steps.pop() // timedelta(microseconds=1)
        since = f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '{cuts[0].isoformat(sep=' ')}', `{ts}`)"
        return F.expr(f"CAST(LEAST({len(cuts)}, GREATEST(0, ({since} + {step - 1}) div {step})) AS INT)")
    origin = datetime(1, 1, 1)
    micros = F.expr("array(" + ", ".join(f"{(c - origin) // timedelta(microseconds=1)}L" for c in cuts) + ")")
    at = micros_index(ts)

    def halved(a, _):
        mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        after = F.get(micros, mid) < at
        return F.when(a["lo"] < a["hi"], F.struct(F.when(after, mid + 1).otherwise(a["lo"]).alias("lo"),
                                                  F.when(after, a["hi"]).otherwise(mid).alias("hi"))).otherwise(a)

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(cuts).bit_length())), F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")),
                       halved, lambda a: a["lo"])


def legacy_latest(bursts: DataFrame, customer: str, id_prefix: str,
                  report_date: date | None = None, now: datetime | None = None,
                  lookback_months: int | None = K.LOOKBACK_MONTHS,
                  port: int = K.LEGACY_PORT, cutoff_hour: int = K.LEGACY_CUTOFF_HOUR) -> DataFrame:
    """Newest qualifying raw uplink per device (legacy source).

    Qualifying: customer matches (case-insensitive), port, device-id prefix, the payload
    contains ``Battery Level`` but not ``Battery Level 0``, and the time lies in the look-back:
    with a ``report_date``, from its midnight minus ``lookback_months`` up to its noon
    (inclusive); without, from ``now`` minus ``lookback_months`` (``lookback_months=None``
    drops the lower bound). Ties on time go to the larger uplink id.
    """
    p = F.col("PayloadData")
    b = bursts.where(
        equals_ignore_case("CustomerName", customer)
        & (F.col("FPort") == port)
        & F.col("DeviceID").startswith(id_prefix)
        & p.contains(K.PAYLOAD_MARKER) & ~p.contains(K.PAYLOAD_ZERO))
    months = F.expr(f"INTERVAL '{lookback_months}' MONTH") if lookback_months is not None else None
    if report_date is not None:
        lo = ntz(day_at_hour(report_date)) - months if months is not None else None
        b = time_range(b, "EventTimeUTC", lo, day_at_hour(report_date, cutoff_hour))
    elif months is not None:
        if now is None:
            raise ValueError("now is required for a relative look-back")
        b = time_range(b, "EventTimeUTC", ntz(now) - months)
    w = Window.partitionBy("DeviceID").orderBy(F.col("EventTimeUTC").desc_nulls_last(),
                                               F.col("ID").desc_nulls_last())
    top = b.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return top.select("ID", "DeviceID", "DeviceName", "CustomerName", "EventTimeUTC", "PayloadData")


def recent_sample(bursts: DataFrame, customer: str, n: int = K.SAMPLE_ROWS) -> DataFrame:
    """The newest ``n`` uplinks of one customer (connectivity check). A top-k: Spark plans it
    as TakeOrderedAndProject, keeping only ``n`` rows per task."""
    b = bursts.where(equals_ignore_case("CustomerName", customer))
    return (b.orderBy(F.col("EventTimeUTC").desc_nulls_last(), F.col("ID").desc_nulls_last())
            .limit(n).select("ID", "DeviceID", "DeviceName", "EventTimeUTC", "PayloadData"))

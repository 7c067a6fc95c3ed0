"""Runnable jobs: the report workload end to end, writing to the snapshot store.

These are the only functions with actions and writes. Clock values are arguments; a
caller that wants "today" passes ``date.today()`` explicitly.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetvolt import constants as K
from fleetvolt.config import PowerBands, SectionSpec
from fleetvolt.functions.timecalc import date_lit, day_at_hour
from fleetvolt.operators import calendar as C
from fleetvolt.operators import dwell_state as DS
from fleetvolt.operators import latest as L
from fleetvolt.operators import sections as S
from fleetvolt.operators.fingerprint import input_digests
from fleetvolt.operators.fleet import active_device_ids, active_devices
from fleetvolt.operators.order import by_date, by_device, by_owner_and_device, newest_first
from fleetvolt.plans import jobs as J
from fleetvolt.session import materialize
from fleetvolt.sources.exports import export_overflow
from fleetvolt.sources.sent_log import append_sent_dates, read_sent_dates
from fleetvolt.sources.store import DATED, IMPORTED, OPEN, SnapshotStore


@dataclass
class Tables:
    """The inputs of the jobs. ``asset_view`` may be a function that reads it: the report then goes on without the
    active filter if that fails."""

    readings: DataFrame
    assets: DataFrame
    organizations: DataFrame
    asset_view: DataFrame | Callable[[], DataFrame]
    bursts: DataFrame | None = None
    allow_list: DataFrame | None = None


class IncompleteWeek(RuntimeError):
    """Raised when required snapshots are still missing; the weekly report is not built."""


def run_open_snapshot(t: Tables, store: SnapshotStore, today: date,
                      bands: PowerBands = PowerBands()) -> DataFrame:
    """The scheduled daily run: all readings so far, without an upper bound, stored as the
    open snapshot of ``today``. Load-or-compute like ``run_daily_snapshot``; nothing is built upon an open
    snapshot, as its readings have no cut-off."""
    return store.load_or_compute(today, K.SOURCE_CURRENT, lambda: J.daily_snapshot(
        t.readings, t.assets, t.organizations, today, bands, open_end=True), OPEN)


def _latest_up_to(store: SnapshotStore, report_date: date):
    """``(cut-off, rows as readings)`` of the stored dated snapshot of ``report_date``; None if there is none or its cut-off is
    not known."""
    entry = store.entry(report_date, K.SOURCE_CURRENT, DATED)
    if entry is None or entry.cutoff is None:
        return None
    rows = store.read([report_date], K.SOURCE_CURRENT, DATED)
    return entry.cutoff, L.time_range(rows, "EventTimeUTC", hi=entry.cutoff)


def _digests(readings: DataFrame, cuts: dict[date, datetime], fingerprint: bool) -> dict[date, str]:
    if not fingerprint:
        return {}
    found = input_digests(readings, list(cuts.values()))
    return {d: found[c] for d, c in cuts.items()}


def run_daily_snapshot(t: Tables, store: SnapshotStore, report_date: date,
                       bands: PowerBands = PowerBands(), incremental: bool = False, fingerprint: bool = False) -> DataFrame:
    """G1 with load-or-compute: the stored current-source snapshot of ``report_date`` up to its midnight.

    ``incremental=True`` builds it from the stored dated snapshot of the day before (when there is
    one) and the readings after its cut-off only, instead of the whole history; see
    ``latest_reading_incremental`` for the one assumption (no late data). ``fingerprint=True`` stores a digest of the readings
    (one more pass over them), by which ``stale_dates`` finds late ones."""
    cut = day_at_hour(report_date)

    def build():
        prev = _latest_up_to(store, report_date - timedelta(days=1)) if incremental else None
        if prev is None:
            return J.daily_snapshot(t.readings, t.assets, t.organizations, report_date, bands)
        latest = L.latest_reading_incremental(prev[1], t.readings, prev[0], cut)
        snap = L.with_power_mode(L.enrich(latest, t.assets, t.organizations), bands)
        return snap.withColumn("report_date", date_lit(report_date))

    if not any(store.exists(report_date, K.SOURCE_CURRENT, k) for k in (DATED, IMPORTED)):
        store.write(build(), K.SOURCE_CURRENT, [report_date], DATED, {report_date: cut},
                    _digests(t.readings, {report_date: cut}, fingerprint))
    return store.load_or_compute(report_date, K.SOURCE_CURRENT, build)


def stale_dates(t: Tables, store: SnapshotStore, dates: Sequence[date] | None = None) -> list[date]:
    """The stored dated snapshots whose readings have changed since: late or corrected readings before their cut-offs.
    One pass over the readings, whatever the number of dates; snapshots without a digest are passed over."""
    runs = store.runs().where((F.col("source") == K.SOURCE_CURRENT) & (F.col("kind") == DATED)
                              & F.col("input_digest").isNotNull() & F.col("cutoff").isNotNull())
    if dates is not None:
        runs = runs.where(F.col("report_date").isin([date_lit(d) for d in dates]))
    stored = {r.report_date: (r.cutoff, r.input_digest) for r in runs.collect()}       # one row per stored date
    now = _digests(t.readings, {d: c for d, (c, _) in stored.items()}, True)
    return sorted(d for d, (_, digest) in stored.items() if now[d] != digest)


def refresh(t: Tables, store: SnapshotStore, dates: Sequence[date] | None = None,
            bands: PowerBands = PowerBands()) -> list[date]:
    """Compute the stale snapshots anew, all in one pass, and store them; the dates done."""
    stale = stale_dates(t, store, dates)
    if stale:
        _store_dated(t, store, t.readings, stale, bands, fingerprint=True)
    return stale


def _store_dated(t: Tables, store: SnapshotStore, readings: DataFrame, dates: Sequence[date], bands: PowerBands,
                 fingerprint: bool) -> None:
    cuts = {d: day_at_hour(d) for d in dates}
    snaps = J.multi_date_snapshot(readings, t.assets, t.organizations, dates, bands)
    store.write(snaps, K.SOURCE_CURRENT, dates, DATED, cuts, _digests(t.readings, cuts, fingerprint))


def run_legacy_snapshot(t: Tables, store: SnapshotStore, report_date: date, customer: str,
                        id_prefix: str, bands: PowerBands = PowerBands()) -> DataFrame:
    """G2 with load-or-compute (legacy source), up to the report date's noon."""
    def build():
        snap = J.legacy_snapshot(t.bursts, customer, id_prefix, report_date, bands=bands)
        return snap.withColumn("report_date", date_lit(report_date))
    return store.load_or_compute(report_date, K.SOURCE_LEGACY, build, cutoff=day_at_hour(report_date, K.LEGACY_CUTOFF_HOUR))


def active_or_none(t: Tables, device_type: str | None) -> DataFrame | None:
    """The ids of the active devices, looked up now and stored; None, which means no filter, without a device type or if
    the lookup fails."""
    if device_type is None:
        return None
    try:
        return materialize(active_device_ids(asset_view(t), device_type), "active")
    except (PySparkException, Py4JJavaError, OSError) as e:
        warnings.warn(f"active devices not available, the report is not filtered by them: {str(e)[:300]}", RuntimeWarning, stacklevel=2)
        return None


def asset_view(t: Tables) -> DataFrame:
    return t.asset_view() if callable(t.asset_view) else t.asset_view


def run_daily_report(t: Tables, store: SnapshotStore, report_date: date,
                     specs: Sequence[SectionSpec], device_type: str | None,
                     as_of: datetime, export_path: str | None = None,
                     window: timedelta = K.RECENCY, bands: PowerBands = PowerBands(), open_end: bool = False,
                     legacy: tuple[str, str] | None = None, preview_limit: int | None = K.PREVIEW_LIMIT) -> J.SectionReport:
    """G3: snapshot (stored or computed), sections filtered by the active set (``device_type``
    None, or a lookup that fails = no active filter), overflow export of tables longer than the preview.

    The snapshot is that of ``report_date``'s midnight; with ``open_end`` all readings so far (the scheduled run, whose label
    is ``report_date``); with ``legacy=(customer, id prefix)`` the legacy source's, which has no active filter. The
    preview comes in the report's order."""
    if legacy is not None:
        snap, active = run_legacy_snapshot(t, store, report_date, *legacy, bands=bands), None
    else:
        snap = (run_open_snapshot if open_end else run_daily_snapshot)(t, store, report_date, bands)
        active = active_or_none(t, device_type)
    rep = J.daily_section_report(snap, specs, as_of, window, t.allow_list, active, preview_limit)
    if export_path is not None:
        export_overflow(rep.tables, export_path)
    return replace(rep, preview=rep.preview.orderBy("section", "position"))


def backfill(t: Tables, store: SnapshotStore, dates: Sequence[date],
             bands: PowerBands = PowerBands(), incremental: bool = False, fingerprint: bool = False) -> list[date]:
    """Compute and store the current-source snapshots of ``dates`` that are missing, in one
    pass over the readings (no loop over dates). Returns the dates computed.

    ``incremental=True``: when the dated snapshot of the day before the first missing date is
    stored, its rows stand in for all readings up to its cut-off (they are the latest of them), so only
    the readings after that are read (same no-late-data assumption as
    ``latest_reading_incremental``)."""
    have = {r.report_date for r in store.catalogue().where(
        F.col("report_date").isin([date_lit(d) for d in dates])).select("report_date").distinct().collect()}
    todo = sorted(set(dates) - have)
    if todo:
        readings = t.readings
        prev = _latest_up_to(store, todo[0] - timedelta(days=1)) if incremental else None
        if prev is not None:
            old = prev[1].select(
                F.col("ReportID").alias("ID"), "OrganizationId", "AssetId",
                F.col("EventTimeUTC").alias("EventTime"), "Voltage")
            new = L.time_range(t.readings, "EventTime", prev[0], lo_inclusive=False)
            readings = old.unionByName(new.select(*old.columns))
        _store_dated(t, store, readings, todo, bands, fingerprint)
    return todo


def run_weekly_trend(t: Tables, store: SnapshotStore, today: date,
                     specs: Sequence[SectionSpec], device_type: str | None, as_of: datetime,
                     window: timedelta = K.RECENCY, days: int = K.WEEK_DAYS,
                     bands: PowerBands = PowerBands(), incremental: bool = False) -> DataFrame:
    """G4: make sure the last ``days`` snapshots exist (one-pass backfill, with the thresholds of
    the daily job), stop if any is still missing in the current source and build the trend from
    the stored snapshots. After the report went out, the caller logs its dates with
    ``log_sent``."""
    dates = week_dates(today, days)
    backfill(t, store, dates, bands, incremental)
    gaps = C.snapshot_gaps(store.catalogue(), today, days).collect()  # at most ``days`` rows
    if gaps:
        raise IncompleteWeek(f"snapshots missing: {[(g.report_date, g.gap) for g in gaps]}")
    return _trend(t, store, dates, specs, device_type, as_of, window)


def week_dates(today: date, days: int = K.WEEK_DAYS) -> list[date]:
    return [today - timedelta(days=i) for i in range(days - 1, -1, -1)]


def _trend(t: Tables, store: SnapshotStore, dates: Sequence[date], specs: Sequence[SectionSpec],
           device_type: str | None, as_of: datetime, window: timedelta) -> DataFrame:
    snaps = store.read(dates, K.SOURCE_CURRENT)
    active = active_or_none(t, device_type)
    members = S.assign_sections(snaps, specs, as_of, window, t.allow_list, active)
    cal = store.spark.createDataFrame([(d,) for d in dates], "report_date date")
    return S.section_mode_summary(members.unionByName(cal, allowMissingColumns=True), specs,
                                  by=["report_date"])


def run_unsent_trend(t: Tables, store: SnapshotStore, today: date, specs: Sequence[SectionSpec],
                     device_type: str | None, as_of: datetime, sent_log: str,
                     window: timedelta = K.RECENCY, bands: PowerBands = PowerBands(),
                     incremental: bool = False) -> tuple[DataFrame, list[date]]:
    """G4 by the sent log: snapshots are filled up from the day after the last sent date, and the
    trend covers every stored date that was not sent yet. Returns the trend and its dates, which
    the caller hands to ``log_sent`` once the report went out."""
    sent = read_sent_dates(store.spark, sent_log)
    missing = C.missing_since_sent(store.catalogue(), sent, today).collect()    # dates since the last report
    backfill(t, store, [r.report_date for r in missing], bands, incremental)
    dates = [r.report_date for r in by_date(C.unsent_dates(store.catalogue(), sent)).collect()]   # one per stored day
    return _trend(t, store, dates, specs, device_type, as_of, window), dates


def log_sent(spark: SparkSession, sent_log: str, dates: Sequence[date], recipients: int = 1) -> None:
    """Log ``dates`` as sent; a report to one recipient is a trial and is not logged. To be called
    after the report was built and sent."""
    if recipients > 1 and dates:
        append_sent_dates(spark, sent_log, spark.createDataFrame([(d,) for d in dates], "report_date date"))


def run_fleet_dwell(t: Tables, organization_ids: Sequence[int], device_type: str,
                    exclude_asset_group_id: int | None = None,
                    bands: PowerBands = PowerBands(), state_path: str | None = None,
                    cut: datetime | None = None, prev_cut: datetime | None = None) -> J.FleetDwellReport:
    """G5: dwell statistics of the listed organizations with device counts; the statistics
    are shown only when ``TotalYears > 0``.

    With ``state_path`` (and the cut-off ``cut``) the statistics come from the stored dwell
    state of the readings up to ``cut`` (``run_dwell_state``; built from the state of
    ``prev_cut`` when that one is stored) instead of the whole history."""
    if state_path is None:
        return J.fleet_dwell_report(t.readings, asset_view(t), t.assets, organization_ids,
                                    device_type, exclude_asset_group_id, bands)
    if cut is None:
        raise ValueError("a stored dwell state needs its cut-off")
    state = run_dwell_state(t, state_path, cut, prev_cut, bands)
    stats = fleet_dwell_from_state(t, state, organization_ids, device_type=device_type,
                                   exclude_asset_group_id=exclude_asset_group_id)
    return J.fleet_report_from_stats(stats, asset_view(t), organization_ids, device_type)


def _state_dir(state_path: str, cut: datetime, bands: PowerBands) -> str:
    """One folder per layout, set of thresholds and exact cut-off: a state holds minutes per band, so it
    answers only for the thresholds that it was built with."""
    key = "-".join(repr(float(x)) for x in (bands.high, bands.medium, bands.low))
    return f"{state_path.rstrip('/')}/runs/bands={key}/cut={cut:%Y%m%dT%H%M%S.%f}"


def _stored_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The state in ``path`` if its write was committed (Spark's marker file is there)."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    marker = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return spark.read.parquet(path) if marker.getFileSystem(conf).exists(marker) else None


def run_dwell_state(t: Tables, state_path: str, cut: datetime, prev_cut: datetime | None = None,
                    bands: PowerBands = PowerBands()) -> DataFrame:
    """The stored dwell state of the readings up to ``cut`` (runs of each asset's readings, see
    ``operators.dwell_state``), written under ``state_path`` (shared storage). When the state
    of ``prev_cut`` is stored, only the readings in ``(prev_cut, cut]`` are read; otherwise the
    whole history up to ``cut``. A stored state is reused; rewriting one is idempotent."""
    spark = t.readings.sparkSession
    if prev_cut is not None and prev_cut >= cut:
        raise ValueError(f"the previous cut-off {prev_cut} is not before {cut}")
    target = _state_dir(state_path, cut, bands)
    have = _stored_state(spark, target)
    if have is not None:
        return have
    prev = _stored_state(spark, _state_dir(state_path, prev_cut, bands)) if prev_cut is not None else None
    if prev is not None:
        new = L.time_range(t.readings, "EventTime", lo=prev_cut, hi=cut, lo_inclusive=False)
        state = DS.advance_dwell_state(prev, new, bands)
    else:
        state = DS.dwell_state(L.time_range(t.readings, "EventTime", hi=cut), bands)
    state.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def fleet_dwell_from_state(t: Tables, state: DataFrame, organization_ids: Sequence[int] | None = None,
                           organization_id: int | None = None, device_type: str = "",
                           exclude_asset_group_id: int | None = None) -> DataFrame:
    """Dwell statistics of the readings that ``state`` covers; no reading is read."""
    return DS.dwell_statistics_from_state(state, asset_view(t), t.assets, organization_id, organization_ids,
                                          exclude_asset_group_id, device_type)


def snapshot_in_order(store: SnapshotStore, report_date: date, source: str = K.SOURCE_CURRENT) -> DataFrame:
    """A stored snapshot as its source lists it: by device, or newest first for the legacy source."""
    snap = store.read([report_date], source)
    return newest_first(snap, tiebreak="DeviceID") if source == K.SOURCE_LEGACY else by_device(snap)


def active_devices_in_order(t: Tables, device_type: str) -> DataFrame:
    """The active devices by organization and device name."""
    return by_owner_and_device(active_devices(asset_view(t), device_type))


__all__ = ["Tables", "IncompleteWeek", "run_daily_snapshot", "run_legacy_snapshot",
           "run_open_snapshot", "run_daily_report", "backfill", "run_weekly_trend",
           "run_unsent_trend", "log_sent", "week_dates", "run_fleet_dwell", "run_dwell_state",
           "fleet_dwell_from_state", "stale_dates", "refresh", "active_or_none", "snapshot_in_order",
           "active_devices_in_order", "day_at_hour"]

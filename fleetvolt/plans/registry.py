"""Registry of the queries run on the driver's test tables, and their reference SQL.

``queries()`` maps a name to ``f(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` maps the same
name to SQL over the raw test tables (DuckDB dialect) that must give the same rows. The
stand-in mapping from test tables to the reporting schemas is ``fleetvolt.sources.standin``
(Spark) and ``_CTE`` below (SQL). Parameters are those of FIXTURES.md section 2.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetvolt import constants as K
from fleetvolt.config import PowerBands, SectionSpec
from fleetvolt.functions.bands import power_band
from fleetvolt.functions.dates import date_label, display_date, parse_label
from fleetvolt.functions.devices import is_numbered_series
from fleetvolt.functions.timecalc import date_lit, day_at_hour
from fleetvolt.operators import calendar as C
from fleetvolt.operators import dwell_state as DS
from fleetvolt.operators import latest as L
from fleetvolt.operators import payload as P
from fleetvolt.operators import sections as S
from fleetvolt.operators.dwell import dwell_statistics, reading_intervals
from fleetvolt.operators.fleet import active_device_ids, active_devices, org_device_counts, total_device_count
from fleetvolt.operators.order import device_order, owner_order
from fleetvolt.operators.positions import with_position
from fleetvolt.plans import jobs as J
from fleetvolt.plans import runner as RN
from fleetvolt.session import ensure_checkpoint_dir, materialize
from fleetvolt.sources import standin as SI
from fleetvolt.sources import tables
from fleetvolt.sources.commits import move_part
from fleetvolt.sources.exports import export_overflow
from fleetvolt.sources.legacy_files import CURRENT_FILE_COLUMNS, malformed_lines, read_snapshot_files
from fleetvolt.sources.sent_log import append_sent_dates, read_sent_dates
from fleetvolt.sources.store import SnapshotStore

# ---- stand-in parameters (FIXTURES.md section 2) ------------------------------------------
BANDS = PowerBands(high=90.0, medium=36.0, low=15.0)
TODAY = date(2024, 1, 31)
AS_OF = day_at_hour(TODAY)                      # current-source cut-off of the report date
EARLY_DATE = date(2024, 1, 25)                  # an as-of inside the data
RECENCY = timedelta(days=10)
SHORT_RECENCY = timedelta(hours=6)              # excludes devices of the test tables
PREVIEW_ROWS = 3                                # fewer than the test tables have
SAMPLE_SIZE = 100                               # fewer than the test tables have from sf0.01 on
DEVICE_TYPE = "MACHINERY"
DWELL_ORGS = [19, 11, 10, 20, 17, 13, 16, 2]
DWELL_ORG = 19
EXCLUDE_GROUP = 5
DWELL_CUT = datetime(2024, 1, 15, 12)          # cut-off of the stored dwell state
LEGACY_CUSTOMER = "nation_19"
LEGACY_PREFIX = "Customer#0"
LEGACY_DATE = date(2024, 1, 30)
SAMPLE_CUSTOMER = "NATION_19"
WEEK_DATES = [TODAY - timedelta(days=i) for i in range(K.WEEK_DAYS - 1, -1, -1)]
SECTIONS = [
    SectionSpec("new_panel", "NATION_19", listed_or_series=True, series_prefix="Customer#0", series_min=100),
    SectionSpec("c_series", "NATION_19", id_prefix="Customer#0000000", table_modes=K.TABLE_MODES_SHORT),
    SectionSpec("customer_b", "NATION_11"),
    SectionSpec("customer_c", "NATION_10"),
]


# ---- Spark side ---------------------------------------------------------------------------
class _T:
    """Stand-in tables of one test directory."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d

    readings = cached_property(lambda s: SI.readings(s.spark, s.d))
    assets = cached_property(lambda s: SI.assets(s.spark, s.d))
    orgs = cached_property(lambda s: SI.organizations(s.spark, s.d))
    av = cached_property(lambda s: SI.asset_view(s.spark, s.d))
    bursts = cached_property(lambda s: SI.bursts(s.spark, s.d))
    allow = cached_property(lambda s: SI.device_list(s.spark, s.d))

    def snapshot(self, as_of=AS_OF):
        return L.latest_snapshot(self.readings, self.assets, self.orgs, as_of, BANDS)

    def members(self, active=None, snap=None):
        snap = self.snapshot() if snap is None else snap
        return S.assign_sections(snap, SECTIONS, AS_OF, RECENCY, self.allow, active)

    def sectioned(self):
        """The snapshot rows with their devices' sections."""
        return S.with_device_sections(self.snapshot(), SECTIONS, AS_OF, RECENCY, self.allow)

    def active(self):
        return active_device_ids(self.av, DEVICE_TYPE)

    def catalogue(self):
        return C.catalogue_from_files(SI.snapshot_files(self.spark, self.d))

    def sent(self):
        return C.sent_dates(SI.sent_labels(self.spark, self.d))


def _q(fn: Callable[[_T], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: fn(_T(spark, d))


def _dwell(**kw):
    return _q(lambda t: dwell_statistics(t.readings, t.av, t.assets, device_type=DEVICE_TYPE,
                                         bands=BANDS, **kw))


def _dwell_incremental(t: _T) -> DataFrame:
    """Dwell from a state of the readings up to ``DWELL_CUT`` advanced with the later ones:
    must equal ``dwell_by_org_list`` over the whole table."""
    r = t.readings
    old = DS.dwell_state(L.time_range(r, "EventTime", hi=DWELL_CUT), BANDS)
    state = materialize(DS.advance_dwell_state(       # stored, as ``run_dwell_state`` does
        old, L.time_range(r, "EventTime", lo=DWELL_CUT, lo_inclusive=False), BANDS))
    return RN.fleet_dwell_from_state(RN.Tables(r, t.assets, t.orgs, t.av), state, DWELL_ORGS, device_type=DEVICE_TYPE)


def _time_renderings(t: _T) -> DataFrame:
    ev = t.spark.read.parquet(f"{t.d}/events.parquet").select("ts")
    long = ev.select(F.expr(
        "stack(3, 'iso', date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS'), "
        "'day_first', date_format(ts, 'd/M/yyyy H:mm'), "
        "'month_first', date_format(ts, 'M/d/yyyy H:mm')) AS (rendering, text)"))
    choice = P.time_format_choice(long, "text", by=["rendering"])
    names = F.element_at(F.array(*[F.lit(n) for n in K.TIME_FORMAT_NAMES]), F.col("format_index"))
    return choice.select("rendering", names.alias("detected"), "n_values")


def _date_labels(t: _T) -> DataFrame:
    d = t.catalogue().select("report_date").distinct()
    lab = date_label("report_date")
    padded = F.date_format("report_date", "ddMMMyy")
    return d.select("report_date", lab.alias("label"), parse_label(lab).alias("parsed"),
                    parse_label(padded).alias("parsed_padded"),
                    display_date("report_date").alias("display"),
                    display_date("report_date", with_year=False).alias("day_month"),
                    display_date("report_date", full_month=True).alias("display_long"),
                    display_date("report_date", with_year=False, full_month=False).alias("day_short"))


def _catalogue(t: _T) -> DataFrame:
    s = C.catalogue_summary(t.catalogue())
    return s.select("report_date", date_label("report_date").alias("label"),
                    "has_preferred", "has_other", "read_source")


def _section_report(t: _T) -> DataFrame:
    rep = J.daily_section_report(t.snapshot(), SECTIONS, AS_OF, RECENCY, t.allow, t.active())
    return J.section_report_overview(rep, SECTIONS, PREVIEW_ROWS)


def _active_report(t: _T) -> J.SectionReport:
    return J.daily_section_report(t.snapshot(), SECTIONS, AS_OF, RECENCY, t.allow, t.active(), PREVIEW_ROWS)


def _weekly(t: _T) -> DataFrame:
    return J.weekly_trend(t.readings, t.assets, t.orgs, WEEK_DATES, SECTIONS, AS_OF, RECENCY,
                          t.allow, t.active(), BANDS)


def _fleet(t: _T) -> DataFrame:
    return J.fleet_dwell_report(t.readings, t.av, t.assets, DWELL_ORGS, DEVICE_TYPE,
                                bands=BANDS).stats


def _tables(t: _T) -> DataFrame:
    return S.section_tables(t.members(), SECTIONS)


def _scratch(t: _T, name: str) -> str:
    return f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/fleetvolt-{name}-{uuid.uuid4().hex}"


def _stored_snapshot(t: _T) -> DataFrame:
    """Both sources written to a store for one date, and the current one read back."""
    store = SnapshotStore(t.spark, _scratch(t, "store"))
    legacy = J.legacy_snapshot(t.bursts, LEGACY_CUSTOMER, LEGACY_PREFIX, LEGACY_DATE, bands=BANDS)
    store.write(legacy.withColumn("report_date", date_lit(TODAY)), K.SOURCE_LEGACY, [TODAY])
    store.write(J.daily_snapshot(t.readings, t.assets, t.orgs, TODAY, BANDS), K.SOURCE_CURRENT, [TODAY])
    return store.read([TODAY], K.SOURCE_CURRENT)


def _latest_from_files(t: _T) -> DataFrame:
    """The readings stored by day and read through the typed reader, up to an as-of time."""
    path = _scratch(t, "readings")
    tables.write_by_day(t.readings, path, "EventTime")
    return L.latest_reading(tables.readings(t.spark, path), day_at_hour(EARLY_DATE))


def _stored_bursts(t: _T) -> DataFrame:
    """The uplinks stored by day and read through the typed reader, up to the report date's noon."""
    path = _scratch(t, "bursts")
    tables.write_by_day(t.bursts, path, "EventTimeUTC")
    return L.legacy_latest(tables.bursts(t.spark, path), LEGACY_CUSTOMER, LEGACY_PREFIX, LEGACY_DATE)


def _device_list(t: _T) -> DataFrame:
    """The allow-list written as the one-column CSV that users keep, with repeated and blank ids, and read back."""
    path = _scratch(t, "device_list")
    ids = t.allow.select(F.explode(F.array(F.col("DeviceID"), F.col("DeviceID"), F.lit(" "))).alias("DeviceID"))
    ids.write.option("header", True).option("lineSep", "\r\n").csv(path)
    return tables.device_list(t.spark, path)


def _snapshot_files(t: _T, days: list[date]) -> str:
    """Snapshot files of the original layout, one for each of ``days``, in a new folder.

    The lines are stored by date first, so the one task that puts a date's file together only copies its lines: joins and
    windows of all partitions would otherwise run, and hold memory, in that task."""
    folder, stored = _scratch(t, "files"), _scratch(t, "lines")
    snaps = J.multi_date_snapshot(t.readings, t.assets, t.orgs, days, BANDS)
    line = F.to_csv(F.struct(*CURRENT_FILE_COLUMNS), {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    snaps.select(line.alias("value"), "report_date").write.partitionBy("report_date").parquet(stored)
    snaps = t.spark.read.schema("value string, report_date date").parquet(stored)
    for d in days:
        rows = snaps.where(F.col("report_date") == date_lit(d))
        head = ["### METADATA ###", "query_time,1.5", "### DATA ###", ",".join(CURRENT_FILE_COLUMNS), "cut,short"]
        lines = t.spark.createDataFrame([(x,) for x in head], "value string").coalesce(1).unionByName(rows.select("value"))
        part = f"{folder}/day={d}"
        lines.coalesce(1).write.text(part)
        move_part(t.spark, part, f"{folder}/{K.SNAPSHOT_PREFIX}{d.day}{d:%b%y}_{K.SOURCE_CURRENT}{K.SNAPSHOT_SUFFIX}")
    return folder


def _read_files(t: _T) -> DataFrame:
    """Three of seven files read, with their dates, recorded seconds and malformed lines."""
    folder, wanted = _snapshot_files(t, WEEK_DATES), WEEK_DATES[2:5]
    rows, runs = read_snapshot_files(t.spark, folder, K.SOURCE_CURRENT, wanted)
    bad = malformed_lines(t.spark, folder, K.SOURCE_CURRENT, wanted)
    # A row for each file: rows are never dealt by their few dates.
    return rows.join(F.broadcast(runs.drop("source")), "report_date").join(F.broadcast(bad.drop("source")), "report_date")


def _load_or_compute(t: _T) -> DataFrame:
    """The snapshot computed and stored, and the second time found: it must not change when the readings are gone."""
    store = SnapshotStore(t.spark, _scratch(t, "store"))
    every = RN.Tables(t.readings, t.assets, t.orgs, t.av)
    RN.run_open_snapshot(every, store, TODAY, BANDS)              # another kind of the same date
    RN.run_daily_snapshot(every, store, TODAY, BANDS)
    return RN.run_daily_snapshot(RN.Tables(t.readings.where("false"), t.assets, t.orgs, t.av), store, TODAY, BANDS)


def _logged(t: _T) -> DataFrame:
    """The snapshot dates appended to a sent log in two overlapping steps, and read back."""
    path = _scratch(t, "sent")
    dates = t.catalogue().select("report_date").distinct()
    first = append_sent_dates(t.spark, path, dates.where(F.col("report_date") <= date_lit(EARLY_DATE)))
    second = append_sent_dates(t.spark, path, dates)
    added = first.withColumn("step", F.lit(1)).unionByName(second.withColumn("step", F.lit(2)))
    return read_sent_dates(t.spark, path).join(added, "report_date")


def _overflow(t: _T) -> DataFrame:
    """The exported tables of the sections that overflow their preview, read back from CSV."""
    path = _scratch(t, "export")
    tables_ = _tables(t)
    export_overflow(tables_, path, PREVIEW_ROWS)
    columns = [f for f in tables_.schema.fields if f.name != "section"]
    back = t.spark.read.schema(StructType([*columns, tables_.schema["section"]])).option("header", True).csv(path)
    return back.select("section", "ReportID", "DeviceID", "Voltage", "PowerMode")


def _coerced_times(t: _T) -> DataFrame:
    """The uplinks' times as day-first text, made times again by the format that fits the whole column."""
    text = t.bursts.select("ID", F.date_format("EventTimeUTC", "d/M/yyyy H:mm").alias("EventTimeUTC"))
    return P.parse_time_column(text, "EventTimeUTC")


def _moments() -> list[datetime]:
    """A hundred moments at growing distances, from before the data to after it."""
    start = datetime(2023, 12, 31, 18)
    return [start + timedelta(minutes=5 * i * i, seconds=i, microseconds=i * 7919) for i in range(100)]


MOMENTS = _moments()


def _newest_uplinks(t: _T) -> DataFrame:
    kept = t.bursts.where(F.col("FPort") == K.LEGACY_PORT).select("ID", "DeviceID", "EventTimeUTC")
    return with_position(kept, [F.col("EventTimeUTC").desc_nulls_last(), F.col("ID").desc_nulls_last()])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # latest state
        "latest_reading": _q(lambda t: L.latest_reading(t.readings)),
        "latest_reading_as_of": _q(lambda t: L.latest_reading(t.readings, day_at_hour(EARLY_DATE))),
        "latest_reading_incremental": _q(lambda t: L.latest_reading_incremental(
            L.latest_reading(t.readings, day_at_hour(EARLY_DATE)), t.readings,
            day_at_hour(EARLY_DATE), AS_OF)),
        "latest_snapshot_open": _q(lambda t: t.snapshot(None)),
        "latest_reading_enriched": _q(lambda t: L.enrich(L.latest_reading(t.readings, AS_OF), t.assets, t.orgs)),
        "stored_readings_latest": _q(_latest_from_files),
        "stored_snapshot": _q(_stored_snapshot),
        "daily_snapshot": _q(lambda t: J.daily_snapshot(t.readings, t.assets, t.orgs, TODAY, BANDS)),
        "multi_date_snapshot": _q(lambda t: J.multi_date_snapshot(t.readings, t.assets, t.orgs, WEEK_DATES, BANDS)),
        "power_band_exclusive": _q(lambda t: t.readings.select(
            "ID", "Voltage", power_band("Voltage", BANDS).alias("PowerMode"))),
        "power_band_inclusive": _q(lambda t: t.readings.select(
            "ID", "Voltage", power_band("Voltage", BANDS, inclusive=True, null_band="Critical").alias("PowerMode"))),
        "voltage_profile": _q(lambda t: P.voltage_profile(t.snapshot())),
        # legacy source
        "recent_sample": _q(lambda t: L.recent_sample(t.bursts, SAMPLE_CUSTOMER, SAMPLE_SIZE)),
        "legacy_latest": _q(lambda t: L.legacy_latest(t.bursts, LEGACY_CUSTOMER, LEGACY_PREFIX, LEGACY_DATE)),
        "legacy_latest_relative": _q(lambda t: L.legacy_latest(t.bursts, LEGACY_CUSTOMER, LEGACY_PREFIX, now=AS_OF)),
        "payload_rejects": _q(lambda t: P.unparsed_count(P.parse_payload(t.bursts))),
        "payload_parse": _q(lambda t: P.drop_unparsed(P.parse_payload(t.bursts)).select(
            "ID", "DeviceID", "Voltage", "PayloadMode")),
        "label_quality": _q(lambda t: P.label_quality(P.drop_unparsed(P.parse_payload(t.bursts)))),
        "detect_time_format": _q(_time_renderings),
        "legacy_snapshot": _q(lambda t: J.legacy_snapshot(t.bursts, LEGACY_CUSTOMER, LEGACY_PREFIX,
                                                          LEGACY_DATE, bands=BANDS)),
        # dwell
        "reading_intervals": _q(lambda t: reading_intervals(t.readings, BANDS)),
        "dwell_all": _dwell(),
        "dwell_by_org_list": _dwell(organization_ids=DWELL_ORGS),
        "dwell_single_org": _dwell(organization_id=DWELL_ORG),
        "dwell_excluding_group": _dwell(organization_ids=DWELL_ORGS, exclude_asset_group_id=EXCLUDE_GROUP),
        "fleet_dwell_report": _q(_fleet),
        "dwell_incremental": _q(_dwell_incremental),
        # registry
        "active_devices": _q(lambda t: active_devices(t.av, DEVICE_TYPE)),
        "org_device_counts": _q(lambda t: org_device_counts(t.av, DWELL_ORGS, DEVICE_TYPE)),
        "total_device_count": _q(lambda t: total_device_count(t.av, DWELL_ORGS, DEVICE_TYPE)),
        "numbered_series": _q(lambda t: t.assets.where(
            F.col("DeviceName").startswith(LEGACY_PREFIX) & is_numbered_series("DeviceName", 100)
        ).select("ID", F.col("DeviceName").alias("DeviceID"))),
        # sections
        "recent_devices": _q(lambda t: S.recent_devices(t.snapshot(), AS_OF, SHORT_RECENCY)),
        "section_members": _q(lambda t: t.members()),
        "section_mode_counts": _q(lambda t: S.section_mode_counts(t.members())),
        "section_mode_summary": _q(lambda t: S.section_mode_summary(t.members(), SECTIONS)),
        "cohort_shares": _q(lambda t: S.cohort_shares(t.sectioned())),
        "cohort_shares_by_customer": _q(lambda t: S.cohort_shares(
            t.sectioned(), paired_only=False, customer=SECTIONS[0].customer)),
        "section_table": _q(_tables),
        "section_preview": _q(lambda t: S.section_preview(_tables(t), PREVIEW_ROWS)),
        "low_battery": _q(lambda t: S.low_battery(t.sectioned(), "new_panel")),
        "daily_section_report": _q(_section_report),
        "daily_section_report_shares": _q(lambda t: _active_report(t).shares),
        "daily_section_report_table": _q(lambda t: _active_report(t).tables),
        "daily_section_report_preview": _q(lambda t: _active_report(t).preview),
        "weekly_trend": _q(_weekly),
        # calendar
        "snapshot_catalogue": _q(_catalogue),
        "sent_dates": _q(lambda t: t.sent().select("report_date", date_label("report_date").alias("label"))),
        "missing_dates": _q(lambda t: C.missing_since_sent(t.catalogue(), t.sent(), TODAY)),
        "missing_in_window": _q(lambda t: C.missing_in_window(t.catalogue(), TODAY)),
        "unsent_dates": _q(lambda t: C.unsent_dates(t.catalogue(), t.sent())),
        "snapshot_gaps": _q(lambda t: C.snapshot_gaps(t.catalogue(), TODAY)),
        "date_labels": _q(_date_labels),
        # stores and files, each written and read back
        "stored_bursts_latest": _q(_stored_bursts),
        "device_list": _q(_device_list),
        "snapshot_files": _q(_read_files),
        "snapshot_load_or_compute": _q(_load_or_compute),
        "sent_log": _q(_logged),
        "overflow_export": _q(_overflow),
        "coerced_times": _q(_coerced_times),
        "moments_latest": _q(lambda t: L.latest_as_of_moments(t.readings, MOMENTS)),
        # the reports' orders, as positions
        "section_preview_all": _q(lambda t: S.section_preview(_tables(t), None)),
        "snapshot_by_device": _q(lambda t: with_position(t.snapshot(), device_order())),
        "active_devices_by_owner": _q(lambda t: with_position(active_devices(t.av, DEVICE_TYPE), owner_order() + [F.col("AssetId")])),
        "uplinks_newest_first": _q(_newest_uplinks),
        "catalogue_by_date": _q(lambda t: with_position(t.catalogue(), [F.col("report_date"), F.col("source")])),
    }

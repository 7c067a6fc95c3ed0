"""The five jobs of the reporting workload, as lazy DataFrame plans.

Each function returns DataFrames and runs no action; the store-writing wrappers live in
``fleetvolt.sources.store`` and ``fleetvolt.plans.runner``.

* G1 ``daily_snapshot``        latest state as of the report date's midnight, with bands
* G2 ``legacy_snapshot``       legacy raw uplinks -> newest per device -> parsed -> bands
* G3 ``daily_section_report``  sections of one snapshot: counts, shares, tables, preview
* G4 ``weekly_trend``          counts per date x section x mode for the last 7 dates
* G5 ``fleet_dwell_report``    dwell statistics + devices per organization + total devices
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetvolt import constants as K
from fleetvolt.config import PowerBands, SectionSpec
from fleetvolt.functions.timecalc import date_lit, day_at_hour
from fleetvolt.operators import latest as L
from fleetvolt.operators import payload as P
from fleetvolt.operators import sections as S
from fleetvolt.operators.dwell import dwell_statistics
from fleetvolt.operators.fleet import org_device_counts, total_device_count


def daily_snapshot(readings: DataFrame, assets: DataFrame, organizations: DataFrame,
                   report_date: date, bands: PowerBands = PowerBands(), open_end: bool = False) -> DataFrame:
    """Current-source snapshot for ``report_date``: readings up to the *start* of that day
    (its midnight, inclusive), or with ``open_end`` all readings. Adds ``report_date``."""
    snap = L.latest_snapshot(readings, assets, organizations, None if open_end else day_at_hour(report_date), bands)
    return snap.withColumn("report_date", date_lit(report_date))


def multi_date_snapshot(readings: DataFrame, assets: DataFrame, organizations: DataFrame,
                        dates: Sequence[date], bands: PowerBands = PowerBands()) -> DataFrame:
    """Current-source snapshots for many dates in one pass (backfill of missing dates)."""
    latest = L.latest_as_of_many(readings, list(dates))
    return L.with_power_mode(L.enrich(latest, assets, organizations), bands)


def legacy_snapshot(bursts: DataFrame, customer: str, id_prefix: str, report_date: date | None,
                    now: datetime | None = None, bands: PowerBands = PowerBands()) -> DataFrame:
    """Legacy-source snapshot: newest qualifying uplink per device, voltage parsed from the
    payload (rows without a decimal level dropped *after* ranking, as the source does), time
    column coerced, band from voltage."""
    top = L.legacy_latest(bursts, customer, id_prefix, report_date, now)
    parsed = P.drop_unparsed(P.parse_payload(top))
    parsed = P.parse_time_column(parsed, "EventTimeUTC")
    out = P.legacy_power_mode(parsed, bands)
    return out.select("DeviceID", "DeviceName", "CustomerName", "EventTimeUTC", "PayloadData",
                      "Voltage", "PowerMode")


@dataclass
class SectionReport:
    members: DataFrame      # section x device
    summary: DataFrame      # section -> members, Critical, Low, Medium (zero-filled)
    shares: DataFrame       # section x mode -> n, total, share
    tables: DataFrame       # rows of each section's table
    preview: DataFrame      # first rows of each table + total_rows


def daily_section_report(snapshot: DataFrame, specs: Sequence[SectionSpec], as_of: datetime,
                         window: timedelta = K.RECENCY, allow_list: DataFrame | None = None,
                         active: DataFrame | None = None,
                         preview_limit: int | None = K.PREVIEW_LIMIT) -> SectionReport:
    members = S.assign_sections(snapshot, specs, as_of, window, allow_list, active)
    tables = S.section_tables(members, specs)
    return SectionReport(
        members=members,
        summary=S.section_mode_summary(members, specs),
        shares=S.cohort_shares(S.with_device_sections(snapshot, specs, as_of, window, allow_list, active)),
        tables=tables,
        preview=S.section_preview(tables, preview_limit),
    )


def section_report_overview(report: SectionReport, specs: Sequence[SectionSpec],
                            preview_limit: int = K.PREVIEW_LIMIT) -> DataFrame:
    """One row per section: member and mode counts, table size and whether the table
    overflows the preview (then it is exported whole)."""
    sizes = report.tables.groupBy("section").agg(F.count(F.lit(1)).alias("table_rows"))
    out = report.summary.join(sizes, "section", "left").fillna(0, ["table_rows"])
    return out.withColumn("overflow", (F.col("table_rows") > preview_limit).cast("int"))


def weekly_trend(readings: DataFrame, assets: DataFrame, organizations: DataFrame,
                 dates: Sequence[date], specs: Sequence[SectionSpec], as_of: datetime,
                 window: timedelta = K.RECENCY, allow_list: DataFrame | None = None,
                 active: DataFrame | None = None, bands: PowerBands = PowerBands()) -> DataFrame:
    """Zero-filled Critical / Low / Medium counts per (report_date, section) for ``dates``.

    The recency clock and the active set are the run's (``as_of``, ``active``) for every
    date, as in the weekly report. Snapshots for all dates come from one pass
    (``multi_date_snapshot``) and sections from one pass over them.
    """
    snaps = multi_date_snapshot(readings, assets, organizations, dates, bands)
    members = S.assign_sections(snaps, specs, as_of, window, allow_list, active)
    # every date keeps its rows even when no device matched any section
    cal = snaps.sparkSession.createDataFrame([(d,) for d in sorted(set(dates))], "report_date date")
    padded = members.unionByName(cal, allowMissingColumns=True)
    return S.section_mode_summary(padded, specs, by=["report_date"])


@dataclass
class FleetDwellReport:
    stats: DataFrame        # one row: TotalYears, percents, TotalDevices
    organizations: DataFrame


def fleet_dwell_report(readings: DataFrame, asset_view: DataFrame, assets: DataFrame,
                       organization_ids: Sequence[int], device_type: str,
                       exclude_asset_group_id: int | None = None,
                       bands: PowerBands = PowerBands()) -> FleetDwellReport:
    stats = dwell_statistics(readings, asset_view, assets, organization_ids=organization_ids,
                             exclude_asset_group_id=exclude_asset_group_id,
                             device_type=device_type, bands=bands)
    return fleet_report_from_stats(stats, asset_view, organization_ids, device_type)


def fleet_report_from_stats(stats: DataFrame, asset_view: DataFrame, organization_ids: Sequence[int],
                            device_type: str) -> FleetDwellReport:
    """The report around a dwell statistics row (computed in full or from a stored state)."""
    total = total_device_count(asset_view, organization_ids, device_type)
    # No statistics without operating time: zero rows when the years are 0 or unknown.
    stats = (stats.where(F.col("TotalYears") > 0)
             .withColumn("TotalDevices", total.select("TotalDevices").scalar()))
    return FleetDwellReport(stats=stats,
                            organizations=org_device_counts(asset_view, organization_ids, device_type))

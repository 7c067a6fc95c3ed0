"""Dwell time: how much operating time a fleet spent in each power band.

For every reading the interval to the asset's next reading (minute boundaries crossed) is
attributed to the reading's band (inclusive thresholds, NULL voltage = Critical); the last
reading of each asset has no interval. Percentages are the band's share of all minutes.

Exactness: minutes are summed as integers and divided once, and the rounding is half-up on
the exact ratio, so results do not depend on summation order.

Plan: filters (organization, active semi-join, group exclusion) run before the shuffle; the minutes come from
segments that are merged by minute, day and asset (``dwell_segments``); the final aggregate is a single global
aggregate with partial aggregation in every task. The intervals themselves (``reading_intervals``) come from the hot-asset-safe
``with_next_time``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetvolt import constants as K
from fleetvolt.config import PowerBands
from fleetvolt.functions.bands import band_name, power_band_code
from fleetvolt.functions.timecalc import minutes_between, ratio_percent
from fleetvolt.operators.dwell_segments import MINUTES, asset_segments
from fleetvolt.operators.fleet import active_filter, filter_orgs
from fleetvolt.operators.intervals import with_next_time


def reading_intervals(readings: DataFrame, bands: PowerBands = PowerBands()) -> DataFrame:
    """Per reading with a successor: ``AssetId, ID, EventTime, NextTime, PowerMode,
    DurationMinutes, DurationHours``. What is shuffled is narrow: the band travels as a one-byte code."""
    r = readings.select("ID", "AssetId", "EventTime", power_band_code("Voltage", bands, inclusive=True).alias("_band"))
    x = with_next_time(r).where(F.col("NextTime").isNotNull())
    mins = minutes_between("EventTime", "NextTime")
    return x.select("AssetId", "ID", "EventTime", "NextTime", band_name("_band").alias("PowerMode"),
                    mins.alias("DurationMinutes"), (mins / F.lit(60.0)).alias("DurationHours"))


def dwell_readings(readings: DataFrame, asset_view: DataFrame, assets: DataFrame,
                   organization_id: int | None = None,
                   organization_ids: Sequence[int] | None = None,
                   exclude_asset_group_id: int | None = None,
                   device_type: str = "") -> DataFrame:
    """The readings the dwell statistics use, with the report's filter precedence.

    * organization: non-empty list, else single id, else all (on the readings and on the
      active-device lookup alike);
    * only assets that are active devices of ``device_type`` (semi-join);
    * optional group exclusion: the asset must be in the same organization as the reading
      (or in ``organization_id`` when given) and its group must differ from the excluded one
      (a NULL group is excluded too, as ``!=`` is unknown for NULL).
    """
    r = filter_orgs(readings, "OrganizationId", organization_id, organization_ids)
    av = filter_orgs(active_filter(asset_view, device_type), "OrganizationId",
                     organization_id, organization_ids)
    # the distinct set (IN semantics) also lets Catalyst drop joins the view needs only for
    # names, so the planner sees its true, small size and broadcasts it
    r = r.join(av.select("AssetId").distinct(), "AssetId", "left_semi")
    if exclude_asset_group_id is not None:
        keep = assets.where(F.col("AssetGroupId") != F.lit(exclude_asset_group_id))
        if organization_id is not None:
            keep = keep.where(F.col("OrganizationId") == F.lit(int(organization_id)))
            r = r.join(keep.select(F.col("ID").alias("AssetId")).distinct(), "AssetId", "left_semi")
        else:
            k = keep.select(F.col("ID").alias("AssetId"), "OrganizationId").distinct()
            r = r.join(k, ["AssetId", "OrganizationId"], "left_semi")
    return r


def dwell_statistics(readings: DataFrame, asset_view: DataFrame, assets: DataFrame,
                     organization_id: int | None = None,
                     organization_ids: Sequence[int] | None = None,
                     exclude_asset_group_id: int | None = None,
                     device_type: str = "", bands: PowerBands = PowerBands()) -> DataFrame:
    """One row: ``TotalYears`` (int, NULL when there is no interval) and
    ``HighPercent, MediumPercent, LowPercent, CriticalPercent`` (2 decimals, 0.0 when empty)."""
    r = dwell_readings(readings, asset_view, assets, organization_id, organization_ids,
                       exclude_asset_group_id, device_type)
    return segment_statistics(asset_segments(r, bands))


def segment_statistics(assets: DataFrame) -> DataFrame:
    """``dwell_result`` over one segment for each asset. An asset's n readings have n - 1 intervals."""
    agg = assets.agg(F.sum(F.col("Readings") - 1).alias("_n"), *[F.sum(c).alias(f"_m_{m}") for c, m in zip(MINUTES, K.MODES)])
    total = sum((F.col(f"_m_{m}") for m in K.MODES[1:]), F.col(f"_m_{K.MODES[0]}"))
    return dwell_result(agg.select(F.when(F.col("_n") > 0, total).alias("_total"), *[f"_m_{m}" for m in K.MODES]))


def dwell_result(agg: DataFrame) -> DataFrame:
    """``TotalYears`` and the four percents from one row of ``_total`` (NULL when there is no
    interval) and ``_m_<Band>`` minutes."""
    years = F.expr(f"CAST((_total * 2 + {K.MINUTES_PER_YEAR}) div {2 * K.MINUTES_PER_YEAR} AS INT)")
    return agg.select(years.alias("TotalYears"),
                      *[ratio_percent(f"_m_{m}", "_total").alias(f"{m}Percent") for m in K.MODES])

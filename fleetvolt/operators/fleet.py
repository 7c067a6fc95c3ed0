"""Device-registry operators: active devices, organization filters, device counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetvolt import constants as K

def active_filter(asset_view: DataFrame, device_type: str) -> DataFrame:
    return asset_view.where((F.col("DeviceType") == device_type)
                            & (F.col("DeviceStatus") == K.ACTIVE_STATUS))


def active_devices(asset_view: DataFrame, device_type: str) -> DataFrame:
    """Active devices of one type, in the snapshot's naming (``DeviceID`` = device name,
    ``DeviceName`` = asset name)."""
    return active_filter(asset_view, device_type).select(
        "AssetId", F.col("DeviceName").alias("DeviceID"), F.col("AssetName").alias("DeviceName"),
        "OrganizationId", "OrgName", "DeviceType", "DeviceStatus")


def active_device_ids(asset_view: DataFrame, device_type: str) -> DataFrame:
    """Distinct non-NULL ``DeviceID`` of the active devices (the report's active set)."""
    return (active_devices(asset_view, device_type).select("DeviceID")
            .where(F.col("DeviceID").isNotNull()).distinct())


def org_predicate(column: str, organization_id: int | None = None,
                  organization_ids: Sequence[int] | None = None) -> Column | None:
    """Organization filter with the report's precedence: a non-empty list, else a single id,
    else none (an empty list falls through to the single id)."""
    if organization_ids is not None and len(organization_ids) > 0:
        return F.col(column).isin([int(i) for i in organization_ids])
    if organization_id is not None:
        return F.col(column) == F.lit(int(organization_id))
    return None


def filter_orgs(df: DataFrame, column: str, organization_id: int | None = None,
                organization_ids: Sequence[int] | None = None) -> DataFrame:
    """Apply ``org_predicate``. Spark keeps a long IN list as one hashed set, so a list of any length is
    a filter on the scan and needs no join."""
    pred = org_predicate(column, organization_id, organization_ids)
    return df if pred is None else df.where(pred)


def org_device_counts(asset_view: DataFrame, organization_ids: Sequence[int] | None,
                      device_type: str) -> DataFrame:
    """Active devices per organization of the list; empty list -> empty frame.
    Sorted by count descending, then organization id (report order)."""
    av = active_filter(asset_view, device_type)
    if not organization_ids:
        av = av.where(F.lit(False))
    else:
        av = filter_orgs(av, "OrganizationId", organization_ids=organization_ids)
    return (av.groupBy("OrganizationId", "OrgName").agg(F.count(F.lit(1)).alias("DevicesCount"))
            .orderBy(F.col("DevicesCount").desc(), F.col("OrganizationId")))


def total_device_count(asset_view: DataFrame, organization_ids: Sequence[int] | None,
                       device_type: str) -> DataFrame:
    """One row ``TotalDevices``: active devices in the listed organizations (0 for an empty
    list)."""
    av = active_filter(asset_view, device_type)
    if not organization_ids:
        av = av.where(F.lit(False))
    else:
        av = filter_orgs(av, "OrganizationId", organization_ids=organization_ids)
    return av.agg(F.count(F.lit(1)).alias("TotalDevices"))

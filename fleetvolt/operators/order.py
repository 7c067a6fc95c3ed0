"""Report orderings, applied at the edge (when a result is shown or exported).

Results are compared and joined order-insensitively everywhere else, so no operator sorts;
these helpers give the orders the reports use. Each is a global sort (range-partitioned by
Spark), meant for final, report-sized frames or for a written export.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_first(df: DataFrame, ts: str = "EventTimeUTC", tiebreak: str | None = "ID") -> DataFrame:
    """Newest first (raw uplinks, legacy snapshot)."""
    cols = [F.col(ts).desc_nulls_last()] + ([F.col(tiebreak).desc_nulls_last()] if tiebreak and tiebreak in df.columns else [])
    return df.orderBy(*cols)


def device_order() -> list:
    return [F.col("DeviceID").asc_nulls_first(), F.col("AssetId").asc_nulls_first()]


def owner_order() -> list:
    return [F.col("OrgName").asc_nulls_first(), F.col("DeviceName").asc_nulls_first()]


def by_device(df: DataFrame) -> DataFrame:
    """Current-source snapshot order: by device id."""
    return df.orderBy(*device_order())


def by_owner_and_device(df: DataFrame) -> DataFrame:
    """Active-device list order: organization name, then device (asset) name."""
    return df.orderBy(*owner_order())


def table_order() -> list:
    """Section-table order: lowest voltage first, missing voltages last, then device id."""
    return [F.col("Voltage").asc_nulls_last(), F.col("DeviceID").asc_nulls_last()]


def by_voltage(df: DataFrame) -> DataFrame:
    """Section tables: lowest voltage first, missing voltages last."""
    return df.orderBy(*table_order())


def by_date(df: DataFrame, column: str = "report_date") -> DataFrame:
    """Dates by value (never by label text)."""
    return df.orderBy(F.col(column).asc())

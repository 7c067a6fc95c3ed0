from datetime import datetime

from fleetvolt import schemas


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)


def readings(spark, rows):
    """rows: (ID, OrganizationId, AssetId, 'YYYY-MM-DD HH:MM:SS' or None, Voltage)"""
    data = [(i, o, a, ts(t) if t else None, v) for i, o, a, t, v in rows]
    return spark.createDataFrame(data, schemas.READINGS)


def assets(spark, rows):
    return spark.createDataFrame(rows, schemas.ASSETS)


def orgs(spark, rows):
    return spark.createDataFrame(rows, schemas.ORGANIZATIONS)


def asset_view(spark, rows):
    return spark.createDataFrame(rows, schemas.ASSET_VIEW)


def snapshot(spark, rows):
    """rows: (ReportID, OrganizationId, CustomerName, AssetId, DeviceID, DeviceName, time, Voltage, PowerMode)"""
    data = [r[:6] + (ts(r[6]) if r[6] else None,) + r[7:] for r in rows]
    return spark.createDataFrame(data, schemas.SNAPSHOT)


def bursts(spark, rows):
    """rows: (ID, DeviceID, DeviceName, time, PayloadData, CustomerName, FPort)"""
    data = [r[:3] + (ts(r[3]) if r[3] else None,) + r[4:] for r in rows]
    return spark.createDataFrame(data, schemas.BURSTS)


def _key(t):
    return tuple((v is not None, str(v)) for v in t)


def rows(df, *cols):
    """Collected rows as tuples, sorted with NULLs first (test frames are small)."""
    got = df.select(*cols).collect() if cols else df.collect()
    return sorted((tuple(r) for r in got), key=_key)

"""Fixed schemas of the input tables and of the snapshot store (see FIXTURES.md)."""

from pyspark.sql import types as T

READINGS = T.StructType([
    T.StructField("ID", T.LongType()),
    T.StructField("OrganizationId", T.IntegerType()),
    T.StructField("AssetId", T.LongType()),
    T.StructField("EventTime", T.TimestampNTZType()),
    T.StructField("Voltage", T.DoubleType()),
])

ASSETS = T.StructType([
    T.StructField("ID", T.LongType()),
    T.StructField("DeviceName", T.StringType()),
    T.StructField("Name", T.StringType()),
    T.StructField("OrganizationId", T.IntegerType()),
    T.StructField("AssetGroupId", T.IntegerType()),
])

ORGANIZATIONS = T.StructType([
    T.StructField("ID", T.IntegerType()),
    T.StructField("Name", T.StringType()),
])

ASSET_VIEW = T.StructType([
    T.StructField("AssetId", T.LongType()),
    T.StructField("DeviceName", T.StringType()),
    T.StructField("AssetName", T.StringType()),
    T.StructField("OrganizationId", T.IntegerType()),
    T.StructField("OrgName", T.StringType()),
    T.StructField("DeviceType", T.StringType()),
    T.StructField("DeviceStatus", T.StringType()),
])

# Raw uplinks of the legacy source. ``ID`` is the uplink id, used to break time ties.
BURSTS = T.StructType([
    T.StructField("ID", T.LongType()),
    T.StructField("DeviceID", T.StringType()),
    T.StructField("DeviceName", T.StringType()),
    T.StructField("EventTimeUTC", T.TimestampNTZType()),
    T.StructField("PayloadData", T.StringType()),
    T.StructField("CustomerName", T.StringType()),
    T.StructField("FPort", T.IntegerType()),
])

# Snapshot of the current source, as stored (plus the partition columns report_date, source).
SNAPSHOT = T.StructType([
    T.StructField("ReportID", T.LongType()),
    T.StructField("OrganizationId", T.IntegerType()),
    T.StructField("CustomerName", T.StringType()),
    T.StructField("AssetId", T.LongType()),
    T.StructField("DeviceID", T.StringType()),
    T.StructField("DeviceName", T.StringType()),
    T.StructField("EventTimeUTC", T.TimestampNTZType()),
    T.StructField("Voltage", T.DoubleType()),
    T.StructField("PowerMode", T.StringType()),
])

# Snapshot of the legacy source.
LEGACY_SNAPSHOT = T.StructType([
    T.StructField("DeviceID", T.StringType()),
    T.StructField("DeviceName", T.StringType()),
    T.StructField("CustomerName", T.StringType()),
    T.StructField("EventTimeUTC", T.TimestampNTZType()),
    T.StructField("PayloadData", T.StringType()),
    T.StructField("Voltage", T.DoubleType()),
    T.StructField("PowerMode", T.StringType()),
])

# One record per stored snapshot: which (date, source, kind) exists in which version, and how it was made.
SNAPSHOT_COMMITS = T.StructType([
    T.StructField("report_date", T.DateType()),
    T.StructField("source", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("cutoff", T.TimestampNTZType()),
    T.StructField("query_seconds", T.DoubleType()),
    T.StructField("rows", T.LongType()),
    T.StructField("input_digest", T.StringType()),
    T.StructField("version", T.StringType()),
])

DEVICE_LIST = T.StructType([T.StructField("DeviceID", T.StringType())])

SENT_DATES = T.StructType([T.StructField("report_date", T.DateType())])


def conform(df, schema: T.StructType, keep: tuple[str, ...] = (), optional: tuple[str, ...] = ()):
    """Select and cast ``df`` to ``schema``. A column that is missing raises, unless it is named in
    ``optional`` (then it becomes a typed NULL); columns named in ``keep`` are passed through when
    present."""
    from pyspark.sql import functions as F

    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in types and f.name not in optional]
    if missing:
        raise ValueError(f"input lacks the columns {missing}; it has {sorted(types)}")
    cols = []
    for f in schema.fields:
        if f.name not in types:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif types[f.name] == f.dataType:
            cols.append(F.col(f.name))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(cols + [F.col(c) for c in keep if c in types])

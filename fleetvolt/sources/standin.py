"""Stand-in tables built from the driver's TPC-H-like test data.

The reporting application reads a relational telemetry database that is not available here.
The test data carries the same shapes under other names; this module maps them (see
FIXTURES.md section 2) with plain projections and joins, so that every query reads the given
tables and its work grows with them.

=================  ==============================================================
readings           ``events``: event_id, user_id (asset), ts, value; organization =
                   the owning customer's nation
assets             ``customer``: id, name as device id, asset name (every seventh device
                   keeps its id as name, i.e. is unpaired), nation, balance group
organizations      ``nation``
asset view         ``customer`` joined with ``nation``; device type = market segment,
                   status Retired for every fifth customer, else Active
bursts             ``events`` joined with the asset and organization; payload text
                   ``Battery Level <value> Power mode <event_type>``; port ``event_id % 3``
allow-list         customers whose key is a multiple of 11
snapshot files     ``(date of ts, source)`` of ``events``: no source for every third user_id,
                   else by parity
sent-date log      dates of ``events`` whose largest event_id is no multiple of 3
=================  ==============================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetvolt import constants as K
from fleetvolt import schemas
from fleetvolt.functions.dates import date_label, snapshot_file_name
from fleetvolt.schemas import conform


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _asset_name(key: F.Column, name: F.Column) -> F.Column:
    return F.when(key % 7 == 0, name).otherwise(F.concat(F.lit("unit-"), key.cast("string")))


def readings(spark, sf_dir) -> DataFrame:
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    cu = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    df = ev.join(cu, ev.user_id == cu.c_custkey, "left").select(
        F.col("event_id").alias("ID"), F.col("c_nationkey").alias("OrganizationId"),
        F.col("user_id").alias("AssetId"), F.col("ts").alias("EventTime"),
        F.col("value").alias("Voltage"))
    return conform(df, schemas.READINGS)


def assets(spark, sf_dir) -> DataFrame:
    cu = _t(spark, sf_dir, "customer")
    df = cu.select(
        F.col("c_custkey").alias("ID"), F.col("c_name").alias("DeviceName"),
        _asset_name(F.col("c_custkey"), F.col("c_name")).alias("Name"),
        F.col("c_nationkey").alias("OrganizationId"),
        F.floor(F.col("c_acctbal") / 1000).alias("AssetGroupId"))
    return conform(df, schemas.ASSETS)


def organizations(spark, sf_dir) -> DataFrame:
    na = _t(spark, sf_dir, "nation")
    return conform(na.select(F.col("n_nationkey").alias("ID"), F.col("n_name").alias("Name")),
                   schemas.ORGANIZATIONS)


def asset_view(spark, sf_dir) -> DataFrame:
    cu = _t(spark, sf_dir, "customer")
    na = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    df = cu.join(na, cu.c_nationkey == na.n_nationkey, "left").select(
        F.col("c_custkey").alias("AssetId"), F.col("c_name").alias("DeviceName"),
        _asset_name(F.col("c_custkey"), F.col("c_name")).alias("AssetName"),
        F.col("c_nationkey").alias("OrganizationId"), F.col("n_name").alias("OrgName"),
        F.col("c_mktsegment").alias("DeviceType"),
        F.when(F.col("c_custkey") % 5 != 0, F.lit(K.ACTIVE_STATUS)).otherwise(F.lit("Retired"))
        .alias("DeviceStatus"))
    return conform(df, schemas.ASSET_VIEW)


def bursts(spark, sf_dir) -> DataFrame:
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "event_type")
    cu = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    na = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    df = (ev.join(cu, ev.user_id == cu.c_custkey, "left")
          .join(na, F.col("c_nationkey") == na.n_nationkey, "left")
          .select(
              F.col("event_id").alias("ID"), F.col("c_name").alias("DeviceID"),
              _asset_name(F.col("c_custkey"), F.col("c_name")).alias("DeviceName"),
              F.col("ts").alias("EventTimeUTC"),
              F.concat(F.lit(K.PAYLOAD_MARKER + " "), F.col("value").cast("string"),
                       F.lit(" Power mode "), F.col("event_type")).alias("PayloadData"),
              F.col("n_name").alias("CustomerName"),
              (F.col("event_id") % 3).alias("FPort")))
    return conform(df, schemas.BURSTS)


def device_list(spark, sf_dir) -> DataFrame:
    cu = _t(spark, sf_dir, "customer")
    return cu.where(F.col("c_custkey") % 11 == 0).select(F.col("c_name").alias("DeviceID")) \
        .where("DeviceID IS NOT NULL").distinct()


def snapshot_files(spark, sf_dir) -> DataFrame:
    """File names of stored snapshots, one per (date, source), as a directory listing gives."""
    ev = _t(spark, sf_dir, "events")
    src = (F.when(F.col("user_id") % 3 == 0, F.lit(None))
           .when(F.col("user_id") % 2 == 0, F.lit(K.SOURCE_CURRENT)).otherwise(F.lit(K.SOURCE_LEGACY)))
    pairs = ev.select(F.to_date("ts").alias("d"), src.alias("src")).distinct()
    bare = F.concat(F.lit(K.SNAPSHOT_PREFIX), date_label("d"), F.lit(K.SNAPSHOT_SUFFIX))
    return pairs.select(F.coalesce(snapshot_file_name("d", F.col("src")), bare).alias("file_name"))


def sent_labels(spark, sf_dir) -> DataFrame:
    """Sent-date log lines (labels such as ``5Jan24``)."""
    ev = _t(spark, sf_dir, "events")
    days = ev.groupBy(F.to_date("ts").alias("d")).agg(F.max("event_id").alias("last"))
    return days.where(F.col("last") % 3 != 0).select(F.date_format("d", K.LABEL_FORMAT).alias("value"))

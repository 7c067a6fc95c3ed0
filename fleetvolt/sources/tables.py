"""Typed readers for the input tables.

Every reader applies the fixed schema of ``fleetvolt.schemas`` so that downstream operators
never depend on inference. Parquet is the default format; any Spark source works through
``read_table`` (for example ``format="jdbc"`` with ``partitionColumn`` options for a
relational source, or a catalog table name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pyspark.sql import functions as F

from fleetvolt import constants as K
from fleetvolt import schemas
from fleetvolt.schemas import conform


def read_table(spark: SparkSession, path_or_name: str, schema: T.StructType,
               format: str = "parquet", **options) -> DataFrame:
    """Read ``path_or_name`` and conform it to ``schema``.

    A name without a path separator is looked up in the catalog; otherwise the path is read
    with ``format``. Column pruning and filter pushdown reach the scan because the result is a
    plain projection of it.
    """
    if format == "table" or ("/" not in path_or_name and ":" not in path_or_name):
        df = spark.table(path_or_name)
    else:
        df = spark.read.format(format).options(**options).load(path_or_name)
    return conform(df, schema, keep=(K.DATE_PARTITION,))   # day partition kept for pruning


def write_by_day(df: DataFrame, path: str, ts: str, mode: str = "overwrite", lookup: str | None = None,
                 row_group_bytes: int | None = None) -> None:
    """Store a readings / uplinks table partitioned by the day of ``ts`` (column
    ``event_date``), the layout the time-bounded operators prune on. ``overwrite`` replaces
    only the days present in ``df`` (dynamic partition overwrite), so reloading a day is
    idempotent.

    ``lookup`` names the column by which single assets are looked up (``AssetId``): the files are sorted by day and that column
    and carry a Bloom filter of it, so that a filter on a few values passes over row groups without them."""
    rows = df.withColumn(K.DATE_PARTITION, F.to_date(F.col(ts)))
    if lookup is not None:
        rows = rows.sortWithinPartitions(K.DATE_PARTITION, lookup)
    out = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(K.DATE_PARTITION)
    if lookup is not None:
        out = out.option(f"parquet.bloom.filter.enabled#{lookup}", "true")
    if row_group_bytes is not None:
        out = out.option("parquet.block.size", str(row_group_bytes))
    out.parquet(path)


def readings(spark, path, **kw):
    return read_table(spark, path, schemas.READINGS, **kw)


def assets(spark, path, **kw):
    return read_table(spark, path, schemas.ASSETS, **kw)


def organizations(spark, path, **kw):
    return read_table(spark, path, schemas.ORGANIZATIONS, **kw)


def asset_view(spark, path, **kw):
    return read_table(spark, path, schemas.ASSET_VIEW, **kw)


def bursts(spark, path, **kw):
    return read_table(spark, path, schemas.BURSTS, **kw)


def device_list(spark: SparkSession, path: str) -> DataFrame:
    """The device allow-list: a one-column CSV with a ``DeviceID`` header.

    Spark's CSV reader drops a UTF-8 byte-order mark and accepts CRLF line ends. Blank ids are
    dropped and the list is made distinct, so that joining it never multiplies rows.
    """
    df = (spark.read.schema(schemas.DEVICE_LIST).option("header", True)
          .option("encoding", "UTF-8").csv(path))
    return df.where("DeviceID IS NOT NULL AND trim(DeviceID) <> ''").distinct()

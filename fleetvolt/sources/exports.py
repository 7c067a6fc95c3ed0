"""Exports of report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetvolt import constants as K
from fleetvolt.operators.order import table_order


def export_overflow(tables: DataFrame, path: str, limit: int = K.PREVIEW_LIMIT) -> None:
    """Write the whole table of every section whose table has more than ``limit`` rows (the
    preview shows only ``limit``) as CSV with a header, one folder per section. The size test
    is a per-section count joined back (semi-join), computed in the same job as the write."""
    sizes = tables.groupBy("section").agg(F.count(F.lit(1)).alias("_n"))
    big = sizes.where(F.col("_n") > limit).select("section")
    rows = tables.join(big, "section", "left_semi")
    # Sorted as the report shows it (range-partitioned, so part files follow each other in order).
    # Static overwrite: a section that no longer overflows must not stay from an earlier run.
    (rows.orderBy("section", *table_order())
     .write.mode("overwrite").option("partitionOverwriteMode", "static").option("header", True)
     .partitionBy("section").csv(path))

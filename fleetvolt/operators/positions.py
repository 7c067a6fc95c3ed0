"""Positions of all rows in an order, without one task per group.

``row_number()`` over a whole table or over few large groups puts each group into one task. Here the rows are dealt over ranges
of the order (``repartitionByRange``), every range counts its rows per group, the counts before a range are added up (one row for
each range and group), and each range numbers its own rows from there on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetvolt.session import materialize


def with_position(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), name: str = "position") -> DataFrame:
    """``df`` with the 1-based position of each row within ``by`` in ``order``. Rows that tie are numbered in the order of
    all their columns, and equal rows in any order. The ranges are stored once, so that counting and numbering see the
    same; runs an action."""
    last = F.monotonically_increasing_id()            # so that equal rows too can lie in several ranges
    flat = [c for c, t in df.dtypes if not t.startswith(("map", "variant"))]
    keys = [*[F.col(b) for b in by], *order, F.xxhash64(*flat), F.col("__row")]
    ranged = df.withColumn("__row", last).repartitionByRange(*keys).withColumn("__range", F.spark_partition_id())
    rows = materialize(ranged, "ranges")
    sums = rows.groupBy("__range", *by).agg(F.count("*").alias("__n"))
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(F.col("__range").alias("__r"), *[F.col(b).alias(f"__by_{b}") for b in by],
                         F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__before"))
    same = F.col("__range") == F.col("__r")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"__by_{b}"))
    inside = Window.partitionBy("__range", *by).orderBy(*order, F.xxhash64(*flat), "__row")
    out = rows.withColumn("__at", F.row_number().over(inside)).join(before, same)
    return out.select(*df.columns, (F.col("__before") + F.col("__at")).cast("long").alias(name))

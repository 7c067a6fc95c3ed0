"""Time to the next reading of the same asset (``LEAD(time)``), safe for hot assets.

A plain ``lead(ts) OVER (PARTITION BY asset ORDER BY ts)`` puts every reading of one asset into one task.
Here the window runs over nested time buckets: first over ``(asset, 10 ms)``, then over ``(asset, minute)``,
``(asset, day)`` and ``(asset)``. On each level the rows that have a successor in their bucket are done, and
only the last row of each bucket goes up, with the first time of its bucket. So the window groups are bounded
whatever the readings do: a minute has at most 6,000 buckets of 10 ms, a day 1,440 minutes, and an asset as many
days as its history. Only readings of one asset within the same 10 ms share a group of the first level.

The buckets have fixed widths, so nothing has to be known about the data beforehand: the readings are scanned once,
and no table is broadcast. The rows that are done and those that go up come from the same shuffle (Spark reuses the
exchange); the big side is never joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetvolt.functions.timecalc import micros_index

FINEST_MICROS = 10_000        # width of the finest buckets
NESTING = (6_000, 1_440)      # buckets of 10 ms in a minute, minutes in a day

_NULL_BUCKET = -(2 ** 62)     # buckets of rows without a time sort before all real buckets
_NULL_ID_SPAN = 2 ** 20       # rows without a time are split into id ranges of this size
_NULL_ID_NULL_BUCKET = _NULL_BUCKET - 2 ** 50   # neither time nor id: first of all


def with_next_time(df: DataFrame, key: str = "AssetId", ts: str = "EventTime", tiebreak: str = "ID",
                   out: str = "NextTime", finest_micros: int = FINEST_MICROS,
                   nesting: tuple[int, ...] = NESTING) -> DataFrame:
    """Add ``out`` = time of the next row of the same ``key`` in ``(ts, tiebreak)`` order
    (NULL for the last row). Rows with a NULL time sort first, as in SQL Server; ties on
    time are ordered by ``tiebreak`` so the result is deterministic. A NULL key is a key like any other."""
    # rows without a time come first and are ordered by id alone, so id ranges keep that order
    untimed = F.lit(_NULL_BUCKET)
    if isinstance(df.schema[tiebreak].dataType, T.IntegralType):
        untimed = F.when(F.col(tiebreak).isNull(), F.lit(_NULL_ID_NULL_BUCKET)).otherwise(
            F.lit(_NULL_BUCKET) + F.floor(F.col(tiebreak) / F.lit(_NULL_ID_SPAN)))
    columns = [*df.columns, out]
    rows = df.withColumns({"_at": micros_index(ts), "_head": F.col(ts)})
    rows = rows.withColumn("_b", F.when(F.col(ts).isNotNull(), F.expr(f"_at div {finest_micros}")).otherwise(untimed.cast("long")))
    # An explicit exchange on (key, bucket): an upstream shuffle on the key alone would also satisfy the
    # window's requirement and bring back one task per asset, so it is not left to the planner.
    rows = rows.repartition(key, "_b")
    order = [F.col(ts).asc_nulls_first(), F.col(tiebreak).asc_nulls_first()]
    result = None
    for width in (*nesting, None):            # the last level's buckets are in one group per key
        w = Window.partitionBy(key, "_b").orderBy(*order)
        x = rows.withColumns({
            out: F.lead("_head").over(w), "_tail": F.lead(F.lit(1)).over(w).isNull(),
            "_first": F.first("_head").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
        done = x.where(~F.col("_tail")).select(*columns)
        result = done if result is None else result.unionByName(done)
        # The last row of each bucket stands for it on the next level, with the bucket's first time.
        above = F.expr(f"_b div {width}") if width else F.lit(0).cast("long")
        rows = x.where("_tail").select(*df.columns, F.col("_b").alias("_at"), F.col("_first").alias("_head"), above.alias("_b"))
        order = [F.col("_at").asc()]
    last = rows.withColumn(out, F.lead("_head").over(Window.partitionBy(key).orderBy(*order)))
    return result.unionByName(last.select(*columns))

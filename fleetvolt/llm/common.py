"""Shared helpers: whole-text expressions, tables in the shared folder, distributed ranks."""

from __future__ import annotations

import os
import sys
import tempfile
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that one window group should hold when an order is cut into blocks.
BLOCK_ROWS = 20_000

_FALLBACK: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which the driver and all executors share.

    Only a session on a local master may leave it unset; it then gets a scratch folder, as the
    driver and the tasks are one process there.
    """
    conf = spark.sparkContext.getConf()
    folder = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir: the executors are processes of their own")
    key = spark.sparkContext.applicationId
    if key not in _FALLBACK:
        _FALLBACK[key] = tempfile.mkdtemp(prefix="fleetvolt-llm-", dir=os.environ.get("TMPDIR", "/tmp"))
    return _FALLBACK[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/fleetvolt-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: what follows survives lost
    executors and never computes ``df`` again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`stored` that no later result reads."""
    spark = df.sparkSession
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles() if "/fleetvolt-" in f}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def worker_cache() -> dict:
    """A dictionary of this Python worker that outlives a task. The functions of this folder are shipped with every task, so
    module-level state of their own does not."""
    return sys.modules.setdefault("fleetvolt_worker_cache", types.ModuleType("fleetvolt_worker_cache")).__dict__


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches small enough for very long texts (rows and bytes per batch)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def quoted(name: str) -> str:
    """A column name as it stands, also with dots or backticks in it."""
    return "`" + name.replace("`", "``") + "`"


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, whatever they are called."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has a column called so in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def word_count(text: Column) -> Column:
    """Words of the whole text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_place(order_hash: Column | str) -> Column:
    """The place in [0, 1) of a 64-bit hash in its own order."""
    h = F.col(order_hash) if isinstance(order_hash, str) else order_hash
    return h.cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)


def unnamed_row(name: str) -> Column:
    """For hashes that deal out rows: null where ``name`` is there, else a number of the row, so that rows without an id spread
    like others. To be stored with the hash: a second evaluation may number the rows anew."""
    return F.when(F.col(name).isNull(), F.monotonically_increasing_id())


def running_before(df: DataFrame, group: list[str], place: Column, order: list[str], blocks: int,
                   weight: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over the rows before this one within ``group``, in the
    order of the columns ``order``. With weight 1 it is the rank from 0.

    ``place`` is a number in [0, 1) that never falls along that order. No group is one task, unless its rows share one
    place: the order is cut into ``blocks`` ranges of the place, their sums are added up first (one row per
    group and range), and only the rows of one range share a window. ``df`` is evaluated twice, so
    pass a stored table. Extra columns are kept.
    """
    n = F.lit(blocks)
    block = F.least(F.greatest(F.floor(place * n), F.lit(0)), n - 1).cast("long")
    keyed = df.withColumn("__block", block).withColumn("__w", weight)
    keys = [*group, "__block"]
    sums = keyed.groupBy(*keys).agg(F.sum("__w").alias("__sum"))
    w = Window.partitionBy(*group).orderBy("__block") if group else Window.orderBy("__block")
    before = sums.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                         (F.sum("__sum").over(w) - F.col("__sum")).alias("__before"))
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    joined = keyed.join(before, same, "left")
    inside = (Window.partitionBy(*keys).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (joined.withColumn(name, (F.col("__before") + F.sum("__w").over(inside) - F.col("__w")).cast("long"))
            .drop("__block", "__w", "__before", *[f"__k_{k}" for k in keys]))


def blocks_for(rows: int) -> int:
    return max(1, -(-rows // BLOCK_ROWS))

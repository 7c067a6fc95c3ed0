"""Snapshot store: one parquet dataset per source, in versions that are never changed, and a log of commits.

* A write makes a new version folder and publishes it last, as one entry of the commit log that is created only if
  it does not exist (``commits``). A write that fails or dies leaves the stored snapshots as they were; its folder is never
  read. Of writers at the same time each publishes an entry of its own, and the later one counts.
* The entry says, for every date of the write, the version, the number of rows (0 for a date without rows, which so counts
  as stored), how long the computation took, the kind of the snapshot (``dated``: up to a cut-off; ``open``: all readings
  so far; ``imported``) with its cut-off, and a digest of the input readings if the caller has one.
* A date can be stored in several kinds. Reading prefers the dated one, then an imported, then an open one.
* Every read names its schema and exactly the folders of the requested dates; nothing else is listed.

The store folder must be on shared storage on a cluster (the same kind of location as
``spark.checkpoint.dir``), never a machine-local folder.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetvolt import constants as K
from fleetvolt import schemas
from fleetvolt.functions.timecalc import date_lit
from fleetvolt.sources.commits import CommitLog, _hadoop_path, names

DATED, IMPORTED, OPEN = "dated", "imported", "open"
KINDS = (DATED, IMPORTED, OPEN)      # in the order in which reading prefers them

_SCHEMAS = {K.SOURCE_CURRENT: schemas.SNAPSHOT, K.SOURCE_LEGACY: schemas.LEGACY_SNAPSHOT}
_DATE = T.StructField("report_date", T.DateType())
_VERSION = T.StructField("version", T.StringType())


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/commits", schemas.SNAPSHOT_COMMITS)

    def data_path(self, source: str) -> str:
        """Each source has a dataset of its own, as their columns differ."""
        if source not in _SCHEMAS:
            raise ValueError(f"unknown source {source!r}; known are {sorted(_SCHEMAS)}")
        return f"{self.root}/snapshots_{source}"

    # ---- writing --------------------------------------------------------------------------
    def _stage(self, rows: DataFrame, source: str) -> tuple[str, dict[date, int]]:
        """Write ``rows`` as a new version; its name and the rows of each date, from the written files' footers."""
        version = uuid.uuid4().hex
        path = f"{self.data_path(source)}/version={version}"
        (schemas.conform(rows, _SCHEMAS[source], keep=("report_date",), optional=("CustomerName",))
         .write.partitionBy("report_date").parquet(path))
        stored = self.spark.read.schema(T.StructType([*_SCHEMAS[source].fields, _DATE])).parquet(path)
        counts = stored.groupBy("report_date").count().collect()          # one row per date of the write
        return version, {r["report_date"]: r["count"] for r in counts}

    def write(self, snapshot: DataFrame, source: str, dates: Sequence[date], kind: str = DATED,
              cutoffs: Mapping[date, datetime] | None = None, digests: Mapping[date, str] | None = None) -> None:
        """Store ``snapshot`` under ``source``. ``dates`` are the report dates it holds
        (the caller knows them: one report date, or the backfilled ones); what is stored for them in this ``kind`` is
        replaced, also by nothing: a date without rows is stored with a count of 0. Rows of other dates are not
        written. ``cutoffs`` says up to when the readings of each date were read (not known if absent)."""
        if "report_date" not in snapshot.columns:
            raise ValueError("snapshot needs a report_date column")
        if kind not in KINDS:
            raise ValueError(f"unknown kind {kind!r}; known are {KINDS}")
        dates = sorted(set(dates))
        t0 = time.time()
        version, counts = self._stage(snapshot.where(F.col("report_date").isin([date_lit(d) for d in dates])), source)
        seconds = {d: time.time() - t0 for d in dates}
        self._publish(source, kind, version, {d: counts.get(d, 0) for d in dates}, seconds, cutoffs or {}, digests or {})

    def _publish(self, source: str, kind: str, version: str, counts: Mapping[date, int], seconds: Mapping[date, float],
                 cutoffs: Mapping[date, datetime], digests: Mapping[date, str]) -> None:
        self.log.publish(
            {"report_date": d.isoformat(), "source": source, "kind": kind, "version": version, "rows": int(n),
             "query_seconds": float(seconds[d]) if seconds.get(d) is not None else None, "input_digest": digests.get(d),
             "cutoff": cutoffs[d].isoformat(sep=" ") if d in cutoffs else None} for d, n in counts.items())

    def import_files(self, folder: str) -> DataFrame:
        """Move snapshot CSV files of the original application (``legacy_files``) into the
        store, both sources, keeping each file's recorded query seconds. Returns the run rows
        of the imported snapshots. Re-importing replaces the same dates (idempotent)."""
        from fleetvolt.sources.legacy_files import read_snapshot_files

        imported = []
        for source in _SCHEMAS:
            rows, runs = read_snapshot_files(self.spark, folder, source)
            seconds = {r.report_date: r.query_seconds for r in runs.collect()}  # one per file
            if not seconds:
                continue
            version, counts = self._stage(rows.where(F.col("report_date").isNotNull()), source)
            self._publish(source, IMPORTED, version, {d: counts.get(d, 0) for d in seconds}, seconds, {}, {})
            imported += [(d, source) for d in seconds]
        return self.runs().join(
            self.spark.createDataFrame(imported, "report_date date, source string"),
            ["report_date", "source"], "left_semi")

    # ---- reading --------------------------------------------------------------------------
    def runs(self) -> DataFrame:
        """One row for every stored snapshot: ``report_date, source, kind, cutoff, query_seconds, rows,
        input_digest, version`` (empty when nothing is stored yet)."""
        w = Window.partitionBy("report_date", "source", "kind").orderBy(F.desc("commit"))
        latest = self.log.records().withColumn("_at", F.row_number().over(w)).where("_at = 1")
        return schemas.conform(latest, schemas.SNAPSHOT_COMMITS)

    def catalogue(self) -> DataFrame:
        return self.runs().select("report_date", "source").distinct()

    def entry(self, report_date: date, source: str, kind: str | None = None):
        """The run row that a read of (date, source) uses, or None."""
        found = self._entries([report_date], source, kind)
        return found[0] if found else None

    def _entries(self, dates: Sequence[date] | None, source: str, kind: str | None) -> list:
        runs = self.runs().where(F.col("source") == source)
        if dates is not None:
            runs = runs.where(F.col("report_date").isin([date_lit(d) for d in dates]))
        best: dict = {}
        for r in runs.collect():                              # at most three per stored date
            if kind in (None, r.kind) and (r.report_date not in best or KINDS.index(r.kind) < KINDS.index(best[r.report_date].kind)):
                best[r.report_date] = r
        return [best[d] for d in sorted(best)]

    def read(self, dates: Sequence[date] | None = None, source: str = K.SOURCE_CURRENT, kind: str | None = None) -> DataFrame:
        """Stored snapshot rows of one source, always with that source's columns. Only the folders of the
        requested dates are read."""
        # a new StructType: ``StructType.add`` would change the shared schema in place
        stored = T.StructType([*_SCHEMAS[source].fields, _DATE])
        root = self.data_path(source)
        paths = [f"{root}/version={r.version}/report_date={r.report_date}" for r in self._entries(dates, source, kind) if r.rows]
        if paths:
            df = (self.spark.read.schema(T.StructType([*_SCHEMAS[source].fields, _VERSION, _DATE]))
                  .option("basePath", root).parquet(*paths).drop("version"))
        else:
            df = self.spark.createDataFrame([], stored)
        return df.withColumn("source", F.lit(source))

    def vacuum(self) -> list[str]:
        """Delete the version folders that no run row names any more; their names. Not while writers or readers of older
        versions are at work."""
        live = {r.version for r in self.runs().select("version").distinct().collect()}
        gone = []
        for source in _SCHEMAS:
            for name in names(self.spark, self.data_path(source)):
                if name.startswith("version=") and name.removeprefix("version=") not in live:
                    fs, p = _hadoop_path(self.spark, f"{self.data_path(source)}/{name}")
                    fs.delete(p, True)
                    gone.append(name.removeprefix("version="))
        return gone

    def exists(self, report_date: date, source: str, kind: str | None = None) -> bool:
        return self.entry(report_date, source, kind) is not None

    def load_or_compute(self, report_date: date, source: str, compute: Callable[[], DataFrame], kind: str = DATED,
                        cutoff: datetime | None = None, digest: str | None = None) -> DataFrame:
        """Stored snapshot of (date, source, kind) if present (an imported one serves for a dated one); else compute it,
        store it, and read it back (the written table also cuts the lineage for the report built on it)."""
        for k in (kind, IMPORTED) if kind == DATED else (kind,):
            if self.exists(report_date, source, k):
                return self.read([report_date], source, k)
        self.write(compute(), source, [report_date], kind, {report_date: cutoff} if cutoff else None,
                   {report_date: digest} if digest else None)
        return self.read([report_date], source, kind)

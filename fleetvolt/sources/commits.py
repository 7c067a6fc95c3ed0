"""Small files that are made once: the commit entries of the stores.

An entry is published by creating a file that must not exist yet, so of several writers exactly one gets a name. On a local
file system the content is complete when the name appears (a hard link to a finished file); elsewhere the store's own
create-without-overwrite decides, and readers pass over an entry whose content is not complete yet.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def create_new(spark: SparkSession, path: str, content: bytes) -> bool:
    """Create ``path`` with ``content`` if it does not exist; whether this call created it."""
    fs, p = _hadoop_path(spark, path)
    if fs.getUri().getScheme() == "file":
        local = unquote(urlparse(fs.makeQualified(p).toString()).path)
        os.makedirs(os.path.dirname(local), exist_ok=True)
        draft = os.path.join(os.path.dirname(local), f".{uuid.uuid4().hex}")
        with open(draft, "wb") as f:
            f.write(content)
        try:
            os.link(draft, local)
            return True
        except FileExistsError:
            return False
        except OSError:                      # a file system without hard links
            try:
                with open(local, "xb") as f:
                    f.write(content)
                return True
            except FileExistsError:
                return False
        finally:
            os.unlink(draft)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(content))
    out.close()
    return True


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in ``folder`` (none if it is not there)."""
    fs, p = _hadoop_path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def move_part(spark: SparkSession, folder: str, path: str) -> None:
    """Give the one part file that Spark wrote to ``folder`` the name ``path``, and remove the folder."""
    fs, p = _hadoop_path(spark, folder)
    part = next(n for n in names(spark, folder) if n.startswith("part-"))
    fs.rename(_hadoop_path(spark, f"{folder}/{part}")[1], _hadoop_path(spark, path)[1])
    fs.delete(p, True)


class CommitLog:
    """Numbered entries, each a JSON file of one or more records; a later entry overrides earlier ones."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema

    def publish(self, records: Iterable[dict]) -> int:
        """Append one entry; its number. Writers that publish at the same time get different numbers."""
        body = "".join(json.dumps(r) + "\n" for r in records).encode()
        taken = [int(n.split(".")[0]) for n in names(self.spark, self.folder) if n.split(".")[0].isdigit()]
        number = max(taken, default=0) + 1
        while not create_new(self.spark, f"{self.folder}/{number:012d}.json", body):
            number += 1
        return number

    def records(self) -> DataFrame:
        """All records with the number of their entry in ``commit``; incomplete ones are passed over."""
        with_number = T.StructType([*self.schema.fields, T.StructField("commit", T.LongType())])
        if not names(self.spark, self.folder):
            return self.spark.createDataFrame([], with_number)
        try:
            read = self.spark.read.schema(self.schema).option("mode", "DROPMALFORMED").json(f"{self.folder}/*.json")
        except AnalysisException:
            return self.spark.createDataFrame([], with_number)
        number = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)", 1).cast("long")
        return read.withColumn("commit", number).where(F.col(self.schema.fields[0].name).isNotNull())

"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


BATCH_ROWS = 1_000


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for a context, so that it need not be installed there.

    Also holds the session's Arrow batches to ``BATCH_ROWS`` rows: whole texts
    are long, and a batch is in memory on both sides.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_lexloom_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="lexloom-")) / "lexloom.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    context.addPyFile(str(path))
    context._lexloom_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where that is unset it becomes a folder of the warehouse, which a cluster
    shares, and for a local master a temporary one.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        local = spark.sparkContext.master.split("[")[0] == "local"
        found = "file://" + tempfile.mkdtemp(prefix="lexloom-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_lexloom"
        spark.conf.set("spark.checkpoint.dir", found)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


class Scratch:
    """Tables written once and reread, so that a lost executor costs a reread only.

    Used as a context manager: on leaving, the folder goes.  What is returned
    to the caller is made with :meth:`keep`, whose files Spark itself removes
    when the frame is no longer referenced.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/lexloom-{uuid.uuid4().hex}"
        self.count = 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.remove(self.path)

    def remove(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def new_path(self, name: str) -> str:
        self.count += 1
        return f"{self.path}/{self.count:03d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write a frame and read it back."""
        path = self.new_path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._lexloom_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Remove a table made by :meth:`table` before the end."""
        self.remove(df._lexloom_path)

    def keep(self, df: DataFrame) -> DataFrame:
        """A checkpoint of a result, independent of the scratch tables."""
        return df.checkpoint(eager=True)

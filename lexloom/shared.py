"""The folder that driver and executors share, and cuts of a plan there."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


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


def cut(df: DataFrame) -> DataFrame:
    """The frame, computed once into the shared folder; what is built on it reads it from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)

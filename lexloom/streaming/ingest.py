"""Landed word-list files as a stream, for builds that run as files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import parsing


def base_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """``word, freq`` of all word lists that land in a folder; the batch parser, unchanged."""
    return parsing.base_entries(spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder))


def running_counts(words: DataFrame) -> DataFrame:
    """Summed frequencies by word; the state is one row a word."""
    return words.groupBy("word").agg(F.sum("freq").alias("freq"))

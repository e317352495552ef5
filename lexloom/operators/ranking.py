"""Dense numbering of rows in a global order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def numbered(df: DataFrame, bucket: list[Column], order: list[Column], name: str, start: int = 1) -> DataFrame:
    """Adds ``name``: consecutive numbers in the order ``bucket``, then ``order``.

    Rows are counted by bucket; only the counts are summed up in one place, and
    rows are numbered inside their bucket.  Choose buckets so that none is large.
    """
    keys = [f"_b{i}" for i in range(len(bucket))]
    rows = df.select("*", *[b.alias(k) for b, k in zip(bucket, keys, strict=True)])
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy(*keys).rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select(*[F.col(k).alias(f"{k}_") for k in keys], F.coalesce(before, F.lit(0)).alias("_before"))
    same = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).join(offsets, cond).select(*df.columns, (F.col("_before") + F.col("_place") + (start - 1)).cast("bigint").alias(name))


def capped(df: DataFrame, keys: list[str], order: list[Column], cap: int) -> DataFrame:
    """The first ``cap`` rows of each key; tasks cut their own rows first."""
    return df.withColumn("_place", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_place") <= cap).drop("_place")

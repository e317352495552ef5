"""Joins with one key in a third of all rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexloom.llm import skew


@pytest.fixture()
def rows(spark):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 5000)
    return spark.range(60_000).select("id", key.alias("k"))


def test_lookup_deals_hot_and_null_keys_out(spark, rows):
    table = rows.groupBy("k").agg(F.count("*").alias("c"), F.max("id").alias("top"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = skew.lookup(rows, ["k"], table, "c", 60_000)
        sizes = sorted(r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) == 16 and sizes[-1] < 3 * sizes[8]


@pytest.mark.parametrize("size", [None, 10])
def test_lookup_equals_a_plain_join(spark, rows, size):
    table = rows.groupBy("k").agg(F.count("*").alias("c"), F.max("id").alias("top")).where("k is null or k % 2 = 1")
    got = Counter((r["id"], r["k"], r["top"]) for r in skew.lookup(rows, ["k"], table, "c", 60_000, size).collect())
    assert got == Counter((r["id"], r["k"], r["top"]) for r in rows.join(table, "k", "left").select("id", "k", "top").collect())

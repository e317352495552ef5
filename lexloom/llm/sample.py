"""Bounded, seeded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most so many labelled rows fit a classifier.
MAX_ROWS = 16_000


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's text, modulo n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def labelled(labels: DataFrame, label: str, allowed: Column | None, max_rows: int = MAX_ROWS) -> DataFrame:
    """``(doc_id, label)``: at most ``max_rows`` documents, the first by a seeded hash.

    Rows without an id or label are left out; of repeated ids with different
    labels the lower label holds.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if allowed is not None:
        rows = rows.where(allowed)
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
    share = min(1.0, 1.1 * max_rows / max(1, rows.count()))
    hashed = F.xxhash64("doc_id", F.lit(11))
    if share < 1:
        rows = rows.where(F.pmod(hashed, F.lit(1 << 30)) < int(share * (1 << 30)))
    return rows.groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(F.pmod(hashed, F.lit(1 << 30)), "doc_id").limit(max_rows)


def with_text(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``(doc_id, text, label)`` of the chosen documents, one row each; ``chosen`` is bounded, and so is its broadcast.

    Of rows with the same id the least text stands for all, a null one only
    where there is no other, so that reruns agree.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))

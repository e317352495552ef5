"""Joins and filters that stay even when one key holds a third of all rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most so many keys can each hold more than one part in HEAVY of all rows.
HEAVY = 500
#: A table of at most so many rows is broadcast whole.
SMALL = 100_000


def lookup(rows: DataFrame, keys: list[str], table: DataFrame, count: str, total: int, size: int | None = None) -> DataFrame:
    """Left join of ``rows`` with ``table``, which has one row per key.

    ``table`` says in column ``count`` how many rows have the key.  Keys with
    more than ``total / HEAVY`` rows are joined by broadcast (there can be no
    more than ``HEAVY`` of them, at any size), the others by a shuffle in which
    no key is large; rows with a null key match nothing.  Where the table's ``size`` in rows is known and within
    ``SMALL``, all of it is broadcast.  The column ``count`` isn't returned.
    """
    if size is not None and size <= SMALL:
        return rows.join(F.broadcast(table.drop(count)), keys, "left").select(*rows.columns, *[c for c in table.columns if c not in (*keys, count)])
    bound = max(1, total // HEAVY)
    heavy = F.broadcast(table.where(F.col(count) > bound).drop(count).withColumn("_hit", F.lit(True)))
    light = table.where(F.col(count) <= bound).drop(count)
    values = [c for c in light.columns if c not in keys]
    first = rows.join(heavy, keys, "left")
    # A row that has its match, or can have none, gets no key for the second join but a salt: a
    # hash of the row, so that a repeated task deals alike.  Salt and keys are one value, since a
    # salt of its own would be a constant on the right side, and rows not be dealt by it.
    done = F.col("_hit").isNotNull()
    for k in keys:
        done = done | F.col(k).isNull()
    own = [F.when(~done, F.col(k)).alias(f"k{i}") for i, k in enumerate(keys)]
    second = first.withColumn("_deal", F.struct(F.when(done, 1 + F.pmod(F.xxhash64(*rows.columns), F.lit(996))).otherwise(0).alias("salt"), *own))
    known = light.where(" and ".join(f"`{k}` is not null" for k in keys))
    right = known.select(F.struct(F.lit(0).cast("bigint").alias("salt"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("_deal"), *[F.col(v).alias(f"_r_{v}") for v in values])
    out = second.join(right, "_deal", "left")
    return out.select(*rows.columns, *[F.coalesce(F.col(v), F.col(f"_r_{v}")).alias(v) for v in values])


class KeyFilter:
    """A Bloom filter of 64-bit keys, of at most ``2**max_bits`` bits at any size.

    It is built on the executors and merged by ``bit_or``; what reaches the
    driver and is broadcast is bounded by 2**max_bits / 8 bytes.  It only
    spares work: an exact join follows.
    """

    def __init__(self, keys: DataFrame, column: str, n: int, max_bits: int = 26):
        self.bits = int(min(max_bits, max(14, np.ceil(np.log2(16 * max(1, n))))))
        size = 1 << self.bits
        at = [F.pmod(F.xxhash64(F.col(column), F.lit(i)), F.lit(size)) for i in range(3)]
        words = (
            keys.where(F.col(column).isNotNull())
            .select(F.explode(F.array(*at)).alias("at"))
            .groupBy((F.col("at") / 64).cast("int").alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("v"))
        ).toArrow()
        mask = np.zeros(size // 64, np.int64)
        mask[words["w"].to_numpy().astype(np.int64)] = words["v"].to_numpy().astype(np.int64)
        self.shared = keys.sparkSession.sparkContext.broadcast(mask)

    def columns(self, column: Column) -> list[Column]:
        """Bit positions of a row's key, to be passed to :meth:`test`."""
        return [F.pmod(F.xxhash64(column, F.lit(i)), F.lit(1 << self.bits)).alias(f"_b{i}") for i in range(3)]

    @staticmethod
    def test(mask: np.ndarray, positions: list[np.ndarray]) -> np.ndarray:
        out = np.ones(len(positions[0]), bool)
        for p in positions:
            out &= (mask[p >> 6] >> (p & 63)) & 1 == 1
        return out

"""Which row of a key stays: first, last or greatest.

All policies are aggregates with map-side partial results (no window), so one
key with very many rows costs one row a task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row's values at the first row's place (``ord``)."""
    rest = [c for c in df.columns if c not in (*keys, *order)]
    best = F.max(F.struct(*order, *rest)).alias("_x")
    return df.groupBy(*keys).agg(best, F.min(F.struct(*order)).alias("_o")).select(*keys, *[F.col(f"_x.{c}") for c in rest], *[F.col(f"_o.{c}").alias(c) for c in order])


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    rest = [c for c in df.columns if c not in (*keys, *order)]
    return df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_x")).select(*keys, "_x.*")


def max_wins(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The row of the greatest value, a tie going to the first; its place is the key's first.

    ``order`` may be of any type that can be compared, pairs included.
    """
    rest = [c for c in df.columns if c not in (*keys, value, order)]
    best = F.min(F.struct((-F.col(value)).alias("_n"), order, value, *rest)).alias("_x")
    return df.groupBy(*keys).agg(best, F.min(order).alias(order)).select(*keys, f"_x.{value}", *[f"_x.{c}" for c in rest], order)

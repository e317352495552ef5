"""Validation gates: one-row reports with a status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import script
from lexloom.functions.script import Profile

LIMIT, SAMPLE = 100, 2000


class BuildRejected(RuntimeError):
    """A gate has failed."""


def char_inventory(df: DataFrame) -> DataFrame:
    """Distinct characters of the column ``word``."""
    return df.select(F.explode(F.split("word", "")).alias("ch")).where("ch <> ''").distinct()


def is_suspect(word: Column, profile: Profile, exempt: str | None = None) -> Column:
    """Some character is a variant that a plain table should not have; judged on characters, not words."""
    return F.translate(word, profile.suspects(exempt), "") != word


def suspect_chars(df: DataFrame, profile: Profile, exempt: str | None = None) -> DataFrame:
    """Suspect characters of the column ``word``; ``exempt`` replaces the profile's own exemptions."""
    return char_inventory(df).where(is_suspect(F.col("ch"), profile, exempt))


def suspect_words(df: DataFrame, profile: Profile, exempt: str | None = None) -> DataFrame:
    """Words with a suspect character."""
    return df.select("word").where(is_suspect(F.col("word"), profile, exempt)).distinct()


def plain_gate(df: DataFrame, profile: Profile, exempt: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``n, suspects, status``: OK without suspect words, WARN below the limit, else FAIL; one aggregate."""
    report = df.agg(F.count("*").alias("n"), F.count_distinct(F.when(is_suspect(F.col("word"), profile, exempt), F.col("word"))).alias("suspects"))
    return report.withColumn("status", F.when(F.col("suspects") == 0, "OK").when(F.col("suspects") < limit, "WARN").otherwise("FAIL"))


def variant_gate(df: DataFrame, profile: Profile, order: str, sample: int = SAMPLE) -> DataFrame:
    """``n, suspects, status``: FAIL when empty, WARN if one of the first rows is no variant."""
    n = df.agg(F.count("*").alias("n"))
    odd = df.orderBy(order).limit(sample).agg(F.count_if(~script.is_variant(F.col("word"), profile)).alias("suspects"))
    return n.join(F.broadcast(odd)).withColumn("status", F.when(F.col("n") == 0, "FAIL").when(F.col("suspects") > 0, "WARN").otherwise("OK"))


def ranked_gate(df: DataFrame, expected: DataFrame) -> DataFrame:
    """``n, lo, hi, expected, status`` of a table ``rank``: not empty, ranks 0 to n - 1, as many as ``expected (expected)``."""
    report = df.agg(F.count("*").alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi")).join(F.broadcast(expected))
    ok = (F.col("n") > 0) & (F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1) & (F.col("n") == F.col("expected"))
    return report.withColumn("status", F.when(F.coalesce(ok, F.lit(False)), "OK").otherwise("FAIL"))


def present(found: dict[str, int], needed: list[str]) -> list[str]:
    """Those of the needed tables that a database's catalog lacks."""
    return [t for t in needed if t not in found]


def overall(*reports: DataFrame) -> DataFrame:
    """``passed``: whether no report has failed; all are looked at."""
    rows = reports[0].select("status")
    for r in reports[1:]:
        rows = rows.unionByName(r.select("status"))
    return rows.agg(F.bool_and(F.col("status") != "FAIL").alias("passed"))


def require(report: DataFrame) -> None:
    """Raise where :func:`overall` did not pass."""
    if not report.first()["passed"]:
        raise BuildRejected("a gate has failed; see the reports")


def reconciled(expected: DataFrame, actual: DataFrame, key: str, value: str) -> DataFrame:
    """``key, status`` for every key of the manifest: match, changed or missing."""
    a = actual.select(F.col(key), F.col(value).alias("_v"), F.lit(True).alias("_here"))
    status = F.when(F.col("_here").isNull(), "missing").when(F.col(value).eqNullSafe(F.col("_v")), "match").otherwise("changed")
    return expected.join(a, key, "left").select(key, status.alias("status"))

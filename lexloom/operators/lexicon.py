"""Merging, splitting and adjusting lexicons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import scoring, script
from lexloom.functions.script import Profile


def fill(base: DataFrame, extra: DataFrame, freq: int = 1) -> DataFrame:
    """``base`` and those words of ``extra`` that it lacks, at a fixed frequency; ``source`` tells which."""
    new = extra.select("word").distinct().join(base.select("word"), "word", "left_anti")
    return base.select("word", "freq", F.lit("base").alias("source")).unionByName(new.select("word", F.lit(freq).cast("bigint").alias("freq"), F.lit("extra").alias("source")))


def classified(df: DataFrame, profile: Profile) -> DataFrame:
    """Adds ``class``: plain, variant or garbage."""
    return df.withColumn("class", script.script_class(F.col("word"), profile))


def dual(df: DataFrame, profile: Profile) -> DataFrame:
    """Domain rows for both tables: a variant goes to ``variant`` as it is and to ``plain`` folded; others to ``plain``."""
    word = F.col("word")
    sides = F.when(
        script.is_variant(word, profile),
        F.array(F.struct(F.lit("variant").alias("side"), word.alias("w")), F.struct(F.lit("plain").alias("side"), script.fold(word, profile).alias("w"))),
    ).otherwise(F.array(F.struct(F.lit("plain").alias("side"), word.alias("w"))))
    rest = [c for c in df.columns if c != "word"]
    return df.select(*rest, F.explode(sides).alias("_s")).select(*rest, F.col("_s.side").alias("side"), F.col("_s.w").alias("word"))


def adjusted(df: DataFrame, boost: DataFrame, demote: DataFrame) -> DataFrame:
    """Frequencies multiplied, then divided, truncating both times; factor tables are curated lists and joined by size."""
    out = df.join(boost.select("word", F.col("factor").alias("_m")), "word", "left").withColumn("freq", scoring.boosted(F.col("freq"), F.col("_m")))
    out = out.join(demote.select("word", F.col("factor").alias("_d")), "word", "left").withColumn("freq", scoring.demoted(F.col("freq"), F.col("_d")))
    return out.select(df.columns)


def unmatched(factors: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Factors whose word the lexicon lacks; they have no effect."""
    return factors.join(lexicon.select("word"), "word", "left_anti")


def compressed(df: DataFrame, name: str = "freq") -> DataFrame:
    """Frequencies on the log scale of the table's own maximum (one row, joined to all)."""
    top = df.agg(F.coalesce(F.max("freq"), F.lit(1)).alias("_top"))
    return df.join(F.broadcast(top)).withColumn(name, scoring.compress(F.col("freq"), F.col("_top"))).drop("_top")


def factors(nested: DataFrame, category: str = "category", entries: str = "entries") -> DataFrame:
    """``word, factor`` of rows with a map of words; a word of several rows has its last row's factor (``ord``)."""
    rows = nested.select("ord", F.posexplode(entries).alias("_p", "word", "factor"))
    return rows.groupBy("word").agg(F.max(F.struct("ord", "_p", "factor")).alias("_x")).select("word", F.col("_x.factor").alias("factor"))


def override(base: DataFrame, curated: DataFrame, key: str = "domain") -> DataFrame:
    """Curated rows replace all rows of the same domain."""
    return base.join(curated.select(key).distinct(), key, "left_anti").unionByName(curated)


def read_as(df: DataFrame, profile: Profile, overrides: DataFrame | None = None) -> DataFrame:
    """Adds ``reading``, of a word's own entry or of its characters; rows without a valid one go."""
    found: Column = script.reading(F.col("word"), profile)
    if overrides is not None:
        df = df.join(overrides.select("word", F.col("reading").alias("_own")), "word", "left")
        found = F.coalesce(F.col("_own"), found)
    return df.withColumn("reading", found).drop("_own").where(script.is_reading(F.col("reading")))


def candidates(common: DataFrame, system: DataFrame, reading: Column) -> DataFrame:
    """Words of a reading: ranked ones by rank, then others by frequency (``tier``, ``place``)."""
    ranked = common.where(reading).select("reading", "word", F.lit(0).alias("tier"), F.col("rank").cast("bigint").alias("place"))
    rest = system.where(reading).join(ranked.select("word"), "word", "left_anti")
    return ranked.unionByName(rest.select("reading", "word", F.lit(1).alias("tier"), (-F.col("freq")).cast("bigint").alias("place")))

"""Line and title parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"(?U)\s+"


def fields(line: Column) -> Column:
    """Fields between runs of any Unicode white space."""
    return F.split(F.regexp_replace(line, r"(?U)^\s+|\s+$", ""), SPACES)


def lines(content: Column) -> Column:
    """Lines of a whole file, whatever ends them."""
    return F.split(content, r"\r\n|\r|\n")


def without_marks(line: Column) -> Column:
    """A line without byte order marks at its start, trimmed."""
    return F.regexp_replace(line, "(?U)^[﻿\\s]+|\\s+$", "")


def is_content(line: Column) -> Column:
    """Neither blank nor a comment."""
    return (line != "") & ~line.startswith("#")


def title(text: Column) -> Column:
    """A title without what follows its first bracket, ASCII or full-width."""
    return F.trim(F.regexp_extract(text, r"^[^(（]*", 0))


def base_entries(raw: DataFrame) -> DataFrame:
    """``word, freq`` of lines ``value``: at least two fields, the second one digits; further fields are ignored."""
    parts = raw.select(fields(F.col("value")).alias("p")).where(F.size("p") >= 2)
    return parts.where(F.get("p", F.lit(1)).rlike("^[0-9]+$")).select(F.get("p", F.lit(0)).alias("word"), F.get("p", F.lit(1)).cast("bigint").alias("freq"))


def words(df: DataFrame, text: str = "text", *keep: str) -> DataFrame:
    """One row ``word`` for every run of letters of a text, lower-cased."""
    return df.select(*keep, F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word")).where("word <> ''")


def placed_words(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """As :func:`words`, with ``ord``, a pair of ``key`` and place that orders words."""
    rows = df.select(key, F.posexplode(F.split(F.lower(text), r"[^\p{L}]+")).alias("pos", "word")).where("word <> ''")
    return rows.select("word", F.struct(key, "pos").alias("ord"))

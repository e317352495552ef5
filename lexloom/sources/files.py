"""Readers of word lists, ranked lists, domain folders and YAML tables."""

from __future__ import annotations

import os
import urllib.request

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import parsing, script
from lexloom.functions.script import Profile
from lexloom.operators import ranking


def download(url: str, target: str, timeout: float = 60) -> str:
    """Fetch a file once; an existing one stays.  Certificates are checked."""
    if not os.path.exists(target):
        request = urllib.request.Request(url, headers={"User-Agent": "lexloom"})
        with urllib.request.urlopen(request, timeout=timeout) as reply:
            data = reply.read()
        os.makedirs(os.path.dirname(os.path.abspath(target)), exist_ok=True)
        with open(target, "wb") as f:
            f.write(data)
    return target


def read_base(spark: SparkSession, path: str, profile: Profile) -> DataFrame:
    """``word, freq`` of a word list, words of the script only."""
    return parsing.base_entries(spark.read.text(path)).where(script.is_word(F.col("word"), profile))


def read_base_placed(spark: SparkSession, path: str, profile: Profile) -> DataFrame:
    """As :func:`read_base`, with the line's number as ``ord``."""
    rows = spark.read.option("wholetext", True).text(path).select(F.posexplode(parsing.lines(F.col("value"))).alias("ord", "value"))
    found = rows.select("ord", parsing.fields(F.col("value")).alias("p")).where((F.size("p") >= 2) & F.get("p", F.lit(1)).rlike("^[0-9]+$"))
    found = found.select("ord", F.get("p", F.lit(0)).alias("word"), F.get("p", F.lit(1)).cast("bigint").alias("freq"))
    return found.where(script.is_word(F.col("word"), profile))


def _placed(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``file, ord, line`` of whole text files; a file is one row, so keep them small."""
    reader = spark.read.option("wholetext", True)
    rows = (reader.option("pathGlobFilter", glob) if glob else reader).text(path).select(F.col("_metadata.file_name").alias("file"), "value")
    lines = rows.select("file", F.posexplode(parsing.lines(F.col("value"))).alias("ord", "line"))
    return lines.select("file", "ord", parsing.without_marks(F.col("line")).alias("line")).where(parsing.is_content(F.col("line")))


def read_ranked(spark: SparkSession, path: str) -> DataFrame:
    """``rank, reading, word`` of a ranked list: ``reading<TAB>word`` in line order, duplicates kept."""
    parts = _placed(spark, path).select("ord", F.split("line", "\t").alias("p")).where(F.size("p") >= 2)
    rows = parts.select("ord", F.lower(F.trim(F.get("p", F.lit(0)))).alias("reading"), F.trim(F.get("p", F.lit(1))).alias("word")).where("reading <> '' and word <> ''")
    return ranking.numbered(rows, [F.floor(F.col("ord") / 10_000)], [F.col("ord")], "rank", 0).select("rank", "reading", "word")


def read_domains(spark: SparkSession, folder: str) -> DataFrame:
    """``domain_id, domain, ord, word, reading`` of a folder's ``.txt`` files; ids are places in name order."""
    lines = _placed(spark, folder, "*.txt")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).select(F.col("_metadata.file_name").alias("file"))
    ids = ranking.numbered(files, [F.substring("file", 1, 1)], [F.col("file")], "domain_id", 0)
    parts = lines.select("file", "ord", parsing.fields(F.col("line")).alias("p")).where(F.size("p") >= 2)
    rows = parts.select("file", "ord", F.get("p", F.lit(0)).alias("word"), F.get("p", F.lit(1)).alias("reading")).where(script.is_domain_reading(F.col("reading")))
    return rows.join(F.broadcast(ids), "file").select("domain_id", F.regexp_replace("file", r"\.[^.]*$", "").alias("domain"), "ord", "word", F.lower("reading").alias("reading"))


def read_factors(spark: SparkSession, path: str, strict_compat: bool = False) -> DataFrame:
    """``ord, category, entries`` of a YAML factor table; a missing file is empty.

    Flat tables and tables by category are both read; with ``strict_compat``
    only the latter.
    """
    data = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            data = yaml.safe_load(f) or {}
    rows = []
    for i, (k, v) in enumerate(data.items()):
        if isinstance(v, dict):
            rows.append((i, str(k), {str(w): float(x) for w, x in v.items()}))
        elif not strict_compat:
            rows.append((i, "", {str(k): float(v)}))
    return spark.createDataFrame(rows, "ord int, category string, entries map<string,double>")


def read_config(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """``name, display, category, max_depth``: a row for each category of each domain, or of those named."""
    with open(path, encoding="utf-8") as f:
        domains = (yaml.safe_load(f) or {}).get("domains", {})
    rows = [(k, v.get("display"), v.get("wiki_categories", []), int(v.get("max_depth", 2))) for k, v in domains.items() if names is None or k in names]
    df = spark.createDataFrame(rows, "name string, display string, categories array<string>, max_depth int")
    return df.select("name", "display", F.explode("categories").alias("category"), "max_depth")

"""The whole build: collect, merge, split, adjust, compress, number, gate and write."""

from __future__ import annotations

import datetime
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexloom.functions.script import Profile
from lexloom.operators import dedupe, gates, lexicon, ranking
from lexloom.plans import manifest
from lexloom.shared import cut
from lexloom.sources import domain_files, files, sqlite

DOMAIN_CAP = 25_000


SYSTEM_TABLES, DOMAIN_TABLES, RANKED_TABLE = ("system_dict", "system_dict_trad"), ("domain_words", "domain_words_trad"), "common_words"


@dataclass
class Sources:
    """Where a build's inputs are; ``titles (domain, title)`` come from a category scan or a table."""

    base: str
    titles: DataFrame
    ranked: str
    boost: str = ""
    demote: str = ""
    curated: DataFrame | None = None


def domain_entries(titles: DataFrame, profile: Profile, cap: int = DOMAIN_CAP, max_length: int | None = None) -> DataFrame:
    """``domain, word, reading`` of ``titles (domain, title)``: cleaned, of the script, distinct, read and capped by word order."""
    from lexloom.functions import parsing, script

    words = titles.select("domain", parsing.title(F.col("title")).alias("word")).where(script.is_word(F.col("word"), profile, max_length)).distinct()
    return ranking.capped(lexicon.read_as(words, profile), ["domain"], [F.col("word")], cap)


def system_lexicon(base: DataFrame, domains: DataFrame, boost: DataFrame, demote: DataFrame, profile: Profile) -> tuple[DataFrame, DataFrame]:
    """Both system tables of ``base (word, reading, freq, ord)`` and ``domains (domain_ord, ord, word, reading)``.

    The last entry of a word counts, at its first place; words of domains that
    the base lacks come behind, with frequency 1.  Plain words are adjusted,
    compressed and numbered by frequency and place; variants keep their raw
    frequency and their place.
    """
    merged = dedupe.last_wins(base.select("word", "ord", "reading", "freq"), ["word"], ["ord"])
    extra = dedupe.last_wins(domains.select("word", "domain_ord", "ord", "reading"), ["word"], ["domain_ord", "ord"]).join(merged.select("word"), "word", "left_anti")
    merged = merged.withColumn("late", F.lit(0)).withColumn("domain_ord", F.lit(0)).unionByName(extra.withColumn("freq", F.lit(1).cast("bigint")).withColumn("late", F.lit(1)), allowMissingColumns=True)
    split = lexicon.classified(merged, profile)
    plain = lexicon.compressed(lexicon.adjusted(split.where("class = 'plain'"), boost, demote))
    place = [F.col("late"), F.col("domain_ord"), F.col("ord")]
    plain = ranking.numbered(plain, [-F.col("freq"), F.col("late"), F.col("domain_ord"), F.floor(F.col("ord") / 10_000)], place, "id")
    variant = split.where("class = 'variant'")
    variant = ranking.numbered(variant, [F.col("late"), F.col("domain_ord"), F.floor(F.col("ord") / 10_000)], place, "id")
    return plain.select("id", "reading", "word", "freq"), variant.select("id", "reading", "word", "freq")


def write_system(plain: DataFrame, variant: DataFrame, path: str) -> None:
    """Both system tables: ids in order, an index by reading, frequency 0 where none is given."""
    for df, table in ((plain, SYSTEM_TABLES[0]), (variant, SYSTEM_TABLES[1])):
        rows = df.select("id", F.col("reading").alias("pinyin"), "word", F.col("freq").alias("frequency"))
        sqlite.write(rows, path, table, "id", "pinyin", {"id": "PRIMARY KEY AUTOINCREMENT", "pinyin": "NOT NULL", "word": "NOT NULL", "frequency": "DEFAULT 0"})


def write_domains(both: DataFrame, path: str) -> None:
    """Both domain tables of :func:`domain_files.domain_tables`: one row a word and domain, indexes by reading and domain."""
    must = {c: "NOT NULL" for c in ("word", "pinyin", "domain_id", "domain_name")}
    for side, table, index in (("plain", DOMAIN_TABLES[0], "pinyin,domain_id"), ("variant", DOMAIN_TABLES[1], "pinyin")):
        rows = both.where(F.col("side") == side).select("word", F.col("reading").alias("pinyin"), "domain_id", F.col("domain").alias("domain_name"))
        sqlite.write(rows.orderBy("domain_id", "word"), path, table, None, index, must, "word,domain_id")


def write_ranked(spark: SparkSession, source: str, path: str) -> DataFrame:
    """The ranked table from its text; a missing text ends the build."""
    if not os.path.exists(source):
        raise FileNotFoundError(source)
    ranked = cut(files.read_ranked(spark, source))
    rows = ranked.select("rank", F.col("reading").alias("pinyin"), "word")
    sqlite.write(rows, path, RANKED_TABLE, "rank", "pinyin", {"rank": "PRIMARY KEY", "pinyin": "NOT NULL", "word": "NOT NULL"})
    return ranked


def check_database(spark: SparkSession, path: str, needed: tuple[str, str], profile: Profile) -> DataFrame:
    """``status`` of a database with a plain and a variant table; FAIL where the file or a table is missing."""
    missing = gates.present(sqlite.tables(path), list(needed))
    if missing:
        return spark.createDataFrame([("FAIL",)], "status string")
    plain, variant = (sqlite.read(spark, path, t) for t in needed)
    place = "id" if "id" in variant.columns else "word"
    return gates.plain_gate(plain, profile).select("status").unionByName(gates.variant_gate(variant, profile, place).select("status"))


def check_ranked(spark: SparkSession, path: str, source: str) -> DataFrame:
    """``status`` of the ranked database against its text; FAIL where either is missing."""
    if not os.path.exists(source) or gates.present(sqlite.tables(path), [RANKED_TABLE]):
        return spark.createDataFrame([("FAIL",)], "status string")
    expected = files.read_ranked(spark, source).agg(F.count("*").alias("expected"))
    return gates.ranked_gate(sqlite.read(spark, path, RANKED_TABLE), expected).select("status")


def build(spark: SparkSession, sources: Sources, out: str, profile: Profile, now: datetime.datetime, cap: int = DOMAIN_CAP) -> dict:
    """The whole build into the folder ``out``; returns the manifest, or raises where a gate has failed.

    Domain lists are written as texts and read back, and the gates look at
    the written databases.  ``out`` must be a path that executors see.
    """
    entries = domain_entries(sources.titles, profile, cap)
    if sources.curated is not None:
        entries = lexicon.override(entries, sources.curated)
    entries = cut(entries)
    place = F.row_number().over(W.partitionBy("domain").orderBy("word"))
    domain_files.write_txt(entries.withColumn("ord", place), f"{out}/domains", ["domain words", "word<TAB>reading", "made by a build; don't edit"])
    rows = cut(files.read_domains(spark, f"{out}/domains"))
    base = lexicon.read_as(files.read_base_placed(spark, sources.base, profile), profile)
    domains = rows.select(F.col("domain_id").alias("domain_ord"), "ord", "word", "reading")
    boost, demote = (lexicon.factors(files.read_factors(spark, p)) for p in (sources.boost, sources.demote))
    write_system(*system_lexicon(base, domains, boost, demote, profile), f"{out}/system.db")
    write_domains(domain_files.domain_tables(rows, profile), f"{out}/domains.db")
    write_ranked(spark, sources.ranked, f"{out}/common.db")
    gates.require(
        gates.overall(
            check_database(spark, f"{out}/system.db", SYSTEM_TABLES, profile),
            check_database(spark, f"{out}/domains.db", DOMAIN_TABLES, profile),
            check_ranked(spark, f"{out}/common.db", sources.ranked),
        )
    )
    names = {f"{n}.db": sqlite.tables(f"{out}/{n}.db") for n in ("system", "domains", "common")}
    previous = manifest.load(f"{out}/version.json").get("version")
    found = manifest.manifest(manifest.artefacts(spark, out, "*.{db,txt}"), names, previous, now, manifest.commit())
    manifest.save(found, f"{out}/version.json")
    return found

"""The queries of this subpackage: each runs one operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, langid, mixing, near_dup, quality, tokenbin, toxicity, urlfilter, warc
from .scratch import Scratch, ship

URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives are written, read back by the salvage reader and removed once the result is kept."""
    pages = _table(spark, sf_dir, "pages")
    with Scratch(spark) as scratch:
        path = scratch.new_path("warc")
        warc.write(pages, path)
        read = warc.read(spark, path, with_payload=False).where("kind = 'record'")
        return scratch.keep(read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def token_index(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Writes the token files, reads them back and removes them once the index is kept."""
    with Scratch(spark) as scratch:
        path = scratch.new_path("tokens")
        tokenbin.write(docs, path)
        rows = scratch.table(tokenbin.read(spark, path), "rows")
        return scratch.keep(tokenbin.index(rows))


def op9_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index(spark, _table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_language_id": op2_language_id,
    "op3_warc": op3_warc,
    "op4_quality_rules": op4_quality_rules,
    "op5_mixing": op5_mixing,
    "op6_decontamination": op6_decontamination,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_token_binary": op9_token_binary,
    "op10_toxicity": op10_toxicity,
}

_URL = """
SELECT page_id, CASE WHEN cut THEN translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
       CASE WHEN cut THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
FROM (SELECT page_id, coalesce(contains(url, '://'), false) AS cut, substr(url, strpos(url, '://') + 3) AS rest FROM pages)
"""

ORACLES: dict[str, str] = {
    "op1_url_filter": f"""
WITH u AS ({_URL}), r(rule, rhost, rpath, verdict) AS (VALUES {", ".join(f"('{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{v}')" for r, v in URL_RULES)})
SELECT u.page_id, u.host, u.path, arg_max(r.rule, length(r.rule)) AS rule, coalesce(arg_max(r.verdict, length(r.rule)), 'allow') AS verdict
FROM u LEFT JOIN r ON ends_with('.' || u.host, '.' || r.rhost) AND starts_with(u.path, r.rpath)
GROUP BY ALL
""",
    "op3_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
     g AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest, CASE WHEN g.first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.first <> page_id THEN g.first END AS refers_to
FROM p LEFT JOIN g ON p.d = g.d
""",
}

"""Registered queries over the test tables, with their SQL.

The tables hold Latin text, so the queries use the Latin profile; the Han
profile runs through the same operators in the tests.
"""

from __future__ import annotations

import uuid
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexloom.functions import parsing, script
from lexloom.functions.script import LATIN
from lexloom.operators import dedupe, gates, graph, lexicon, ranking
from lexloom.plans import build
from lexloom.shared import cut, shared_dir
from lexloom.sources import domain_files, files

BOOST = {"common": {"the": 3.0, "and": 2.5, "of": 1.5}, "news": {"that": 1.25, "and": 2.0}}
DEMOTE = {"stale": {"the": 4.0, "in": 3.0, "is": 7.0}}
CONFIG = {"food": (["Food", "Cuisine"], 2), "sport": (["Sport"], 1), "music": (["Music", "Songs", "Bands"], 3)}
VERSIONS = ["2024.05.06.3", "2024.05.05.9", "broken", "2024.05.06.x"]
TODAY = "2024.05.06"
DOMAINS = ["src1", "src2", "src7"]
CAP = build.DOMAIN_CAP


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _words(spark: SparkSession, d: str, table: str = "documents") -> DataFrame:
    """Word counts of a text table."""
    return parsing.words(_t(spark, d, table)).groupBy("word").agg(F.count("*").alias("freq"))


def _rows(spark: SparkSession, table: dict) -> DataFrame:
    return spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(table.items())], "ord int, category string, entries map<string,double>")


def _domain_words(spark: SparkSession, d: str) -> DataFrame:
    return parsing.words(_t(spark, d, "documents").where("source is not null"), "text", "source").withColumnRenamed("source", "domain")


def lex_base(spark, d):
    """Word counts written as lines with an ideographic space, and parsed again."""
    lines = _words(spark, d).select(F.concat(F.lit(" "), "word", F.lit("　"), F.col("freq").cast("string"), F.lit(" n ")).alias("value"))
    return parsing.base_entries(lines).where(F.col("word").rlike("^[a-z]{1,6}$"))


def title_clean(spark, d):
    raw = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return _t(spark, d, "pages").select("page_id", parsing.title(raw).alias("title")).where("title <> ''")


def _edges(spark, d):
    def node(kind, c):
        return F.concat(F.lit(kind), F.col(c).cast("string"))

    nation = _t(spark, d, "nation").select(node("r", "n_regionkey").alias("parent"), node("n", "n_nationkey").alias("child"))
    customer = _t(spark, d, "customer").select(node("n", "c_nationkey").alias("parent"), node("c", "c_custkey").alias("child"))
    orders = _t(spark, d, "orders").select(node("c", "o_custkey").alias("parent"), node("o", "o_orderkey").alias("child"))
    return nation.unionByName(customer).unionByName(orders)


def graph_collect(spark, d):
    seeds = _t(spark, d, "region").where("r_regionkey in (1, 2)").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("node"))
    return graph.collect(_edges(spark, d), seeds, 3)


def domain_collect(spark, d):
    """Distinct words of the script in each domain, read, and capped by word order."""
    rows = _domain_words(spark, d).where(script.is_word(F.col("word"), LATIN)).distinct()
    return ranking.capped(lexicon.read_as(rows, LATIN), ["domain"], [F.col("word")], CAP)


def domain_subset(spark, d):
    return domain_collect(spark, d).where(F.col("domain").isin(DOMAINS))


def domain_cap(spark, d):
    counts = _domain_words(spark, d).groupBy("domain", "word").agg(F.count("*").alias("freq"))
    return ranking.capped(counts, ["domain"], [F.desc("freq"), F.col("word")], CAP)


def domain_clean(spark, d):
    """First place of each word and reading in a domain, without garbage."""
    docs = _t(spark, d, "documents").where("source is not null")
    rows = docs.select(F.col("source").alias("domain"), "doc_id", F.posexplode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("pos", "word")).where("word <> ''")
    rows = rows.where(~script.is_garbage(F.col("word"), LATIN)).withColumn("reading", script.fold(F.col("word"), LATIN))
    return dedupe.first_wins(rows, ["domain", "word", "reading"], ["doc_id", "pos"])


def domain_counts(spark, d):
    rows = _domain_words(spark, d).distinct()
    return rows.rollup("domain").agg(F.count("*").alias("n")).select(F.coalesce("domain", F.lit("(all)")).alias("domain"), "n")


def fill_merge(spark, d):
    return lexicon.fill(_words(spark, d), _words(spark, d, "conversations"))


def anti_new_words(spark, d):
    return parsing.words(_t(spark, d, "benchmark")).distinct().join(parsing.words(_t(spark, d, "documents")).distinct(), "word", "left_anti")


def last_wins(spark, d):
    return dedupe.last_wins(_t(spark, d, "events").select("user_id", "event_type", "ts", "event_id"), ["user_id"], ["ts", "event_id"])


def first_wins(spark, d):
    return dedupe.first_wins(_t(spark, d, "part").select("p_name", "p_size", "p_partkey", "p_brand"), ["p_name", "p_size"], ["p_partkey"])


def fold_max_wins(spark, d):
    words = parsing.placed_words(_t(spark, d, "documents"), "doc_id").groupBy("word").agg(F.count("*").alias("freq"), F.min("ord").alias("ord"))
    words = words.where(~script.is_garbage(F.col("word"), LATIN)).withColumn("folded", script.fold(F.col("word"), LATIN))
    out = dedupe.max_wins(words.withColumnRenamed("word", "form").withColumnRenamed("folded", "word"), ["word"], "freq", "ord")
    return out.select("word", "freq", "form", "ord.doc_id", "ord.pos")


def factor_flatten(spark, d):
    return lexicon.factors(_rows(spark, BOOST))


def config_explode(spark, d):
    rows = spark.createDataFrame([(k, v[0], v[1]) for k, v in CONFIG.items()], "domain string, categories array<string>, max_depth int")
    return rows.select("domain", F.explode("categories").alias("category"), "max_depth")


def _adjusted(spark, d):
    return lexicon.adjusted(_words(spark, d), lexicon.factors(_rows(spark, BOOST)), lexicon.factors(_rows(spark, DEMOTE)))


def factor_apply(spark, d):
    return _adjusted(spark, d)


def factor_unmatched(spark, d):
    return lexicon.unmatched(lexicon.factors(_rows(spark, {"x": {"the": 2.0, "zzzz": 3.0, "a1": 1.0}})), _words(spark, d))


def log_compress(spark, d):
    return lexicon.compressed(_words(spark, d))


def _ranked(df: DataFrame) -> DataFrame:
    return ranking.numbered(df, [-F.col("freq"), F.substring("word", 1, 2)], [F.col("word")], "id")


def final_rank(spark, d):
    """The whole path: words of the script, compressed and numbered by frequency, then word."""
    words = _words(spark, d).where(F.col("word").rlike("^[a-z]{1,6}$"))
    return _ranked(lexicon.compressed(words))


def script_split(spark, d):
    return lexicon.classified(_words(spark, d), LATIN)


def script_split_counts(spark, d):
    return script_split(spark, d).groupBy("class").agg(F.count("*").alias("n"), F.sum("freq").alias("freq"))


def dual_write(spark, d):
    rows = script_split(spark, d).where("class <> 'garbage'").select("word", "freq")
    both = lexicon.dual(rows, LATIN)
    return both.groupBy("side", "word").agg(F.max("freq").alias("freq"))


def system_build(spark, d):
    """Merge, split, adjust and compress: plain words on the log scale, variants at their raw frequency."""
    # Both sides and the maximum read the merged words once they are written.
    merged = cut(lexicon.classified(lexicon.fill(_words(spark, d), _words(spark, d, "conversations")), LATIN).where("class <> 'garbage'"))
    plain = merged.where("class = 'plain'").select("word", "freq")
    plain = lexicon.compressed(lexicon.adjusted(plain, lexicon.factors(_rows(spark, BOOST)), lexicon.factors(_rows(spark, DEMOTE))))
    variant = merged.where("class = 'variant'").select("word", "freq")
    return plain.select(F.lit("plain").alias("side"), "word", F.col("freq").cast("bigint").alias("freq")).unionByName(variant.select(F.lit("variant").alias("side"), "word", "freq"))


def readings(spark, d):
    rows = _words(spark, d).where(~script.is_garbage(F.col("word"), LATIN))
    return lexicon.read_as(rows, LATIN).select("word", "reading", F.length("word").alias("n_chars"))


def homophones(spark, d):
    return readings(spark, d).groupBy("reading").agg(F.count("*").alias("n"), F.min("word").alias("first")).where("n > 1")


def common_rank(spark, d):
    """Conversation turns in order, as ranked lines: rank 0 onwards, duplicates kept."""
    rows = _t(spark, d, "conversations").select("conv_id", "turn", F.lower(F.trim("role")).alias("reading"), parsing.without_marks(F.col("text")).alias("word")).where("word <> '' and reading <> ''")
    return ranking.numbered(rows, [F.floor(F.col("conv_id") / 1000)], [F.col("conv_id"), F.col("turn")], "rank", 0).select("rank", "reading", "word")


def dir_scan_ids(spark, d):
    """Sources as files: zero-based ids in name order, stem and lower-cased name."""
    files = _t(spark, d, "documents").where("source is not null").groupBy(F.concat("source", F.lit(".txt")).alias("file")).agg(F.count("*").alias("n"))
    ids = ranking.numbered(files, [F.substring("file", 1, 4)], [F.col("file")], "domain_id", 0)
    return ids.select("domain_id", F.regexp_replace("file", r"\.[^.]*$", "").alias("domain"), "n")


def char_inventory(spark, d):
    return gates.char_inventory(_words(spark, d))


def suspect_words(spark, d):
    return gates.suspect_words(_words(spark, d), LATIN, "éè")


def suspect_examples(spark, d):
    """First five words and first twenty characters that a report would show."""
    words = _words(spark, d)
    first = gates.suspect_words(words, LATIN).orderBy("word").limit(5).select(F.lit("word").alias("kind"), F.col("word").alias("value"))
    chars = gates.suspect_chars(words, LATIN).orderBy("ch").limit(20).select(F.lit("char").alias("kind"), F.col("ch").alias("value"))
    return first.unionByName(chars)


def script_gate(spark, d):
    words = cut(lexicon.classified(_words(spark, d), LATIN))
    plain = gates.plain_gate(words.where("class = 'plain'"), LATIN).withColumn("gate", F.lit("plain"))
    mixed = gates.plain_gate(words, LATIN).withColumn("gate", F.lit("mixed"))
    variant = gates.variant_gate(words.where("class = 'variant'"), LATIN, "word").withColumn("gate", F.lit("variant"))
    return plain.unionByName(mixed).unionByName(variant)


def common_verify(spark, d):
    expected = _t(spark, d, "conversations").agg(F.count_if(F.trim("text") != "").alias("expected"))
    return gates.ranked_gate(common_rank(spark, d), expected)


def gate_all(spark, d):
    return gates.overall(script_gate(spark, d).where("gate <> 'mixed'"), common_verify(spark, d))


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_counts(spark, d):
    parts = [_t(spark, d, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), "n") for t in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(~F.col("name").startswith("sqlite"))


def content_hash(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").alias("size"))


def manifest_reconcile(spark, d):
    """Hashes against a copy in which some texts differ and some are missing."""
    docs = _t(spark, d, "documents")
    text = F.when(F.col("doc_id") % 10 == 3, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    copy = docs.where("doc_id % 10 <> 7").select("doc_id", F.sha2(text, 256).alias("sha256"))
    return gates.reconciled(docs.select("doc_id", F.sha2("text", 256).alias("sha256")), copy, "doc_id", "sha256")


def next_version(spark, d):
    from lexloom.plans.manifest import next_version as step

    rows = spark.createDataFrame([(v,) for v in VERSIONS], "previous string")
    return rows.select("previous", step(F.col("previous"), F.lit(TODAY)).alias("version"))


def batching(spark, d):
    rows = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    ids = ranking.numbered(rows, [F.floor(F.col("l_orderkey") / 1000)], [F.col("l_orderkey"), F.col("l_linenumber")], "rn", 0)
    return ids.groupBy(F.floor(F.col("rn") / 2000).alias("batch")).agg(F.count("*").alias("n"))


def domain_override(spark, d):
    """A curated domain replaces the built one of the same name."""
    base = domain_cap(spark, d).select("domain", "word")
    curated = spark.createDataFrame([("src1", "alpha"), ("src1", "beta"), ("extra", "gamma")], "domain string, word string")
    return lexicon.override(base, curated)


def candidates(spark, d):
    """Words read as given: those of the ranked list first."""
    system = _words(spark, d).where(~script.is_garbage(F.col("word"), LATIN)).withColumn("reading", script.fold(F.col("word"), LATIN))
    common = spark.createDataFrame([(0, "de", "de"), (1, "e", "é"), (2, "la", "là")], "rank int, reading string, word string")
    return lexicon.candidates(common, system, F.col("reading").isin("de", "e", "la", "u"))


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/queries-{uuid.uuid4().hex}"


def domain_files_round_trip(spark, d):
    """Domain words written as text files and read back, with the ids of the files."""
    rows = domain_collect(spark, d)
    place = F.row_number().over(W.partitionBy("domain").orderBy("word"))
    path = _folder(spark)
    domain_files.write_txt(rows.withColumn("ord", place), path, ["domain words", "word<TAB>reading"])
    return cut(files.read_domains(spark, path).select("domain_id", "domain", "word", "reading"))


def ranked_file_round_trip(spark, d):
    """Items of the benchmark as a ranked list in one file, with comments and capitals, and read back.

    Only a to z are capitalised: capitals of other letters may not lead back to them (an ß becomes SS).
    """
    word = F.regexp_extract("text", r"^\S+", 0)
    given = F.translate(word, ascii_lowercase, ascii_uppercase)
    lines = _t(spark, d, "benchmark").where(word != "").select("item_id", F.concat(F.lit("\ufeff "), given, F.lit("\t"), word, F.lit("\r")).alias("line"))
    body = lines.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_id", "line"))), lambda x: x["line"]), "\n").alias("value"))
    path = _folder(spark)
    body.select(F.concat(F.lit("# ranked\r\n\r\n"), "value").alias("value")).coalesce(1).write.text(path)
    return cut(files.read_ranked(spark, path))


QUERIES = {
    f.__name__: f
    for f in (
        final_rank, lex_base, title_clean, graph_collect, domain_collect, domain_subset, domain_cap, domain_clean, domain_counts, domain_override,
        fill_merge, anti_new_words, last_wins, first_wins, fold_max_wins, factor_flatten, config_explode, factor_apply, factor_unmatched, log_compress,
        script_split, script_split_counts, dual_write, system_build, readings, homophones, common_rank, dir_scan_ids, char_inventory, suspect_words,
        suspect_examples, script_gate, common_verify, gate_all, table_counts, content_hash, manifest_reconcile, next_version, batching, candidates, domain_files_round_trip, ranked_file_round_trip,
    )
}

_V, _P = LATIN.variants, LATIN.plains


def _fold(w: str) -> str:
    return f"translate({w}, '{_V}', '{_P}')"


def _garbage(w: str) -> str:
    return f"(translate({w}, '{LATIN.allowed}{_V}', '') <> '')"


def _tok(table: str, *more: str) -> str:
    cols = "".join(f"{c}, " for c in more)
    return f"SELECT * FROM (SELECT {cols}unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}]+')) AS word FROM {table}) WHERE word <> ''"


_W = f"w AS (SELECT word, count(*) AS freq FROM ({_tok('documents')}) GROUP BY word)"
_C = f"c AS (SELECT DISTINCT word FROM ({_tok('conversations')}))"
_PLACED = "(SELECT * FROM (SELECT doc_id, source, unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) AS word, generate_subscripts(regexp_split_to_array(lower(text), '[^\\p{L}]+'), 1) - 1 AS pos FROM documents) WHERE word <> '')"
_CLASS = f"CASE WHEN {_garbage('word')} THEN 'garbage' WHEN {_fold('word')} <> word THEN 'variant' ELSE 'plain' END"
_CHARS = "SELECT DISTINCT unnest(string_split(word, '')) AS ch FROM w"


def _log(freq: str, top: str) -> str:
    return f"CASE WHEN {freq} <= 0 OR {top} <= 1 THEN 1 ELSE greatest(1, least(5000, CAST(trunc(5000 * log10({freq}) / log10({top})) AS INT))) END"


def _map(table: dict) -> str:
    rows = [(w, f, i, j) for i, m in enumerate(table.values()) for j, (w, f) in enumerate(m.items())]
    return "(SELECT word, arg_max(factor, i * 1000 + j) AS factor FROM (VALUES " + ", ".join(f"('{w}', CAST({f} AS DOUBLE), {i}, {j})" for w, f, i, j in rows) + ") v(word, factor, i, j) GROUP BY word)"


_ADJ = f"""SELECT word, CAST(trunc(CASE WHEN x.factor IS NULL THEN f ELSE f / x.factor END) AS BIGINT) AS freq
FROM (SELECT word, CAST(trunc(CASE WHEN b.factor IS NULL THEN freq ELSE freq * b.factor END) AS BIGINT) AS f FROM {{src}} LEFT JOIN {_map(BOOST)} b USING (word)) LEFT JOIN {_map(DEMOTE)} x USING (word)"""
_DOMAIN = f"(SELECT DISTINCT source AS domain, word FROM ({_tok('documents', 'source')}) WHERE source IS NOT NULL)"
_COLLECT = f"SELECT domain, word, reading FROM (SELECT domain, word, {_fold('word')} AS reading, row_number() OVER (PARTITION BY domain ORDER BY word) AS rn FROM {_DOMAIN} WHERE regexp_full_match(word, '[a-zß-öø-ÿ]{{1,6}}') AND regexp_full_match({_fold('word')}, '[\\x00-\\x7F]+') AND regexp_matches({_fold('word')}, '[a-z]')) WHERE rn <= {CAP}"
_CAPPED = f"SELECT domain, word, freq FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY freq DESC, word) AS rn FROM (SELECT source AS domain, word, count(*) AS freq FROM ({_tok('documents', 'source')}) WHERE source IS NOT NULL GROUP BY ALL)) WHERE rn <= {CAP}"
_READ = f"SELECT word, {_fold('word')} AS reading, length(word) AS n_chars FROM w WHERE NOT {_garbage('word')} AND regexp_matches({_fold('word')}, '[a-z]')"
_SUSPECT = f"SELECT ch FROM ({_CHARS}) WHERE {_fold('ch')} <> ch"
_RANK = "SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS rank, lower(trim(role)) AS reading, trim(text) AS word FROM conversations WHERE trim(text) <> '' AND trim(role) <> ''"


def _n_suspect(where: str) -> str:
    return f"(SELECT count(*) FROM (SELECT word FROM w WHERE {where} AND {_fold('word')} <> word))"


def _gates(names: str) -> str:
    return f"""SELECT * FROM (
SELECT 'plain' AS gate, count(*) AS n, {_n_suspect(f"{_CLASS} = 'plain'")} AS suspects, 'OK' AS status FROM w WHERE {_CLASS} = 'plain'
UNION ALL SELECT 'mixed', (SELECT count(*) FROM w), s, CASE WHEN s = 0 THEN 'OK' WHEN s < 100 THEN 'WARN' ELSE 'FAIL' END FROM (SELECT {_n_suspect('true')} AS s)
UNION ALL SELECT 'variant', count(*), 0, CASE WHEN count(*) = 0 THEN 'FAIL' ELSE 'OK' END FROM w WHERE {_CLASS} = 'variant') WHERE gate IN ({names})"""


_VERIFY = f"SELECT count(*) AS n, min(rank) AS lo, max(rank) AS hi, any_value(e) AS expected, CASE WHEN count(*) > 0 AND min(rank) = 0 AND max(rank) = count(*) - 1 AND count(*) = any_value(e) THEN 'OK' ELSE 'FAIL' END AS status FROM ({_RANK}), (SELECT count(*) AS e FROM conversations WHERE trim(text) <> '')"

ORACLES: dict[str, str] = {
    "final_rank": f"WITH {_W}, s AS (SELECT * FROM w WHERE regexp_full_match(word, '[a-z]{{1,6}}')), k AS (SELECT word, {_log('freq', '(SELECT max(freq) FROM s)')} AS freq FROM s) SELECT word, freq, row_number() OVER (ORDER BY freq DESC, word) AS id FROM k",
    "lex_base": f"WITH {_W} SELECT word, freq FROM w WHERE regexp_full_match(word, '[a-z]{{1,6}}')",
    "title_clean": "SELECT * FROM (SELECT page_id, trim(regexp_extract(regexp_extract(html, '<title>(.*?)</title>', 1), '^[^(（]*')) AS title FROM pages) WHERE title <> ''",
    "graph_collect": """WITH RECURSIVE e AS (SELECT 'r' || n_regionkey AS parent, 'n' || n_nationkey AS child FROM nation UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey FROM orders),
g AS (SELECT 'r' || r_regionkey AS node, 0 AS depth FROM region WHERE r_regionkey IN (1, 2) UNION ALL SELECT child, depth + 1 FROM g JOIN e ON node = parent WHERE depth < 3) SELECT node, min(depth) AS depth FROM g GROUP BY node""",
    "domain_collect": _COLLECT,
    "domain_subset": f"SELECT * FROM ({_COLLECT}) WHERE domain IN ({', '.join(f"'{x}'" for x in DOMAINS)})",
    "domain_cap": _CAPPED,
    "domain_clean": f"SELECT source AS domain, word, {_fold('word')} AS reading, min(row(doc_id, pos))[1] AS doc_id, min(row(doc_id, pos))[2] AS pos FROM {_PLACED} WHERE source IS NOT NULL AND NOT {_garbage('word')} GROUP BY domain, word, reading",
    "domain_counts": f"SELECT coalesce(domain, '(all)') AS domain, count(*) AS n FROM {_DOMAIN} GROUP BY ROLLUP (domain)",
    "domain_override": f"SELECT domain, word FROM ({_CAPPED}) WHERE domain NOT IN ('src1', 'extra') UNION ALL SELECT * FROM (VALUES ('src1', 'alpha'), ('src1', 'beta'), ('extra', 'gamma'))",
    "fill_merge": f"WITH {_W}, {_C} SELECT word, freq, 'base' AS source FROM w UNION ALL SELECT word, 1, 'extra' FROM c WHERE word NOT IN (SELECT word FROM w)",
    "anti_new_words": f"SELECT DISTINCT word FROM ({_tok('benchmark')}) WHERE word NOT IN (SELECT word FROM ({_tok('documents')}))",
    "last_wins": "SELECT user_id, arg_max(event_type, row(ts, event_id)) AS event_type, min(row(ts, event_id))[1] AS ts, min(row(ts, event_id))[2] AS event_id FROM events GROUP BY user_id",
    "first_wins": "SELECT p_name, p_size, min(p_partkey) AS p_partkey, arg_min(p_brand, p_partkey) AS p_brand FROM part GROUP BY p_name, p_size",
    "fold_max_wins": f"WITH f AS (SELECT word AS form, {_fold('word')} AS word, count(*) AS freq, min(row(doc_id, pos)) AS o FROM {_PLACED} WHERE NOT {_garbage('word')} GROUP BY form) SELECT word, max(freq) AS freq, arg_min(form, row(-freq, o)) AS form, min(o)[1] AS doc_id, min(o)[2] AS pos FROM f GROUP BY word",
    "factor_flatten": f"SELECT * FROM {_map(BOOST)}",
    "config_explode": "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{c}', {v[1]})" for k, v in CONFIG.items() for c in v[0]) + ") v(domain, category, max_depth)",
    "factor_apply": f"WITH {_W} " + _ADJ.format(src="w"),
    "factor_unmatched": f"WITH {_W} SELECT * FROM (VALUES ('the', 2.0::DOUBLE), ('zzzz', 3.0::DOUBLE), ('a1', 1.0::DOUBLE)) v(word, factor) WHERE word NOT IN (SELECT word FROM w)",
    "log_compress": f"WITH {_W} SELECT word, {_log('freq', '(SELECT max(freq) FROM w)')} AS freq FROM w",
    "script_split": f"WITH {_W} SELECT word, freq, {_CLASS} AS class FROM w",
    "script_split_counts": f"WITH {_W} SELECT {_CLASS} AS class, count(*) AS n, CAST(sum(freq) AS BIGINT) AS freq FROM w GROUP BY 1",
    "dual_write": f"WITH {_W}, k AS (SELECT * FROM w WHERE NOT {_garbage('word')}) SELECT side, word, max(freq) AS freq FROM (SELECT 'plain' AS side, {_fold('word')} AS word, freq FROM k UNION ALL SELECT 'variant', word, freq FROM k WHERE {_fold('word')} <> word) GROUP BY side, word",
    "system_build": f"WITH {_W.replace('w AS (', 'w AS MATERIALIZED (')}, {_C}, m AS MATERIALIZED (SELECT word, freq FROM w UNION ALL SELECT word, 1 FROM c WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.word = c.word)), p AS (SELECT * FROM m WHERE {_CLASS} = 'plain'), a AS MATERIALIZED ({_ADJ.format(src='p')}), top AS (SELECT max(freq) AS top FROM a) SELECT 'plain' AS side, word, CAST({_log('freq', 'top')} AS BIGINT) AS freq FROM a, top UNION ALL SELECT 'variant', word, freq FROM m WHERE {_CLASS} = 'variant'",
    "readings": f"WITH {_W} {_READ}",
    "homophones": f"WITH {_W} SELECT reading, count(*) AS n, min(word) AS first FROM ({_READ}) GROUP BY reading HAVING count(*) > 1",
    "common_rank": _RANK,
    "dir_scan_ids": "SELECT row_number() OVER (ORDER BY file) - 1 AS domain_id, regexp_replace(file, '\\.[^.]*$', '') AS domain, n FROM (SELECT source || '.txt' AS file, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1)",
    "char_inventory": f"WITH {_W} {_CHARS}",
    "suspect_words": f"WITH {_W} SELECT word FROM w WHERE {_fold("translate(word, 'éè', '')")} <> translate(word, 'éè', '')",
    "suspect_examples": f"WITH {_W} (SELECT 'word' AS kind, word AS value FROM w WHERE {_fold('word')} <> word ORDER BY word LIMIT 5) UNION ALL (SELECT 'char', ch FROM ({_SUSPECT}) ORDER BY ch LIMIT 20)",
    "script_gate": f"WITH {_W} " + _gates("'plain', 'mixed', 'variant'"),
    "common_verify": _VERIFY,
    "gate_all": f"WITH {_W}, r AS (SELECT status FROM ({_gates("'plain', 'variant'")}) UNION ALL SELECT status FROM ({_VERIFY})) SELECT bool_and(status <> 'FAIL') AS passed FROM r",
    "table_counts": " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in TABLES),
    "content_hash": "SELECT doc_id, sha256(text) AS sha256, strlen(text) AS size FROM documents",
    "manifest_reconcile": "SELECT doc_id, CASE WHEN doc_id % 10 = 7 THEN 'missing' WHEN doc_id % 10 = 3 AND text IS NOT NULL THEN 'changed' ELSE 'match' END AS status FROM documents",
    "next_version": f"SELECT previous, '{TODAY}.' || CASE WHEN starts_with(previous, '{TODAY}.') THEN coalesce(try_cast(regexp_extract(previous, '([^.]*)$', 1) AS INT), 0) + 1 ELSE 1 END AS version FROM (VALUES {', '.join(f"('{v}')" for v in VERSIONS)}) v(previous)",
    "batching": "SELECT CAST(floor(rn / 2000) AS BIGINT) AS batch, count(*) AS n FROM (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS rn FROM lineitem) GROUP BY 1",
    "domain_files_round_trip": f"SELECT dense_rank() OVER (ORDER BY domain || '.txt') - 1 AS domain_id, domain, word, reading FROM ({_COLLECT})",
    "ranked_file_round_trip": "SELECT row_number() OVER (ORDER BY item_id) - 1 AS rank, lower(word) AS reading, word FROM (SELECT item_id, regexp_extract(text, '^\\S+') AS word FROM benchmark) WHERE word <> ''",
    "candidates": f"WITH {_W}, cm AS (SELECT * FROM (VALUES (0, 'de', 'de'), (1, 'e', 'é'), (2, 'la', 'là')) v(rank, reading, word)), s AS (SELECT word, freq, {_fold('word')} AS reading FROM w WHERE NOT {_garbage('word')} AND {_fold('word')} IN ('de', 'e', 'la', 'u')) SELECT reading, word, 0 AS tier, CAST(rank AS BIGINT) AS place FROM cm UNION ALL SELECT reading, word, 1, -freq FROM s WHERE word NOT IN (SELECT word FROM cm)",
}

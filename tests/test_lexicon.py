"""Hand-written Han fixtures; the character tables are stubs, so that expectations are exact."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexloom.functions import parsing, scoring, script
from lexloom.functions.script import Profile
from lexloom.operators import dedupe, gates, graph, lexicon, ranking
from lexloom.plans import build, manifest

HAN = Profile(
    name="stub",
    word="一-鿿",
    max_length=6,
    variants="電腦學",
    plains="电脑学",
    allowed="电脑学中文银行女",
    floor=0x4E00,
    readings={"电": "dian", "脑": "nao", "学": "xue", "中": "zhong", "文": "wen", "银": "yin", "行": "hang", "女": "nv"},
)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_base_parse(spark):
    lines = ["电脑 100 n", "电脑", "电脑 x n", "A股 5 n", "电脑电脑电脑电 3", "中文　7"]
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    out = parsing.base_entries(raw).where(script.is_word(F.col("word"), HAN))
    assert rows(out, "word", "freq") == [("中文", 7), ("电脑", 100)]


def test_title(spark):
    raw = spark.createDataFrame([("学（甲）",), ("学(乙)",), ("（甲）学",)], "t string")
    assert [r[0] for r in raw.select(parsing.title(F.col("t"))).collect()] == ["学", "学", ""]


@pytest.mark.parametrize("parts", [1, 8])
def test_last_value_first_place(spark, parts):
    df = spark.createDataFrame([("电脑", 1, 0), ("中文", 2, 1), ("电脑", 9, 2)], "word string, freq long, ord int").repartition(parts)
    assert rows(dedupe.last_wins(df, ["word"], ["ord"]), "ord", "word", "freq") == [(0, "电脑", 9), (1, "中文", 2)]


def test_fill(spark):
    base = spark.createDataFrame([("电脑", 9)], "word string, freq long")
    extra = spark.createDataFrame([("电脑",), ("中文",), ("中文",)], "word string")
    assert rows(lexicon.fill(base, extra), "word", "freq") == [("中文", 1), ("电脑", 9)]


def test_split_is_a_partition(spark):
    df = spark.createDataFrame([("電腦",), ("电脑",), ("龘",), ("電龘",)], "word string")
    assert rows(lexicon.classified(df, HAN), "word", "class") == sorted([("電腦", "variant"), ("电脑", "plain"), ("龘", "garbage"), ("電龘", "garbage")])


def test_fold_is_idempotent(spark):
    df = spark.createDataFrame([("電腦學x",), ("",)], "word string")
    once = script.fold(F.col("word"), HAN)
    assert df.select(once == script.fold(once, HAN)).distinct().collect() == [(True,)]


@pytest.mark.parametrize("parts", [1, 8])
def test_max_wins(spark, parts):
    df = spark.createDataFrame([("电脑", "p1", 5, 0), ("電腦", "p2", 8, 1), ("电脑", "p3", 8, 2)], "word string, reading string, freq long, ord int").repartition(parts)
    out = dedupe.max_wins(df.withColumn("word", script.fold(F.col("word"), HAN)), ["word"], "freq", "ord")
    assert rows(out, "word", "reading", "freq", "ord") == [("电脑", "p2", 8, 0)]


def test_dual(spark):
    from lexloom.sources.domain_files import domain_tables

    df = spark.createDataFrame([(0, "d", 0, "電腦", "a"), (0, "d", 1, "电脑", "b")], "domain_id int, domain string, ord int, word string, reading string")
    assert rows(domain_tables(df, HAN), "side", "word", "reading") == [("plain", "电脑", "a"), ("variant", "電腦", "a")]


def test_factors_truncate_twice(spark):
    words = spark.createDataFrame([("a", 7), ("b", 3)], "word string, freq long")
    m = spark.createDataFrame([("a", 1.5)], "word string, factor double")
    d = spark.createDataFrame([("a", 4.0)], "word string, factor double")
    assert rows(lexicon.adjusted(words, m, d), "word", "freq") == [("a", 2), ("b", 3)]
    assert rows(lexicon.unmatched(spark.createDataFrame([("z", 2.0), ("a", 2.0)], "word string, factor double"), words), "word") == [("z",)]


def test_compress(spark):
    df = spark.createDataFrame([(0, 10), (10, 10), (1, 10), (1, 1), (5, 0)], "f long, top long")
    assert [r[0] for r in df.select(scoring.compress(F.col("f"), F.col("top"))).collect()] == [1, 5000, 1, 1, 1]


def test_compress_is_monotonic(spark):
    out = [r[0] for r in spark.range(1, 3000).orderBy("id").select(scoring.compress(F.col("id"), F.lit(2999))).collect()]
    assert out == sorted(out) and out[0] == 1 and out[-1] <= 5000


def test_readings(spark):
    df = spark.createDataFrame([("nv",), ("",), ("Nv",), ("123",), ("a1",), ("lü",)], "r string")
    assert [r[0] for r in df.where(script.is_reading(F.col("r"))).collect()] == ["nv", "a1"]
    assert [r[0] for r in df.where(script.is_domain_reading(F.col("r"))).select(F.lower("r")).collect()] == ["nv", "nv", "123", "a1"]
    words = spark.createDataFrame([("银行",), ("女",), ("龘",)], "word string")
    own = spark.createDataFrame([("女", "ru")], "word string, reading string")
    assert rows(lexicon.read_as(words, HAN), "word", "reading") == [("女", "nv"), ("银行", "yinhang")]
    assert rows(lexicon.read_as(words, HAN, own), "reading") == [("ru",), ("yinhang",)]


def test_graph(spark):
    edges = spark.createDataFrame([("R", "A"), ("R", "B"), ("A", "C"), ("B", "C"), ("C", "D"), ("D", "A")], "parent string, child string")
    seeds = spark.createDataFrame([("R",)], "node string")
    assert rows(graph.collect(edges, seeds, 2), "node", "depth") == [("A", 1), ("B", 1), ("C", 2), ("R", 0)]
    assert graph.collect(edges, seeds, 5, max_nodes=2).count() == 3
    pages = spark.createDataFrame([("A", "x"), ("C", "x"), ("D", "y")], "parent string, title string")
    assert rows(graph.members(graph.collect(edges, seeds, 2), pages), "title") == [("x",)]


@pytest.mark.parametrize("n, status", [(0, "OK"), (99, "WARN"), (100, "FAIL")])
def test_plain_gate(spark, n, status):
    df = spark.createDataFrame([("电脑",)] + [("電" + "中" * i,) for i in range(n)], "word string")
    assert gates.plain_gate(df, HAN).first()["status"] == status


def test_variant_gate(spark):
    empty = spark.createDataFrame([], "word string, id int")
    mixed = spark.createDataFrame([("電腦", 0), ("中", 1)], "word string, id int")
    assert gates.variant_gate(empty, HAN, "id").first()["status"] == "FAIL"
    assert gates.variant_gate(mixed, HAN, "id").first()["status"] == "WARN"
    assert gates.variant_gate(mixed.limit(1), HAN, "id").first()["status"] == "OK"


@pytest.mark.parametrize("ranks, n, status", [([0, 1, 2], 3, "OK"), ([0, 2], 2, "FAIL"), ([0, 1], 3, "FAIL"), ([], 0, "FAIL")])
def test_ranked_gate(spark, ranks, n, status):
    df = spark.createDataFrame([(r,) for r in ranks], "rank long")
    assert gates.ranked_gate(df, spark.range(1).select(F.lit(n).alias("expected"))).first()["status"] == status


def test_overall_looks_at_all(spark):
    ok, bad = (spark.createDataFrame([(s,)], "status string") for s in ("WARN", "FAIL"))
    assert gates.overall(ok, ok).first()["passed"]
    with pytest.raises(gates.BuildRejected):
        gates.require(gates.overall(ok, bad, ok))


def test_next_version(spark):
    df = spark.createDataFrame([("D.3",), ("E.9",), ("broken",), ("D.x",), (None,)], "v string")
    assert [r[0] for r in df.select(manifest.next_version(F.coalesce("v", F.lit("")), F.lit("D"))).collect()] == ["D.4", "D.1", "D.1", "D.1", "D.1"]


def test_reconcile(spark):
    want = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "k string, h string")
    have = spark.createDataFrame([("a", "1"), ("b", "x")], "k string, h string")
    assert rows(gates.reconciled(want, have, "k", "h"), "k", "status") == [("a", "match"), ("b", "changed"), ("c", "missing")]


def test_numbering_does_not_depend_on_partitions(spark):
    df = spark.range(500).select((F.col("id") * 37 % 101).alias("f"), F.col("id").alias("w"))
    want = sorted((-r["f"], r["w"]) for r in df.collect())
    for n in (1, 8):
        out = ranking.numbered(df.repartition(n), [-F.col("f")], [F.col("w")], "id")
        assert [(-r["f"], r["w"]) for r in out.orderBy("id").collect()] == want
        assert rows(out, "id") == [(i,) for i in range(1, 501)]


def test_system_lexicon(spark):
    base = spark.createDataFrame([("电脑", "dn", 5, 0), ("電腦", "dn", 3, 1), ("电脑", "dn2", 100, 2), ("龘", "da", 9, 3), ("中文", "zw", 10, 4)], "word string, reading string, freq long, ord int")
    domains = spark.createDataFrame([(0, 0, "银行", "yh"), (1, 0, "银行", "yh2"), (1, 1, "中文", "no")], "domain_ord int, ord int, word string, reading string")
    none = spark.createDataFrame([], "word string, factor double")
    plain, variant = build.system_lexicon(base, domains, none, none, HAN)
    assert rows(plain, "id", "word", "reading", "freq") == [(1, "电脑", "dn2", 5000), (2, "中文", "zw", 2500), (3, "银行", "yh2", 1)]
    assert rows(variant, "id", "word", "reading", "freq") == [(1, "電腦", "dn", 3)]


def test_domain_entries(spark):
    titles = spark.createDataFrame([("d", "学（甲）"), ("d", "学"), ("d", "Latin"), ("d", "中文"), ("d", "银行")], "domain string, title string")
    assert rows(build.domain_entries(titles, HAN, cap=2), "word", "reading") == [("中文", "zhongwen"), ("学", "xue")]


def test_han_profile(spark):
    han = script.han_profile(spark)
    df = spark.createDataFrame([("電腦",), ("电脑",), ("乾坤",), ("女",)], "word string")
    out = {r["word"]: r for r in lexicon.read_as(lexicon.classified(df, han), han).collect()}
    assert out["電腦"]["class"] == "variant" and out["电脑"]["class"] == "plain" and out["乾坤"]["class"] == "plain"
    assert out["电脑"]["reading"] == "diannao" and out["女"]["reading"] == "nv"


@given(st.text(alphabet="a　 \t\n1", max_size=12))
def test_fields_as_python_splits(text):
    import re

    assert [x for x in re.split(r"\s+", text.strip()) if x] == text.split()

"""Operators over documents: brute force, held-out accuracy and odd rows."""

import inspect
import itertools
import json
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexloom.llm import decontaminate, langid, mixing, near_dup, quality, queries, toxicity, urlfilter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, None, None, 0), (2, "", "en", "a", 0), (3, " \n\t", "en", "a", 3), (4, "one", None, None, 3), (4, "one", None, None, 3), (None, "a b c d e f", "en", "a", 11), (5, "été " * 30000, "fr", "b", 1), (6, "12 34 !!", "en", "a", 8)]


@pytest.fixture(scope="module")
def docs(sf_dir):
    return pd.read_parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with columns named like those that operators make."""
    extra = ["score", "label", "rep", "n", "target", "_t", "kept", "h", "size", "key"]
    return spark.createDataFrame(ODD, SCHEMA).select("*", *[F.lit("x").alias(c) for c in extra])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(2, 1, 0), (4, 0, 1), (4, 1, None), (None, 1, 1), (9, None, 0)], "doc_id long, quality int, toxic int")


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def brute_components(rows):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= 75 * len(sets[a] | sets[b]):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def test_near_duplicates(spark, sf_dir, docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in queries.QUERIES["op7_near_duplicates"](spark, sf_dir).collect()}
    assert got == brute_components(zip(docs.doc_id, docs.text, strict=True))


def test_near_duplicate_chains_and_stars(spark):
    """Links that no hub shows: chains of edits, and many copies of a base that are far from each other."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(4000)]
    rows, base = [], [words[i] for i in rng.integers(0, 4000, 120)]
    for i in range(60):  # each near the base, few near each other
        own = list(base)
        for at in rng.integers(0, 120, 3):
            own[at] = words[rng.integers(0, 4000)]
        rows.append((1000 + i, " ".join(own)))
    chain = [words[i] for i in rng.integers(0, 4000, 100)]
    for i in range(12):
        chain = list(chain)
        chain[8 * i] = f"edit{i}"
        rows.append((2000 - i, " ".join(chain)))
    rows += [(3000 + i, " ".join(base)) for i in range(30)] + [(50, "a b"), (51, "A  b"), (52, "a b c")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_odd(odd, empty):
    got = sorted((tuple(r) for r in near_dup.near_duplicates(odd).collect()), key=str)
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (4, 1, 4, True), (None, 2, None, True), (5, 1, 5, True), (6, 1, 6, True)], key=str)
    assert near_dup.near_duplicates(empty).count() == 0
    kept = near_dup.deduplicated(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 1
    assert near_dup.deduplicated(empty).count() == 0


def item(n, seed):
    rng = np.random.default_rng(seed)
    return [f"k{i}" for i in rng.integers(0, 5000, n)]


def test_decontamination(spark, sf_dir, duck):
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op6_decontamination"](spark, sf_dir).collect()}
    assert got == set(duck.sql("SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)").fetchall())


@pytest.mark.parametrize("broadcast_rows", [0, 100_000])
def test_decontamination_tolerates_substitutions(spark, broadcast_rows):
    a, b = item(30, 1), item(14, 2)
    noise = item(200, 3)
    changed = [w if i % 9 else "zz" for i, w in enumerate(a)]
    far = [w if i % 2 else "zz" for i, w in enumerate(a)]
    two = [w if i not in (4, 9) else "zz" for i, w in enumerate(b)]
    rows = [
        (1, " ".join(noise[:90] + a + noise[90:])),
        (2, " ".join(noise + changed)),
        (3, " ".join(far + noise)),
        (4, " ".join(noise)),
        (5, ", ".join(w.upper() for w in two) + " " + " ".join(noise)),
        (6, " ".join(a[:15] + noise)),
        (7, None),
        (8, ""),
        (9, " ".join(a[:9])),
        (10, " ".join((a + noise[:3]) * 40 + b)),
        (None, " ".join(a)),
    ]
    items = [(100, " ".join(a)), (200, " ".join(b)), (200, " ".join(b)), (300, "too short"), (400, None), (None, " ".join(a))]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, item_id int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["matched"] for r in decontaminate.contaminated(docs, bench, broadcast_rows=broadcast_rows).collect()}
    assert set(got) == {(1, 100), (2, 100), (5, 200), (6, 100), (10, 100), (10, 200)}
    assert got[1, 100] == 13 and got[5, 200] in (11, 12)
    left = decontaminate.clean(docs, bench, broadcast_rows=broadcast_rows)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {3, 4, 7, 8, 9, None}


@pytest.mark.parametrize("broadcast_rows", [0, 100_000])
def test_decontamination_of_short_items(spark, broadcast_rows):
    """Every choice of changed words that leaves 80 % of a short item is found, and none beyond."""
    noise, items, docs, want = item(40, 9), [], [], {}
    for n in range(1, 13):
        words = [f"q{n}x{i}" for i in range(n)]
        items.append((n, " ".join(words)))
        for k in range(min(n, 4)):
            for changed in itertools.combinations(range(n), k):
                d = len(docs)
                docs.append((d, " ".join(noise[:20] + ["zz" if i in changed else w for i, w in enumerate(words)] + noise[20:])))
                if 100 * (n - k) >= 80 * n:
                    want[d, n] = n - k
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(docs, bench, broadcast_rows=broadcast_rows).collect()
    assert {(r["doc_id"], r["item_id"]): r["matched"] for r in got} == want and {r["position"] for r in got} == {20}


def test_decontamination_of_nothing(spark, empty, odd):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.clean(odd, bench).count() == len(ODD)


def test_decontamination_is_native():
    source = inspect.getsource(decontaminate)
    assert not re.search(r"udf|mapIn|applyIn|\.rdd|pandas|pyarrow|toPandas", source)


def test_url_filter(spark, sf_dir, duck, same):
    same(queries.QUERIES["op1_url_filter"](spark, sf_dir), duck.sql(queries.ORACLES["op1_url_filter"]))


def test_url_rules(spark):
    rules = [*queries.URL_RULES, ("a.org/x/y", "block"), ("a.org/x/y", "allow"), ("bad.net/", "block")]
    trie = urlfilter.UrlTrie(rules)
    urls = ["http://WWW.Example.ORG/es/1?x", "https://example.org/en/12", "http://example.org", "ftp://x.com/fr/?", "http://xcom/fr/", "http://x.com/de", "http://q.a.org/x/yz/", "none", "", None, "http://", "://org/", "http://bad.net#/", "http://bad.net/#x", "http://a://b.org/x"]
    for url in urls:
        host, path = urlfilter.split(url)
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        assert (host, path) == ((re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", ""))
        fits = [(len(r), v == "block", r, v) for r, v in rules if f".{host}".endswith("." + r.partition("/")[0]) and path.startswith("/" + r.partition("/")[2])]
        assert trie.match(host, path) == (max(fits)[2:] if fits else (None, "allow"))
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(None, urls[0], "x")], "page_id long, url string, host string")
    assert urlfilter.judge(pages, rules).count() == len(urls) + 1
    assert urlfilter.judge(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in urlfilter.judge(pages, [], "block").collect()} == {"block"}
    with pytest.raises(ValueError):
        urlfilter.UrlTrie([("nopath", "allow")])


def test_warc_query(spark, sf_dir, duck, same):
    same(queries.QUERIES["op3_warc"](spark, sf_dir), duck.sql(queries.ORACLES["op3_warc"]))


def test_language_id(spark, sf_dir, docs):
    got = queries.QUERIES["op2_language_id"](spark, sf_dir).toPandas().merge(docs, on="doc_id")
    assert len(got) == len(docs) and got.score.between(0, 1).all()
    assert (got.held_out == [fold(i, 4) == 2 for i in got.doc_id]).all()
    assert (got.lang_pred == got.lang)[got.held_out].mean() > 0.95


def test_language_id_by_brute_force(spark, sf_dir, docs):
    profiles = langid.learn(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=50)
    ranks = {lang: {int(c): int(r) for c, r in zip(profiles.codes, profiles.ranks[:, i], strict=True) if r < 100} for i, lang in enumerate(profiles.langs)}
    for text in docs.text.head(25):
        letters = "".join(c if c.isalpha() else " " for c in text.lower())
        padded = " " + " ".join(letters.split()) + " "
        counts = {}
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                g = padded[i : i + n]
                if g != " " and not (n == 3 and g[1] == " "):
                    code = sum(ord(c) << (21 * j) for j, c in enumerate(g))
                    counts[code] = counts.get(code, 0) + 1
        mine = sorted(counts, key=lambda c: (-counts[c], c))[:50]
        far = {lang: sum(min(50, abs(i - table.get(c, 10**6))) for i, c in enumerate(mine)) for lang, table in ranks.items()}
        best = min(sorted(far), key=far.get)
        assert profiles.predict(text)[0] == best


def test_language_id_odd(odd, empty):
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.language_id(odd).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (6, "und")} <= got
    assert langid.language_id(empty).count() == 0


LARGER = "/root/testdata/sf0.01"  # the smallest tables have 87 labels and ten documents a source


def test_quality(spark, sf_dir):
    sf_dir = LARGER
    labels = pd.read_parquet(f"{sf_dir}/labels.parquet")
    got = queries.QUERIES["op8_quality_classifier"](spark, sf_dir).toPandas()
    assert (got.held_out == [fold(i, 5) == 0 for i in got.doc_id]).all() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    both = got.merge(labels, on="doc_id")
    assert (both.predicted == both.quality).mean() > 0.9
    ruled = queries.QUERIES["op4_quality_rules"](spark, sf_dir).toPandas()
    assert (ruled.base_failed == ((ruled.n_words < 20) | (100 * ruled.n_repeat_words > 30 * ruled.n_words))).all()
    assert not (ruled.base_failed & ruled.kept).any()
    both = ruled[~ruled.base_failed].merge(labels, on="doc_id")
    assert (both.kept == (both.quality == 1)).mean() > 0.9


def test_quality_odd(odd, empty, labels):
    for op in (quality.rules, quality.classify):
        assert op(odd, labels).where("score between 0 and 1").count() == len(ODD)
        assert op(empty, labels.limit(0)).count() == 0
    kept = quality.accepted(odd, labels)
    assert kept.columns == odd.columns and kept.count() <= len(ODD)
    assert quality.accepted(empty, labels).count() == 0


def test_toxicity(spark):
    """Made-up texts: two words mark label 1."""
    rng, rows = np.random.default_rng(2), []
    for i in range(600):
        w = [f"word{k}" for k in rng.integers(0, 60, 40)]
        toxic = i % 5 == 0
        if toxic:
            w[rng.integers(0, 40)] = ["vileness", "dreckig"][i % 2]
        rows.append((i, " ".join(w), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, labels).toPandas().merge(pd.DataFrame(rows, columns=["doc_id", "text", "toxic"]), on="doc_id")
    assert (got.held_out == [fold(i, 3) == 1 for i in got.doc_id]).all()
    assert (got.predicted == got.toxic)[got.held_out].mean() > 0.97
    assert (got.predicted == (got.score >= 0.7)).all()


def test_toxicity_odd(odd, empty, labels):
    assert toxicity.toxicity(odd, labels).where("score between 0 and 1").count() == len(ODD)
    assert toxicity.toxicity(empty, labels.limit(0)).count() == 0


def test_targets():
    assert mixing.targets({}) == {}
    assert mixing.targets({"a": 0, None: 0}) == {"a": 0.0, None: 0.0}
    goal = mixing.targets({"a": 10, "b": 1000, "c": 10, None: 5})
    assert goal["a"] == 30 and sum(goal.values()) == pytest.approx(1025) and goal[None] == 15
    assert mixing.targets({"b": 80, "a": 80, "c": 80}) == pytest.approx({"a": 150, "b": 60, "c": 30})


def test_flow_shares_overlapping_sources():
    """The pattern in both sources goes where it is needed, and repetition is avoided."""
    got = mixing.route({("a",): 100, ("a", "b"): 100, ("b",): 20}, {"a": 100, "b": 120})
    assert got == {("a",): 100, ("a", "b"): 100, ("b",): 20}
    got = mixing.route({("a",): 10}, {"a": 25})
    assert got == {("a",): 25}


def test_mixing(spark, sf_dir):
    sf_dir = LARGER
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    got = queries.QUERIES["op5_mixing"](spark, sf_dir).toPandas()
    again = queries.QUERIES["op5_mixing"](spark, sf_dir).toPandas()
    assert got.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))
    both = got.merge(docs[["doc_id", "source", "text"]], on="doc_id")
    assert list(both["size"]) == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in both.text]
    sizes = both.groupby("source")["size"].sum().to_dict()
    goal = mixing.targets(sizes)
    assert np.allclose(both.target, both.source.map(goal)) and (both.source_size == both.source.map(sizes)).all()
    assert (both.taken <= 3 * both["size"]).all() and (both.taken % both["size"].clip(1) == 0).all()
    taken = both.groupby("source").taken.sum()
    for s, t in goal.items():
        assert taken[s] <= round(t) and t - taken[s] < max(60, 0.02 * t)


def test_mixing_odd(odd, empty, spark):
    assert mixing.mix(odd).where("taken <= 3 * size").count() == len(ODD)
    made = mixing.materialise(odd)
    assert made.columns == odd.columns and made.count() > 0
    assert mixing.mix(empty).count() == 0 and mixing.materialise(empty).count() == 0
    over = spark.createDataFrame([(1, "a b c", "x", ["x", "y"]), (2, "a b", "x", ["x"]), (3, "a", "y", None), (4, "d e f", "y", ["y"])], "doc_id long, text string, source string, m array<string>")
    assert mixing.mix(over, members="m").count() == 4


def test_mixing_passes_over_long_documents(spark):
    """Wherever a long document lies in the order, what is left is filled until no other document fits."""
    rows = [(10_000 * k + i, 200, f"s{k}") for k in (0, 1) for i in range(1_000)] + [(20_000 + i, 100, "s2") for i in range(1_000)]
    for long in range(30_000, 30_006):
        docs = spark.createDataFrame([*rows, (long, 100_000, "s2")], "doc_id long, n int, source string").select("doc_id", F.repeat(F.lit("w "), F.col("n")).alias("text"), "source")
        got = mixing.mix(docs).where("source = 's2'").toPandas()
        rest = round(got.target[0]) - got.taken.sum()
        assert 0 <= rest < got["size"][got.taken == 0].min()
    copies = mixing.materialise(docs).where("source = 's2'").groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in copies} == {i: t // n for i, t, n in zip(got.doc_id, got.taken, got["size"], strict=True) if t}


def test_mixing_fills_sizes_of_many_scales(spark):
    """Sizes of all scales, repeated and null ids: rows of an id are taken together, and no further id fits."""
    rng = np.random.default_rng(5)
    rows = [(None if i % 40 == 0 else i // 2 if i % 7 == 0 else 1_000 + i, int(2 ** rng.uniform(0, 12)), f"s{i % 4}") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, n int, source string").select("doc_id", F.repeat(F.lit("w "), F.col("n")).alias("text"), "source")
    got = mixing.mix(docs).toPandas()
    for _, g in got.groupby("source"):
        ids = g.assign(times=g.taken // g["size"]).groupby("doc_id", dropna=False).agg(size=("size", "sum"), least=("times", "min"), most=("times", "max"))
        rest = round(g.target.iloc[0]) - g.taken.sum()
        assert (ids.least == ids.most).all() and rest >= 0
        assert rest < ids["size"][ids.least == ids.least.min()].min()


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = {r["doc_id"]: r["predicted"] for r in queries.QUERIES["op8_quality_classifier"](spark, sf_dir).collect()}
    names = [f for _, f in corpus_pipeline.STAGES]
    one = names[0](spark, docs, sf_dir)
    assert one.columns == docs.columns and {r["doc_id"] for r in one.select("doc_id").collect()} == {i for i, p in scored.items() if p}
    two = names[1](spark, one, sf_dir)
    want = brute_components([(r["doc_id"], r["text"]) for r in one.collect()])
    assert sorted(r["doc_id"] for r in two.select("doc_id").collect()) == sorted(i for i, x in want.items() if x[2])
    three = names[2](spark, two, sf_dir)
    bench = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert sorted(r["doc_id"] for r in three.select("doc_id").collect()) == sorted(r["doc_id"] for r in two.collect() if not any(b in r["text"] for b in bench))
    four = names[3](spark, three, sf_dir)
    times = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(three).where("size > 0").collect()}
    assert four.columns == docs.columns
    assert {r["doc_id"]: r["count"] for r in four.groupBy("doc_id").count().collect()} == {i: t for i, t in times.items() if t}
    done = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in done) == sorted(r["doc_id"] for r in four.select("doc_id").collect())
    assert min(r["start"] for r in done) == 0


def test_toxicity_of_held_out_labels(spark):
    """Held-out labels of the tables: most toxic documents are found, and few others."""
    sf_dir = "/root/testdata/sf0.1"
    labels = pd.read_parquet(f"{sf_dir}/labels.parquet")
    got = queries.QUERIES["op10_toxicity"](spark, sf_dir).toPandas().merge(labels, on="doc_id")
    held = got[got.held_out]
    found = held[held.predicted == 1]
    assert held.toxic.sum() > 100
    assert found.toxic.sum() > 0.8 * held.toxic.sum() and found.toxic.mean() > 0.95


def test_classifiers_with_repeated_ids(spark):
    """Copies of an id with other texts: reruns and other orders of the rows agree."""
    rng, rows = np.random.default_rng(7), []
    for i in range(300):
        for copy in range(1 + 2 * (i % 5 == 0)):
            rows.append((i, " ".join(f"word{k}" for k in rng.integers(0, 60, 30 + copy)) + (" vile" if i % 4 == 0 else ".")))
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 4 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    for op in (quality.classify, toxicity.toxicity):
        found = []
        for order in (rows, rows[::-1]):
            docs = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
            found.append(sorted((r["doc_id"], round(r["score"], 9)) for r in op(docs, labels).collect()))
        assert found[0] == found[1] and len(found[0]) == len(rows)


def test_flow_is_a_cheapest_maximal_one():
    """Against all ways to take tokens of some small patterns of overlapping sources."""
    rng = np.random.default_rng(11)
    sources = ["a", "b", "c"]
    subsets = [s for k in (1, 2, 3) for s in itertools.combinations(sources, k)]
    for _ in range(40):
        patterns = [subsets[i] for i in rng.choice(len(subsets), 4, replace=False)]
        capacity = {p: int(rng.integers(0, 4)) for p in patterns}
        quota = {s: float(rng.integers(0, 8)) for s in sources}
        best = None
        for taken in itertools.product(*[range(3 * capacity[p] + 1) for p in patterns]):
            # Whatever goes into a set of sources alone must fit into their quotas.
            if all(sum(t for t, p in zip(taken, patterns, strict=True) if set(p) <= set(s)) <= sum(quota[x] for x in s) for s in subsets):
                cost = sum(sum(j // capacity[p] for j in range(t)) for t, p in zip(taken, patterns, strict=True))
                best = max(best or (-1, 0), (sum(taken), -cost))
        got = mixing.route(capacity, quota)
        cost = sum(sum(j // capacity[p] for j in range(t)) for p, t in got.items())
        assert (sum(got.values()), -cost) == best


def test_mixing_of_overlapping_sources(spark):
    rng = np.random.default_rng(12)
    names = [["x"], ["y"], ["x", "y"], ["y", "z"], ["z"]]
    rows = [(i, "w " * int(rng.integers(1, 40)), "x", names[i % 5]) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, m array<string>")
    got = mixing.mix(docs, members="m").toPandas().merge(pd.DataFrame(rows, columns=["doc_id", "text", "s", "m"]), on="doc_id")
    capacity = {tuple(sorted(m)): int(sum(len(r[1].split()) for r in rows if r[3] == m)) for m in names}
    # Of several cheapest flows the one that follows from the patterns in the order of their texts.
    capacity = dict(sorted(capacity.items(), key=lambda x: json.dumps(x[0], separators=(",", ":"))))
    size = {s: sum(n for p, n in capacity.items() if s in p) for s in "xyz"}
    want = mixing.route(capacity, mixing.targets(size))
    taken = got.groupby(got.m.map(lambda m: tuple(sorted(m)))).taken.sum()
    for p, n in want.items():
        assert 0 <= n - taken[p] < 40


def test_materialise_keeps_clashing_columns(spark):
    names = ["_t", "_pattern", "_passes", "_below", "_more", "_copy", "_id", "_p", "row", "copy", "key", "a.b"]
    docs = spark.createDataFrame([(i, "w " * (i % 7), f"s{i % 3}", *[f"{n}{i}" for n in names]) for i in range(60)], f"doc_id long, text string, source string, {', '.join(f'`{n}` string' for n in names)}")
    made = mixing.materialise(docs)
    assert made.columns == docs.columns
    times = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(docs).where("size > 0").collect()}
    rows = made.collect()
    assert all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names)
    counts = pd.Series([r["doc_id"] for r in rows]).value_counts().to_dict()
    assert counts == {i: t for i, t in times.items() if t}

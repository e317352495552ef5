import datetime
import io
import json
import sqlite3

import pytest

from lexloom.functions.script import LATIN
from lexloom.plans import manifest
from lexloom.sources import category_api, domain_files, files, sqlite
from lexloom.streaming import ingest


def test_ranked_list(spark, tmp_path):
    path = tmp_path / "ranked.txt"
    path.write_bytes("﻿# comment\r\n\r\n﻿zhong\t中\r\nZHONG\t中\r\nx\t \r\nnotab\r\n".encode())
    out = files.read_ranked(spark, str(path)).orderBy("rank").collect()
    assert [tuple(r) for r in out] == [(0, "zhong", "中"), (1, "zhong", "中")]


def test_domain_folder_ids(spark, tmp_path):
    for n in "bac":
        (tmp_path / f"{n}.txt").write_text("# head\nword Read extra\n\nother é\n", encoding="utf-8")
    (tmp_path / "skip.md").write_text("word x\n")
    got = lambda: {r["domain"]: r["domain_id"] for r in files.read_domains(spark, str(tmp_path)).collect()}
    assert got() == {"a": 0, "b": 1, "c": 2}
    (tmp_path / "aa.txt").write_text("word x\n")
    assert got() == {"a": 0, "aa": 1, "b": 2, "c": 3}
    assert files.read_domains(spark, str(tmp_path)).where("domain = 'a'").first()["reading"] == "read"


def test_base_list(spark, tmp_path):
    (tmp_path / "base.txt").write_text("the 10 x\nno\nAB 3\nvery 5\n")
    assert sorted(tuple(r) for r in files.read_base(spark, str(tmp_path / "base.txt"), LATIN).collect()) == [("the", 10), ("very", 5)]


def test_factors(spark, tmp_path):
    path = tmp_path / "f.yaml"
    path.write_text("the: 2\nnews:\n  a: 1.5\n  the: 3\n")
    from lexloom.operators import lexicon

    got = lambda **k: {r["word"]: r["factor"] for r in lexicon.factors(files.read_factors(spark, str(path), **k)).collect()}
    assert got() == {"the": 3.0, "a": 1.5}
    assert got(strict_compat=True) == {"the": 3.0, "a": 1.5}
    path.write_text("the: 2\n")
    assert got() == {"the": 2.0} and got(strict_compat=True) == {}
    assert files.read_factors(spark, str(tmp_path / "none.yaml")).count() == 0


def test_config(spark, tmp_path):
    (tmp_path / "d.yaml").write_text("domains:\n  food:\n    display: Food\n    wiki_categories: [A, B]\n  sport:\n    wiki_categories: [C]\n    max_depth: 1\n")
    assert sorted((r["name"], r["category"], r["max_depth"]) for r in files.read_config(spark, str(tmp_path / "d.yaml")).collect()) == [("food", "A", 2), ("food", "B", 2), ("sport", "C", 1)]
    assert files.read_config(spark, str(tmp_path / "d.yaml"), ["sport"]).count() == 1


def test_paging_and_retries(monkeypatch):
    replies = [{"query": {"categorymembers": [{"title": "x", "ns": 0}]}, "continue": {"cmcontinue": "t"}}, {"query": {"categorymembers": [{"title": "y", "ns": 14}]}}]
    asked = []

    def get(url):
        asked.append(url)
        return replies[len(asked) - 1]

    assert list(category_api.pages("http://h/api", "C", get, 0)) == [("C", "x", 0, None), ("C", "y", 14, None)]
    assert "cmcontinue=t" in asked[1]

    def broken(url):
        raise OSError("down")

    assert list(category_api.pages("http://h/api", "C", broken, 0)) == [("C", None, None, "down")]
    waits, tries = [], []

    def opened(request, timeout):
        tries.append(timeout)
        if len(tries) < 3:
            raise OSError("down")
        return io.BytesIO(json.dumps({"a": 1}).encode())

    monkeypatch.setattr(category_api.urllib.request, "urlopen", opened)
    assert category_api.fetch("http://h", sleep=waits.append) == {"a": 1} and waits == [1, 2]
    tries[:] = [0] * -9
    with pytest.raises(OSError):
        category_api.fetch("http://h", tries=1)


def test_download_once(tmp_path, monkeypatch):
    path = tmp_path / "x" / "f"
    monkeypatch.setattr(files.urllib.request, "urlopen", lambda *a, **k: io.BytesIO(b"data"))
    assert open(files.download("http://h/f", str(path))).read() == "data"
    monkeypatch.setattr(files.urllib.request, "urlopen", None)
    files.download("http://h/f", str(path))


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "t.db")
    df = spark.createDataFrame([(2, "b", 1.5), (1, "a", None)], "id long, word string, x double").repartition(2)
    sqlite.write(df, path, "words", order="id", index="word")
    with sqlite3.connect(path) as db:
        assert db.execute("SELECT id, word FROM words").fetchall() == [(1, "a"), (2, "b")]
    assert sorted(tuple(r) for r in sqlite.read(spark, path, "words").collect()) == [(1, "a", None), (2, "b", 1.5)]
    sqlite.write(df.limit(1), path, "words", order="id")
    assert sqlite.tables(path) == {"words": 1}
    with pytest.raises(Exception, match="not a table"):
        sqlite.read(spark, path, "words; drop").count()


def test_domain_txt(spark, tmp_path):
    df = spark.createDataFrame([("d", 1, "b", "rb"), ("d", 0, "a", "ra"), ("e", 0, "c", "rc")], "domain string, ord int, word string, reading string")
    out = str(tmp_path / "domains")
    domain_files.write_txt(df, out, ["one", "two"])
    assert (tmp_path / "domains" / "d.txt").read_text() == "# one\n# two\na\tra\nb\trb\n"
    assert files.read_domains(spark, out).count() == 3


def test_domain_txt_of_a_window(spark, tmp_path):
    """A frame that is already dealt out by domain: still one file each, with all rows behind the header."""
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F

    made = spark.range(0, 6_000, numPartitions=4).select(F.concat(F.lit("d"), (F.col("id") % 20).cast("string")).alias("domain"), F.concat(F.lit("w"), F.col("id").cast("string")).alias("word"))
    df = made.withColumn("reading", F.col("word")).withColumn("ord", F.row_number().over(W.partitionBy("domain").orderBy("word")))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "6")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
        domain_files.write_txt(df, str(tmp_path / "out"), ["one", "two"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    texts = {p.name: p.read_text().splitlines() for p in (tmp_path / "out").glob("*.txt")}
    assert len(texts) == 20 and all(t[:2] == ["# one", "# two"] and len(t) == 302 and t[2:] == sorted(t[2:]) for t in texts.values())
    assert files.read_domains(spark, str(tmp_path / "out")).count() == 6_000


def test_domain_txt_names(spark, tmp_path):
    for name in ("_x", ".x", "a/b", "", None):
        with pytest.raises(ValueError, match="name"):
            domain_files.write_txt(spark.createDataFrame([(name, 0, "a", "a")], "domain string, ord int, word string, reading string"), str(tmp_path / "out"), ["one"])


def test_manifest_and_publish(spark, tmp_path):
    src, dst = tmp_path / "src", tmp_path / "dst"
    src.mkdir(), dst.mkdir()
    (src / "a.db").write_bytes(b"one")
    found = manifest.manifest(manifest.artefacts(spark, str(src)), {"a.db": {"t": 3}}, "2024.05.06.2", datetime.datetime(2024, 5, 6, 7, 8, 9))
    assert found["version"] == "2024.05.06.3" and found["dicts"]["a.db"]["rows"] == {"t": 3} and found["dicts"]["a.db"]["size"] == 3
    manifest.save(found, str(tmp_path / "V.json"))
    assert manifest.load(str(tmp_path / "V.json")) == found and manifest.load(str(tmp_path / "none")) == {}
    status = lambda df: {r["name"]: r["status"] for r in df.collect()}
    assert status(manifest.publish(spark, str(src), str(dst), found)) == {"a.db": "match"}
    assert (dst / "a.db").read_bytes() == b"one"
    (src / "a.db").write_bytes(b"two")
    (dst / "a.db").unlink()
    assert status(manifest.publish(spark, str(src), str(dst), found)) == {"a.db": "changed"} and not (dst / "a.db").exists()


def test_stream_equals_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("a 1\nb 2\n")
    (tmp_path / "in" / "2.txt").write_text("a 5\n")
    q = ingest.running_counts(ingest.base_stream(spark, str(tmp_path / "in"), 1)).writeStream.format("memory").queryName("counts").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(tuple(r) for r in spark.table("counts").collect()) == [("a", 6), ("b", 2)]


def test_whole_build(spark, tmp_path):
    """Files to databases, gates, manifest and a published copy, with a small Han profile."""
    from lexloom.functions.script import Profile
    from lexloom.plans import build

    spoken = dict(zip("电脑学中文银行電腦學", ["dian", "nao", "xue", "zhong", "wen", "yin", "hang", "dian", "nao", "xue"], strict=True))
    han = Profile("han", "一-鿿", 6, "電腦學", "电脑学", "电脑学中文银行", 0x4E00, spoken)
    (tmp_path / "base.txt").write_text("电脑 100 n\n電腦 8\n中文 7\n中文 9\nno 5\n银行 x\n", encoding="utf-8")
    (tmp_path / "ranked.txt").write_text("zhong\t中\nzhong\t中\n", encoding="utf-8")
    (tmp_path / "boost.yaml").write_text("中文: 2\n", encoding="utf-8")
    titles = spark.createDataFrame([("it", "電腦 (x)"), ("it", "学文"), ("it", "龘"), ("edu", "文学"), ("edu", "中文")], "domain string, title string")
    out, at = tmp_path / "out", datetime.datetime(2024, 5, 6, 7, 8, 9)
    sources = build.Sources(str(tmp_path / "base.txt"), titles, str(tmp_path / "ranked.txt"), str(tmp_path / "boost.yaml"))
    found = build.build(spark, sources, str(out), han, at)
    assert (out / "domains" / "it.txt").read_text(encoding="utf-8").splitlines()[3:] == ["学文\txuewen", "電腦\tdiannao"]
    rows = lambda db, sql: sqlite3.connect(str(out / db)).execute(sql).fetchall()
    assert rows("system.db", "SELECT id, word, pinyin, frequency FROM system_dict ORDER BY id") == [(1, "电脑", "diannao", 5000), (2, "中文", "zhongwen", 3138), (3, "文学", "wenxue", 1), (4, "学文", "xuewen", 1)]
    assert rows("system.db", "SELECT id, word, frequency FROM system_dict_trad") == [(1, "電腦", 8)]
    assert rows("domains.db", "SELECT word, pinyin, domain_id, domain_name FROM domain_words ORDER BY domain_id, word") == [("中文", "zhongwen", 0, "edu"), ("文学", "wenxue", 0, "edu"), ("学文", "xuewen", 1, "it"), ("电脑", "diannao", 1, "it")]
    assert rows("domains.db", "SELECT word FROM domain_words_trad") == [("電腦",)]
    assert rows("common.db", "SELECT * FROM common_words") == [(0, "zhong", "中"), (1, "zhong", "中")]
    assert found["version"] == "2024.05.06.1" and set(found["dicts"]) == {"system.db", "domains.db", "common.db", "domains/it.txt", "domains/edu.txt"}
    assert found["dicts"]["domains.db"]["rows"] == {"domain_words": 4, "domain_words_trad": 1}
    assert build.build(spark, sources, str(out), han, at)["version"] == "2024.05.06.2"
    again = manifest.publish(spark, str(out), str(tmp_path / "live"), manifest.load(str(out / "version.json")), "*.{db,txt}")
    assert {r["status"] for r in again.collect()} == {"match"} and (tmp_path / "live" / "domains" / "it.txt").exists()
    # Missing inputs and tables.
    with pytest.raises(FileNotFoundError):
        build.write_ranked(spark, str(tmp_path / "none.txt"), str(out / "x.db"))
    assert build.check_database(spark, str(out / "none.db"), build.SYSTEM_TABLES, han).first()["status"] == "FAIL"
    assert build.check_database(spark, str(out / "common.db"), build.SYSTEM_TABLES, han).first()["status"] == "FAIL"


def test_commit_and_equal_names(spark, tmp_path):
    (tmp_path / ".git" / "refs" / "heads").mkdir(parents=True)
    (tmp_path / ".git" / "HEAD").write_text("ref: refs/heads/main\n")
    assert manifest.commit(str(tmp_path)) == "unknown"
    (tmp_path / ".git" / "packed-refs").write_text("# pack-refs\n0123456789abcdef refs/heads/main\n")
    assert manifest.commit(str(tmp_path)) == "0123456"
    (tmp_path / ".git" / "refs" / "heads" / "main").write_text("fedcba9876543210\n")
    assert manifest.commit(str(tmp_path)) == "fedcba9"
    for n in "ab":
        (tmp_path / "src" / n).mkdir(parents=True)
        (tmp_path / "src" / n / "x.db").write_text(n)
    found = manifest.manifest(manifest.artefacts(spark, str(tmp_path / "src")), {}, None, datetime.datetime(2024, 5, 6))
    assert set(found["dicts"]) == {"a/x.db", "b/x.db"}
    assert {r["status"] for r in manifest.publish(spark, str(tmp_path / "src"), str(tmp_path / "dst"), found).collect()} == {"match"}
    assert [(tmp_path / "dst" / n / "x.db").read_text() for n in "ab"] == ["a", "b"]


def test_marks_and_caps(spark):
    from pyspark.sql import functions as F

    from lexloom.functions import parsing
    from lexloom.operators import gates, ranking

    lines = spark.createDataFrame([("﻿ # c",), (" ﻿\tword ",)], "v string").select(parsing.without_marks(F.col("v")).alias("v"))
    assert [r["v"] for r in lines.collect()] == ["# c", "word"]
    rows = spark.range(40).select((F.col("id") % 2).alias("d"), "id")
    assert sorted(r["id"] for r in ranking.capped(rows, ["d"], [F.desc("id")], 3).collect()) == [34, 35, 36, 37, 38, 39]
    words = spark.createDataFrame([("été",), ("ane",), ("âne",), ("âne",)], "word string")
    assert sorted(r["word"] for r in gates.suspect_words(words, LATIN, "é").collect()) == ["âne"]
    assert gates.plain_gate(words, LATIN).first()["suspects"] == 2

"""Versions, manifests and publishing."""

from __future__ import annotations

import datetime
import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.operators import gates


def next_version(previous: Column, today: Column) -> Column:
    """``today.n``: n follows that of a version of the same day; of any other, or an unreadable one, it is 1."""
    number = F.element_at(F.split(previous, r"\."), -1).try_cast("int")
    same = F.startswith(previous, F.concat(today, F.lit(".")))
    return F.concat(today, F.lit("."), (F.when(same, F.coalesce(number, F.lit(0))).otherwise(0) + 1).cast("string"))


def commit(folder: str = ".") -> str:
    """Short hash of the checked-out commit, read from the repository's files, or ``unknown``."""
    top = next((p / ".git" for p in (Path(folder).resolve(), *Path(folder).resolve().parents) if (p / ".git").is_dir()), None)
    if top is None or not (top / "HEAD").exists():
        return "unknown"
    head = (top / "HEAD").read_text().strip()
    if not head.startswith("ref: "):
        return head[:7]
    name = head[5:]
    if (top / name).exists():
        return (top / name).read_text()[:7]
    packed = (top / "packed-refs").read_text().splitlines() if (top / "packed-refs").exists() else []
    return next((line[:7] for line in packed if line.endswith(" " + name)), "unknown")


def artefacts(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, name, sha256, size`` of files; ``name`` is the path below the folder.  Hashing is spread over the executors, a file a row."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    top = _place(spark, path)[1].toString()
    return files.select("path", F.col("path").substr(F.lit(len(top) + 2), F.length("path")).alias("name"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def _place(spark: SparkSession, path: str):
    """The file system of a path, and the path as that names it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(at)


def manifest(files: DataFrame, rows: dict[str, dict[str, int]], previous: str | None, now: datetime.datetime, git: str = "unknown") -> dict:
    """Version, time, commit and, for each artefact by its path below the folder, hash, size and row counts."""
    today = now.strftime("%Y.%m.%d")
    spark = files.sparkSession
    version = spark.range(1).select(next_version(F.lit(previous or ""), F.lit(today)).alias("v")).first()["v"]
    entries = {}
    for r in files.orderBy("path").toLocalIterator():
        name = r["name"]
        entries[name] = {"sha256": r["sha256"], "size": r["size"]} | ({"rows": rows[name]} if rows.get(name) else {})
    return {"version": version, "built_at": now.strftime("%Y-%m-%dT%H:%M:%S"), "git_commit": git, "dicts": entries}


def save(found: dict, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(found, f, ensure_ascii=False, indent=2)


def load(path: str) -> dict:
    """A manifest, or an empty one where there is none or it can't be read."""
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except (OSError, ValueError):
        return {}


def check(found: dict, files: DataFrame) -> DataFrame:
    """``name, status`` of every artefact of a manifest against files: match, changed or missing."""
    spark = files.sparkSession
    expected = spark.createDataFrame([(k, v["sha256"]) for k, v in found.get("dicts", {}).items()], "name string, sha256 string")
    return gates.reconciled(expected, files, "name", "sha256")


def publish(spark: SparkSession, source: str, target: str, found: dict, glob: str = "*") -> DataFrame:
    """Copy a folder's files after a check of their hashes, and check the copies.

    Nothing is copied where the first check fails.  Returns the last check.
    """
    before = check(found, artefacts(spark, source, glob))
    if before.where("status <> 'match'").limit(1).count():
        return before
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for r in artefacts(spark, source, glob).select("path", "name").toLocalIterator():
        (a_fs, a), (b_fs, b) = _place(spark, r["path"]), _place(spark, f"{target}/{r['name']}")
        b_fs.mkdirs(b.getParent())
        jvm.org.apache.hadoop.fs.FileUtil.copy(a_fs, a, b_fs, b, False, True, conf)
    return check(found, artefacts(spark, target, glob))

"""Domain lists as text files, and the two domain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexloom.functions.script import Profile
from lexloom.operators import dedupe, lexicon


def write_txt(df: DataFrame, path: str, header: list[str]) -> None:
    """``path/DOMAIN.txt`` for every domain of ``df (domain, ord, word, reading)``: header comments, then ``word<TAB>reading``.

    A domain's rows meet in one task (by a window, whose distribution Spark
    keeps; a plain ``repartition`` over a union may be removed), its first row
    brings the header, and the task writes them in order to one file.  Raises
    ``ValueError`` for names that can't be a visible file's, and ``OSError``
    where a domain comes in several files, rather than lose rows.
    """
    spark = df.sparkSession
    place = F.row_number().over(W.partitionBy("domain").orderBy("ord", "word", "reading"))
    line = F.concat("word", F.lit("\t"), "reading")
    heads = F.array(*[F.lit(f"# {h}") for h in header], line)
    rows = df.withColumn("_n", place).select("domain", "_n", F.posexplode(F.when(F.col("_n") == 1, heads).otherwise(F.array(line))).alias("_at", "value"))
    rows = rows.sortWithinPartitions("domain", "_n", "_at")
    rows.select("domain", "value").write.mode("overwrite").partitionBy("domain").text(path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(conf)
    for folder in fs.listStatus(top):
        at = folder.getPath()
        if not at.getName().startswith("domain="):
            continue
        name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(at.getName()[7:])
        # Spark's readers pass over files that begin with a dot or an underscore; null and empty names share a folder.
        if "/" in name or name[:1] in ("", ".", "_"):
            raise ValueError(f"no file can have this domain's name: {name!r}")
        parts = [f.getPath() for f in fs.listStatus(at) if f.getPath().getName().startswith("part-")]
        if len(parts) != 1 or not fs.rename(parts[0], jvm.org.apache.hadoop.fs.Path(top, name + ".txt")):
            raise OSError(f"domain {name!r} is not in one file: {len(parts)} parts")
        fs.delete(at, True)


def domain_tables(rows: DataFrame, profile: Profile) -> DataFrame:
    """``side, word, reading, domain_id, domain`` of both tables; of a word in a domain the first line stays."""
    both = lexicon.dual(rows.select("domain_id", "domain", "ord", "reading", "word"), profile)
    return dedupe.first_wins(both, ["side", "word", "domain_id"], ["ord"]).select("side", "word", "reading", "domain_id", "domain")

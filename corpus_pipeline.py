"""A training-corpus build of five stages over ``documents``.

``STAGES`` lists the stages; each function takes the session, the documents
that its predecessor kept and the folder of the tables, and returns a frame
that is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexloom.llm import decontaminate, mixing, near_dup, quality
from lexloom.llm.queries import token_index
from lexloom.llm.scratch import Scratch, ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ship(spark)
    return quality.accepted(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    ship(spark)
    return near_dup.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated so that sources meet their targets."""
    ship(spark)
    return mixing.materialise(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files; their index is returned."""
    ship(spark)
    return token_index(spark, docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mix),
    ("token-ID / binary output", token_output),
]

#: SQL can express neither the classifiers nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a table in the shared folder between any two."""
    docs = _table(spark, sf_dir, "documents")
    with Scratch(spark) as scratch:
        for name, stage in STAGES[:-1]:
            made = scratch.table(stage(spark, docs, sf_dir), name.split()[0].lower())
            if hasattr(docs, "_lexloom_path"):
                scratch.drop(docs)
            docs = made
        return STAGES[-1][1](spark, docs, sf_dir)

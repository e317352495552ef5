"""Quality rules and quality classifier over document statistics.

Both score a document by gradient-boosted trees over :mod:`docstats`.  The
rules add fixed base rules and hold the score monotonic: more symbols, repeated
lines, repeated windows, capitals, bars or exclamation marks per word never
raise it.  The classifier has no such constraint.

Defined results: null texts count as empty ones; a document without words
fails the base rules and gets the score of a text without words.  Repeated
rows each get their row's result, and one text of a repeated id is fitted (see
:func:`sample.with_text`); a null ``doc_id`` is carried along and never used
for fitting.  Without labels of both kinds the score is a constant: the
share of label 1 (with half a row of each kind added).  Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import docstats, gbdt, sample, textvec

#: Features that may only lower the score of the rules.
FALLING = ("symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "bang_rate", "pipe_rate")


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in textvec.chunks(batch["text"]):
            x = docstats.measure(batch["text"].slice(a, b - a))[1]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), batch["label"].slice(a, b - a), lists], ["doc_id", "label", "x"])


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, monotonic: bool = False, max_rows: int = sample.MAX_ROWS, **options) -> gbdt.Trees:
    """Trees for ``labels.quality``, fitted on at most ``max_rows`` labelled documents."""
    chosen = sample.labelled(labels, "quality", allowed, max_rows)
    rows = sample.with_text(docs, chosen).mapInArrow(textvec.tidy(_featured), "doc_id bigint, label int, x array<double>").toArrow().sort_by("doc_id")
    x = pc.list_flatten(rows["x"]).to_numpy().reshape(len(rows), len(docstats.FEATURES))
    directions = {docstats.FEATURES.index(f): -1 for f in FALLING} if monotonic else None
    return gbdt.fit(x, rows["label"].to_numpy().astype(np.float64), directions, **options)


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in textvec.chunks(batch["text"]):
                base, x = docstats.measure(batch["text"].slice(a, b - a))
                counts = [pa.array(base[k].astype(np.int64)) for k in docstats.BASE]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), *counts, pa.array(model.value.score(x))], ["doc_id", *docstats.BASE, "score"])

    return run


def score(docs: DataFrame, model: gbdt.Trees) -> DataFrame:
    """``doc_id``, the counts of :data:`docstats.BASE` and ``score`` for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    counts = ", ".join(f"{k} bigint" for k in docstats.BASE)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(textvec.tidy(_scored(shared)), f"doc_id bigint, {counts}, score double")


def rules(docs: DataFrame, labels: DataFrame, min_words: int = 20, max_repeat: int = 30, threshold: float = 0.5, max_rows: int = sample.MAX_ROWS) -> DataFrame:
    """Base rules, then the monotonic trees: counts, ``base_failed``, ``score`` and ``kept``."""
    model = fit(docs, labels, sample.fold(F.col("doc_id"), 5) != 0, monotonic=True, max_rows=max_rows)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    return score(docs, model).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = sample.MAX_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted``; fitted outside the held-out fifth of ids."""
    model = fit(docs, labels, sample.fold(F.col("doc_id"), 5) != 0, max_rows=max_rows)
    out = score(docs, model).select("doc_id", (sample.fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _passing(model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in textvec.chunks(batch["text"]):
                part = batch.slice(a, b - a)
                yield part.filter(pa.array(model.value.score(docstats.measure(part["text"])[1]) >= threshold))

    return run


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = sample.MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    model = fit(docs, labels, sample.fold(F.col("doc_id"), 5) != 0, max_rows=max_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(textvec.tidy(_passing(shared, threshold)), docs.schema)

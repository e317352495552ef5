"""Toxicity: a character n-gram linear classifier scaled by naive Bayes ratios.

The features of a text are the distinct hashed n-grams of 4, 6 and 8 characters of
its lower-cased (A-Z) text, white space counting as a blank.  On a bounded
labelled sample the log-count ratio of every n-gram between the two labels is
taken; the n-grams that tell the labels apart best (by the log-likelihood
statistic) are kept, and a logistic regression is fitted on features that hold
the ratio where the n-gram occurs.  Scoring looks each n-gram of a whole text
up in one dense table.

Defined results: null and empty texts have no features and get the score of
the intercept.  Repeated rows each get their row's result, and one text of a
repeated id is fitted (see :func:`sample.with_text`); a null ``doc_id`` is
carried along and never used for fitting.  Without labels of both kinds the
score is the share of label 1 (with half a row of each kind added).  Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sample, textvec
from .scratch import Scratch
from .textvec import U64

ORDERS, BITS, FEATURES = (4, 6, 8), 21, 4096
#: An n-gram counts if it occurs in so many labelled documents; weight of the squared coefficients.
LEAST_DOCS, L2 = 5, 3.0
_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[0x09:0x0E] = 32


@dataclass
class Linear:
    """Weight of every n-gram bucket (ratio times coefficient), and the intercept."""

    weight: np.ndarray
    intercept: float


def ngrams(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and document of every n-gram of a run of texts, one order at a time."""
    t = textvec.Texts(column, lower=True)
    chars = np.frombuffer(_BLANK[t.data].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.concatenate(([0], np.cumsum((t.data & 0xC0) != 0x80)))[t.offsets]
    doc = np.repeat(np.arange(t.n), np.diff(lead))
    c = chars.astype(np.uint64)
    for n in ORDERS:
        m = len(c) - n + 1
        if m <= 0:
            continue
        acc = np.full(m, n, np.uint64)
        for j in range(n):
            acc += c[j : j + m] * textvec.WORD_COEF[j + 1]
        acc ^= acc >> U64(31)
        acc *= U64(0x9E3779B97F4A7C15)
        inside = doc[:m] == doc[n - 1 :]
        yield (acc >> U64(64 - BITS)).astype(np.int64)[inside], doc[:m][inside]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of each label an n-gram occurs; the table has a fixed size."""
    df = np.zeros((2, 1 << BITS), np.int32)
    for batch in batches:
        label = batch["label"].to_numpy(zero_copy_only=False)
        for a, b in textvec.chunks(batch["text"]):
            parts = [at | (doc << BITS) for at, doc in ngrams(batch["text"].slice(a, b - a))]
            each = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
            for k in (0, 1):
                own = each[label[a + (each >> BITS)] == k] & ((1 << BITS) - 1)
                df[k] += np.bincount(own, minlength=1 << BITS).astype(np.int32)
    at = np.flatnonzero(df.sum(0))
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[0, at]), pa.array(df[1, at])], ["at", "n0", "n1"])


def _occurring(chosen):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.full(1 << BITS, -1, np.int64)
        table[chosen] = np.arange(len(chosen))
        for batch in batches:
            for a, b in textvec.chunks(batch["text"]):
                parts = []
                for at, doc in ngrams(batch["text"].slice(a, b - a)):
                    f = table[at]
                    parts.append((f[f >= 0] << 32) | doc[f >= 0])
                each = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
                doc, f = each & 0xFFFFFFFF, each >> 32
                order = np.argsort(doc, kind="stable")
                cuts = np.searchsorted(doc[order], np.arange(b - a + 1))
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(f[order].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), batch["label"].slice(a, b - a), lists], ["doc_id", "label", "f"])

    return run


def _minimised(loss, start: np.ndarray, rounds: int, kept: int = 12, enough: float = 1e-6) -> np.ndarray:
    """The least of a smooth convex function, by limited-memory quasi-Newton steps; ``loss`` gives value and gradient."""
    x, (value, g) = start, loss(start)
    moves: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        if np.abs(g).max(initial=0) < enough:
            break
        way, parts = -g, []
        for dx, dg, rho in reversed(moves):
            parts.append(rho * (dx @ way))
            way = way - parts[-1] * dg
        if moves:
            dx, dg, rho = moves[-1]
            way = way / (rho * (dg @ dg))
        for (dx, dg, rho), part in zip(moves, reversed(parts), strict=True):
            way = way + dx * (part - rho * (dg @ way))
        slope, step = g @ way, 1.0 if moves else 1.0 / max(1.0, float(np.abs(g).sum()))
        for _ in range(40):
            new = x + step * way
            new_value, new_g = loss(new)
            if new_value <= value + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        dx, dg = new - x, new_g - g
        if dx @ dg > 1e-12:
            moves = [*moves[1 - kept :], (dx, dg, 1 / (dx @ dg))]
        x, value, g = new, new_value, new_g
    return x


def _regression(cuts: np.ndarray, cols: np.ndarray, scale: np.ndarray, y: np.ndarray, l2: float = L2, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Coefficients of the scaled binary features, and the intercept.

    Minimises the mean logistic loss plus ``l2 / (2 n)`` times the squared
    coefficients.  Rows of the rarer label count as much as those of the other,
    so that a small sample of it isn't drowned.
    """
    n, rows = len(y), np.repeat(np.arange(len(y)), np.diff(cuts))
    value, k = scale[cols], len(scale)
    ratio = (n - y.sum() + 0.5) / (y.sum() + 0.5)
    mass = np.where(y == 1, max(1.0, ratio), max(1.0, 1 / ratio))
    mass /= mass.sum()

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        raw = np.bincount(rows, x[cols] * value, n) + x[k]
        off = mass * (1 / (1 + np.exp(-np.clip(raw, -500, 500))) - y)
        inner = np.bincount(cols, off[rows] * value, k) + l2 / n * x[:k]
        return float(mass @ (np.logaddexp(0, raw) - y * raw) + l2 / (2 * n) * (x[:k] @ x[:k])), np.append(inner, off.sum())

    x = _minimised(loss, np.zeros(k + 1), rounds)
    return x[:k], float(x[k])


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, features: int = FEATURES, max_rows: int = sample.MAX_ROWS) -> Linear:
    """Fit on at most ``max_rows`` labelled documents; the driver gets ``features`` counts and these documents' kept n-grams."""
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        chosen = sample.labelled(labels, "toxic", allowed, max_rows)
        rows = scratch.table(sample.with_text(docs, chosen), "sample")
        n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
        n0, n1 = n.get(0, 0), n.get(1, 0)
        weight = np.zeros(1 << BITS, np.float32)
        if not n0 or not n1:
            share = (n1 + 0.5) / (n0 + n1 + 1)
            return Linear(weight, float(np.log(share / (1 - share))))
        # A bounded table: a bucket has at most one row a task.
        df = rows.mapInArrow(textvec.tidy(_frequencies), "at bigint, n0 int, n1 int").groupBy("at").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        p0, p1 = (F.col("n0") + 0.5) / (n0 + 1), (F.col("n1") + 0.5) / (n1 + 1)
        pool = (F.col("n0") + F.col("n1") + 1) / (n0 + n1 + 2)
        stat = (F.col("n0") + 0.5) * F.log(p0 / pool) + (F.col("n1") + 0.5) * F.log(p1 / pool) + (n0 - F.col("n0") + 0.5) * F.log((1 - p0) / (1 - pool)) + (n1 - F.col("n1") + 0.5) * F.log((1 - p1) / (1 - pool))
        best = df.where(F.col("n0") + F.col("n1") >= LEAST_DOCS).select("at", F.log(p1 / p0).alias("r"), stat.alias("s")).orderBy(F.desc("s"), "at").limit(features).toArrow().sort_by("at")
        at, r = best["at"].to_numpy().astype(np.int64), best["r"].to_numpy()
        got = rows.mapInArrow(textvec.tidy(_occurring(at)), "doc_id bigint, label int, f array<int>").toArrow().sort_by("doc_id")
    cuts = np.concatenate(([0], np.cumsum(pc.list_value_length(got["f"]).to_numpy())))
    cols = pc.list_flatten(got["f"]).to_numpy().astype(np.int64)
    w, b = _regression(cuts, cols, r, got["label"].to_numpy().astype(np.float64))
    weight[at] = w * r
    return Linear(weight, b)


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, intercept = model.value.weight, model.value.intercept
        active = weight != 0
        for batch in batches:
            for a, b in textvec.chunks(batch["text"]):
                parts = []
                for at, doc in ngrams(batch["text"].slice(a, b - a)):
                    hit = active[at]
                    parts.append(at[hit] | (doc[hit] << BITS))
                each = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
                raw = np.bincount(each >> BITS, weight[each & ((1 << BITS) - 1)], b - a) + intercept
                score = 1 / (1 + np.exp(-np.clip(raw, -40, 40)))
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), pa.array(score)], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Linear) -> DataFrame:
    """``doc_id, score`` for every row of ``docs``, from its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(textvec.tidy(_scored(shared)), "doc_id bigint, score double")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_rows: int = sample.MAX_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted``; fitted outside the held-out third of ids."""
    model = fit(docs, labels, sample.fold(F.col("doc_id"), 3) != 1, max_rows=max_rows)
    out = score(docs, model).select("doc_id", (sample.fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

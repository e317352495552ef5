"""Language identification by rank-order profiles.

A profile lists the most frequent 1- to 3-grams of letters of a language, by
rank.  A document's own most frequent n-grams are ranked the same way, and the
out-of-place distance adds up how far each stands from its rank in the profile
(a missing one counts as the greatest distance).  The nearest profile wins, a
tie going to the language that comes first by code point.

Texts are lower-cased; every run of other characters than letters is one
border.  Ranks go by count, then by n-gram, so that runs agree.

Defined results: a null text or one without a letter is ``und`` with score 0,
and so is every text where no language could be learned.  Repeated rows each
get their row's result; a null ``doc_id`` is carried along (its ``held_out`` is
null).  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import sample

PROFILE = 300
#: At most about so many documents of each language fit its profile.
MAX_DOCS = 1_000
_SPAN = 21


def _letters() -> np.ndarray:
    if "table" not in _CACHE:
        _CACHE["table"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _CACHE["table"]


_CACHE: dict[str, np.ndarray] = {}


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, packed 21 bits a character, ascending, and their counts."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    solid = _letters()[c]
    if not solid.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = np.where(solid, c, 32)
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    c = np.concatenate(([32], c[keep], [32]))
    two = c[:-1] | (c[1:] << _SPAN)
    three = two[:-1] | (c[2:] << (2 * _SPAN))
    one = c[c != 32]
    # A middle border joins two words; such n-grams are no part of a word.
    every = np.sort(np.concatenate((one, two[(c[:-1] != 32) | (c[1:] != 32)], three[c[1:-1] != 32])))
    first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    return every[first], np.diff(np.concatenate((first, [len(every)])))


def top(codes: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` most frequent codes by rank; equal counts go by code."""
    key = ((counts.max() - counts) << 32) | np.arange(len(codes)) if len(codes) else codes
    if len(key) > n:
        key = np.partition(key, n)[:n]
    return codes[np.sort(key) & 0xFFFFFFFF]


@dataclass
class Profiles:
    """Languages, all n-grams of their profiles, and each one's rank in each language."""

    langs: list[str]
    codes: np.ndarray
    ranks: np.ndarray
    size: int

    def predict(self, text: str | None) -> tuple[str, float]:
        codes, counts = grams(text)
        if not len(codes) or not self.langs:
            return "und", 0.0
        mine = top(codes, counts, self.size)
        at = np.minimum(np.searchsorted(self.codes, mine), len(self.codes) - 1)
        ranks = np.where((self.codes[at] == mine)[:, None], self.ranks[at], self.size * 2)
        off = np.minimum(np.abs(ranks - np.arange(len(mine))[:, None]), self.size).sum(0)
        best = int(off.argmin())
        return self.langs[best], float(1 - off[best] / (self.size * len(mine)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[np.ndarray]] = {}
    names = ["lang", "code", "n"]

    def out(lang: str) -> pa.RecordBatch:
        codes, at = np.unique(np.concatenate(held[lang][::2]), return_inverse=True)
        n = np.bincount(at, np.concatenate(held[lang][1::2])).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes), pa.array(n)], names)

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            held.setdefault(lang, []).extend(grams(text))
    for lang in held:
        yield out(lang)


def learn(docs: DataFrame, allowed: Column | None = None, size: int = PROFILE, max_docs: int = MAX_DOCS) -> Profiles:
    """Profiles of every non-null ``lang`` of ``docs``.

    At most about ``max_docs`` documents of each language are read, chosen by a
    seeded hash of ``doc_id``.  What reaches the driver is ``size`` rows a
    language.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    if allowed is not None:
        rows = rows.where(allowed)
    sizes = rows.groupBy("lang").count().collect()
    pick = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30))
    chosen = F.lit(False)
    for r in sizes:
        chosen = chosen | ((F.col("lang") == r["lang"]) & (pick < int(min(1.0, max_docs / r["count"]) * (1 << 30))))
    counted = rows.where(chosen).select("lang", "text").mapInArrow(_counted, "lang string, code bigint, n bigint")
    counted = counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "code"))
    ranked = counted.withColumn("rank", place - 1).where(F.col("rank") < size).select("lang", "code", "rank").collect()
    langs = sorted({r["lang"] for r in ranked})
    codes = np.array(sorted({r["code"] for r in ranked}), np.int64)
    ranks = np.full((len(codes), len(langs)), size * 2, np.int64)
    for r in ranked:
        ranks[np.searchsorted(codes, r["code"]), langs.index(r["lang"])] = r["rank"]
    return Profiles(langs, codes, ranks, size)


def _predicted(profiles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.value.predict(x.as_py()) for x in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs``, from its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_predicted(shared), "doc_id bigint, lang_pred string, score double")


def language_id(docs: DataFrame) -> DataFrame:
    """Learn outside the held-out quarter of ids, then predict every document."""
    profiles = learn(docs, sample.fold(F.col("doc_id"), 4) != 2)
    out = identify(docs, profiles)
    return out.select("doc_id", (sample.fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")

"""Near-duplicate documents: SuperMinHash, banding, verification, union-find.

Texts are lower-cased (A-Z only) and cut into words ``[^\\x20\\x09-\\x0D]+``; a
document's set is that of its distinct shingles of ``k`` words, or its whole
word sequence where it has fewer.  Two documents are linked when
``100 * intersection >= 100 * threshold * union`` on their full sets.

Steps, none of which lists all pairs of a group:

1. Equal sets form one group, stood for by its least ``doc_id``.
2. SuperMinHash signatures of the representatives are cut into bands.  The
   members of a band bucket are paired with one hub of the bucket, which is
   linear in its size; these pairs are verified on the full sets and the links
   contracted by union-find.
3. Members of buckets that are then still in several components are joined in
   full, by a prefix filter with positions: rare shingles first, pairs are made
   only where the first common shingle leaves enough behind it.  That bound is
   exact, so no link between bucket mates is lost.
4. Links of both steps give the components.

At similarity 0.75, 24 bands of 5 rows miss 0.15 % of pairs (0.001 % at 0.85).

Defined results: null or empty texts and texts without words have an empty
set, are linked with nothing and are kept.  Rows with a null ``doc_id`` are
returned with a null component and kept.  Repeated rows of a document share
its result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import superminhash, textvec
from .components import components
from .scratch import Scratch
from .skew import SMALL, KeyFilter, lookup

SHINGLE, THRESHOLD, BANDS, ROWS = 5, 75, 24, 5


def _lists(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values))


def _profile(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in textvec.chunks(batch["text"]):
                texts = textvec.Texts(batch["text"].slice(a, b - a), lower=True)
                flat, cuts = texts.shingle_sets(k)
                keys = superminhash.band_keys(superminhash.signatures(flat, cuts, bands * rows), rows)
                marks = []
                for seed in (1, 2):
                    total = np.concatenate(([np.uint64(0)], np.cumsum(textvec.mix(flat ^ textvec.U64(seed)), dtype=np.uint64)))
                    marks.append((total[cuts[1:]] - total[cuts[:-1]]).view(np.int64))
                n = b - a
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(a, n), pa.array(np.diff(cuts)), *map(pa.array, marks), _lists(keys.ravel(), np.arange(n + 1) * bands)],
                    ["doc_id", "n", "h1", "h2", "keys"],
                )

    return run


def _sets(k: int, mask):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = KeyFilter.test(mask.value, [batch[f"_b{i}"].to_numpy(zero_copy_only=False) for i in range(3)])
            batch = batch.filter(pa.array(hit))
            for a, b in textvec.chunks(batch["text"]):
                texts = textvec.Texts(batch["text"].slice(a, b - a), lower=True)
                flat, cuts = texts.shingle_sets(k)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), _lists(flat.view(np.int64), cuts)], ["doc_id", "sh"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int, scratch: Scratch) -> DataFrame:
    """The pairs ``(a, b)`` that are similar on their full sets.

    ``a`` may be in very many pairs: its set is handed out once for every 500
    of them, and pairs are dealt out over these.
    """
    pairs = scratch.table(pairs, "pairs")
    degree = pairs.groupBy("a").agg(F.count("*").alias("d")).withColumn("parts", (F.col("d") / 500).cast("int") + 1)
    hubs = degree.join(sets, degree["a"] == sets["doc_id"]).select("a", "parts", F.col("sh").alias("sh_a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    members = lookup(pairs, ["a"], degree.select("a", "parts", "d"), "d", max(1, pairs.count())).withColumn("part", F.pmod(F.hash("b"), F.col("parts")))
    members = members.join(sets, members["b"] == sets["doc_id"]).select("a", "b", "part", F.col("sh").alias("sh_b"))
    both = members.join(hubs.drop("parts"), ["a", "part"])
    common = F.size(F.array_intersect("sh_a", "sh_b"))
    out = both.withColumn("k", common).where(F.col("k") * 100 >= threshold * (F.size("sh_a") + F.size("sh_b") - F.col("k")))
    out = scratch.table(out.select("a", "b").distinct(), "links")
    scratch.drop(pairs)
    return out


def _rare_mates(sets: DataFrame, left: DataFrame, threshold: int, scratch: Scratch) -> DataFrame:
    """Pairs ``(a, b)`` of ``left (rep, comp, n)`` of different components that may be similar; exact.

    Shingles are ordered from rare to frequent among these documents.  Similar
    sets share one among the first of each, and their first common shingle
    leaves enough behind it on both sides.  Of a shingle's documents those of
    its largest component are not paired with each other.
    """
    t = threshold
    tokens = sets.join(left, sets["doc_id"] == left["rep"]).select("rep", "comp", "n", F.explode("sh").alias("t"))
    df = tokens.groupBy("t").agg(F.count("*").alias("c"), F.count("*").alias("df")).where("c > 1")
    total = left.agg(F.coalesce(F.sum("n"), F.lit(1))).first()[0]
    kept = lookup(tokens, ["t"], df, "c", total).where("df is not null")
    # Shingles of one document only come first in its order; they need no row.
    place = F.row_number().over(W.partitionBy("rep").orderBy("df", "t"))
    kept = kept.select("*", (place + F.col("n") - F.count("*").over(W.partitionBy("rep"))).alias("p"))
    kept = scratch.table(kept.where((100 * (F.col("n") - F.col("p") + 1)) >= t * F.col("n")).select("t", "rep", "comp", "n", "p"), "prefix")
    main = kept.groupBy("t", "comp").agg(F.count("*").alias("c")).groupBy("t").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.count("*").alias("comps")).where("comps > 1").select("t", "main")
    main = scratch.table(main, "main")
    both = kept.join(main, "t")
    x, y = both.where("comp <> main").alias("x"), both.alias("y")
    near = (100 + t) * (F.least(F.col("x.n") - F.col("x.p"), F.col("y.n") - F.col("y.p")) + 1) >= t * (F.col("x.n") + F.col("y.n"))
    once = (F.col("y.comp") == F.col("y.main")) | (F.col("x.rep") < F.col("y.rep"))
    pairs = x.join(y, (F.col("x.t") == F.col("y.t")) & (F.col("x.comp") != F.col("y.comp")) & once & near)
    return pairs.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()


def near_duplicates(docs: DataFrame, k: int = SHINGLE, threshold: int = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs (doc_id, text)``."""
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        profile = scratch.table(docs.mapInArrow(textvec.tidy(_profile(k, bands, rows)), "doc_id bigint, n bigint, h1 bigint, h2 bigint, keys array<bigint>"), "profile")
        total = max(1, profile.count())
        known = profile.where("n > 0 and doc_id is not null")
        groups = scratch.table(known.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("c"), F.any_value("keys").alias("keys")), "groups")
        spots = groups.select("rep", "n", F.posexplode("keys").alias("band", "key"))
        hubs = spots.groupBy("band", "key").agg(F.min("rep").alias("a"), F.count("*").alias("c")).where("c > 1")
        spots = scratch.table(lookup(spots, ["band", "key"], hubs, "c", total).where("a is not null"), "spots")
        star = spots.where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
        ids = scratch.table(spots.select("rep").distinct(), "candidates")
        found = KeyFilter(ids, "rep", ids.count())
        sets = docs.select("doc_id", "text", *found.columns(F.col("doc_id"))).where("doc_id is not null")
        sets = sets.mapInArrow(textvec.tidy(_sets(k, found.shared)), "doc_id bigint, sh array<bigint>")
        sets = scratch.table(sets.join(ids, sets["doc_id"] == ids["rep"], "left_semi"), "sets")
        links = _verified(star, sets, threshold, scratch)
        first = scratch.table(components(links, scratch), "components")
        spots = spots.join(first, spots["rep"] == first["node"], "left").select("band", "key", "rep", "n", F.coalesce("component", "rep").alias("comp"))
        spots = scratch.table(spots, "placed")
        opened = spots.groupBy("band", "key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("c")).where("lo < hi").select("band", "key", "lo", "c")
        left = lookup(spots, ["band", "key"], opened, "c", total).where("lo is not null").select("rep", "comp", "n").distinct()
        rest = _rare_mates(sets, scratch.table(left, "left"), threshold, scratch).join(star, ["a", "b"], "left_anti")
        links = links.union(_verified(rest, sets, threshold, scratch))
        final = components(links, scratch)
        groups = groups.join(final, groups["rep"] == final["node"], "left").select("h1", "h2", "n", "c", F.coalesce("component", "rep").alias("comp"))
        rows_ = profile.select("doc_id", "n", "h1", "h2")
        out = lookup(rows_, ["h1", "h2", "n"], groups, "c", total)
        comp = F.when(F.col("n") > 0, F.col("comp")).otherwise(F.col("doc_id"))
        out = out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), comp).alias("component_id"))
        return scratch.keep(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One document of each group of near-duplicates, with all its columns; of repeated rows one stays."""
    found = near_duplicates(docs, **options)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    docs = docs.join(F.broadcast(gone) if gone.count() <= SMALL else gone, "doc_id", "left_anti").select(docs.columns)
    twice = found.where("kept and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id")
    n = twice.count()
    if not n:
        return docs
    twice = F.broadcast(twice) if n <= SMALL else twice
    return docs.join(twice, "doc_id", "left_anti").select(docs.columns).unionByName(docs.join(twice, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id", "text"]))

"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Texts are lower-cased and cut into words at everything but letters and digits.
Fixed masks look at two pairs of adjacent words and ignore the words between
them, so that a changed word does not hide a passage.  Hashes of all masked
windows of the benchmark are joined with those of all documents.  Where two of
them or more (one, for items of fewer than ``window`` words) lie on one
diagonal, the words along it are compared, and a document is contaminated by an
item if some stretch of ``window`` words (the whole item, if it is shorter)
agrees in ``percent`` of its words.  In 13 words with any two of them changed, at
least three masked windows stay whole; in 10 to 12 words, at least one.  Items
of fewer than 10 words have masks of their whole length, one for every choice
of the words that may be changed (at 80 percent one of 5 to 9 words, none of
fewer); documents are hashed by those of the lengths that the benchmark has.

Documents are not shuffled: where the table of benchmark windows is within
``broadcast_rows``, it is broadcast; a larger one is joined by a shuffle.  Only
hits leave the scan; the words of documents that have hits are then read again
for the comparison, all hits of a document at once.

Defined results: null and empty texts are in no pair.  Repeated rows of a document or item give one pair.  Rows
with a null ``doc_id`` or ``item_id`` are in no pair.  Other columns are
ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

WINDOW, PERCENT, LEAST_WORDS, LEAST_HITS = 13, 80, 10, 2
#: Starts of the pairs of adjacent words that each mask looks at.
MASKS = ((0, 3), (0, 5))
#: A table of at most so many benchmark windows, or of so many documents with hits, is broadcast.
BROADCAST_ROWS = 100_000


def _words(text: str) -> Column:
    """Hashes of a text's words."""
    return F.transform(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), ""), lambda w: F.xxhash64(w))


def _hashed(df: DataFrame, key: str, name: str) -> DataFrame:
    """``key`` and the array ``name`` of the hashes of the text's words."""
    return df.select(F.col(key).cast("bigint").alias(key), _words("text").alias(name))


def _windows(df: DataFrame, key: str, name: str) -> DataFrame:
    """``key, mask, place, seed``: the hash of every mask at every place of the array ``name``.

    The array itself isn't carried along, so that a place takes a few bytes.
    """
    n, spans = F.col("_n"), [max(m) + 2 for m in MASKS]
    pairs = F.when(F.size(name) > 1, F.transform(F.sequence(F.lit(0), F.size(name) - 2), lambda i: F.xxhash64(F.get(name, i), F.get(name, i + 1))))
    df = df.select(key, F.size(name).alias("_n"), pairs.alias("_p"))

    def seeds(k: int) -> Column:
        made = F.transform(F.sequence(F.lit(0), n - spans[k]), lambda i: F.xxhash64(F.lit(k), *[F.get("_p", i + o) for o in MASKS[k]]))
        return F.when(n >= spans[k], made).otherwise(F.array().cast("array<bigint>"))

    # The outer form: a plain one would add a filter that repeats these expressions inside each other.
    df = df.select(key, "_n", F.posexplode_outer(F.concat(*map(seeds, range(len(MASKS))))).alias("_at", "seed"))
    starts = [F.lit(0)]
    for span in spans[:-1]:
        starts.append(starts[-1] + F.greatest(n - span + 1, F.lit(0)))
    mask = sum(((F.col("_at") >= x).cast("int") for x in starts[1:]), F.lit(0))
    return df.select(key, mask.alias("mask"), (F.col("_at") - F.element_at(F.array(*starts), mask + 1)).alias("place"), "seed")


def _short_masks(lengths: list[int], percent: int) -> list[tuple[int, tuple[int, ...]]]:
    """Length and looked-at words of every mask for items of few words."""
    return [(n, kept) for n in lengths for kept in combinations(range(n), max(1, -(-percent * n // 100)))]


def _short_windows(df: DataFrame, key: str, name: str, masks: list[tuple[int, tuple[int, ...]]], whole: bool) -> DataFrame:
    """Like :func:`_windows` for ``masks``; with ``whole`` only where the array is as long as the mask."""
    n = F.size(name)

    def seeds(k: int) -> Column:
        span, kept = masks[k]
        made = F.transform(F.sequence(F.lit(0), n - span), lambda i: F.struct(F.lit(len(MASKS) + k).alias("mask"), i.alias("place"), F.xxhash64(F.lit(len(MASKS) + k), *[F.get(name, i + o) for o in kept]).alias("seed")))
        return F.when(n == span if whole else n >= span, made).otherwise(F.array().cast("array<struct<mask:int,place:int,seed:bigint>>"))

    return df.select(key, F.explode_outer(F.concat(*map(seeds, range(len(masks))))).alias("x")).select(key, "x.*")


def _best(h: Column, ih: Column, start: Column, window: int) -> Column:
    """The most equal words in a stretch, with the item laid on the document at ``start``."""
    n = F.size(ih)
    same = F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.coalesce((F.get(h, start + j) == F.get(ih, j)).cast("int"), F.lit(0)))
    # Running sums: a stretch's matches are the difference of two of them.
    sums = F.aggregate(same, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    width = F.least(F.lit(window), n)
    return F.aggregate(F.array(sums), F.lit(0), lambda a, c: F.array_max(F.transform(F.sequence(width, n), lambda e: F.get(c, e) - F.get(c, e - width))))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = PERCENT, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row ``doc_id, item_id, matched, position`` for every contaminated document and item.

    ``matched`` is the greatest number of equal words in a stretch, ``position``
    the word of the document on which the item's first word then lies.
    """
    with Scratch(docs.sparkSession) as scratch:
        known = benchmark.where(F.col("item_id").isNotNull()).dropDuplicates(["item_id", "text"])
        items = scratch.table(_hashed(known, "item_id", "ih").where(F.size("ih") > 0), "items")
        lengths = [r["n"] for r in items.where(F.size("ih") < LEAST_WORDS).select(F.size("ih").alias("n")).distinct().orderBy("n").collect()]
        masks = _short_masks(lengths, percent)
        n = F.size("ih")
        seeds = _windows(items.where((n >= LEAST_WORDS) & (n >= window)), "item_id", "ih").withColumn("least", F.lit(LEAST_HITS))
        seeds = seeds.unionByName(_windows(items.where((n >= LEAST_WORDS) & (n < window)), "item_id", "ih").withColumn("least", F.lit(1)))
        if masks:
            seeds = seeds.unionByName(_short_windows(items.where(n < LEAST_WORDS), "item_id", "ih", masks, True).withColumn("least", F.lit(1)))
        seeds = seeds.where(F.col("seed").isNotNull())
        seeds = scratch.table(seeds.withColumnRenamed("place", "item_place"), "seeds")
        small = seeds.count() <= broadcast_rows
        hashed = _hashed(docs.where(F.col("doc_id").isNotNull()), "doc_id", "h")
        rows = _windows(hashed, "doc_id", "h")
        if masks:
            rows = rows.unionByName(_short_windows(hashed, "doc_id", "h", masks, False))
        hits = rows.join(F.broadcast(seeds) if small else seeds, ["seed", "mask"])
        hits = hits.groupBy("doc_id", "item_id", (F.col("place") - F.col("item_place")).alias("start")).agg(F.count("*").alias("c"), F.min("least").alias("least")).where(F.col("c") >= F.col("least"))
        by_item = hits.groupBy("doc_id", "item_id").agg(F.collect_set("start").alias("starts"))
        by_item = by_item.join(F.broadcast(items) if small else items, "item_id")
        hits = scratch.table(by_item.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "ih", "starts")).alias("hits")), "hits")
        text = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        # Documents without a hit are left out before their words are hashed again.
        few = hits.count() <= broadcast_rows and small
        found = text.join(F.broadcast(hits) if few else hits, "doc_id")
        found = found.select("doc_id", "hits", _words("text").alias("h"))

        def verified(hit: Column) -> Column:
            tried = F.transform(hit["starts"], lambda s: F.struct(_best(F.col("h"), hit["ih"], s, window).alias("matched"), (-s).alias("back")))
            return F.struct(hit["item_id"].alias("item_id"), F.least(F.lit(window), F.size(hit["ih"])).alias("width"), F.array_max(tried).alias("best"))

        found = found.select("doc_id", F.explode_outer(F.transform("hits", verified)).alias("x")).select("doc_id", "x.*")
        found = found.where(F.col("best.matched") * 100 >= percent * F.col("width"))
        found = found.select("doc_id", "item_id", F.col("best.matched").alias("matched"), (-F.col("best.back")).alias("position"))
        return scratch.keep(found.groupBy("doc_id", "item_id").agg(F.max(F.struct("matched", "position")).alias("x")).select("doc_id", "item_id", "x.*"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that no item contaminates; rows with a null ``doc_id`` stay."""
    bad = contaminated(docs, benchmark, **options).select("doc_id").distinct()
    return docs.join(F.broadcast(bad) if bad.count() <= BROADCAST_ROWS else bad, "doc_id", "left_anti")

"""Mixing sources to target weights by min-cost flow.

A document may belong to several sources.  Documents are summed up by
membership pattern; token capacity flows from each pattern to the quotas of its
sources, and a further pass over the same documents costs more than the one
before (convex costs 0, 1, 2, ...), so that repetition is spread as evenly as
the quotas allow.  What a pattern gives is then taken as whole passes over all
of its documents and one pass over those whose seeded hash lies below a
threshold; thresholds are found by refining histograms of the hash, ten bits at
a time, whose size depends on the number of patterns only.  The document at the
threshold is larger than what is left of the quota; it is passed over, and the
search goes on behind it among documents of at most half of what is left, so
that every search halves the rest.  At last the largest document that fits is
taken, and no further one fits.

Targets: sources in code point order (null last) weigh ``weights``, repeating,
and share all tokens; a target stops at ``max_repeat`` times the source's size
and the excess is shared anew by weight, until none is above.

Defined results: null and empty texts have size 0 and nothing is taken of
them.  A null source is a source of its own.  Rows with the same ``doc_id``
(also null) are chosen together.  An empty table has no sources and gives no
rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textvec
from .scratch import Scratch

WEIGHTS, MAX_REPEAT, SEED = (5, 2, 1), 3, 17
_STEP, _BITS = 10, 60
#: The flow is solved on the driver, and its plan broadcast; more patterns are refused.
MAX_PATTERNS = 20_000
#: A list of at most so many documents taken behind a threshold is broadcast.
BROADCAST_ROWS = 100_000


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in textvec.chunks(batch["text"]):
            n = textvec.Texts(batch["text"].slice(a, b - a)).n_words
            yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), batch["source"].slice(a, b - a), pa.array(n)], ["doc_id", "source", "size"])


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size`` in words for every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "text")
    return rows.mapInArrow(textvec.tidy(_sized), "doc_id bigint, source string, size bigint")


def targets(size: dict[str | None, int], weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> dict[str | None, float]:
    """The target of every source."""
    names = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in size)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full, open_ = float(sum(size.values())), {}, list(names)
    while open_:
        left, shares = total - sum(full.values()), sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / shares > max_repeat * size[s]]
        if not above:
            return {s: full.get(s, left * weight[s] / shares) for s in names}
        for s in above:
            full[s] = float(max_repeat * size[s])
            open_.remove(s)
    return {s: full[s] for s in names}


class _Network:
    """Maximal flow by blocking flows (shortest paths first); capacities may be raised between calls."""

    def __init__(self, n: int):
        self.to: list[int] = []
        self.cap: list[int] = []
        self.out: list[list[int]] = [[] for _ in range(n)]

    def arc(self, a: int, b: int, capacity: int) -> int:
        """A new arc; its flow is the capacity of the arc behind it."""
        for u, v, c in ((a, b, capacity), (b, a, 0)):
            self.out[u].append(len(self.to))
            self.to.append(v)
            self.cap.append(c)
        return len(self.to) - 2

    def _levels(self, source: int, sink: int) -> list[int] | None:
        level = [-1] * len(self.out)
        level[source], front = 0, [source]
        while front and level[sink] < 0:
            after = []
            for u in front:
                for e in self.out[u]:
                    v = self.to[e]
                    if self.cap[e] and level[v] < 0:
                        level[v] = level[u] + 1
                        after.append(v)
            front = after
        return level if level[sink] >= 0 else None

    def fill(self, source: int, sink: int) -> None:
        """Push flow until no path is left."""
        to, cap, out = self.to, self.cap, self.out
        while (level := self._levels(source, sink)) is not None:
            tried, path = [0] * len(out), []
            at = source
            while True:
                if at == sink:
                    least = min(cap[e] for e in path)
                    for e in path:
                        cap[e] -= least
                        cap[e ^ 1] += least
                    # Go back to the first arc that is now full.
                    back = next(i for i, e in enumerate(path) if not cap[e])
                    at = to[path[back] ^ 1]
                    del path[back:]
                arcs, i = out[at], tried[at]
                while i < len(arcs) and not (cap[arcs[i]] and level[to[arcs[i]]] == level[at] + 1):
                    i += 1
                tried[at] = i
                if i < len(arcs):
                    path.append(arcs[i])
                    at = to[arcs[i]]
                elif path:
                    at = to[path.pop() ^ 1]
                    tried[at] += 1
                else:
                    break


def route(capacity: dict[tuple, int], quota: dict[str | None, float], max_repeat: int = MAX_REPEAT) -> dict[tuple, int]:
    """Tokens to take of each membership pattern (a tuple of sources), by a cheapest maximal flow.

    Only arcs out of the source cost something: 0 for the first pass over a
    pattern's documents, 1 for the second, and so on.  An augmenting path costs
    what its first arc does, so the cheapest maximal flow is a maximal one of
    the first passes, raised to a maximal one of two passes, and so on.
    """
    patterns, sources = list(capacity), list(quota)
    place = {s: 1 + len(patterns) + i for i, s in enumerate(sources)}
    sink = 1 + len(patterns) + len(sources)
    net = _Network(sink + 1)
    first = [net.arc(0, 1 + i, 0) for i in range(len(patterns))]
    for i, p in enumerate(patterns):
        for s in p:
            net.arc(1 + i, place[s], max_repeat * capacity[p])
    for s in sources:
        net.arc(place[s], sink, round(quota[s]))
    for _ in range(max_repeat):
        for i, p in enumerate(patterns):
            net.cap[first[i]] += capacity[p]
        net.fill(0, sink)
    return {p: net.cap[first[i] + 1] for i, p in enumerate(patterns)}


@dataclass
class Rule:
    """Of a pattern: whole passes, the hash below which one more pass is taken, and what is then left of the quota."""

    passes: int
    below: int
    rest: int


def _hash(doc_id: Column, seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 64 - _BITS)


def _rules(rows: DataFrame, capacity: dict[tuple, int], taken: dict[tuple, int], seed: int) -> dict[tuple, Rule]:
    """Thresholds for ``rows (key, doc_id, size)``; ``key`` is the pattern's number."""
    spark, patterns = rows.sparkSession, list(capacity)
    passes, rest, rules = {}, {}, {}
    for i, p in enumerate(patterns):
        passes[i], rest[i] = divmod(taken[p], capacity[p]) if capacity[p] else (0, 0)
    prefix = {i: 0 for i in rest if rest[i]}
    below, bits = dict.fromkeys(range(len(patterns)), 0), 0
    while prefix and bits < _BITS:
        bits += _STEP
        state = F.broadcast(spark.createDataFrame(list(prefix.items()), "key int, prefix long"))
        u = _hash(F.col("doc_id"), seed)
        hits = rows.join(state, "key").where(F.shiftright(u, _BITS - bits + _STEP) == F.col("prefix"))
        found = hits.groupBy("key", F.shiftright(u, _BITS - bits).alias("b")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        by: dict[int, list] = {}
        for r in found:
            by.setdefault(r["key"], []).append((r["b"], r["size"], r["n"]))
        for i in list(prefix):
            for b, size, n in sorted(by.get(i, [])):
                if size > rest[i]:
                    below[i] = b << (_BITS - bits)
                    if n == 1 or bits == _BITS:
                        del prefix[i]
                    else:
                        prefix[i] = b
                    break
                rest[i] -= size
                below[i] = (b + 1) << (_BITS - bits)
            else:
                del prefix[i]
    for i, p in enumerate(patterns):
        rules[p] = Rule(passes[i], below[i], rest[i])
    return rules


def _filled(rows: DataFrame, rules: Sequence[Rule], seed: int, scratch: Scratch) -> DataFrame | None:
    """``key, doc_id`` of the documents behind the thresholds that fill what is left of the quotas of patterns ``0, 1, ...``.

    A pattern takes fewer of them than the document at its threshold has words.
    """
    spark = rows.sparkSession
    rest = {i: r.rest for i, r in enumerate(rules) if r.rest}
    if not rest:
        return None
    state = F.broadcast(spark.createDataFrame([(i, rules[i].below) for i in rest], "key int, below long"))
    behind = rows.withColumn("u", _hash(F.col("doc_id"), seed)).join(state, "key").where(F.col("u") >= F.col("below"))
    units = scratch.table(behind.groupBy("key", "doc_id", "u").agg(F.sum("size").alias("size")), "units")
    # Of every search: where it begins, the largest size it takes, and the bits and prefix of the histogram.
    start, limit = {i: rules[i].below for i in rest}, {i: n // 2 for i, n in rest.items()}
    place, taken, done = dict.fromkeys(rest, (0, 0)), [], {}
    while place:
        state = F.broadcast(spark.createDataFrame([(i, start[i], limit[i], _BITS - bits, prefix) for i, (bits, prefix) in place.items()], "key int, start long, most long, shift int, prefix long"))
        hits = units.join(state, "key").where((F.col("u") >= F.col("start")) & (F.col("size") <= F.col("most")) & (F.expr("shiftright(u, shift)") == F.col("prefix")))
        found = hits.groupBy("key", F.expr(f"shiftright(u, shift - {_STEP})").alias("b")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        by: dict[int, list] = {}
        for r in found:
            by.setdefault(r["key"], []).append((r["b"], r["size"], r["n"]))
        for i in list(place):
            bits = place[i][0] + _STEP
            for b, size, n in sorted(by.get(i, [])):
                if size <= rest[i]:
                    rest[i] -= size
                    continue
                if n > 1 and bits < _BITS:
                    place[i] = bits, b
                    break
                # The search stops at a document that is larger than the rest: the next one begins there.
                stop = max(start[i], b << (_BITS - bits))
                taken.append((i, start[i], stop, limit[i]))
                start[i], limit[i], place[i] = stop, rest[i] // 2, (0, 0)
                break
            else:
                # All documents of at most the limit are taken; of larger ones, no two fit.
                taken.append((i, start[i], 1 << _BITS, limit[i]))
                done[i] = (start[i], limit[i], rest[i])
                del place[i]
    last = F.broadcast(spark.createDataFrame([(i, *x) for i, x in done.items()], "key int, start long, most long, rest long"))
    fits = units.join(last, "key").where((F.col("u") >= F.col("start")) & (F.col("size") > F.col("most")) & (F.col("size") <= F.col("rest")))
    largest = fits.groupBy("key").agg(F.max(F.struct("size", "u", "doc_id")).alias("x")).select("key", "x.doc_id")
    spans = F.broadcast(spark.createDataFrame(taken, "key int, start long, stop long, most long"))
    inside = units.join(spans, "key").where((F.col("u") >= F.col("start")) & (F.col("u") < F.col("stop")) & (F.col("size") <= F.col("most")))
    return scratch.table(inside.select("key", "doc_id").unionByName(largest), "filled")


def _membership(members: str | None) -> Column:
    """A row's membership pattern as text."""
    pattern = F.array(F.col("source").cast("string")) if members is None else F.coalesce(F.array_sort(F.array_distinct(members)), F.array(F.lit(None).cast("string")))
    return F.to_json(F.struct(pattern.alias("s")), {"ignoreNullFields": "false"})


def _plan(sized: DataFrame, weights: Sequence[int], max_repeat: int, seed: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """A row for each pattern of ``sized (doc_id, source, size)``, where ``source`` is the pattern's text: sizes, target and rule.

    Also a row ``_pattern, _id`` for each document that is taken once more behind its pattern's threshold.
    """
    spark = sized.sparkSession
    found = sized.groupBy("source").agg(F.sum("size").alias("size")).withColumn("s", F.from_json("source", "s array<string>")["s"]).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns; group sources first")
    capacity = {tuple(r["s"]): r["size"] for r in sorted(found, key=lambda r: r["source"])}
    text = {tuple(r["s"]): r["source"] for r in found}
    size: dict[str | None, int] = {}
    for p, n in capacity.items():
        for s in p:
            size[s] = size.get(s, 0) + n
    goal = targets(size, weights, max_repeat)
    key = spark.createDataFrame([(text[p], i) for i, p in enumerate(capacity)], "source string, key int")
    keyed = sized.join(F.broadcast(key), "source").where("size > 0").select("key", "doc_id", "size")
    rules = _rules(keyed, capacity, route(capacity, goal, max_repeat), seed)
    rows = [(text[p], p[0], size[p[0]], goal[p[0]], rules[p].passes, rules[p].below) for p in capacity]
    plan = spark.createDataFrame(rows, "_pattern string, _first string, source_size long, target double, _passes int, _below long")
    filled = _filled(keyed, list(rules.values()), seed, scratch)
    if filled is None:
        return F.broadcast(plan), spark.createDataFrame([], "_pattern string, _id long")
    more = filled.join(F.broadcast(key), "key").select(F.col("source").alias("_pattern"), F.col("doc_id").alias("_id"))
    return F.broadcast(plan), F.broadcast(scratch.keep(more)) if filled.count() <= BROADCAST_ROWS else scratch.keep(more)


def _planned(rows: DataFrame, plan: DataFrame, more: DataFrame, seed: int) -> DataFrame:
    """``rows`` of ``_pattern`` and ``doc_id`` with their part of the plan, and ``_t``, how many times each is taken."""
    out = rows.join(plan, "_pattern")
    more = more.withColumnRenamed("_pattern", "_p").withColumn("_more", F.lit(True))
    out = out.join(more, (out["_pattern"] == more["_p"]) & out["doc_id"].cast("bigint").eqNullSafe(more["_id"]), "left")
    again = (_hash(F.col("doc_id"), seed) < F.col("_below")) | F.coalesce("_more", F.lit(False))
    return out.withColumn("_t", F.col("_passes") + again.cast("bigint"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = SEED, members: str | None = None) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row of ``docs``.

    ``members`` may name a column of ``docs`` with an array of sources; without
    it each document belongs to its ``source`` alone (``source``,
    ``source_size`` and ``target`` are those of the first source of the
    pattern).  The driver holds a row a pattern and source, and histograms of
    1,024 places a pattern.
    """
    with Scratch(docs.sparkSession) as scratch:
        sized = scratch.table(sizes(docs.select("doc_id", _membership(members).alias("source"), "text")), "sizes")
        plan, more = _plan(sized, weights, max_repeat, seed, scratch)
        out = _planned(sized.withColumnRenamed("source", "_pattern"), plan, more, seed).withColumn("taken", F.col("size") * F.col("_t"))
        return scratch.keep(out.select("doc_id", F.col("_first").alias("source"), "size", "source_size", "target", "taken"))


def materialise(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = SEED, members: str | None = None) -> DataFrame:
    """The mix itself: every row of ``docs`` as many times as it is taken; rows without a word are left out.

    A row's part follows from its pattern, its hash and the list of documents
    behind the thresholds, so texts aren't shuffled unless that list is longer
    than ``BROADCAST_ROWS``.
    """
    with Scratch(docs.sparkSession) as scratch:
        sized = scratch.table(sizes(docs.select("doc_id", _membership(members).alias("source"), "text")), "sizes")
        plan, more = _plan(sized, weights, max_repeat, seed, scratch)
        plan = plan.select("_pattern", "_passes", "_below")
    # Rows are carried as one value, so that no name of theirs meets a name of the plan.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    worded = docs.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(row, "doc_id", _membership(members).alias("_pattern"))
    out = _planned(worded, plan, more, seed).where("_t > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("_t").cast("int"))).alias("copy")).select("row.*")

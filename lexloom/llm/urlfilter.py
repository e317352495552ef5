"""URL filter: a trie over reversed host labels and path segments.

A rule is a host followed by a path that begins with ``/``.  It fits a URL
whose host is the rule's or a subdomain of it and whose path starts with the
rule's.  Among the rules that fit, the longest string wins; at equal length a
block entry goes before an allow entry.  Where none fits, the default verdict
holds.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end.

Defined results: a null URL, or one without ``://``, has an empty host and
path, no rule and the default verdict.  Repeated rows each get their row's
result; a null ``page_id`` is carried along.  Without rules all rows get the
default.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LOWER = {c: c + 32 for c in range(65, 91)}


class Node:
    """A place in the trie: children by host label, by whole path segment, and rules by the segment's beginning."""

    __slots__ = ("labels", "segments", "tails")

    def __init__(self):
        self.labels: dict[str, Node] = {}
        self.segments: dict[str, Node] = {}
        #: Begun segments by their length: a rule fits if the next segment begins so.
        self.tails: dict[int, dict[str, tuple[str, str]]] = {}


class UrlTrie:
    """Allow and block entries, looked up by walking a URL's labels and segments once."""

    def __init__(self, rules: list[tuple[str, str]], default: str = "allow"):
        self.root, self.default = Node(), default
        for rule, verdict in rules:
            host, slash, path = rule.partition("/")
            if not slash or not host or verdict not in ("allow", "block"):
                raise ValueError(f"not a rule: {rule!r} {verdict!r}")
            node = self.root
            for label in reversed(host.translate(_LOWER).split(".")):
                node = node.labels.setdefault(label, Node())
            *whole, last = path.split("/")
            for segment in whole:
                node = node.segments.setdefault(segment, Node())
            old = node.tails.setdefault(len(last), {}).get(last)
            if old is None or verdict == "block":
                node.tails[len(last)][last] = (rule, verdict)

    def match(self, host: str, path: str) -> tuple[str | None, str]:
        """The winning rule, if any, and the verdict."""
        best: tuple[int, bool, str | None, str] = (-1, False, None, self.default)
        if not path.startswith("/"):
            return best[2:]
        segments = path[1:].split("/")
        node: Node | None = self.root
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            at: Node | None = node
            for segment in segments:
                for size, tails in at.tails.items():
                    if (hit := tails.get(segment[:size])) is not None:
                        best = max(best, (len(hit[0]), hit[1] == "block", *hit), key=lambda x: x[:2])
                at = at.segments.get(segment)
                if at is None:
                    break
        return best[2:]


def split(url: str | None) -> tuple[str, str]:
    """Host and path of a URL."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    rest = rest[: min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def _judged(trie):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url in batch["url"].to_pylist():
                host, path = split(url)
                rows.append((host, path, *trie.value.match(host, path)))
            cols = [pa.array([r[i] for r in rows], pa.string()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch["page_id"], *cols], ["page_id", "host", "path", "rule", "verdict"])

    return run


def judge(pages: DataFrame, rules: list[tuple[str, str]], default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages (page_id, url)``.

    The trie is broadcast; its size is that of the rule list, which the caller
    holds in memory, and does not depend on the pages.
    """
    shared = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules, default))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    return rows.mapInArrow(_judged(shared), "page_id bigint, host string, path string, rule string, verdict string")

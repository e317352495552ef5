"""Token ids of whole texts in a compressed binary file format.

Texts are encoded by the ``tokenizers`` library, an end id is put behind each
document, and the ids are written in ascending order of ``doc_id`` as segments
of about ``SEGMENT`` ids.  A segment holds whole documents: their ids and
lengths, and their token ids in the blocks of :mod:`rangecoder`.  Files are
written by Spark's text sink (a segment's bytes are the line, ``END`` is the
separator), so that its commit protocol holds where executors are lost.

Encoding by pieces.  In a text whose blanks and line feeds all stand alone
between other characters, a byte-level pre-tokenizer always cuts before a
blank, around a line feed, and between letters, digits and other characters
(here only those whose kind is certain; nothing is cut off at an apostrophe).
Such a text's ids are thus those of its pieces.  These are encoded by the
library once and remembered; other texts are given to the library whole.  A
tokenizer that normalises or adds blanks gets whole texts only.

Defined results: a null or empty text has the end id alone.  Null ``doc_id``
come first; rows with equal ``doc_id`` are ordered by text.  An empty table
gives no segments and no rows.  Other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import rangecoder, textvec
from .textvec import U64

TOKENIZER, END_ID = "byte_bpe_50k.json", 2
SEGMENT = rangecoder.BLOCK * rangecoder.WRITTEN
#: Segments a file; it bounds what a reader holds in memory at once.
FILE_SEGMENTS = 8
MAGIC, END = b"LXSEGM01", b"\x00LXEND\x00\n"
#: Pieces in a worker's memo, and their ids (about 22 MB at the usual three ids a piece, 30 MB at most); beyond that a new one
#: is begun, and the one before is kept for look-ups.
MEMO, MEMO_IDS = 480_000, 1 << 22
_HEAD = struct.Struct("<8sIIIIIII")

_odd = np.zeros(256, bool)
_odd[[*range(9), *range(11, 32), 127]] = True
_ODD = _odd.tobytes()
#: Of a word of eight bytes, the first so many.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_LENGTH = U64(0x9E3779B97F4A7C15)


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _visible() -> np.ndarray:
    """The code point by which byte-level vocabularies write every byte: its own where that can be seen, else the next one from U+0100 on."""
    out = np.arange(256, dtype="<u2")
    hidden = np.array([*range(0x21), *range(0x7F, 0xA1), 0xAD])
    out[hidden] = 256 + np.arange(len(hidden))
    return out


_VISIBLE = _visible()


class Memo:
    """Ids of pieces by the pieces' hashes, in an open table that is searched for many pieces at once."""

    def __init__(self):
        self.n, self.used = 0, 0
        self.ids, self.cuts = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int32)
        self.keys, self.at = np.zeros(1 << 15, np.uint64), np.zeros(1 << 15, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of every piece, -1 for unknown ones; no key is 0."""
        mask = len(self.keys) - 1
        slot = (keys & U64(mask)).view(np.int64)
        held = self.keys.take(slot)
        hit = held == keys
        out = np.where(hit, self.at.take(slot), -1)
        left = np.flatnonzero(~hit & (held != 0))
        slot, keys = slot.take(left), keys.take(left)
        while len(left):
            slot = (slot + 1) & mask
            held = self.keys.take(slot)
            hit = held == keys
            out[left[hit]] = self.at.take(slot[hit])
            on = np.flatnonzero(~hit & (held != 0))
            left, slot, keys = left.take(on), slot.take(on), keys.take(on)
        return out

    def _enter(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        mask, left = len(self.keys) - 1, np.arange(len(keys))
        slot = (keys & U64(mask)).view(np.int64)
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            self.keys[slot[free]] = keys[free]
            # Of several keys for one place the last one has it; the others go on.
            mine = self.keys[slot[left]] == keys[left]
            self.at[slot[left[mine]]] = numbers[left[mine]]
            left = left[~mine]
            slot[left] = (slot[left] + 1) & mask

    def held(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces ``at`` behind each other, and how many each has."""
        begin = self.cuts[at].astype(np.int64)
        size = self.cuts[at + 1] - begin
        stop = np.cumsum(size)
        place = np.repeat(begin - stop + size, size)
        place += np.arange(len(place))
        return self.ids[place], size

    def learn(self, keys: np.ndarray, got: list[list[int]]) -> None:
        """Enter new pieces; they are numbered from ``n`` on."""
        self.enter(keys, np.fromiter(chain.from_iterable(got), np.uint32), np.fromiter(map(len, got), np.int64, len(got)))

    def enter(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """As :meth:`learn`, of ids behind each other."""
        end, n = self.used + len(ids), self.n + len(keys)
        while end > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while n + 1 > len(self.cuts):
            self.cuts = np.concatenate((self.cuts, np.zeros_like(self.cuts)))
        self.ids[self.used : end] = ids
        self.cuts[self.n + 1 : n + 1] = self.used + np.cumsum(sizes)
        if 2 * n > len(self.keys):
            full = np.flatnonzero(self.keys)
            old, at = self.keys[full], self.at[full]
            size = 1 << int(2 * n - 1).bit_length()
            self.keys, self.at = np.zeros(size, np.uint64), np.zeros(size, np.int32)
            self._enter(old, at)
        self._enter(keys, np.arange(self.n, n))
        self.n, self.used = n, end


def _by_byte(raw: np.ndarray, table: bytes) -> np.ndarray:
    """A table's entries for all bytes, in an array of its own."""
    return np.frombuffer(bytearray(raw.tobytes().translate(table)), np.uint8)


def _keys(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of pieces: of up to 16 bytes by their two words, of longer ones by those of :mod:`textvec`; none is 0."""
    size = ends - starts
    words = np.zeros((len(raw) >> 3) + 3, "<u8")
    words.view(np.uint8)[: len(raw)] = raw
    at, low = starts >> 3, ((starts & 7) << 3).astype(np.uint64)
    high = U64(64) - low  # a shift by 64 gives 0
    one, two, three = words.take(at), words.take(at + 1), words.take(at + 2)
    one >>= low
    one |= two << high
    one &= _FIRST.take(np.minimum(size, 8))
    two >>= low
    two |= three << high
    two &= _FIRST.take(np.clip(size - 8, 0, 8))
    two += size.astype(np.uint64) * _LENGTH
    one ^= textvec.mix(two)
    keys = textvec.mix(one)
    if (long := np.flatnonzero(size > 16)).size:
        stop = np.cumsum(size[long])
        begin = stop - size[long]
        place = np.repeat(starts[long] - begin, size[long])
        place += np.arange(len(place))
        keys[long] = textvec.hashes(raw[place], begin, stop)
    keys[keys == 0] = 1
    return keys


def _kinds(added: list[str]) -> np.ndarray:
    """Kind of every byte: 1 letters, 2 digits, 3 other ASCII characters, 0 what is never cut off.

    An apostrophe begins contractions.  Of an added token's text no part is cut
    off, so characters at which it would be are of kind 0.
    """
    out = np.zeros(256, np.uint8)
    out[33:127] = 3
    out[48:58] = 2
    out[65:91] = out[97:123] = 1
    out[ord("'")] = 0
    for text in added:
        raw = text.encode()
        for a, b in zip(raw[:-1], raw[1:], strict=True):
            if out[a] and out[b] and out[a] != out[b]:
                out[a if out[a] > out[b] else b] = 0
    return out


class Encoder:
    """Encodes runs of texts; pieces are remembered from run to run."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        parts = json.loads(spec)
        pre, added = parts.get("pre_tokenizer") or {}, parts.get("added_tokens", [])
        self.by_piece = parts.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space", True) and pre.get("use_regex", True)
        self.by_piece = self.by_piece and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"]) for t in added)
        self.kinds = _kinds([t["content"] for t in added]).tobytes()
        self.tokenize = self.library.model.tokenize
        self.memo, self.older = Memo(), Memo()

    def forget(self) -> None:
        """Begin a new memo; pieces of the present one are entered there as they are met again."""
        self.memo, self.older = Memo(), self.memo

    def _learn(self, keys: np.ndarray, raw: np.ndarray, kind: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Enter distinct pieces that the memo lacks, and return their numbers; a pure one is what the pre-tokenizer gives the model at a time."""
        at, memo, numbers = self.older.find(keys), self.memo, np.empty(len(keys), np.int64)
        again, new = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        numbers[again] = memo.n + np.arange(len(again))
        memo.enter(keys[again], *self.older.held(at[again]))
        if not len(new):
            return numbers
        size = ends[new] - starts[new]
        stop = np.cumsum(size)
        begin = stop - size
        place = np.repeat(starts[new] - begin, size)
        place += np.arange(len(place))
        own = raw[place]
        unsure = (kind[place] == 0) & (own != 10) & (own != 32)
        pure = ~np.logical_or.reduceat(unsure, begin)
        seen = _VISIBLE[own].tobytes().decode("utf-16-le")
        flat, sizes, tokenize = [], [], self.tokenize
        for a, b in zip(begin[pure].tolist(), stop[pure].tolist(), strict=True):
            ids = [t.id for t in tokenize(seen[a:b])]
            flat += ids
            sizes.append(len(ids))
        others = np.flatnonzero(~pure)
        for ids in self.whole([own[begin[i] : stop[i]].tobytes().decode("utf-8", "replace") for i in others]):
            flat += ids
            sizes.append(len(ids))
        new = new[np.concatenate((np.flatnonzero(pure), others))]
        numbers[new] = memo.n + np.arange(len(new))
        memo.enter(keys[new], np.array(flat, np.uint32), np.array(sizes, np.int64))
        return numbers

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a run of texts behind each other, and the cuts between texts."""
        raw, offsets = textvec.raw(column)
        plain = self._plain(raw, offsets) if self.by_piece else np.zeros(len(column), bool)
        kind = self._kind(raw)
        starts = self._pieces(raw, kind, offsets, plain)
        ends = np.append(starts[1:], len(raw))
        if self.memo.n > MEMO or self.memo.used > MEMO_IDS:
            self.forget()
        memo, piece_cuts = self.memo, np.searchsorted(starts, offsets)
        own = np.flatnonzero(~plain & (offsets[1:] > offsets[:-1]))
        # A text that goes to the library whole takes the first piece's place until its ids are known.
        whole = piece_cuts[own]
        ends[whole] = starts[whole]
        keys = _keys(raw, starts, ends)
        at = memo.find(keys)
        at[whole] = 0
        if (missing := np.flatnonzero(at < 0)).size:
            new, first, which = np.unique(keys[missing], return_index=True, return_inverse=True)
            first = missing[first]
            at[missing] = self._learn(new, raw, kind, starts[first], ends[first])[which]
        begin = memo.cuts[at].astype(np.int64)
        size = memo.cuts[at + 1] - begin
        held = self.whole([bytes(raw[offsets[i] : offsets[i + 1]]).decode("utf-8", "replace") for i in own])
        size[whole] = [len(x) for x in held]
        stop = np.concatenate(([0], np.cumsum(size)))
        place = np.repeat(begin - stop[:-1], size)
        place += np.arange(stop[-1])
        flat = memo.ids.take(place, mode="clip")
        for i, x in zip(whole, held, strict=True):
            flat[stop[i] : stop[i + 1]] = x
        return flat, stop[piece_cuts]

    def _kind(self, raw: np.ndarray) -> np.ndarray:
        """Kind of every byte, with letters of two bytes."""
        kind = _by_byte(raw, self.kinds)
        # U+00C0 to U+00FF are letters but for the signs of multiplication and division.
        lead = np.flatnonzero(raw[:-1] == 0xC3)
        lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = 1
        return kind

    @staticmethod
    def _pieces(raw: np.ndarray, kind: np.ndarray, offsets: np.ndarray, plain: np.ndarray) -> np.ndarray:
        """Where pieces begin; a text that isn't plain is one piece."""
        feed, cut = raw == 10, np.zeros(len(raw) + 1, bool)
        cut[1:-1] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        cut[1:] |= feed
        cut[:-1] |= feed | (raw == 32)
        for i in np.flatnonzero(~plain):
            cut[offsets[i] : offsets[i + 1]] = False
        cut[offsets] = True
        return np.flatnonzero(cut[: len(raw)])

    @staticmethod
    def _plain(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts with characters in which every white space is a blank or line feed alone between other characters."""
        bad, blank = _by_byte(raw, _ODD).view(bool), (raw == 32) | (raw == 10)
        bad[1:] |= blank[1:] & blank[:-1]
        # First bytes of U+0085, U+00A0, U+1680, U+180E, U+2000-205F and U+3000; some harmless characters share them.
        high = np.flatnonzero(raw >= 0xC2)
        lead, follow = raw[high], raw[np.minimum(high + 1, len(raw) - 1)]
        bad[high] |= ((lead >= 0xE1) & (lead <= 0xE3)) | ((lead == 0xC2) & ((follow == 0x85) | (follow == 0xA0)))
        ok = offsets[1:] > offsets[:-1]
        ok[np.searchsorted(offsets, np.flatnonzero(bad), side="right") - 1] = False
        full = np.flatnonzero(ok)
        ok[full] &= ~blank[offsets[full]] & ~blank[offsets[full + 1] - 1]
        return ok


_ENCODERS: dict[int, Encoder] = {}


def encoder(spec: str) -> Encoder:
    """A worker's encoder for a vocabulary; it lives on from task to task, and its memo until files are read."""
    key = zlib.crc32(spec.encode())
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


def pack(part: int, number: int, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of a segment."""
    known = np.array([i is not None for i in doc_ids], np.uint8)
    values = np.array([i or 0 for i in doc_ids], "<i8")
    listed = zlib.compress(known.tobytes() + np.diff(values, prepend=np.int64(0)).astype("<i8").tobytes() + lengths.astype("<i8").tobytes(), 6)
    body = rangecoder.encode(ids)
    return _HEAD.pack(MAGIC, part, number, len(doc_ids), len(ids) & 0xFFFFFFFF, len(listed), len(body), zlib.crc32(listed)) + listed + body


def unpack(data: bytes | memoryview) -> Iterator[tuple[int, int, list[int | None], np.ndarray, np.ndarray]]:
    """Partition, number, document ids, lengths and token ids of every segment of a file.

    Segments are decoded together as far as a reader's blocks go, from the file's bytes where they stand.
    """
    data, at, held, blocks = memoryview(data), 0, [], 0
    while at < len(data):
        if data[at : at + 8] != MAGIC or len(data) - at < _HEAD.size:
            raise rangecoder.Damaged("no segment begins here")
        _, part, number, n, _, listed, body, crc = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        index = data[at : at + listed]
        if zlib.crc32(index) != crc or data[at + listed + body : at + listed + body + len(END)] != END:
            raise rangecoder.Damaged("segment")
        raw = zlib.decompress(index)
        known = np.frombuffer(raw, np.uint8, n)
        values = np.cumsum(np.frombuffer(raw, "<i8", n, n))
        lengths = np.frombuffer(raw, "<i8", n, 9 * n)
        own = -(-int(lengths.sum()) // rangecoder.BLOCK)
        if held and blocks + own > rangecoder.READ:
            yield from _decoded(held)
            held, blocks = [], 0
        held.append((part, number, [int(v) if k else None for k, v in zip(known, values, strict=True)], lengths, data[at + listed : at + listed + body]))
        blocks += own
        at += listed + body + len(END)
    yield from _decoded(held)


def _decoded(held: list[tuple]) -> Iterator[tuple]:
    ids = rangecoder.decode(*(x[-1] for x in held))
    if len(ids) != sum(int(x[-2].sum()) for x in held):
        raise rangecoder.Damaged("lengths")
    at = 0
    for part, number, doc_ids, lengths, _ in held:
        n = int(lengths.sum())
        yield part, number, doc_ids, lengths, ids[at : at + n]
        at += n


def _segments(spec, end_id: int, segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, part, number = encoder(spec.value), TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def out() -> pa.RecordBatch:
            whole = np.concatenate(ids)
            ids.clear()  # not held twice while they are coded
            made = pack(part, number, doc_ids, np.concatenate(lengths), whole)
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["value"])

        for batch in batches:
            for a, b in textvec.chunks(batch["text"], 1 << 20):
                flat, cuts = make.encode(batch["text"].slice(a, b - a))
                doc_ids += batch["doc_id"].slice(a, b - a).to_pylist()
                lengths.append(np.diff(cuts) + 1)
                ids.append(np.insert(flat, cuts[1:], end_id))
                held += len(ids[-1])
                if held >= segment:
                    yield out()
                    doc_ids, lengths, ids, held = [], [], [], 0
                    number += 1
        if doc_ids:
            yield out()

    return run


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, segment: int = SEGMENT, file_segments: int = FILE_SEGMENTS) -> None:
    """Write the ids of ``docs (doc_id, text)`` in ascending ``doc_id`` order.

    ``tokenizer`` is the place of a vocabulary file that the driver reads; its
    text is broadcast.
    """
    with open(tokenizer or tokenizer_path(), encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    made = rows.mapInArrow(textvec.tidy(_segments(spec, end_id, segment)), "value binary").select(F.col("value").cast("string").alias("value"))
    made.write.option("lineSep", END.decode("latin-1")).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", file_segments).text(path)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # All is written when reading begins; a worker's room is then needed for the blocks.
    for make in _ENCODERS.values():
        make.memo, make.older = Memo(), Memo()
    for batch in batches:
        for content in batch["content"]:
            for part, number, doc_ids, lengths, ids in unpack(memoryview(content.as_buffer())):
                stop = np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(stop, lengths, strict=True)]
                n = len(doc_ids)
                cols = [pa.array([part] * n, pa.int64()), pa.array([number] * n, pa.int64()), pa.array(doc_ids, pa.int64()), pa.array(stop - lengths), pa.array(lengths), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["part", "number", "doc_id", "offset", "n_tokens", "ids_crc32"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """``part, number, doc_id, offset, n_tokens, ids_crc32`` of every document, decoded from the files under ``path``."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(textvec.tidy(_unpacked), "part bigint, number bigint, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint")


def index(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what :func:`read` gives; only one row a segment is ordered globally."""
    sizes = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("size"))
    before = W.orderBy("part", "number").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("part", "number", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    out = rows.join(F.broadcast(starts) if starts.count() <= 100_000 else starts, ["part", "number"])
    return out.select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")

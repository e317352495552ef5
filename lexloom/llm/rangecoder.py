"""Adaptive context-mixing range coder for runs of token ids.

Ids are coded in blocks of at most ``BLOCK`` ids.  Every block starts from a
fresh model, carries a checksum and can be read without any other.  A block
lists its distinct ids; the coder works on their numbers.  Three predictions are
mixed:

* order 0: counts of the numbers so far;
* order 1: the number that last followed the one before;
* order 2: the number that last followed the two before (hashed).

The latter two give the number that they name a weight that follows how often
such a prediction, at its present confidence, was right in this block.  The
scaled counts come first in the coder's range and the two weights behind them
(as one where both name the same number); a number that has several of these
intervals is coded by the widest.  What orders 1 and 2 name is known at once;
counts and weights are brought up to date at the steps of :data:`EPOCHS`, so
that in between a number is found by one look into a table.

The coder's range has 48 bits and gives off 24 at a time; all values are whole
numbers below 2**53 held as doubles, whose quotients round down exactly.

Many blocks are coded side by side in numpy arrays.  The writer knows all ids
beforehand, so it works the predictions of all steps out at once and only walks
the arithmetic step by step; the reader walks both.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

#: Blocks coded side by side, at most: a reader's steps are dearer, so that it takes more.
BLOCK, WRITTEN, READ = 4096, 640, 3072
#: Steps before which counts and weights are brought up to date.
EPOCHS = (0, 16, 48, 112, 240, 432, 704, 1088, 1600, 2304, 3200)
#: Counts are scaled to this total; it is no less than ``BLOCK``, so that every number has a share.
_TOTAL = 1 << 12
_LEVELS, _RATIO, _SLOTS = 8, 24, 1024
#: Lanes whose predictions the writer works out together.
_GROUP = 32
#: The range is held between _LEAST and _WHOLE by giving off words of 24 bits; a total is less than 2**20, so that one a step is enough.
_WORD, _LEAST, _WHOLE = float(1 << 24), float(1 << 24), float(1 << 48)
#: By what the range grows where a word is given off, and where not.
_MORE = np.array([1.0, _WORD])
_HEAD = struct.Struct("<4sIIIIII")
MAGIC = b"LXB3"


class Damaged(ValueError):
    """A block that fails its checks."""


def _place2(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Slot of the two numbers before."""
    return (one * 75 + two) & (_SLOTS - 1)


def _scaled(counts: np.ndarray, distinct: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the order-0 interval of every number begins, and its width (lanes x numbers); every number of a lane has one."""
    size = counts * (_TOTAL - distinct)[:, None].astype(np.int32)
    size //= max(step, 1)
    size += np.arange(counts.shape[1], dtype=np.int32) < distinct[:, None].astype(np.int32)
    return np.cumsum(size, 1, dtype=np.int32) - size, size


def _weights(record: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Weight of a prediction by its confidence (lanes x levels); ``record`` counts wrong and right ones of each level."""
    record = record.reshape(-1, _LEVELS, 2)
    wrong, right, total = record[:, :, 0], record[:, :, 1], total[:, None].astype(np.int64)
    out = np.minimum(total * (right + 1) // (wrong + 3), total * _RATIO)
    out[:, 0] = 0
    return out


def _followers(key: np.ndarray, s: np.ndarray, steps: int, n: int) -> np.ndarray:
    """What the last follower of the same ``key`` (lane and slot) says of all steps (step-major, ``n`` lanes).

    Each is ``confidence << 1 | right``.
    """
    # Sorted by key and step; a key's entries then stand in the order in which they follow each other.
    entry = np.sort(((key << 12) | np.repeat(np.arange(steps, dtype=np.int32), n)).view(np.uint32))
    place = (entry & 0xFFF).astype(np.int64)
    place *= n
    place += entry >> 24
    x = s.take(place)
    entry >>= 12
    hit = np.zeros(len(entry), np.uint8)
    np.logical_and(entry[1:] == entry[:-1], x[1:] == x[:-1], out=hit[1:].view(bool))
    # Confidence: how many followers in a row were equal, the first one counting.
    level, run = hit + np.uint8(1), hit.copy()
    for _ in range(_LEVELS - 3):
        run[1:] &= run[:-1].copy()
        level += run
    level <<= 1
    said = np.zeros(len(entry), np.uint8)
    np.bitwise_or(level[:-1], hit[1:], out=said[1:])
    said[1:] *= entry[1:] == entry[:-1]
    out = np.empty(len(entry), np.uint8)
    out[place] = said
    return out


def _predicted(grid: np.ndarray, lengths: np.ndarray, distinct: np.ndarray, out: tuple[np.ndarray, ...]) -> None:
    """Fills interval start, width and total of every step (step-major) for a group of lanes."""
    steps, n = grid.shape
    width = int(distinct.max(initial=1))
    lane = np.tile(np.arange(n, dtype=np.int32), steps)
    s = grid.reshape(-1).astype(np.int32)
    before = np.zeros((2, steps, n), np.int32)
    before[0, 1:], before[1, 2:] = grid[:-1], grid[:-2]
    one, two = before.reshape(2, -1)
    seen = [_followers((lane << 12) | one, s, steps, n), _followers((lane << 12) | _place2(one, two), s, steps, n)]
    lane = lane.astype(np.int64)
    live = np.arange(steps)[:, None] < lengths
    whole = bool(live.all())
    counts = np.zeros((n, width), np.int32)
    records = [np.zeros((n, 2 * _LEVELS), np.int64) for _ in seen]
    for begin, end in zip(EPOCHS, (*EPOCHS[1:], BLOCK), strict=True):
        end = min(end, steps)
        if begin >= end:
            break
        start, size = _scaled(counts, distinct, begin)
        total0 = start[:, -1] + size[:, -1]
        part, own = slice(begin * n, end * n), lane[begin * n : end * n]
        at = own * width
        at += s[part]
        own = own * (2 * _LEVELS)
        freq = ((start << 16) | size).reshape(-1).take(at)
        cum = freq >> 16
        freq &= 0xFFFF
        total = np.tile(total0, end - begin)
        known = slice(None) if whole else live[begin:end].reshape(-1)
        weights = []
        for said, record in zip(seen, records, strict=True):
            place = own + said[part]
            weights.append(np.repeat(_weights(record, total0).astype(np.int32), 2).take(place))
            record += np.bincount(place[known], minlength=record.size).reshape(record.shape)
        w1, w2 = weights
        right1, right2 = ((said[part] & 1).view(bool) for said in seen)
        for right, both, first in ((right1, right2, True), (right2 & ~right1, None, False)):
            hit = np.flatnonzero(right)
            w = w1.take(hit) + w2.take(hit) * both.take(hit) if first else w2.take(hit)
            better = w > freq.take(hit)
            hit = hit[better]
            freq[hit] = w[better]
            cum[hit] = total.take(hit) if first else total.take(hit) + w1.take(hit)
        total += w1
        total += w2
        for field, values in zip(out, (cum, freq, total), strict=True):
            field[begin:end] = values.reshape(end - begin, n)
        counts += np.bincount(at[known], minlength=n * width).reshape(n, width).astype(np.int32)


def _encode_lanes(seqs: list[np.ndarray], distinct: np.ndarray) -> list[bytes]:
    """Payloads of some blocks; the longest come first."""
    lengths, n = np.array([len(s) for s in seqs]), len(seqs)
    steps = int(lengths.max(initial=0))
    cum, freq, total = np.zeros((steps + 2, n), np.float32), np.ones((steps, n), np.float32), np.ones((steps, n), np.float32)
    for a in range(0, n, _GROUP):
        b = min(n, a + _GROUP)
        grid = np.zeros((steps, b - a), np.int16)  # numbers lie below BLOCK
        for i in range(a, b):
            grid[: lengths[i], i - a] = seqs[i]
        _predicted(grid, lengths[a:b], distinct[a:b], (cum[:steps, a:b], freq[:, a:b], total[:, a:b]))
    # A step gives off one word at most, which takes its interval's place; a word holds a bit of carry above its 24 until the end.
    words, given = cum.view(np.uint32), np.zeros((steps + 2, n), bool)
    low, size = np.zeros(n), np.full(n, _WHOLE)
    for step, m in enumerate(_active(lengths)):
        lo, r = low[:m], size[:m]
        np.floor(np.divide(r, total[step, :m], out=r), out=r)
        lo += cum[step, :m] * r
        r *= freq[step, :m]
        again = np.less(r, _LEAST, out=given[step, :m])
        top = lo * (1 / _LEAST)
        words[step, :m] = top
        np.floor(top, out=top)
        top *= _LEAST
        top *= again
        lo -= top
        more = _MORE.take(again.view(np.uint8))
        lo *= more
        r *= more
    words[steps], words[steps + 1] = np.floor(low * (1 / _LEAST)), low % _LEAST
    given[steps:] = True
    flat = np.concatenate([words[:, a : a + _GROUP].T[given[:, a : a + _GROUP].T] for a in range(0, n, _GROUP)])
    # A lane's first word has no carry, as all lies below the whole range.
    while (at := np.flatnonzero(flat >> 24)).size:
        flat[at] &= 0xFFFFFF
        flat[at - 1] += 1
    cuts = np.concatenate(([0], 3 * np.cumsum(np.count_nonzero(given, 0))))
    flat = flat.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
    return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _active(lengths: np.ndarray) -> np.ndarray:
    """Per step, how many of the lanes (longest first) still have an id."""
    return np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")


class _Orders:
    """What a reader's lanes know of the numbers that follow the contexts of both orders, an order a row; held as ``number << 4 | confidence << 1``."""

    def __init__(self, n: int, width: int):
        lanes = np.arange(n)
        self.base, self.named = np.stack((lanes * width, n * width + lanes * _SLOTS)), _roomy(n * (width + _SLOTS))
        self.levels, self.record = np.arange(2 * n).reshape(2, n) * 2 * _LEVELS, np.zeros(4 * n * _LEVELS, np.int64)
        # What was said at the steps since the last renewal.
        self.begun, self.said = 0, np.zeros((max(np.diff((*EPOCHS, BLOCK))), 2, n), np.uint8)

    def renew(self, total: np.ndarray, end: int) -> None:
        """Bring the records up to date by the steps before ``end``, and the weights by the records."""
        n, each = 2 * len(total), 2 * _LEVELS
        steps = self.said.reshape(-1, n)[: end - self.begun]
        for a in range(0, n, _GROUP):
            b = min(n, a + _GROUP)
            said = steps[:, a:b] + np.arange(b - a) * each
            self.record[a * each : b * each] += np.bincount(said.reshape(-1), minlength=(b - a) * each)
        self.begun = end
        self.weight = np.repeat(_weights(self.record, np.tile(total, 2)).astype(float), 2)

    def predict(self, m: int, context: np.ndarray) -> np.ndarray:
        """The weights of the numbers named."""
        self.slot = context + self.base[:, :m]
        self.held = self.named.take(self.slot)
        self.sure = self.held.astype(np.uint8) & 15
        return self.weight.take(self.levels[:, :m] + self.sure)

    def learn(self, step: int, m: int, s: np.ndarray) -> None:
        """Enter the numbers ``s`` (uint16); an unknown follower's confidence is 0, and 1 after the step."""
        s = s << 4
        right = ((self.held ^ s) < 16).view(np.uint8)
        np.add(self.sure, right, out=self.said[step - self.begun, :, :m])
        after = np.minimum(self.sure, 2 * _LEVELS - 4)
        after *= right
        after += 2
        self.named[self.slot] = s | after


def _roomy(n: int) -> np.ndarray:
    """A table of ``n`` zeros, as part of one that is large enough for large pages."""
    return np.zeros(max(n, 1 << 22), np.uint16)[:n]


def _decode_lanes(payloads: list[memoryview], lengths: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    n, width = len(payloads), int(distinct.max(initial=1))
    room = max(len(p) for p in payloads) // 3 + 4
    parts = np.zeros((n, room, 4), np.uint8)
    for i, p in enumerate(payloads):
        parts[i, : len(p) // 3, :3] = np.frombuffer(p, np.uint8, len(p) // 3 * 3).reshape(-1, 3)
    words, base, last = parts.view("<u4").reshape(-1), np.arange(n) * room, np.arange(1, n + 1) * room - 1
    rel, size, at = words[base] * _WORD + words[base + 1], np.full(n, _WHOLE), base + 2
    grid = np.zeros((int(lengths.max(initial=0)), n), np.int16)
    orders, context = _Orders(n, width), np.zeros((2, n), np.int64)
    row, look, numbers = np.arange(n) * width, np.arange(n) * _TOTAL, np.tile(np.arange(width, dtype=np.uint16), _GROUP)
    # For every unit of the scaled counts, the number that has it; for every number, where its interval begins and its width.
    table, spans = _roomy(n * _TOTAL), np.zeros(n * width, np.int32)
    counts, total0 = np.zeros((n, width), np.int16), np.zeros(n)
    begun = 0
    for step, m in enumerate(_active(lengths)):
        if step in EPOCHS:
            # In small groups, whose arrays stay in the cache; lanes that have ended count on, but are no longer read.
            for a in range(0, n, _GROUP):
                b = min(n, a + _GROUP)
                held = counts[a:b]
                held += np.bincount((grid[begun:step, a:b] + row[: b - a]).reshape(-1), minlength=held.size).reshape(held.shape).astype(np.int16)
                start, wide = _scaled(held, distinct[a:b], step)
                total0[a:b] = start[:, -1] + wide[:, -1]
                spans[a * width : b * width] = ((start << 16) | wide).reshape(-1)
                wide[:, -1] += _TOTAL - total0[a:b].astype(np.int32)
                table[a * _TOTAL : b * _TOTAL] = np.repeat(numbers[: wide.size], wide.reshape(-1))
            orders.renew(total0, step)
            begun = step
        w1, w2 = orders.predict(m, context[:, :m])
        plain, total = total0[:m], total0[:m] + w1
        total += w2
        r = np.floor(size[:m] / total)
        total -= 1
        t = np.minimum(rel[:m] / r, total, out=total).astype(np.int64)
        s = table.take(np.minimum(t, _TOTAL - 1) + look[:m])
        span = spans.take(s + row[:m])
        lo, wide = (span >> 16).astype(float), (span & 0xFFFF).astype(float)
        beyond = (t >= plain).nonzero()[0]
        if len(beyond):
            # The weights' own intervals; where both name the same number, all weight is one.
            n1, n2 = (held.take(beyond) >> 4 for held in orders.held)
            first, second, begin = w1.take(beyond), w2.take(beyond), plain.take(beyond)
            first += second * (n1 == n2)
            end = begin + first
            is1 = t.take(beyond) < end
            s[beyond], lo[beyond], wide[beyond] = np.where(is1, n1, n2), np.where(is1, begin, end), np.where(is1, first, second)
        lo *= r
        wide *= r
        left = rel[:m] - lo
        again = (wide < _LEAST).nonzero()[0]
        place = at.take(again)
        left[again] = left.take(again) * _WORD + words.take(place)
        at[again] = np.minimum(place + 1, last.take(again))
        wide[again] = wide.take(again) * _WORD
        rel[:m], size[:m] = left, wide
        orders.learn(step, m, s)
        grid[step, :m] = s
        context[1, :m] = _place2(s.astype(np.int64), context[0, :m])
        context[0, :m] = s
    return grid


def _parts(n: int, most: int) -> list[tuple[int, int]]:
    """``n`` blocks in equal runs of about ``most``, a little more where that spares a short one."""
    k = max(1, -(-n * 4 // (5 * most)))
    cuts = [n * i // k for i in range(k + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _numbered(block: np.ndarray, mark: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids of a block, ascending, and the number of each id; ``mark`` and ``number`` are tables by id."""
    if not len(mark):
        names, at = np.unique(block, return_inverse=True)
        return names, at.astype(np.int16)
    block = block.astype(np.int64)
    mark[block] = True
    names = np.flatnonzero(mark)
    number[names] = np.arange(len(names))
    mark[names] = False
    return names, number.take(block)


def _crc(ids: np.ndarray, listed: bytes | memoryview, payload: bytes | memoryview) -> int:
    """Checksum of a block: of its ids and of the bytes that stand for them."""
    return zlib.crc32(payload, zlib.crc32(listed, zlib.crc32(ids.tobytes())))


def encode(ids: np.ndarray) -> bytes:
    """All blocks of a run of ids (uint32), one behind the other."""
    ids = np.ascontiguousarray(ids, "<u4")
    blocks = [ids[i : i + BLOCK] for i in range(0, len(ids), BLOCK)]
    top = int(ids.max(initial=0)) + 1
    top = top if top <= 1 << 20 else 0
    mark, number = np.zeros(top, bool), np.zeros(top, np.int16)
    out = []
    for a, b in _parts(len(blocks), WRITTEN):
        if a == b:
            continue
        heads, seqs = [], []
        for x in blocks[a:b]:
            names, seq = _numbered(x, mark, number)
            listed = zlib.compress(np.diff(names, prepend=names[:1]).astype("<u2" if int(names[-1]) < 1 << 16 else "<u4").tobytes(), 1)
            heads.append((x, len(names), int(names[0]), listed))
            seqs.append(seq)
        payloads = _encode_lanes(seqs, np.array([h[1] for h in heads]))
        for (x, d, first, listed), payload in zip(heads, payloads, strict=True):
            out += [_HEAD.pack(MAGIC, len(x), d, first, len(listed), len(payload), _crc(x, listed, payload)), listed, payload]
    return b"".join(out)


def _blocks(data: memoryview) -> Iterator[tuple]:
    """Of every block the ids' number, the distinct ones' number, the first of those and the steps from one to the next, payload, list and checksum; bytes of ``data`` are not copied."""
    at = 0
    while at < len(data):
        if data[at : at + 4] != MAGIC or len(data) - at < _HEAD.size:
            raise Damaged("no block begins here")
        _, n, d, first, listed, payload, crc = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        if at + listed + payload > len(data) or not 0 < d <= n <= BLOCK or payload < 6 or payload % 3:
            raise Damaged("block sizes")
        try:
            raw = zlib.decompress(data[at : at + listed])
        except zlib.error:
            raise Damaged("list of ids") from None
        if len(raw) not in (2 * d, 4 * d):
            raise Damaged("list of ids")
        yield n, d, first, np.frombuffer(raw, "<u2" if len(raw) == 2 * d else "<u4"), data[at + listed : at + listed + payload], data[at : at + listed], crc
        at += listed + payload


def decode(*runs: bytes | memoryview) -> np.ndarray:
    """The ids of :func:`encode`, of several runs behind each other; raises :class:`Damaged` where a check fails."""
    blocks = [block for data in runs for block in _blocks(memoryview(data))]
    out, begin = np.empty(sum(x[0] for x in blocks), "<u4"), 0
    for a, b in _parts(len(blocks), READ):
        part = blocks[a:b]
        if not part:
            continue
        order = sorted(range(len(part)), key=lambda i: -part[i][0])
        lanes = [part[i] for i in order]
        grid = _decode_lanes([x[4] for x in lanes], np.array([x[0] for x in lanes]), np.array([x[1] for x in lanes]))
        cuts = begin + np.cumsum([0, *(x[0] for x in part)])
        begin = cuts[-1]
        by_lane: np.ndarray | None = None
        for lane, (i, (n, _, first, steps, payload, listed, crc)) in enumerate(zip(order, lanes, strict=True)):
            if lane % _GROUP == 0:
                by_lane = grid[:, lane : lane + _GROUP].T.copy()
            names = (first + np.cumsum(steps, dtype=np.int64)).astype("<u4")
            ids = names.take(by_lane[lane % _GROUP, :n], mode="clip")
            if _crc(ids, listed, payload) != crc:
                raise Damaged("checksum")
            out[cuts[i] : cuts[i + 1]] = ids
    return out

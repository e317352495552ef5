import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexloom.llm import rangecoder, tokenbin, warc
from lexloom.llm.scratch import Scratch

HARD = ["a b c", "  lead", "trail ", "two  blanks", "tab\there", "it's we'll 're", "line\n\nbreak", "a\nb c", "<|endoftext|> a", "a <|endoftext|>b c<|endoftext|>", "　wide", "1 2 34,5", "", None, " ", "é à ñ", "\x1c\x1d a", "日本 語", "a\x85b c", "x " * 3000 + "y", "—dash “q” a", "a1b2 (x).y, 3rd", "x|y<|endoftext|>z <<|endoftext|>>", "dogs' 12's été×2÷3"]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300))
def test_coder_round_trip(ids):
    ids = np.array(ids, np.uint32)
    assert (rangecoder.decode(rangecoder.encode(ids)) == ids).all()


def test_coder_blocks():
    rng = np.random.default_rng(0)
    for ids in (np.full(9000, 7), rng.integers(0, 50257, 9000), np.tile(np.arange(50), 400), rng.zipf(1.3, 20000) % 70000):
        ids = ids.astype(np.uint32)
        data = rangecoder.encode(ids)
        assert (rangecoder.decode(data) == ids).all()
    # Order 1 and 2 pay off, and each block can be read alone.
    assert len(rangecoder.encode(np.tile(np.arange(50, dtype=np.uint32), 400))) < 1500
    cut = data.rfind(rangecoder.MAGIC)
    assert (rangecoder.decode(data[cut:]) == ids[len(ids) // rangecoder.BLOCK * rangecoder.BLOCK :]).all()


def _intervals(seq, distinct):
    """The intervals of a block's numbers, worked out one by one."""
    levels, total, out = rangecoder._LEVELS, rangecoder._TOTAL, []
    counts, after = [0] * distinct, [{}, {}]  # by context: number and confidence
    records, begun = [[[0, 0] for _ in range(levels)] for _ in after], []
    for step, x in enumerate(seq):
        if step in rangecoder.EPOCHS:
            for number, said in begun:
                counts[number] += 1
                for record, (level, right) in zip(records, said, strict=True):
                    record[level][right] += 1
            begun = []
            size = [n * (total - distinct) // max(step, 1) + 1 for n in counts]
            plain = sum(size)
            weight = [[min(plain * (r + 1) // (w + 3), plain * rangecoder._RATIO) * (level > 0) for level, (w, r) in enumerate(record)] for record in records]
        one, two = (seq[step - 1] if step else 0), (seq[step - 2] if step > 1 else 0)
        keys = one, (one * 75 + two) % rangecoder._SLOTS
        (n1, c1), (n2, c2) = (known.get(key, (0, 0)) for known, key in zip(after, keys, strict=True))
        w1, w2 = weight[0][c1], weight[1][c2]
        first, second = (w1 + w2, 0) if n1 == n2 else (w1, w2)
        ways = [(size[x], sum(size[:x])), (first * (n1 == x), plain), (second * (n2 == x), plain + first)]
        wide, start = max(ways, key=lambda way: way[0])
        out.append((start, wide, plain + w1 + w2))
        begun.append((x, [(c, n == x and c > 0) for n, c in ((n1, c1), (n2, c2))]))
        for known, key, n, c in ((after[0], keys[0], n1, c1), (after[1], keys[1], n2, c2)):
            known[key] = (x, min(c + 1, levels - 1) if c and n == x else 1)
    return out


def test_numbers_are_coded_by_their_widest_interval():
    """Counts come first in the range and the predictions' weights behind them, as worked out one by one."""
    rng = np.random.default_rng(7)
    runs = [np.tile(np.arange(9), 130)[:1150], rng.zipf(1.4, 1150) % 60, np.where(rng.random(1150) < 0.8, np.arange(1150) % 7, rng.integers(0, 40, 1150))]
    seqs = [np.unique(run, return_inverse=True)[1] for run in runs]
    grid, distinct = np.stack(seqs, 1).astype(np.int16), np.array([s.max() + 1 for s in seqs])
    out = tuple(np.zeros(grid.shape, np.float32) for _ in range(3))
    rangecoder._predicted(grid, np.full(3, 1150), distinct, out)
    ways = set()
    for lane, seq in enumerate(seqs):
        want = _intervals(seq.tolist(), int(distinct[lane]))
        assert [tuple(map(int, x)) for x in zip(*(field[:, lane] for field in out), strict=True)] == want
        ways |= {start >= total / 2 for start, _, total in want}
    assert ways == {False, True}
    for run in runs:
        assert (rangecoder.decode(rangecoder.encode(run.astype(np.uint32))) == run).all()


def test_carries_run_through_words():
    """Carries run on through full words, in each lane by itself."""
    rng = np.random.default_rng(8)
    ids = np.where(rng.random(300_000) < 0.999, 5, rng.integers(0, 50_000, 300_000)).astype(np.uint32)
    for part in (ids, ids[: 5 * rangecoder.BLOCK + 1], ids[:1], ids[:0]):
        assert (rangecoder.decode(rangecoder.encode(part)) == part).all()


def test_reader_looks_few_things_up():
    """Look-ups into tables at each step of a reader, however many blocks it reads side by side."""
    import sys

    ids = (np.random.default_rng(9).zipf(1.2, 3 * rangecoder.BLOCK) % 50_000).astype(np.uint32)
    data, calls = rangecoder.encode(ids), []
    sys.setprofile(lambda frame, event, arg: calls.append(arg.__name__) if event == "c_call" and "rangecoder" in frame.f_code.co_filename else None)
    try:
        back = rangecoder.decode(data)
    finally:
        sys.setprofile(None)
    assert (back == ids).all()
    assert calls.count("take") < 11 * rangecoder.BLOCK


def test_coder_finds_damage():
    data = bytearray(rangecoder.encode(np.arange(100, dtype=np.uint32) * 7 % 31))
    for at in range(0, len(data), 5):
        bad = bytearray(data)
        bad[at] ^= 0x55
        with pytest.raises(rangecoder.Damaged):
            rangecoder.decode(bytes(bad))


def test_pieces_equal_the_library():
    with open(tokenbin.tokenizer_path(), encoding="utf-8") as f:
        make = tokenbin.Encoder(f.read())
    assert make.by_piece
    flat, cuts = make.encode(pa.array(HARD))
    for i, text in enumerate(HARD):
        assert flat[cuts[i] : cuts[i + 1]].tolist() == make.library.encode(text or "", add_special_tokens=False).ids, text
    make.forget()
    again = make.encode(pa.array(HARD))
    assert (again[0] == flat).all() and 0 < make.memo.n == make.older.n


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aZéß1²'.,|<>œ—×÷\u0301sret \n", max_size=30), max_size=5))
def test_random_pieces_equal_the_library(texts):
    with open(tokenbin.tokenizer_path(), encoding="utf-8") as f:
        make = tokenbin.encoder(f.read())
    flat, cuts = make.encode(pa.array(texts, pa.string()))
    assert len(cuts) == len(texts) + 1
    for i, text in enumerate(texts):
        assert flat[cuts[i] : cuts[i + 1]].tolist() == make.library.encode(text, add_special_tokens=False).ids, text


def test_memo_grows_and_finds():
    rng, memo = np.random.default_rng(4), tokenbin.Memo()
    keys = np.unique(rng.integers(1, 2**63, 70_000, dtype=np.uint64) << np.uint64(1))
    for a in range(0, len(keys), 9_000):
        part = keys[a : a + 9_000]
        assert (memo.find(part) == -1).all()
        memo.learn(part, [[int(k) & 0xFFFF] * (1 + int(k >> np.uint64(5)) % 3) for k in part])
    at = memo.find(keys)
    assert (at == np.arange(len(keys))).all() and (memo.ids[memo.cuts[at]] == (keys & np.uint64(0xFFFF))).all()


def test_pieces_of_the_older_memo_are_entered_at_once():
    """New and known pieces of one run, the latter taken over without the library."""
    with open(tokenbin.tokenizer_path(), encoding="utf-8") as f:
        make = tokenbin.Encoder(f.read())
    old = [f"older{i} words{i % 7}é" for i in range(40)]
    make.encode(pa.array(old))
    make.forget()
    asked, tokenize = [], make.tokenize
    make.tokenize = lambda piece: asked.append(piece) or tokenize(piece)
    flat, cuts = make.encode(pa.array([*old, "brandnew 'quote'", *old]))
    for i, text in enumerate([*old, "brandnew 'quote'", *old]):
        assert flat[cuts[i] : cuts[i + 1]].tolist() == make.library.encode(text, add_special_tokens=False).ids
    assert asked == ["brandnew"]
    ids, sizes = make.memo.held(np.arange(make.memo.n))
    assert len(ids) == sizes.sum() == make.memo.used


def test_memos_are_bounded_by_bytes():
    rng, memo = np.random.default_rng(5), tokenbin.Memo()
    for _ in range(0, tokenbin.MEMO, 40_000):
        memo.enter(rng.integers(1, 2**63, 40_000, dtype=np.uint64), np.zeros(110_000, np.uint32), np.r_[np.full(30_000, 3), np.full(10_000, 2)])
    assert memo.n == tokenbin.MEMO and sum(x.nbytes for x in vars(memo).values() if isinstance(x, np.ndarray)) < 25e6
    # Few pieces of many ids do not fill the memory either.
    with open(tokenbin.tokenizer_path(), encoding="utf-8") as f:
        make = tokenbin.Encoder(f.read())
    make.memo.enter(np.array([5], np.uint64), np.zeros(tokenbin.MEMO_IDS + 1, np.uint32), np.array([tokenbin.MEMO_IDS + 1]))
    flat, _ = make.encode(pa.array(["new words"]))
    assert make.memo.n == 2 and flat.tolist() == make.library.encode("new words", add_special_tokens=False).ids


def test_readers_hold_no_memo():
    with open(tokenbin.tokenizer_path(), encoding="utf-8") as f:
        make = tokenbin.encoder(f.read())
    flat, cuts = make.encode(pa.array(["some words", "more of them"]))
    assert make.memo.n
    file = tokenbin.pack(0, 0, [1, 2], np.diff(cuts), flat) + tokenbin.END
    rows = [r for b in tokenbin._unpacked(iter([pa.RecordBatch.from_arrays([pa.array([file], pa.binary())], ["content"])])) for r in b.to_pylist()]
    assert [(r["doc_id"], r["n_tokens"]) for r in rows] == [(1, cuts[1]), (2, cuts[2] - cuts[1])]
    assert make.memo.n == make.older.n == 0
    assert (make.encode(pa.array(["some words", "more of them"]))[0] == flat).all()


def _peak(work, *args):
    import tracemalloc

    tracemalloc.start()
    out = work(*args)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, peak


def test_coder_memory():
    """Peak bytes an id, of a writer's and a reader's usual number of blocks."""
    ids = (np.random.default_rng(6).zipf(1.1, 600 * rangecoder.BLOCK) % 50_000).astype(np.uint32)
    data, writer = _peak(rangecoder.encode, ids)
    back, reader = _peak(rangecoder.decode, data)
    assert (back == ids).all()
    assert writer < 22.5 * len(ids) and reader < 25 * len(ids)


def test_pieces_are_told_apart_by_their_words(monkeypatch):
    """Only the bytes of long pieces are hashed one by one."""
    with open(tokenbin.tokenizer_path(), encoding="utf-8") as f:
        make = tokenbin.Encoder(f.read())
    hashes, given = tokenbin.textvec.hashes, []
    monkeypatch.setattr(tokenbin.textvec, "hashes", lambda data, *cuts: given.append(bytes(data)) or hashes(data, *cuts))
    texts = ["x" * n + " " + "y" * m for n in range(1, 20) for m in range(1, 19)] + ["a b", "ab", "two  blanks in a text that the library gets whole"]
    for column in (texts, texts[::-1]):
        flat, cuts = make.encode(pa.array(column))
        for i, text in enumerate(column):
            assert flat[cuts[i] : cuts[i + 1]].tolist() == make.library.encode(text, add_special_tokens=False).ids, text
    held = b"".join(given)
    assert len(held) < 0.8 * 2 * sum(map(len, texts)) and b"x" * 17 in held and b" " + b"y" * 16 in held


def test_token_files(spark):
    docs = spark.createDataFrame([(i * 3 % 21, t, "x") for i, t in enumerate(HARD)] + [(None, "no id", "x")], "doc_id long, text string, start string").repartition(5)
    make = tokenbin.encoder(open(tokenbin.tokenizer_path(), encoding="utf-8").read())
    with Scratch(spark) as scratch:
        path = scratch.new_path("tokens")
        tokenbin.write(docs, path, segment=2000, file_segments=1)
        got = tokenbin.index(tokenbin.read(spark, path)).orderBy("start").collect()
    rows = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    at = 0
    assert len(got) == len(rows)
    for r, want in zip(got, rows, strict=True):
        ids = [*make.library.encode(want["text"] or "", add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (want["doc_id"], at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)


def test_token_files_of_nothing(spark):
    with Scratch(spark) as scratch:
        path = scratch.new_path("tokens")
        tokenbin.write(spark.createDataFrame([], "doc_id long, text string"), path)
        assert tokenbin.index(tokenbin.read(spark, path)).count() == 0


PAGES = [
    (3, "http://a/x y\r\n", "p" * 200),
    (1, None, "p" * 200),
    (2, "http://b", "p" * 200),
    (4, "http://c", "short"),
    (5, "http://d", "short"),
    (6, "http://e", None),
    (7, "http://f", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" + "é" * 90 + "\x1f\x8b"),
    (None, "http://g", "q" * 150),
    (8, "http://h", "q" * 150),
    (8, "http://h", "q" * 150),
]


def test_warc_round_trip(spark):
    import hashlib

    pages = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, digest int")
    with Scratch(spark) as scratch:
        path = scratch.new_path("warc")
        warc.write(pages, path, file_rows=3)
        got = warc.read(spark, path).collect()
    assert len(got) == len(PAGES) and {r["kind"] for r in got} == {"record"}
    first = {"p" * 200: 1, "q" * 150: 8}
    for page_id, url, html in PAGES:
        r = next(x for x in got if x["page_id"] == page_id)
        data = (html or "").encode()
        assert r["payload_bytes"] == len(data) and r["payload_digest"] == hashlib.sha256(data).hexdigest()
        revisit = html in first and first[html] != page_id
        assert (r["record_type"], r["refers_to"]) == (("revisit", first[html]) if revisit else ("response", None))
        assert r["payload"] == (None if revisit else data)
        assert (r["url"] is None) == (url is None)


def _archive(zipped):
    import hashlib

    parts = []
    for i in range(6):
        body = b"body %d " % i * 30
        raw = warc.record(i, "http://x", body, hashlib.sha256(body).hexdigest(), None, False)
        if zipped:
            made = zlib.compressobj(6, zlib.DEFLATED, 31)
            raw = made.compress(raw) + made.flush()
        parts.append(raw)
    return parts


@pytest.mark.parametrize("zipped", [False, True])
def test_salvage(zipped):
    parts = _archive(zipped)
    ids = lambda data: [warc._page(x.headers["warc-record-id"]) for x in warc.salvage(data) if isinstance(x, warc.Record)]
    gaps = lambda data: [x for x in warc.salvage(data) if isinstance(x, tuple)]
    assert ids(b"".join(parts)) == list(range(6)) and not gaps(b"".join(parts))
    # A damaged record, rubbish between two, a cut end.
    bad = bytearray(parts[2])
    bad[-40] ^= 0xFF  # in the payload
    rubbish = b"rubbish WARC/1.1 \x1f\x8b\x08 more"
    data = b"".join([*parts[:2], bytes(bad), parts[3], rubbish, parts[4], parts[5][:-9]])
    # The cut member still gives its content, whose digest agrees; the cut is reported all the same.
    assert ids(data) == ([0, 1, 3, 4, 5] if zipped else [0, 1, 3, 4])
    at = [len(b"".join(parts[:2])), len(b"".join(parts[:4])), len(data) - len(parts[5]) + 9]
    found = gaps(data)
    assert [g[0] for g in found] == at
    assert found[0][1] == at[0] + len(parts[2]) and found[1][1] - found[1][0] == len(rubbish) and found[2][1] == len(data)
    # Every byte lies in a record or a gap.
    assert sum(g[1] - g[0] for g in found) + sum(len(parts[i]) for i in (0, 1, 3, 4)) == len(data)
    assert ids(b"\x00" * 50 + b"".join(parts)) == list(range(6))
    assert list(warc.salvage(b"")) == [] and gaps(b"junk") == [(0, 4, "version")]


def test_salvage_of_mixed_archive():
    data = b"".join(x for pair in zip(_archive(True), _archive(False), strict=True) for x in pair)
    assert sum(isinstance(x, warc.Record) for x in warc.salvage(data)) == 12


def _raw_archive(n):
    import hashlib

    bodies = [b"body %d " % i * 200 for i in range(n)]
    return [warc.record(i, "http://x", b, hashlib.sha256(b).hexdigest(), None, False) for i, b in enumerate(bodies)]


def _zip(data):
    made = zlib.compressobj(6, zlib.DEFLATED, 31)
    return made.compress(data) + made.flush()


def _ids(data):
    return [warc._page(x.headers["warc-record-id"]) for x in warc.salvage(data) if isinstance(x, warc.Record)]


def _gaps(data):
    return [x for x in warc.salvage(data) if isinstance(x, tuple)]


def test_salvage_inside_a_member():
    """Of records in one member, those beside a damaged one are recovered."""
    raw = _raw_archive(6)
    bad = bytearray(raw[2])
    bad[-40] ^= 0xFF
    content = b"".join([*raw[:2], bytes(bad), *raw[3:]])
    data = _zip(content)
    assert _ids(_zip(b"".join(raw))) == list(range(6)) and not _gaps(_zip(b"".join(raw)))
    assert _ids(data) == [0, 1, 3, 4, 5]
    at = len(raw[0]) + len(raw[1])
    assert _gaps(data) == [(0, len(data), "digest", at, at + len(raw[2]))]
    # In front of and behind other members.
    more = _zip(raw[0]) + data + _zip(raw[5])
    assert _ids(more) == [0, 0, 1, 3, 4, 5, 5] and len(_gaps(more)) == 1
    found = [x for x in warc.salvage(data) if isinstance(x, warc.Record)]
    assert [x.inner for x in found][:3] == [0, len(raw[0]), at + len(raw[2])] and all(x.inner_length == len(raw[0]) and x.length == len(data) for x in found)


def test_salvage_of_cut_and_broken_members():
    raw = _raw_archive(6)
    data = _zip(b"".join(raw))
    assert _ids(data[:-4]) == list(range(6)) and _gaps(data[:-4]) == [(0, len(data) - 4, "gzip", len(b"".join(raw)), len(b"".join(raw)))]
    assert _ids(data[:-4] + _zip(raw[0])) == [*range(6), 0]
    # A cut in the middle leaves the records before it; what follows the member is found again.
    import random

    noise = [warc.record(i, "http://x", b, __import__("hashlib").sha256(b).hexdigest(), None, False) for i, b in enumerate(random.Random(i).randbytes(5000) for i in range(6))]
    data = _zip(b"".join(noise))
    assert _ids(data[: len(data) // 2] + _zip(raw[5])) == [0, 1, 5]
    broken = bytearray(data)
    broken[len(data) // 2] ^= 0xFF
    assert _ids(bytes(broken) + raw[4]) in ([0, 1, 4], [0, 1, 2, 4], [0, 1, 3, 4, 5, 4])
    # Nothing can be checked in a damaged member without digests.
    bare = [r.replace(b"WARC-Payload-Digest", b"X-Was-Digest") for r in raw]
    assert _ids(_zip(b"".join(bare))) == list(range(6)) and _ids(_zip(b"".join(bare))[:-4]) == []


def test_salvage_of_a_payload_with_many_version_lines():
    raw = _raw_archive(2)
    damaged = raw[0][:-2] + b"xx" + b"WARC/1.1\r\nWARC-Type: x\r\n" * 20_000
    assert _ids(damaged + raw[1]) == [1] and len(_gaps(damaged + raw[1])) == 1


def test_warc_files_are_bounded_by_bytes(spark, monkeypatch):
    import os

    monkeypatch.setattr(warc, "FILE_BYTES", 16 * 4_000)
    rng = np.random.default_rng(6)
    pages = spark.createDataFrame([(i, "u", rng.bytes(3_000).hex()) for i in range(60)], "page_id long, url string, html string").coalesce(1)
    with Scratch(spark) as scratch:
        path = scratch.new_path("warc")
        warc.write(pages, path)
        folder = path.removeprefix("file:")
        sizes = [os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder) if f.startswith("part-")]
        assert len(sizes) > 2 and max(sizes) <= 16 * 4_000 + 16 * 20
        assert sorted(r["page_id"] for r in warc.read(spark, path, with_payload=False).collect()) == list(range(60))

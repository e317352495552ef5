import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexloom.llm import docstats, gbdt, superminhash, textvec, toxicity

WORD = r"[^\x20\x09-\x0D]+"
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \t\n\x0b日#", max_size=60)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_counts_equal_brute_force(texts):
    base, x = docstats.measure(pa.array(texts, pa.string()))
    assert x.shape == (len(texts), len(docstats.FEATURES)) and np.isfinite(x).all()
    for i, t in enumerate(texts):
        words = re.findall(WORD, t or "")
        lines = [line for line in (t or "").split("\n") if re.search(WORD, line)]
        c, covered = Counter(tuple(words[j : j + 8]) for j in range(len(words) - 7)), set()
        for j in range(len(words) - 7):
            if c[tuple(words[j : j + 8])] > 1:
                covered.update(range(j, j + 8))
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))
        assert tuple(int(base[k][i]) for k in docstats.BASE) == want


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_shingle_sets(texts):
    t = textvec.Texts(pa.array(texts, pa.string()), lower=True)
    flat, cuts = t.shingle_sets(5)
    sets = []
    for i, x in enumerate(texts):
        w = re.findall(WORD, (x or "").translate({c: c + 32 for c in range(65, 91)}))
        want = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        assert cuts[i + 1] - cuts[i] == len(want)
        sets.append((want, flat[cuts[i] : cuts[i + 1]].tobytes()))
    for a, x in sets:
        for b, y in sets:
            assert (a == b) == (x == y)


def test_equal_words_hash_alike_across_pieces():
    word = "x" * (textvec._PIECE + 77)
    t = textvec.Texts(pa.array([f"{word} a", "a", f"pre {word} a a"]))
    assert t.words[0] == t.words[4] and len({int(w) for w in t.words}) == 3


def test_chunks_cover_all_rows():
    assert list(textvec.chunks(pa.array([], pa.string()))) == []
    assert list(textvec.chunks(pa.array(["a" * 9, None, "b" * 90, "c"]), 10)) == [(0, 2), (2, 3), (3, 4)]


@pytest.mark.parametrize("similarity", [0.3, 0.75])
def test_signatures_estimate_similarity(similarity):
    rng, found = np.random.default_rng(3), []
    for _ in range(60):
        n = 300
        same = int(2 * n * similarity / (1 + similarity))
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        b = np.concatenate((a[:same], rng.integers(0, 2**63, n - same, dtype=np.uint64)))
        sig = superminhash.signatures(np.concatenate((a, b)), np.array([0, n, 2 * n]), 120)
        found.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(found) - similarity) < 0.02
    # Lower variance than independent hash functions.
    assert np.std(found) < 1.05 * (similarity * (1 - similarity) / 120) ** 0.5


def test_small_sets_fill_all_places():
    sig = superminhash.signatures(np.array([5], np.uint64), np.array([0, 0, 1]), 120)
    assert (sig[0] == 0xFFFFFFFF).all()
    assert sorted(sig[1] >> 24) == list(range(120))


def test_trees_learn_and_stay_monotonic():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (rng.random(3000) < 0.1)).astype(float)
    model = gbdt.fit(x, y, {0: 1, 1: -1}, trees=30)
    assert ((model.score(x) > 0.5) == (x[:, 0] > 0.5)).mean() > 0.95
    for f, sign in ((0, 1), (1, -1)):
        grid = np.repeat(rng.random((50, 3)), 40, 0)
        grid[:, f] = np.tile(np.linspace(0, 1, 40), 50)
        steps = np.diff(model.score(grid).reshape(50, 40), axis=1) * sign
        assert (steps >= -1e-12).all()
    # Without the constraint the same arrays are walked one row at a time.
    one = gbdt.fit(x, y, trees=5)
    for row in x[:20]:
        raw = one.base
        for root in one.roots:
            at = root
            for _ in range(one.depth):
                at = one.left[at] if row[one.feature[at]] <= one.cut[at] else one.right[at]
            raw += one.value[at]
        assert one.score(row[None])[0] == pytest.approx(1 / (1 + np.exp(-raw)))


def test_trees_without_two_labels():
    assert gbdt.fit(np.zeros((0, 2)), np.zeros(0)).score(np.zeros((2, 2))).tolist() == [0.5, 0.5]
    assert gbdt.fit(np.zeros((3, 2)), np.ones(3)).score(np.zeros((1, 2)))[0] == pytest.approx(3.5 / 4)


def test_first_split_by_brute_force():
    """The root of the first tree is the best of all splits at all quantile cuts."""
    rng = np.random.default_rng(8)
    x = rng.random((400, 4))
    y = ((x[:, 2] > 0.37) ^ (rng.random(400) < 0.2)).astype(float)
    model = gbdt.fit(x, y, trees=1, depth=1)
    share = (y.sum() + 0.5) / (len(y) + 1)
    grad, hess, best = share - y, np.full(len(y), share * (1 - share)), (-1.0, None)

    def score(rows):
        return grad[rows].sum() ** 2 / (hess[rows].sum() + 2.0)

    for f in range(4):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0, 1, 65)[1:-1])):
            low = x[:, f] <= cut
            if min(hess[low].sum(), hess[~low].sum()) >= 3.0:
                best = max(best, (score(low) + score(~low), (f, cut)))
    root = model.roots[0]
    assert (model.feature[root], model.cut[root]) == best[1]
    for side, rows in ((model.left, x[:, best[1][0]] <= best[1][1]), (model.right, x[:, best[1][0]] > best[1][1])):
        assert model.value[side[root]] == pytest.approx(-0.15 * grad[rows].sum() / (hess[rows].sum() + 2.0))


def test_regression_is_a_minimum():
    rng = np.random.default_rng(9)
    rows = [np.sort(rng.choice(30, rng.integers(0, 8), replace=False)) for _ in range(200)]
    cuts, cols = np.concatenate(([0], np.cumsum([len(r) for r in rows]))), np.concatenate(rows)
    scale, y = rng.normal(size=30), (rng.random(200) < 0.15).astype(float)
    w, b = toxicity._regression(cuts, cols, scale, y)
    x = np.zeros((200, 30))
    for i, r in enumerate(rows):
        x[i, r] = scale[r]
    mass = np.where(y == 1, (200 - y.sum() + 0.5) / (y.sum() + 0.5), 1.0)
    mass /= mass.sum()

    def loss(w, b):
        raw = x @ w + b
        return mass @ (np.logaddexp(0, raw) - y * raw) + toxicity.L2 / 400 * (w @ w)

    at = loss(w, b)
    for _ in range(200):
        assert loss(w + 0.01 * rng.normal(size=30), b + 0.01 * rng.normal()) > at


def test_toxicity_features_by_brute_force():
    texts = ["Vile  words\tand é日 words", "", None, "abc", "the same the same", "x" * 70_000]
    parts = {}
    for at, doc in toxicity.ngrams(pa.array(texts, pa.string())):
        for a, d in zip(at.tolist(), doc.tolist(), strict=True):
            parts.setdefault(d, []).append(a)
    coef, mask = [int(c) for c in textvec.WORD_COEF], (1 << 64) - 1
    for i, text in enumerate(texts):
        chars = [" " if c in "\t\n\x0b\x0c\r" else chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""]
        want = []
        for n in toxicity.ORDERS:
            for j in range(len(chars) - n + 1):
                acc = (n + sum(ord(c) * coef[k + 1] for k, c in enumerate(chars[j : j + n]))) & mask
                want.append((((acc ^ (acc >> 31)) * 0x9E3779B97F4A7C15) & mask) >> (64 - toxicity.BITS))
        assert parts.get(i, []) == want

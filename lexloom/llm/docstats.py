"""Statistics of whole documents, as the quality operators use them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import textvec

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "stop_rate", "bang_rate", "pipe_rate", "digit_rate", "distinct_rate", "line_words", "wide_rate", "mark_rate", "open_words")


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOLS = _table(b"#*$%&|<>")
_UPPER = _table(bytes(range(65, 91)))
_DIGIT = _table(b"0123456789")
_STOP = _table(b".?!")
_MARK = _table(b",;:()'\"-")
_LEAD = np.ones(256, bool)
_LEAD[0x80:0xC0] = False
_WIDE = np.zeros(256, bool)
_WIDE[0xC0:] = True


def measure(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Counts (``BASE``) and features (documents x ``FEATURES``) of a run of texts.

    A null text counts as an empty one; its counts and rates are 0.
    """
    t = textvec.Texts(column)
    words = t.n_words
    chars = t.sums(_LEAD[t.raw] & t.solid)
    base = {"n_words": words, "word_chars": chars, "n_symbols": t.table_sums(_SYMBOLS), "n_dup_lines": t.n_dup_lines(), "n_repeat_words": t.n_repeat_words(8)}
    lines = np.bincount(t.lines()[1], minlength=t.n)
    distinct = np.zeros(t.n, np.int64)
    for i in range(t.n):
        w = np.sort(t.words[t.word_cuts[i] : t.word_cuts[i + 1]])
        distinct[i] = len(w) and 1 + np.count_nonzero(w[1:] != w[:-1])
    # Words that follow no line or sentence end: a text of full sentences has long runs of them.
    per_word, per_char, per_line = np.maximum(words, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    stops = t.table_sums(_STOP)
    x = np.stack(
        [
            np.log1p(words),
            chars / per_word,
            base["n_symbols"] / per_word,
            base["n_dup_lines"] / per_line,
            base["n_repeat_words"] / per_word,
            t.table_sums(_UPPER) / per_char,
            stops / per_word,
            t.table_sums(_table(b"!")) / per_word,
            t.table_sums(_table(b"|")) / per_word,
            t.table_sums(_DIGIT) / per_char,
            distinct / per_word,
            words / per_line,
            t.table_sums(_WIDE) / per_char,
            t.table_sums(_MARK) / per_word,
            words / (stops + 1),
        ],
        1,
    ).astype(np.float64)
    return base, x

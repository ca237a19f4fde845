"""Counts per line of a block of texts, shared by the line-based operators."""

from __future__ import annotations

import numpy as np

from cadence.llm.common import SpanHasher, code_points, is_letter, is_space, spans

SYMBOLS = "#*$%&|<>"
_kinds: list[np.ndarray] = []


def _kind(flat: np.ndarray) -> np.ndarray:
    """Per code point: 1 upper-case letter, 2 digit, 3 one of SYMBOLS, 4 the
    exclamation mark, 5 sentence end, 0 anything else."""
    if not _kinds:
        t = np.zeros(0x20000, np.uint8)
        for c in range(0x20000):
            ch = chr(c)
            t[c] = 1 if ch.isupper() else 2 if ch.isdigit() else 0
        for ch in SYMBOLS:
            t[ord(ch)] = 3
        t[ord("!")] = 4
        for ch in ".?…。":
            t[ord(ch)] = 5
        _kinds.append(t)
    return _kinds[0][np.minimum(flat, 0x1FFFF)]


class Lines:
    """Every line (split at \\n) of the given texts, in order.

    row: the text of each line; chars, words, letters, upper, digits, symbols,
    pipes, shouts, ends: counts; repeats: words equal to the word before;
    distinct: different words; closed: the last character ends a sentence.
    begin, end: offsets in ``flat``. word_*: the same for words.
    """

    def __init__(self, texts: list[str]):
        flat, at = code_points(texts)
        self.flat = flat
        self.end = np.flatnonzero(flat == 10)
        self.begin = np.concatenate(([0], self.end[:-1] + 1)) if len(self.end) else np.zeros(0, np.int64)
        self.row = np.searchsorted(at, self.begin, "right") - 1
        n = len(self.begin)
        kind, space, letter = _kind(flat), is_space(flat), is_letter(flat)
        total = lambda mask: np.add.reduceat(mask.astype(np.int32), self.begin) if n else np.zeros(0, np.int32)
        self.chars = (self.end - self.begin).astype(np.int64)
        self.letters, self.upper, self.digits = total(letter), total((kind == 1) & letter), total(kind == 2)
        self.symbols, self.shouts, self.pipes = total(kind == 3), total(kind == 4), total(flat == ord("|"))
        self.ends, self.visible = total(kind == 5), total(~space)
        self.word_begin, self.word_end = spans(~space)
        self.word_line = np.searchsorted(self.begin, self.word_begin, "right") - 1
        self.word_hash = SpanHasher(flat)(self.word_begin, self.word_end)
        self.words = np.bincount(self.word_line, minlength=n)
        again = np.zeros(len(self.word_hash), bool)
        again[1:] = (self.word_hash[1:] == self.word_hash[:-1]) & (self.word_line[1:] == self.word_line[:-1])
        self.repeats = np.bincount(self.word_line[again], minlength=n)
        mark = self.word_hash ^ (self.word_line.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        self.distinct = np.bincount(self.word_line[np.unique(mark, return_index=True)[1]], minlength=n)
        last = np.zeros(n, np.int64)
        np.maximum.at(last, self.word_line, self.word_end - 1)
        self.closed = (self.words > 0) & np.isin(kind[last], (4, 5))
        self.capitals = np.bincount(self.word_line[(kind[self.word_begin] == 1)], minlength=n)

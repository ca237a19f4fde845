"""Quality rules, line first.

Each line is judged by itself (punctuation, navigation, boilerplate); failing
lines are removed; a document is rejected when it loses more than ``MAX_LOST``
of its visible characters, or fails the base rules on its whole text. Nulls
count as empty texts; an empty text has no words and so fails. Line order and
the white space of kept lines stay. Word and window equality is decided by
64-bit hashes of code points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import blocks, mixed
from cadence.llm.lines import Lines

LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5
MAX_LOST = 0.5
# Line limits: shares of words, or of letters.
SYMBOLS_A_WORD, SHOUTS_A_WORD, UPPER_SHARE, REPEAT_SHARE, PIPES = 0.3, 0.5, 0.7, 0.5, 2
# Phrases of pages' frames, matched in short lines only.
PHRASES = [
    "accept cookies", "all rights reserved", "back to top", "click here", "cookie policy", "enable javascript",
    "forgot password", "lorem ipsum", "log in", "privacy policy", "read more", "sign in", "sign up",
    "skip to content", "subscribe to our", "terms of service", "terms of use",
]
SHORT_WORDS = 12
_phrases = re.compile("|".join(map(re.escape, PHRASES)))
_blank = re.compile("[^ \t\n\v\f\r]")
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judged(texts: list[str]) -> tuple[pd.DataFrame, list[list[str]]]:
    """Counts and verdicts of each text of a block, and its kept lines."""
    x, n = Lines(texts), len(texts)
    words = np.maximum(x.words, 1)
    fails = x.symbols / words > SYMBOLS_A_WORD  # punctuation
    fails |= x.shouts / words > SHOUTS_A_WORD
    fails |= (x.words >= 3) & (x.upper > UPPER_SHARE * np.maximum(x.letters, 1))
    fails |= x.pipes >= PIPES  # navigation: cells and menus
    fails |= (x.words >= 6) & (x.repeats / words > REPEAT_SHARE)
    lines = [line for t in texts for line in t.split("\n")]
    for i in np.flatnonzero((x.words > 0) & (x.words <= SHORT_WORDS) & ~fails):
        fails[i] = bool(_phrases.search(lines[i].lower()))
    fails &= x.words > 0
    out = pd.DataFrame({
        "n_words": np.bincount(x.row, x.words, n), "word_chars": np.bincount(x.row, x.visible, n),
        "n_symbols": np.bincount(x.row, x.symbols, n), "n_lines_failed": np.bincount(x.row, fails, n),
        "lost_chars": np.bincount(x.row, x.visible * fails, n),
    }).astype(np.int64)
    filled = [[line for line in t.split("\n") if _blank.search(line)] for t in texts]
    out["n_dup_lines"] = [len(f) - len(set(f)) for f in filled]
    # windows of five words within one text, found twice or more in it
    row = x.row[x.word_line]
    repeated = np.zeros(len(row), bool)
    if len(row) >= WINDOW:
        whole = row[WINDOW - 1 :] == row[: -WINDOW + 1]
        code = np.zeros(len(whole), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(WINDOW):
                code = mixed(code * np.uint64(0x9E3779B97F4A7C15) + x.word_hash[k : k + len(whole)])
            code = mixed(code + row[: len(whole)].astype(np.uint64) * np.uint64(0xD1342543DE82EF95))[whole]
        _, back, count = np.unique(code, return_inverse=True, return_counts=True)
        first = np.flatnonzero(whole)[count[back] > 1]
        cover = np.zeros(len(row) + 1, np.int64)
        np.add.at(cover, first, 1)
        np.add.at(cover, first + WINDOW, -1)
        repeated = np.cumsum(cover[:-1]) > 0
    out["n_repeat_words"] = np.bincount(row[repeated], minlength=n)
    out["base_failed"] = (out.n_words < LEAST_WORDS) | (100 * out.n_repeat_words > MOST_REPEATED * out.n_words)
    out["kept"] = ~out.base_failed & (out.lost_chars <= MAX_LOST * out.word_chars)
    kept, at = [], 0
    for t in texts:
        own = t.split("\n")
        kept.append([line for k, line in enumerate(own) if not fails[at + k]])
        at += len(own)
    return out, kept


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines_failed long, "
    "lost_chars long, base_failed boolean, kept boolean"
)


def clean(docs: DataFrame) -> DataFrame:
    """All columns of docs, the counts and verdicts, and clean_text (the text
    without its failing lines)."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            own = [t or "" for t in texts]
            done = [judged(own[s:e]) for s, e in blocks(own)]
            table = pd.concat([d for d, _ in done], ignore_index=True)[names]
            yield table.assign(clean_text=["\n".join(k) for _, kept in done for k in kept])

    judge = F.pandas_udf(run, SCHEMA + ", clean_text string")
    docs = docs.drop(*names, "clean_text")
    return docs.withColumn("_llm_row", judge("text")).select("*", "_llm_row.*").drop("_llm_row")

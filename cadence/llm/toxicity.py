"""Toxicity by a counterfactually regularised classifier.

A logistic model over the presence of words and word beginnings. In the
labelled sentences that mention an identity term, the term is swapped for other
terms, and the squared change of the score is part of what is minimised: a
neutral mention of a group then moves no score, however often a group happens
to be mentioned in toxic texts.

The features are those that are associated with the label in the sample
(likelihood ratio of presence), and the identity terms themselves. Learning
uses a bounded sample (``MAX_TRAIN`` texts of at most ``MAX_CHARS`` characters,
parameters) on the driver; scoring covers every whole text, in tasks. Null text
counts as empty; an empty text gets the score of a text without features. With
no label of one kind, the score is the share of the other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import SpanHasher, blocks, code_points, is_letter, labelled_texts, sigmoid, spans

MAX_TRAIN, MAX_CHARS = 6000, 20_000
MAX_FEATURES, LEAST_RATIO = 1000, 10.0
PREFIXES = (3, 4, 5, 6)
RIDGE, COUNTERFACTUAL = 0.1, 20.0
TABLE = 1 << 22
THRESHOLD = 0.3

# Neutral names of groups, one list per kind; a term is swapped for others of its kind.
IDENTITY_TERMS = [
    ["muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"],
    ["black", "white", "asian", "latino", "african", "european", "arab"],
    ["gay", "lesbian", "straight", "bisexual", "transgender", "queer"],
    ["women", "men", "girls", "boys"],
    ["woman", "man", "girl", "boy"],
    ["immigrants", "refugees", "natives", "foreigners", "citizens"],
    ["old", "young", "elderly", "disabled", "blind", "deaf"],
]
_terms = {t: kind for kind in IDENTITY_TERMS for t in kind}
_sentence = re.compile(r"[^.!?\n]+")
_word = re.compile(r"\w+")


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of each word and word beginning, one kind at a time."""
    flat, at = code_points([t.lower() for t in texts])
    begin, end = spans(is_letter(flat))
    row = np.searchsorted(at, begin, "right") - 1
    code = SpanHasher(flat)
    yield row, code(begin, end)
    for k in PREFIXES:
        use = end - begin >= k
        # one more than the length tells a beginning from a whole word
        yield row[use], code(begin[use], begin[use] + k) ^ np.uint64(0xA5A5 + k)


def _text_blocks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    for s, e in blocks(texts):
        yield s, texts[s:e]


def swapped(sentence: str, partners: int = 3) -> Iterator[str]:
    """The sentence with each identity term replaced by others of its kind."""
    for m in _word.finditer(sentence):
        kind = _terms.get(m[0].lower())
        if kind:
            k = kind.index(m[0].lower())
            for step in range(1, min(partners, len(kind) - 1) + 1):
                yield sentence[: m.start()] + kind[(k + step) % len(kind)] + sentence[m.end() :]


def choose_features(texts: list[str], y: np.ndarray) -> np.ndarray:
    """Hashes whose presence is associated with the label, the strongest
    first, by a count table over hash bins; sorted."""
    counts = np.zeros((2, TABLE), np.int32)
    for s, part in _text_blocks(texts):
        for row, code in features(part):
            cell = np.unique((row << 32) + (code & np.uint64(TABLE - 1)).astype(np.int64))
            np.add.at(counts, (y[(cell >> 32) + s], cell & 0xFFFFFFFF), 1)
    n1, n0 = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    a, b = counts[1].astype(np.float64), counts[0].astype(np.float64)
    rate = (a + b) / (n1 + n0)
    with np.errstate(divide="ignore", invalid="ignore"):
        part = lambda k, n, p: np.where(k > 0, k * np.log(k / n / p), 0) + np.where(k < n, (n - k) * np.log((n - k) / n / (1 - p)), 0)
        ratio = 2 * (part(a, n1, rate) + part(b, n0, rate))
    ratio[~np.isfinite(ratio) | (a + b < 3)] = 0
    top = np.argsort(-ratio, kind="stable")[:MAX_FEATURES]
    wanted = np.zeros(TABLE, bool)
    wanted[top[ratio[top] >= LEAST_RATIO]] = True
    named = [c for _, c in features([" ".join(_terms)])]
    got = [np.concatenate(named)]
    for _, part in _text_blocks(texts):
        for _, code in features(part):
            got.append(np.unique(code[wanted[(code & np.uint64(TABLE - 1)).astype(np.int64)]]))
    return np.unique(np.concatenate(got))


def _present(codes: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs of one block."""
    quick = np.zeros(1 << 16, bool)
    quick[(codes & np.uint64(0xFFFF)).astype(np.int64)] = True
    rows, cols = [], []
    for row, code in features(texts):
        maybe = np.flatnonzero(quick[(code & np.uint64(0xFFFF)).astype(np.int64)])
        col = np.minimum(np.searchsorted(codes, code[maybe]), len(codes) - 1)
        hit = codes[col] == code[maybe]
        rows.append(row[maybe][hit])
        cols.append(col[hit])
    pair = np.unique(np.concatenate(rows) * len(codes) + np.concatenate(cols))
    return pair // len(codes), pair % len(codes)


def design(codes: np.ndarray, texts: list[str]) -> np.ndarray:
    x = np.zeros((len(texts), len(codes)), np.float32)
    for s, part in _text_blocks(texts):
        row, col = _present(codes, part)
        x[row + s, col] = 1
    return x


def changes(codes: np.ndarray, texts: list[str]) -> np.ndarray:
    """Feature differences between labelled sentences and their counterfactuals."""
    before, after = [], []
    for t in texts:
        for m in _sentence.finditer(t):
            if any(w.lower() in _terms for w in _word.findall(m[0])):
                other = list(swapped(m[0]))
                before += [m[0]] * len(other)
                after += other
    if not before:
        return np.zeros((0, len(codes)), np.float32)
    return design(codes, before) - design(codes, after)


def fit(texts: list[str], y: np.ndarray, counterfactual: float = COUNTERFACTUAL) -> dict:
    y = y.astype(np.int64)
    if len(y) == 0 or y.min() == y.max():
        return {"codes": np.zeros(1, np.uint64), "weight": np.zeros(1), "bias": -40.0 if len(y) == 0 or y[0] == 0 else 40.0}
    codes = choose_features(texts, y)
    x = np.concatenate([design(codes, texts), np.ones((len(texts), 1), np.float32)], 1)
    delta = changes(codes, texts)
    hold = RIDGE * np.eye(x.shape[1])
    hold[-1, -1] = 1e-6
    if len(delta):
        hold[:-1, :-1] += counterfactual * len(texts) / len(delta) * (delta.T @ delta)
    w = np.zeros(x.shape[1])
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    loss = lambda w: np.logaddexp(0, x @ w).sum() - y @ (x @ w) + w @ hold @ w / 2
    now = loss(w)
    for _ in range(25):  # Newton, with shorter steps where a full one overshoots
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None].astype(np.float32)).T @ x + hold, x.T @ (p - y) + hold @ w)
        rate = 1.0
        while (after := loss(w - rate * step)) > now and rate > 1e-3:
            rate /= 2
        w, gain, now = w - rate * step, now - after, after
        if gain < 1e-4:
            break
    return {"codes": codes, "weight": w[:-1], "bias": float(w[-1])}


def score(model: dict, texts: list[str | None]) -> np.ndarray:
    texts = [t or "" for t in texts]
    z = np.full(len(texts), model["bias"])
    for s, part in _text_blocks(texts):
        row, col = _present(model["codes"], part)
        z[s : s + len(part)] += np.bincount(row, model["weight"][col], len(part))
    return sigmoid(z)


def classify(docs: DataFrame, labels: DataFrame, train: Column, most: int = MAX_TRAIN, max_chars: int = MAX_CHARS) -> DataFrame:
    """All columns of docs, score and predicted."""
    model = fit(*labelled_texts(docs, labels, "toxic", train, most, max_chars))

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(score(model, texts.tolist()))

    docs = docs.drop("score", "predicted")
    return docs.withColumn("score", F.pandas_udf(run, "double")("text")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )

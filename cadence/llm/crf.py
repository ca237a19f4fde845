"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's unary potentials are linear in its own
features and those of its neighbours; a 2 x 2 transition matrix links
neighbouring lines. Forward-backward gives each line's marginal, and the
length-weighted mean of the marginals gives a document's bad share, which a
one-dimensional logistic curve maps to the quality score.

Labels are of documents: at first every line inherits its document's label, and
then, twice, the lines of bad documents are relabelled by their own marginals
(the worst line stays bad). Learning uses a bounded sample (``MAX_TRAIN`` texts
of at most ``MAX_CHARS`` characters and ``MAX_LINES`` lines, parameters) on the
driver; scoring covers every line of every text, in tasks. A null text is one
empty line. Labels of one kind only: the score is that label for all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import blocks, labelled_texts, sigmoid
from cadence.llm.lines import Lines

MAX_TRAIN, MAX_CHARS, MAX_LINES = 3000, 20_000, 60
ROUNDS, STEPS, RIDGE = 3, 120, 1e-3
THRESHOLD = 0.3


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, each line's text, each line's weight."""
    x = Lines(texts)
    words, seen = np.maximum(x.words, 1), np.maximum(x.visible, 1)
    own = np.stack([
        np.minimum(x.symbols / words, 2), np.minimum(x.pipes / words, 1), np.minimum(x.shouts / words, 1.5),
        x.upper / np.maximum(x.letters, 1), x.digits / seen, x.repeats / words, x.distinct / words,
        (seen - x.letters) / seen, np.minimum(x.visible / words, 20) / 10, np.log1p(x.words),
        x.closed.astype(float), (x.words == 0).astype(float), np.minimum(x.ends / words, 1), x.capitals / words,
        np.log1p(x.words) * (x.distinct / words < 0.35),
    ], 1)
    first = np.concatenate(([True], x.row[1:] != x.row[:-1]))
    last = np.concatenate((first[1:], [True]))
    before, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
    before[first], after[last] = 0, 0
    return np.concatenate([own, before, after, first[:, None], last[:, None], np.ones((len(own), 1))], 1), x.row, x.chars + 1.0


def marginals(unary: np.ndarray, move: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """P(bad) of each line, and the expected transitions (2 x 2), by forward
    and backward passes over all texts at once, position by position.

    unary: the log odds of bad of each line; move: log potentials [from, to];
    row: the text of each line (sorted), of n texts."""
    length = np.bincount(row, minlength=n)
    start = np.concatenate(([0], np.cumsum(length)[:-1]))
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    emit = np.stack([np.zeros(len(unary)), unary], 1)
    forward, backward = np.zeros_like(emit), np.zeros_like(emit)
    active = [int(np.searchsorted(-length, -t, "left")) for t in range(length.max(initial=0) + 1)]  # longer than t
    for t in range(len(active) - 1):
        i = start[: active[t]] + t
        if t:
            a = np.logaddexp(forward[i - 1, :1] + move[0], forward[i - 1, 1:] + move[1]) + emit[i]
        else:
            a = emit[i]
        forward[i] = a - np.logaddexp(a[:, :1], a[:, 1:])
    pairs = np.zeros((2, 2))
    for t in range(len(active) - 2, 0, -1):
        i = start[: active[t]] + t
        b = backward[i] + emit[i]
        step = forward[i - 1][:, :, None] + move[None] + b[:, None, :]
        step = np.exp(step - step.max((1, 2), keepdims=True))
        pairs += (step / step.sum((1, 2), keepdims=True)).sum(0)
        a = np.logaddexp(move[:, 0] + b[:, :1], move[:, 1] + b[:, 1:])
        backward[i - 1] = a - np.logaddexp(a[:, :1], a[:, 1:])
    both = forward + backward
    return sigmoid(both[:, 1] - both[:, 0]), pairs


def _train(x: np.ndarray, bad: np.ndarray, row: np.ndarray, n: int, w: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Conditional likelihood by gradient steps with adaptive rates."""
    same = row[1:] == row[:-1]
    true = np.zeros((2, 2))
    np.add.at(true, (bad[:-1][same], bad[1:][same]), 1)
    m = [np.zeros_like(w), np.zeros_like(move)]
    v = [np.zeros_like(w), np.zeros_like(move)]
    for k in range(1, STEPS + 1):
        p, pairs = marginals(x @ w, move, row, n)
        grads = [x.T @ (p - bad) / len(bad) + RIDGE * w, (pairs - true) / len(bad) + RIDGE * move]
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            step = 0.15 * m[i] / (1 - 0.9**k) / (np.sqrt(v[i] / (1 - 0.99**k)) + 1e-8)
            if i == 0:
                w = w - step
            else:
                move = move - step
    return w, move


def _share(p: np.ndarray, row: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, p * weight, n) / np.maximum(np.bincount(row, weight, n), 1)


def _curve(share: np.ndarray) -> np.ndarray:
    return np.log(share + 1e-3)


def fit(texts: list[str], quality: np.ndarray) -> dict:
    quality = np.asarray(quality, np.int64)
    use = [i for i, t in enumerate(texts) if t.count("\n") < MAX_LINES]
    texts, quality = [texts[i] for i in use], quality[use]
    if len(quality) == 0 or quality.min() == quality.max():
        return {"constant": 1.0 if len(quality) == 0 else float(quality[0])}
    parts, at = [], 0
    for s, e in blocks(texts):
        x, row, weight = line_features(texts[s:e])
        parts.append((x, row + s, weight))
    x, row, weight = (np.concatenate(p) for p in zip(*parts, strict=True))
    n = len(texts)
    mean, std = x.mean(0), x.std(0)
    std[std < 1e-9], mean[-1] = 1, 0
    x = (x - mean) / std
    bad_text = quality[row] == 0
    bad = bad_text.astype(np.int64)
    w, move = np.zeros(x.shape[1]), np.zeros((2, 2))
    for at in range(ROUNDS):
        w, move = _train(x, bad, row, n, w, move)
        p, _ = marginals(x @ w, move, row, n)
        if at + 1 < ROUNDS:
            worst = np.zeros(n)
            np.maximum.at(worst, row, p)
            bad = (bad_text & ((p > 0.5) | (p >= worst[row]))).astype(np.int64)
    z = np.stack([_curve(_share(p, row, weight, n)), np.ones(n)], 1)
    c = np.zeros(2)
    for _ in range(25):  # Newton, held by a small ridge
        q = sigmoid(z @ c)
        c -= np.linalg.solve((z * (q * (1 - q))[:, None]).T @ z + 0.02 * np.eye(2), z.T @ (q - quality) + 0.02 * c)
    return {"mean": mean, "std": std, "weight": w, "move": move, "curve": c}


def score(model: dict, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Quality (0 to 1) and bad share of each text."""
    if "constant" in model:
        return np.full(len(texts), model["constant"]), np.full(len(texts), 1 - model["constant"])
    texts = [t or "" for t in texts]
    share = np.zeros(len(texts))
    for s, e in blocks(texts):
        x, row, weight = line_features(texts[s:e])
        p, _ = marginals((x - model["mean"]) / model["std"] @ model["weight"], model["move"], row, e - s)
        share[s:e] = _share(p, row, weight, e - s)
    a, b = model["curve"]
    return sigmoid(a * _curve(share) + b), share


def classify(docs: DataFrame, labels: DataFrame, train: Column, most: int = MAX_TRAIN, max_chars: int = MAX_CHARS) -> DataFrame:
    """All columns of docs, score, predicted and bad_share."""
    model = fit(*labelled_texts(docs, labels, "quality", train, most, max_chars))

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            quality, share = score(model, texts.tolist())
            yield pd.DataFrame({"score": quality, "bad_share": share})

    rate = F.pandas_udf(run, "score double, bad_share double")
    docs = docs.drop("score", "predicted", "bad_share")
    score_of = F.col("_llm_row.score")
    return docs.withColumn("_llm_row", rate("text")).select(
        "*", score_of, (score_of >= THRESHOLD).cast("int").alias("predicted"), "_llm_row.bad_share"
    ).drop("_llm_row")

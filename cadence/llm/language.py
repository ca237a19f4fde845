"""Language identification by string kernels.

Blended spectrum: the set of n-grams (n = 1 to 3) over lower-case letters, all
else standing as one blank, hashed to bins. The kernel of two texts is the
cosine of their presence sets, |A & B| / sqrt(|A| |B|). A Nystroem map on a few
landmark texts makes one-versus-rest kernel ridge regression linear: a block of
texts is scored by two matrix products. The model (landmark presence and one
vector per language) has a fixed size, whatever the corpus.

Learning uses a bounded sample (``MAX_TRAIN`` texts of at most ``MAX_CHARS``
characters, parameters); prediction uses every whole text. Null text, a text
without any letter and a model without languages give ``und`` and score 0.
Ties: the language that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import blocks, code_points, is_letter, labelled_texts, mixed

ORDERS = (1, 2, 3)
BINS = 1 << 13
MAX_TRAIN, MAX_CHARS = 2400, 20_000
LANDMARKS = 96
RIDGE, SHARPNESS = 1e-2, 6.0
ROWS = 512
UNKNOWN = "und"


def presence(texts: list[str]) -> np.ndarray:
    """One row per text: which bins its n-grams fall into (float32)."""
    flat, at = code_points([t.lower() for t in texts])
    code = np.where(is_letter(flat), flat, 32).astype(np.uint64)
    n = len(texts)
    row = np.repeat(np.arange(n), np.diff(at))
    seen = np.zeros(n * BINS, bool)
    last = at[1:][row] - 1  # the line feed that ends the text
    gram = np.zeros(len(code), np.uint64)
    place = np.arange(len(code))
    with np.errstate(over="ignore"):
        for order in ORDERS:
            gram = gram[: len(code) - order + 1] * np.uint64(1 << 21) + code[order - 1 :]
            ok = place[: len(gram)] + order - 1 <= last[: len(gram)]
            cell = mixed(gram[ok] + np.uint64(order << 62 & (1 << 64) - 1)) >> np.uint64(64 - BINS.bit_length() + 1)
            seen[row[: len(gram)][ok] * BINS + cell.astype(np.int64)] = True
    return seen.reshape(n, BINS).astype(np.float32)


def kernel(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Normalised presence kernel of all rows of x with all rows of y."""
    return (x @ y.T) / np.sqrt(np.outer(x.sum(1), y.sum(1)))


def fit(texts: list[str], langs: np.ndarray, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> dict | None:
    """Landmarks are dealt round robin over the languages, in the given order."""
    names = sorted({str(x) for x in langs})
    if not names:
        return None
    langs = np.array([str(x) for x in langs])
    own = [np.flatnonzero(langs == x) for x in names]
    turns = [o[k] for k in range(max(map(len, own))) for o in own if k < len(o)][:landmarks]
    marks = np.concatenate([presence([texts[i]]) for i in turns])
    rows = [kernel(presence(texts[a:b]), marks) for s, e in blocks(texts) for a, b in _steps(s, e)]
    k_nm = np.concatenate(rows).astype(np.float64)
    value, vector = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
    use = value > 1e-6 * value.max()
    to_map = vector[:, use] / np.sqrt(value[use])
    phi = np.concatenate([k_nm @ to_map, np.ones((len(texts), 1))], 1)
    target = np.where(langs[:, None] == np.array(names)[None, :], 1.0, -1.0)
    weight = np.linalg.solve(phi.T @ phi + ridge * np.eye(phi.shape[1]), phi.T @ target)
    return {"names": names, "marks": marks.astype(bool), "weight": (to_map @ weight[:-1]).astype(np.float32), "bias": weight[-1]}


def _steps(s: int, e: int) -> Iterator[tuple[int, int]]:
    for a in range(s, e, ROWS):
        yield a, min(e, a + ROWS)


def predict(model: dict | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    texts = [t or "" for t in texts]
    out, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if model is None:
        return out, score
    known = np.array([i for i, t in enumerate(texts) if any(map(str.isalpha, t))], dtype=np.int64)
    own = [texts[i] for i in known]
    marks = model["marks"].astype(np.float32)
    for s, e in blocks(own):
        for a, b in _steps(s, e):
            margin = kernel(presence(own[a:b]), marks) @ model["weight"] + model["bias"]
            best = margin.argmax(1)
            soft = np.exp(SHARPNESS * (margin - margin.max(1, keepdims=True)))
            for i, k, p in zip(known[a:b], best, 1.0 / soft.sum(1), strict=True):
                out[i], score[i] = model["names"][k], p
    return out, score


def identify(docs: DataFrame, train: Column, most: int = MAX_TRAIN, max_chars: int = MAX_CHARS) -> DataFrame:
    """All columns of docs, lang_pred and score. ``train``: condition on
    doc_id that marks the rows whose lang may be learnt."""
    model = fit(*labelled_texts(docs, docs.select("doc_id", "lang"), "lang", train, most, max_chars))

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            names, score = predict(model, texts.tolist())
            yield pd.DataFrame({"lang_pred": names, "score": score})

    guess = F.pandas_udf(run, "lang_pred string, score double")
    docs = docs.drop("lang_pred", "score")
    return docs.withColumn("_llm_row", guess("text")).select("*", "_llm_row.lang_pred", "_llm_row.score").drop("_llm_row")

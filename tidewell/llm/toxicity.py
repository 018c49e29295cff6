"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents (P) and documents of any kind (U) train a logistic model whose risk is corrected by the
share ``prior`` of toxic documents:  ``prior * E_P[l(+)] + max(0, E_U[l(-)] - prior * E_P[l(-)])``. Where the second
term falls below zero its gradient is turned round, as the non-negative estimator asks. Last, the bias is moved so
that the share of U above one half is the prior.

A text's features are the presence of hashed words and of hashed word beginnings, so inflected and compound forms
share weight with their stems. Words end at ASCII other than letters and digits, and at spaces and punctuation beyond
ASCII. Runs that may hold several words, those of over ``REACH`` bytes and those with letters beyond ASCII (scripts
without spaces among them), give their ``GRAMS`` too, so that any part of a text can weigh. Only features that stand out in P against U weigh anything (``MIN_POSITIVE``
documents of P and ``MIN_LIFT`` standard deviations), which keeps long clean texts from collecting weight by chance.

The fit takes a bounded sample (``MAX_POSITIVE`` and ``MAX_UNLABELLED`` documents, those whose ids hash lowest, by row where an id repeats); the
prior is counted over all labelled training rows. Scoring covers every whole text.

Edge cases: null and empty texts have no features and get the score of the bias; labels that repeat for a document
are toxic if any is; labels of null id or null mark don't count; without a toxic training document every score is 0;
repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import fold, keep_where, lowest_hashes, map_batches

#: Hash space of the features; documents that the fit takes; toxic documents and standard deviations that a feature needs; lengths (bytes) of beginnings.
BITS, MAX_POSITIVE, MAX_UNLABELLED, MIN_POSITIVE, MIN_LIFT, BEGINNINGS = 18, 3000, 6000, 5, 8.0, (5, 6, 7, 8, 9)
#: Bytes of a word hashed one by one (longer words are hashed by segment); letters of the n-grams; size of the feature space, words before n-grams.
REACH, GRAMS, SPACE = 16, (2, 3, 4, 6), 2 << BITS
_WORD = np.array([48 <= c <= 57 or 97 <= c <= 122 or c >= 128 for c in range(256)])
_MIX, _FNV, _BASIS = np.uint64(0x9E3779B97F4A7C15), np.uint64(1099511628211), np.uint64(14695981039346656037)
#: Spaces, punctuation and controls beyond ASCII (joiners inside words are none).
_GAPS = re.compile("[\x80-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf\xd7\xf7\u1680\u2000-\u200b\u200e-\u2069\u2e00-\u2e5d\u3000-\u3004\u3008-\u3020\u3030\u30fb\ufe30-\ufe4f\ufeff\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")


def _bytes(text: str | None) -> bytes:
    if not text:
        return b""
    return (text if text.isascii() else _GAPS.sub(" ", text)).lower().encode()


def _long_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Hashes of whole runs of bytes, and (run, hash) of their n-grams of letters."""
    size = end - start
    run = np.repeat(np.arange(start.size), size)
    data = data[np.arange(run.size) + np.repeat(start - np.concatenate(([0], np.cumsum(size)[:-1])), size)]
    first = np.flatnonzero((data & 0xC0) != 0x80)
    run, length = run[first], np.diff(np.append(first, data.size))
    letter = data[first].astype(np.uint64)
    for j in (1, 2, 3):
        more = np.flatnonzero(length > j)
        letter[more] = letter[more] << np.uint64(8) | data[first[more] + j]
    letter = (letter + np.uint64(1)) * _MIX
    at = np.flatnonzero(np.diff(run, prepend=-1))
    place = np.arange(run.size) - at[run]
    power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(int(place.max()), _FNV))))
    whole = np.add.reduceat((letter ^ letter >> np.uint64(29)) * power[place], at)
    grams, key = [], np.full(run.size, _BASIS)
    for n in range(max(GRAMS)):
        live = run.size - n
        if live <= 0:
            break
        key = (key[:live] ^ letter[n:]) * _FNV
        key ^= key >> np.uint64(31)
        if n + 1 in GRAMS:
            inside = run[:live] == run[n:]
            grams.append((run[:live][inside], key[inside] ^ np.uint64(n)))
    return whole, grams


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text as (offsets, indices), whole texts at a time, vectorised."""
    if not texts:
        return np.zeros(1, np.int64), np.zeros(0, np.int32)
    raws = [_bytes(x) for x in texts]
    ends = np.cumsum([len(r) + 1 for r in raws])
    data = np.frombuffer(b" ".join(raws) + b" " * (REACH + 1), np.uint8)
    word = _WORD[data]
    start = np.flatnonzero(word[: ends[-1]] & ~np.concatenate(([False], word[: ends[-1] - 1])))
    doc = np.searchsorted(ends, start, side="right")
    parts, key, live = [], np.full(start.size, _BASIS), np.arange(start.size)
    for j in range(REACH + 1):
        inside = word[start[live] + j]
        over = live[~inside]
        parts.append((doc[over], key[over] * _MIX ^ np.uint64(1)))  # a whole word
        live = live[inside]
        if not live.size or j == REACH:
            break
        key[live] = (key[live] ^ data[start[live] + j]) * _FNV
        if j + 1 in BEGINNINGS:
            parts.append((doc[live], key[live] * _MIX ^ np.uint64(2)))
    end = np.flatnonzero(word[: ends[-1]] & ~word[1 : ends[-1] + 1]) + 1
    beyond = np.concatenate(([0], np.cumsum(data >= 128)))
    long = np.flatnonzero((end - start > REACH) | (beyond[end] > beyond[start]))
    grams = []
    if long.size:
        whole, found = _long_runs(data, start[long], end[long])
        parts.append((doc[live], whole[np.searchsorted(long, live)] * _MIX ^ np.uint64(1)))
        grams = [(doc[long[run]], key * _MIX) for run, key in found]
    docs, keys = (np.concatenate(x) for x in zip(*parts))
    both = docs.astype(np.uint64) << np.uint64(32) | (keys * _MIX) >> np.uint64(64 - BITS)
    grams = [at.astype(np.uint64) << np.uint64(32) | (key * _MIX) >> np.uint64(64 - BITS) | np.uint64(1 << BITS) for at, key in grams]
    both = np.unique(np.concatenate([both, *grams]))
    return np.searchsorted(both, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32)), (both & np.uint64(2**32 - 1)).astype(np.int32)


def _sums(weights: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(weights[index], dtype=np.float64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _pack(rows: list[np.ndarray], slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features in use of each row, as (offsets, indices)."""
    kept = [y[y >= 0] for y in (slot[x] for x in rows)]
    return np.concatenate(([0], np.cumsum([len(x) for x in kept]))), np.concatenate(kept)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def slopes(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Direction of the next step for the margins of P and U: the gradient of the risk while its second term isn't
    negative, else that of the second term turned round."""
    if np.logaddexp(0, zu).mean() >= prior * np.logaddexp(0, zp).mean():
        return np.full(zp.size, -prior / zp.size), _sigmoid(zu) / zu.size
    return prior * _sigmoid(zp) / zp.size, -_sigmoid(zu) / zu.size


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = 400, rate: float = 0.05, decay: float = 5e-5) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic model under the non-negative PU risk; Adam over the whole sample."""
    seen = [np.bincount(np.concatenate(x), minlength=SPACE) for x in (positive, unlabelled)]
    share = (seen[1] + 0.5) / (len(unlabelled) + 1)
    lift = (seen[0] - len(positive) * share) / np.sqrt(len(positive) * share * (1 - share))
    used = np.flatnonzero((seen[0] >= min(MIN_POSITIVE, max(1, len(positive) // 2))) & (lift >= min(MIN_LIFT, len(positive) ** 0.5 / 2)))
    slot = np.full(SPACE, -1, np.int64)
    slot[used] = np.arange(used.size)
    (p_at, p_index), (u_at, u_index) = _pack(positive, slot), _pack(unlabelled, slot)
    w, bias = np.zeros(used.size), np.log(prior / (1 - prior))
    m, v = np.zeros(used.size + 1), np.zeros(used.size + 1)
    for t in range(1, steps + 1):
        zp, zu = bias + _sums(w, p_at, p_index), bias + _sums(w, u_at, u_index)
        dp, du = slopes(zp, zu, prior)
        grad = [np.bincount(i, np.repeat(d, np.diff(o)), used.size) for o, i, d in ((p_at, p_index, dp), (u_at, u_index, du))]
        grad = np.append(sum(grad)[: used.size], dp.sum() + du.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, bias = (w - step[:-1]) * (1 - rate * decay * 100), bias - step[-1]
    cut = max(np.quantile(_sums(w, u_at, u_index), 1 - prior), 1e-3)
    full = np.zeros(SPACE, np.float32)
    full[used] = w
    return full, float(-cut)


def _features_of(docs: DataFrame) -> list[np.ndarray]:
    """Features of a bounded frame of documents, on the driver, in an order of their own."""

    def make():
        def step(columns):
            offsets, index = features(columns[0])
            return [[index[a:b] for a, b in zip(offsets[:-1], offsets[1:])]]

        return step

    schema = T.StructType([T.StructField("f", T.ArrayType(T.IntegerType()))])
    rows = map_batches(docs.select("text"), make, schema).toLocalIterator()
    return sorted((np.asarray(r[0], np.int32) for r in rows), key=lambda f: f.tobytes())


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark_col: str = "toxic", folds: int = 5) -> tuple[np.ndarray, float] | None:
    """Weights and bias from the rows outside fold 0; None without a toxic one."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter(fold("id", folds) != 0)
    marks = labels.select(F.col(id_col).alias("id"), F.col(mark_col).alias("y")).dropna().filter(fold("id", folds) != 0).groupBy("id").agg(F.max("y").alias("y"))
    n, toxic = marks.agg(F.count("y"), F.count(F.when(F.col("y") == 1, 1))).first()
    if not toxic:
        return None
    chosen = lowest_hashes(marks.filter("y = 1"), "id", MAX_POSITIVE).select("id")  # so few ids are broadcast
    positive = _features_of(lowest_hashes(rows.join(F.broadcast(chosen), "id", "left_semi"), "id", MAX_POSITIVE))
    unlabelled = _features_of(lowest_hashes(rows, "id", MAX_UNLABELLED))
    if not positive or not unlabelled:
        return None
    return fit_nnpu(positive, unlabelled, min(0.9, max(0.001, toxic / n)))


def scores(texts: list[str | None], model: tuple[np.ndarray, float] | None) -> np.ndarray:
    """Score of each text, 0 to 1."""
    return np.zeros(len(texts)) if model is None else _sigmoid(model[1] + _sums(model[0], *features(texts)))


def score(docs: DataFrame, model: tuple[np.ndarray, float] | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``score double``; the weights (``SPACE`` floats, 2 MB) are broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda c: [c[0], scores(c[1], shared.value).tolist()]

    schema = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType())])
    return map_batches(docs.select(F.col(id_col), F.col(text_col).cast("string")), make, schema)


def drop_toxic(docs: DataFrame, model: tuple[np.ndarray, float] | None, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that score below ``threshold``, all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda texts: (scores(texts, shared.value) < threshold).tolist()

    return keep_where(docs, text_col, make)

"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, everything but letters becomes a space, and its runs of one to ``ORDER`` characters are hashed
to ``2**BITS`` buckets (runs of spaces only don't count). Training counts buckets by language over a bounded sample
(``MAX_TRAIN`` documents, those whose ids hash lowest); the matrix of log probabilities, a column for every language
of the sample, is broadcast. It is cut by language into blocks of ``LANGS``: where there are more, each block is
broadcast and scored by itself, and a row's best language and normaliser are reduced over the blocks, so what is
broadcast at once is bounded and no number of languages changes a prediction. Scoring takes a batch's n-grams, whole texts in pieces of bounded size, as a
sparse matrix (document x bucket) times that matrix. The score is the posterior probability of the predicted language.

Edge cases: null texts and texts without a letter are ``und`` with score 0, and so are all without training rows;
rows of null id count as held out; null languages aren't learned from; repeated rows give repeated results; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import fold, lowest_hashes, map_batches
from tidewell.session import materialise, scratch

#: Longest n-gram, hash bits, documents of the training sample, languages of a block, characters taken at a time, smoothing.
ORDER, BITS, MAX_TRAIN, LANGS, BLOCK, ALPHA = 3, 16, 20000, 256, 1 << 16, 0.5
UNKNOWN = "und"

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point whether it is a letter; made once per process."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Lower-cased texts with a space at either end, ``BLOCK`` characters at a time and long ones in pieces: code
    points, the text that each belongs to, and how many n-grams' beginnings still follow in its piece."""
    held, room = [], BLOCK
    for k, text in enumerate(texts):
        full = f" {text.lower()} " if text else ""
        for at in range(0, len(full), BLOCK):
            own = min(BLOCK, len(full) - at)
            if own > room:
                yield _joined(held)
                held, room = [], BLOCK
            held.append((k, full[at : at + own + ORDER - 1], own))
            room -= own
    if held:
        yield _joined(held)


def _joined(held: list[tuple[int, str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    points = np.frombuffer("".join(x for _, x, _ in held).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = [len(x) for _, x, _ in held]
    left = np.concatenate([np.arange(own, own - size, -1) for size, (_, _, own) in zip(sizes, held)])
    return points, np.repeat([k for k, _, _ in held], sizes), left


def batch_grams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of every n-gram, in parts that are ordered by text."""
    for points, text, left in _pieces(texts):
        full = _letters()[points]
        points = np.where(full, points, 32).astype(np.uint64)
        key, some = np.zeros(points.size, np.uint64), np.zeros(points.size, bool)
        piece = np.cumsum(np.diff(left, prepend=left[0] + 1) != -1)
        for n in range(1, ORDER + 1):
            size = points.size - n + 1
            if size <= 0:
                break
            key = key[:size] * np.uint64(0x100000001B3) + points[n - 1 :] + np.uint64(n)
            some = some[:size] | full[n - 1 :]
            mixed = (key ^ key >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
            use = np.flatnonzero(some & (left[:size] > 0) & (piece[:size] == piece[n - 1 :]))
            yield text[use], (mixed[use] >> np.uint64(64 - BITS)).astype(np.int64)


def grams(text: str | None) -> np.ndarray:
    """Bucket of each n-gram of the text; empty where it has no letter."""
    return np.concatenate([np.zeros(0, np.int64), *(b for _, b in batch_grams([text]))])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log priors and the log probabilities (bucket x language) from the rows outside fold 0."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = lowest_hashes(rows.filter((fold("id", folds) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull()), "id", MAX_TRAIN)

    def make():
        def step(columns):
            out: dict[str, np.ndarray] = {}
            n: dict[str, int] = {}
            for lang, text in zip(*columns):
                found = grams(text)
                if found.size:
                    out[lang] = out.get(lang, 0) + np.bincount(found, minlength=1 << BITS)
                    n[lang] = n.get(lang, 0) + 1
            hit = {k: np.flatnonzero(v) for k, v in out.items()}
            return [
                [k for k in hit for _ in range(hit[k].size + 1)],
                [x for k in hit for x in (-1, *hit[k].tolist())],
                [x for k in hit for x in (n[k], *out[k][hit[k]].tolist())],
            ]

        return step

    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])
    counts = map_batches(rows.select("lang", "text"), make, schema).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    with scratch():
        table = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("c")).select("lang", F.col("c.bucket").alias("b"), F.col("c.n").alias("n"))
        table = materialise(table, "langid-counts")  # a row per language, each of 2**BITS entries at most
        learned = []
        for r in table.toLocalIterator():
            at = np.asarray(r["b"])
            full = np.bincount(at + 1, r["n"], (1 << BITS) + 1)
            learned.append((full[0], r["lang"], np.log((full[1:] + ALPHA) / (full[1:] + ALPHA).sum()).astype(np.float32)))
    learned.sort(key=lambda x: x[1])
    if not learned:
        return [], np.zeros(0), np.zeros((1 << BITS, 0), np.float32)
    n = np.array([k for k, _, _ in learned])
    return [x for _, x, _ in learned], np.log(n / n.sum()), np.stack([c for _, _, c in learned], axis=1)


def _margins(texts: list[str | None], prior: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log of prior times likelihood (text x language), and whether a text has a letter."""
    total, seen = np.zeros((len(texts), prior.size)), np.zeros(len(texts), bool)
    step = max(1024, (1 << 20) // prior.size)
    columns = np.ascontiguousarray(matrix.T) if prior.size <= 8 else None  # a few columns are read faster one by one
    for text, bucket in batch_grams(texts):
        for at in range(0, text.size, step):
            own = text[at : at + step]
            first = np.flatnonzero(np.diff(own, prepend=-1))
            found = bucket[at : at + step]
            if columns is None:
                total[own[first]] += np.add.reduceat(matrix[found], first, axis=0, dtype=np.float64)
            else:
                for k, column in enumerate(columns):
                    total[own[first], k] += np.add.reduceat(column[found], first, dtype=np.float64)
            seen[own[first]] = True
    return total + prior, seen


def _best(texts: list[str | None], prior: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: the best language's number (the first on a tie), its margin, the normaliser less that margin, and
    whether there is a letter."""
    total, seen = _margins(texts, prior, matrix)
    best = total.argmax(axis=1)
    top = total[np.arange(len(texts)), best]
    return best, top, np.log(np.exp(np.clip(total - top[:, None], -700, 0)).sum(axis=1)), seen


def predict(texts: list[str | None], model: tuple[list[str], np.ndarray, np.ndarray]) -> tuple[list[str], list[float]]:
    """Language and posterior probability of each text."""
    langs, prior, matrix = model
    if not langs:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    best, _, rest, seen = _best(texts, prior, matrix)
    return [langs[k] if s else UNKNOWN for k, s in zip(best, seen)], np.where(seen, np.exp(-rest), 0.0).tolist()


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred``, ``score``."""
    if len(model[0]) > LANGS:
        return _identify_by_blocks(docs, model, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda c: [c[0], *predict(c[1], shared.value)]

    schema = T.StructType([docs.schema[id_col], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_batches(docs.select(F.col(id_col), F.col(text_col).cast("string")), make, schema)


def _identify_by_blocks(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], id_col: str, text_col: str) -> DataFrame:
    """One pass for each block of ``LANGS`` languages, reduced by row."""
    langs, prior, matrix = model
    rows = materialise(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col), F.col(text_col).cast("string").alias("text")), "langid-rows")
    schema = "row long, lang string, number int, top double, rest double"
    fields = T.StructType.fromDDL(schema)
    found = []
    for at in range(0, len(langs), LANGS):
        shared = docs.sparkSession.sparkContext.broadcast((langs[at : at + LANGS], prior[at : at + LANGS], np.ascontiguousarray(matrix[:, at : at + LANGS])))

        def make(shared=shared, at=at):
            def step(c):
                names, *own = shared.value
                best, top, rest, seen = _best(c[1], *own)
                return [c[0], [names[k] if s else None for k, s in zip(best, seen)], (best + at).tolist(), top.tolist(), rest.tolist()]

            return step

        found.append(materialise(map_batches(rows.select("row", "text"), make, fields), "langid-block"))
        shared.unpersist()
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    first = F.max(F.struct("top", (-F.col("number")).alias("number"), "lang")).alias("b")
    over = F.collect_list(F.struct("top", "rest")).alias("blocks")  # one for each block
    one = every.groupBy("row").agg(first, over)
    total = F.aggregate("blocks", F.lit(0.0), lambda s, x: s + F.exp(x["top"] + x["rest"] - F.col("b.top")))
    named = one.select("row", F.coalesce("b.lang", F.lit(UNKNOWN)).alias("lang_pred"), F.when(F.col("b.lang").isNull(), 0.0).otherwise(1 / total).alias("score"))
    return rows.select("row", id_col).join(named, "row").select(id_col, "lang_pred", "score")

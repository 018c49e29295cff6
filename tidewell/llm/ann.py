"""Approximate nearest neighbours by learned partitions.

Fit, on a bounded sample (the vectors whose ids hash lowest: ``SAMPLE`` of them, or ``PER_CELL`` for each part if
that is more, ``SAMPLE_VALUES`` components at most): a neighbour graph, its balanced partitioning (principal-axis
bisection, then moves of vertices to the part most of their neighbours are in, under a capacity), and a small network
that predicts from a vector how its neighbours are spread over the parts. The number of parts follows the number of
vectors up to ``MAX_PARTS``; the number of parts that a query probes is the least that finds ``TARGET`` of the sample's
true neighbours. Where vectors have no structure to learn that is most of the parts.

Index: every vector goes to its most probable part; a part is dealt into packs of about ``PACK`` vectors by a hash of
the id, so no pack grows with the data or with a part. Search: a query goes to all packs of its most probable parts,
queries meet packs by an equi-join, distances are computed exactly in double precision, and the nearest are merged.
The fit is for vectors of the commonest length (the smaller on a tie). A distance needs equal lengths, so vectors of
any other length are a part of their own for each length, which queries of that length search as a whole.

Edge cases: vectors that are null, zero or hold null or non-finite components, and rows of null id, take no part; rows
that repeat count once, different vectors of one id count as one candidate with its smallest distance; ties go to the smaller id; other columns are ignored; an
empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import bound_batches, lowest_hashes
from tidewell.session import materialise

#: Sample size, its vectors for each part, components it may hold in all; vectors per part aimed at, and the most parts; vectors of a pack; queries of a pack; graph degree; sought recall on the sample.
SAMPLE, PER_CELL, SAMPLE_VALUES, PER_PART, MAX_PARTS, PACK, QUERY_PACK, DEGREE, TARGET = 6144, 64, 1 << 22, 8192, 1024, 4096, 256, 10, 0.92


def _nearest(x: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """Rows of ``x`` nearest to each of its rows ``queries``, itself not counted; in blocks."""
    norm, out = (x * x).sum(axis=1), []
    for at in range(0, queries.size, 512):
        q = queries[at : at + 512]
        d = norm[None] - 2 * x[q] @ x.T
        d[np.arange(q.size), q] = np.inf
        out.append(np.argpartition(d, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1, seed: int = 3) -> np.ndarray:
    """Part of each row: balanced bisection, then neighbour majority under a capacity."""
    part, groups = np.zeros(len(x), np.int64), [np.arange(len(x))]
    while len(groups) < parts:
        halves = []
        for g in groups:
            y = x[g] - x[g].mean(axis=0)
            axis = np.linalg.eigh(y.T @ y)[1][:, -1] if len(g) > 1 else np.zeros(x.shape[1])
            order = g[np.argsort(y @ axis, kind="stable")]
            halves += [order[: len(g) // 2], order[len(g) // 2 :]]
        groups = halves
    for k, g in enumerate(groups):
        part[g] = k
    load, capacity = np.bincount(part, minlength=parts), slack * len(x) / parts
    both = [[] for _ in x]
    for i, near in enumerate(graph.tolist()):
        both[i] += near
        for j in near:
            both[j].append(i)
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0
        for i in rng.permutation(len(x)):
            votes = np.bincount(part[both[i]], minlength=parts)
            best = int(np.where(load < capacity, votes, -1).argmax())
            if votes[best] > votes[part[i]]:
                load[part[i]] -= 1
                load[best] += 1
                part[i], moved = best, moved + 1
        if moved < len(x) / 500:
            break
    return part


class Router:
    """One hidden layer; log probabilities of the parts."""

    def __init__(self, x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 60, rate: float = 3e-3, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std() + 1e-12
        sizes = [(x.shape[1], hidden), (1, hidden), (hidden, target.shape[1]), (1, target.shape[1])]
        w = [rng.normal(0, 1 / np.sqrt(a), (a, b)) if a > 1 else np.zeros((a, b)) for a, b in sizes]
        m, v, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
        z = (x - self.mean) / self.scale
        for _ in range(epochs):
            order = rng.permutation(len(z))
            for at in range(0, len(z), 256):
                own = order[at : at + 256]
                h = np.maximum(z[own] @ w[0] + w[1], 0)
                e = (self._soft(h @ w[2] + w[3]) - target[own]) / own.size
                back = (e @ w[2].T) * (h > 0)
                t += 1
                for k, g in enumerate((z[own].T @ back, back.sum(axis=0, keepdims=True), h.T @ e, e.sum(axis=0, keepdims=True))):
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    w[k] = w[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8) - rate * 1e-3 * w[k]
        self.w = w

    @staticmethod
    def _soft(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x - self.mean) / self.scale @ self.w[0] + self.w[1], 0)
        return h @ self.w[2] + self.w[3]


def fit(x: np.ndarray, parts: int, k: int = DEGREE, target: float = TARGET) -> tuple[Router | None, int]:
    """The router and the number of parts to probe; None where one part will do."""
    if parts < 2 or len(x) <= 4 * k:
        return None, 1
    rng = np.random.default_rng(11)
    held = rng.permutation(len(x))[: min(len(x) // 6, 1000)]
    rest = np.setdiff1d(np.arange(len(x)), held)
    graph = _nearest(x[rest], np.arange(rest.size), k)
    part = balanced_parts(x[rest], graph, parts)
    own = np.eye(parts)[part]
    router = Router(x[rest], 0.3 * own + 0.7 * own[graph].mean(axis=1))
    where, ranked = router.logits(x).argmax(axis=1), np.argsort(-router.logits(x[held]), axis=1)
    near = where[_nearest(x, held, k)]
    found = np.cumsum([(near == ranked[:, p : p + 1]).mean() for p in range(parts)])
    return router, int(np.searchsorted(found, target) + 1) if found[-1] >= target else parts


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    fine = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec_col, lambda x: x != 0)
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).filter(fine)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` (Euclidean distance): the ``k`` nearest found of each query,
    which itself is no candidate."""
    spark = vectors.sparkSession
    rows, asked = _usable(vectors, id_col, vec_col), _usable(queries, id_col, vec_col)
    sizes = sorted((-r["n"], r["d"]) for r in rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect())
    dims, total = (sizes[0][1], -sizes[0][0]) if sizes else (0, 0)
    plain = F.size("v") == dims
    parts = 16
    while parts < MAX_PARTS and parts * PER_PART < total:
        parts *= 2
    limit = max(1, min(max(SAMPLE, parts * PER_CELL), SAMPLE_VALUES // max(1, dims)))
    sample = [np.array(r["v"], np.float64) for r in lowest_hashes(rows.filter(plain), "id", limit).orderBy("id").select("v").toLocalIterator()]
    x = np.unique(np.array(sample).reshape(len(sample), dims), axis=0)
    while parts > 1 and parts * PER_CELL > len(x):
        parts //= 2
    router, probes = fit(x, parts, k)
    shared = spark.sparkContext.broadcast(router)

    def route(count):
        def run(batches):
            for batch in batches:
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                near = np.zeros((len(x), 1), np.int32) if shared.value is None else np.argsort(-shared.value.logits(x), axis=1, kind="stable")[:, :count].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, near.size + 1, near.shape[1], dtype=np.int32)), pa.array(near.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["id", "v", "parts"])

        return run

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.ArrayType(T.DoubleType())), T.StructField("parts", T.ArrayType(T.IntegerType()))])
    bound_batches(spark, 4096)
    own_part = F.array(-F.size("v")).alias("parts")  # of vectors of another length
    index = rows.filter(plain).mapInArrow(route(1), schema).union(rows.filter(~plain).select("id", "v", own_part))
    index = materialise(index.select("id", "v", F.get("parts", 0).alias("part")), "ann-index")
    dealt = index.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / PACK).cast("int").alias("packs"))
    packs = {r["part"]: r["packs"] for r in dealt.filter("part >= 0").collect()}  # a row per part
    packs_of = F.coalesce(F.get(F.array(*(F.lit(packs.get(p, 1)) for p in range(max(packs, default=0) + 1))), F.greatest("part", F.lit(0))), F.lit(1))

    def counted(df: DataFrame) -> DataFrame:
        """With ``packs`` of the row's part; other lengths look it up, of which there may be any number."""
        others = df.filter("part < 0").join(dealt.filter("part < 0"), "part").select(*df.columns, "packs")
        return df.filter("part >= 0").withColumn("packs", packs_of).union(others)

    held = counted(index).groupBy("part", F.pmod(F.xxhash64("id"), "packs").cast("int").alias("pack")).agg(F.collect_set(F.struct("id", "v")).alias("c"))
    routed = asked.filter(plain).mapInArrow(route(probes), schema).union(asked.filter(~plain).select("id", "v", own_part)).select("id", "v", F.explode("parts").alias("part"))
    n_asked = max(1, -(-queries.count() // QUERY_PACK))
    sent = routed.groupBy("part", F.pmod(F.xxhash64("id"), F.lit(n_asked)).alias("q")).agg(F.collect_set(F.struct("id", "v")).alias("asked"))
    sent = counted(sent).select("part", "asked", F.explode(F.sequence(F.lit(0), F.col("packs") - 1)).alias("pack"))
    met = held.join(sent, ["part", "pack"]).select(F.col("c.id").alias("i"), F.col("c.v").alias("v"), F.col("asked.id").alias("qi"), F.col("asked.v").alias("qv"))

    def compare(batches):
        for batch in batches:
            out = [[], [], []]
            for ids, vecs, query_ids, query_vecs in zip(*batch.columns):  # a pack and a block of queries
                ids, query_ids = (c.values.to_numpy() for c in (ids, query_ids))
                vecs, query_vecs = (c.values.flatten().to_numpy().reshape(n, -1) for c, n in ((vecs, ids.size), (query_vecs, query_ids.size)))
                for query, vector in zip(query_ids, query_vecs):
                    d = vecs - vector
                    d = np.sqrt(np.einsum("ij,ij->i", d, d))
                    d[ids == query] = np.inf
                    near = np.flatnonzero(d <= np.partition(d, min(k, d.size) - 1)[min(k, d.size) - 1])
                    near = near[np.isfinite(d[near])]
                    near = near[np.lexsort((ids[near], d[near]))]
                    near = near[np.sort(np.unique(ids[near], return_index=True)[1])][:k]
                    for column, values in zip(out, (np.full(near.size, query), ids[near], d[near])):
                        column.append(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

    bound_batches(spark)
    found = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    best = met.mapInArrow(compare, found).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

"""SimHash near-dedup by segment-popcount embedding.

A fingerprint's 32 segments of two bits are mapped to their bit counts, a point of the grid {0,1,2}^32. The Manhattan
distance of two points is a lower bound of the fingerprints' Hamming distance, so fingerprints that link are at most
``DISTANCE`` apart on the grid. Counts are stored in thermometer code (0, 01, 11): the Manhattan distance is then the
number of differing bits. The range join splits the grid's axes into six blocks; two points within distance 3 differ
in three blocks at most, so they share the cell of the other three in one of 20 projections. Candidates that share a
cell are held against the Manhattan bound and then verified exactly.

A cell with more than ``HOT`` distinct fingerprints isn't paired: its fingerprints go to a finer projection (5 of 8
blocks of the bits themselves), and where that is crowded, to 13 of 16 blocks, whose cells have 4,096 members at most
by construction. No link is lost. Within a cell only the edges of a spanning forest are emitted, since components are
asked for, and exact copies are one fingerprint from the start.

Edge cases: null and empty texts and texts without words have fingerprint 0, which links as any other; repeated rows
give repeated results; a null id never becomes a component's id unless all its ids are null; other columns are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import ROW_KEY, bound_batches, map_batches, row_key, stand_in
from tidewell.operators.graph import components, salted_join
from tidewell.session import materialise, scratch

#: Words of a shingle, seed of their hash, differing bits of a link, and distinct fingerprints a cell may pair.
SHINGLE, SEED, DISTANCE, HOT = 3, 42, 3, 512
_EVEN = 0x5555555555555555


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    runs = zip(*(words[k:] for k in range(size))) if len(words) >= size else [words]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED)), np.uint64)
    votes = np.zeros(64, np.int64)
    for at in range(0, hashes.size, 1 << 15):
        part = hashes[at : at + (1 << 15)]
        votes += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > hashes.size, bitorder="little").view("<u8")[0])


def thermometer(fp: Column) -> Column:
    """The embedding: bit counts of the 32 segments, 0 as 00, 1 as 01, 2 as 11."""
    low, high = fp.bitwiseAND(F.lit(_EVEN)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_EVEN))
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _masks(edges: list[int], keep: int) -> list[int]:
    """For each choice of ``keep`` blocks (``edges``: where blocks begin and end) the signed mask of their bits."""
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [(m ^ (1 << 63)) - (1 << 63) for m in (sum(x) for x in combinations(blocks, keep))]


#: (embedded?, masks of the projections, cells of this level are bounded by construction)
LEVELS = (
    (True, _masks([0, 12, 22, 32, 42, 52, 64], 3), False),
    (False, _masks(list(range(0, 65, 8)), 5), False),
    (False, _masks(list(range(0, 65, 4)), 13), True),
)


def forest(fps: list[int], distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Edges that connect what links within one cell: one per fingerprint at most."""
    x = np.array(fps, np.int64).view(np.uint64)
    if x.size == 2:
        return [(min(fps), max(fps))] if np.bitwise_count(x[0] ^ x[1]) <= distance else []
    even = np.uint64(_EVEN)
    low, high = x & even, x >> np.uint64(1) & even
    t = low | high | (low & high) << np.uint64(1)
    left, edges = np.arange(x.size), []
    while left.size:  # breadth first from the least that is left
        front, left = left[:1], left[1:]
        while front.size and left.size:
            reached = []
            for at in range(0, front.size, 64):
                part = front[at : at + 64]
                near = np.bitwise_count(t[left][:, None] ^ t[part]) <= distance  # the Manhattan bound
                near &= np.bitwise_count(x[left][:, None] ^ x[part]) <= distance
                hit = near.any(axis=1)
                edges += zip(x[part[near[hit].argmax(axis=1)]].view(np.int64).tolist(), x[left[hit]].view(np.int64).tolist())
                reached.append(left[hit])
                left = left[~hit]
                if not left.size:
                    break
            front = np.concatenate(reached)
    return [(min(e), max(e)) for e in edges]


def links(fps: DataFrame, hot: int = HOT) -> DataFrame:
    """Edges ``u < v`` that connect distinct fingerprints (column ``fp``) as all links within ``DISTANCE`` do."""
    bound_batches(fps.sparkSession)
    found, left = [], fps.select("fp")
    for level, (embedded, masks, bounded) in enumerate(LEVELS):
        base = thermometer(F.col("fp")) if embedded else F.col("fp")
        cells = F.array(*(F.struct(F.lit(k).alias("p"), base.bitwiseAND(F.lit(m)).alias("cell")) for k, m in enumerate(masks)))
        keyed = left.select("fp", F.inline(cells))
        counts = keyed.groupBy("p", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        counts = materialise(counts, f"simhash-cells{level}")
        paired = keyed.join(counts.filter(F.lit(True) if bounded else F.col("n") <= hot).drop("n"), ["p", "cell"])
        paired = materialise(paired, f"simhash-paired{level}")  # apart from the grouping, so that AQE can split crowded cells in the join
        lists = paired.groupBy("p", "cell").agg(F.collect_list("fp").alias("fps")).select("fps")

        def make():
            return lambda c: list(map(list, zip(*(e for x in c[0] for e in forest(x))))) or [[], []]

        schema = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])
        found.append(map_batches(lists, make, schema).distinct())
        crowded = counts.filter(F.col("n") > hot)
        if bounded or crowded.isEmpty():
            break
        left = materialise(keyed.join(crowded.drop("n"), ["p", "cell"], "left_semi").select("fp").distinct(), f"simhash-crowded{level}")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct() if len(found) > 1 else out


def _grouped(docs: DataFrame, id_col: str, text_col: str, size: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """Rows (``id_col``, ``fp``), and for each fingerprint ``best``, the key of the row that its component keeps: the
    least id (null after all others), then the least hash of the text. Two written tables."""

    def make():
        return lambda c: [c[0], c[1], [(x ^ (1 << 63)) - (1 << 63) for x in (fingerprint(t, size) for t in c[2])]]

    kind = docs.schema[id_col].dataType
    schema = T.StructType([docs.schema[id_col], T.StructField("th", T.LongType()), T.StructField("fp", T.LongType())])
    rows = map_batches(docs.select(F.col(id_col), F.xxhash64(text_col).alias("th"), F.col(text_col).cast("string")), make, schema)
    with scratch() as kept:
        rows = materialise(rows, "simhash-rows")
        place = F.struct(F.col(id_col).isNull().alias("none"), stand_in(id_col, kind).alias("id"), "th")
        distinct = materialise(rows.groupBy("fp").agg(F.min(place).alias("first")), "simhash-distinct")
        linked = materialise(components(links(distinct, hot)).withColumnRenamed("node", "fp").join(distinct, "fp"), "simhash-linked")
        least = linked.groupBy("label").agg(F.min("first").alias("best"))
        of = salted_join(linked.select("fp", "label"), least, "label", "fp").select("fp", "best")
        every = distinct.join(of, "fp", "left").select("fp", F.coalesce("best", "first").alias("best"))
        every = materialise(every, "simhash-every")  # apart from the join, so that AQE can split a fingerprint of many copies
        kept += [rows, every]
    return rows, every


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, hot: int = HOT) -> DataFrame:
    """``id_col``, ``fp``, ``component_id``: the smallest id that links reach from the row's fingerprint."""
    rows, every = _grouped(docs, id_col, text_col, size, hot)
    return rows.join(every, "fp").select(id_col, "fp", F.when(~F.col("best.none"), F.col("best.id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, hot: int = HOT) -> DataFrame:
    """One row of each component, all its columns: the least id (null after all others), then the least hash of the
    text. What is decided is decided for the row, so a row stays if another text of its id goes. Of rows that repeat
    both id and text one stays; if they differ in other columns, which one is open."""
    _, every = _grouped(docs, id_col, text_col, size, hot)
    keys = [f"_{k}_" for k in ROW_KEY]
    whole = docs.select(F.struct("*").alias("row"), *(c.alias(k) for c, k in zip(row_key(docs, id_col, text_col), keys)))
    return whole.join(every.select("best.*").distinct().toDF(*keys), keys, "left_semi").dropDuplicates(keys).select("row.*")

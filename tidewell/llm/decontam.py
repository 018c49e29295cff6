"""Benchmark decontamination: test windows of ten words are looked for in every training text.

Texts are lower-cased (A-Z) and split into words of digits, a-z and non-ASCII characters. An item's windows are its
runs of ``n`` consecutive words; an item of fewer words, but not none, is one window. A word inside any occurrence of
a window is hit.

While the benchmark's texts are at most ``MAX_BROADCAST`` bytes (measured first), a hash set of their windows is
broadcast: words become vocabulary numbers, a window a 64-bit polynomial of them, and each match is verified word by
word. A larger benchmark is joined by shuffle instead, on the windows themselves; results are the same.

Edge cases: null and empty texts have no words and aren't contaminated; an item without words never occurs; items of
one id count once, items of null id cover words but aren't counted; repeated rows give repeated results; an empty
benchmark hits nothing; other columns are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import keep_where, map_batches
from tidewell.session import materialise

#: Words per window, and bytes of benchmark text up to which its windows are broadcast.
WINDOW, MAX_BROADCAST = 10, 4 << 20

_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SPACE = 32
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TO_WORDS).split() if text else []


class WindowSet:
    """Hash set of the windows of some items, with the items that each occurs in."""

    def __init__(self, items: list[tuple], n: int):
        windows: dict[tuple, set] = {}
        for item_id, text in items:
            words = words_of(text)
            for i in range(max(1, len(words) - n + 1) if words else 0):
                windows.setdefault(tuple(words[i : i + n]), set()).add(None if item_id is None else str(item_id))
        self.vocab = {w: k for k, w in enumerate(sorted({w for x in windows for w in x}), 1)}
        self.by_length = {}
        for length in sorted({len(x) for x in windows}):
            own = [x for x in windows if len(x) == length]
            table = np.array([[self.vocab[w] for w in x] for x in own], np.int64)
            multiplier = 0x9E3779B97F4A7C15
            while len(np.unique(keys := self._keys(table.T, multiplier))) < len(own):
                multiplier += 2
            order = np.argsort(keys)
            self.by_length[length] = (multiplier, keys[order], table[order], [sorted(windows[own[i]] - {None}) for i in order])

    @staticmethod
    def _keys(columns, multiplier: int) -> np.ndarray:
        key = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            key = key * np.uint64(multiplier & (2**64 - 1)) + c.astype(np.uint64)
        return key

    def scan(self, text: str | None) -> tuple[int, int, list[str], list[tuple[int, int]]]:
        """Words, hit words, items that occur (sorted as strings), byte spans of the runs of hit words."""
        raw = text.encode().translate(_TO_WORDS) if text else b""
        words = raw.split()
        total = len(words)
        if not total or not self.by_length:
            return total, 0, [], []
        ids = np.fromiter(map(self.vocab.get, words, repeat(0)), np.int64, total)
        unknown = np.concatenate(([0], np.cumsum(ids == 0)))
        edges, items = None, set()
        for length, (multiplier, keys, table, owners) in self.by_length.items():
            if total < length:
                continue
            at = np.flatnonzero(unknown[length:] == unknown[:-length])
            if not at.size:
                continue
            found = self._keys([ids[at + j] for j in range(length)], multiplier)
            slot = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            same = keys[slot] == found
            at, slot = at[same], slot[same]
            if not at.size:
                continue
            same = (ids[at[:, None] + np.arange(length)] == table[slot]).all(axis=1)
            at, slot = at[same], slot[same]
            edges = np.zeros(total + 1, np.int64) if edges is None else edges
            np.add.at(edges, at, 1)
            np.add.at(edges, at + length, -1)
            for s in np.unique(slot):
                items.update(owners[s])
        if edges is None:
            return total, 0, [], []
        return total, *_covered(raw, np.cumsum(edges[:-1]) > 0, sorted(items))


def _covered(raw: bytes, hit: np.ndarray, items: list[str]) -> tuple[int, list[str], list[tuple[int, int]]]:
    """Hit words, items, byte spans of the runs of hit words; ``hit`` has a mark for each word of ``raw``."""
    letters = np.concatenate(([False], np.frombuffer(raw, np.uint8) != _SPACE, [False]))
    starts, ends = np.flatnonzero(letters[1:] & ~letters[:-1]), np.flatnonzero(~letters[1:] & letters[:-1])
    turn = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    spans = list(zip(starts[np.flatnonzero(turn == 1)].tolist(), ends[np.flatnonzero(turn == -1) - 1].tolist()))
    return int(hit.sum()), items, spans


def _spread(text: str | None, found: list | None, items: list[str] | None) -> tuple[int, int, list[str], list[tuple[int, int]]]:
    """What ``WindowSet.scan`` gives, from the windows found: (first word from 1, length)."""
    raw = text.encode().translate(_TO_WORDS) if text else b""
    total = len(raw.split())
    if not found:
        return total, 0, [], []
    edges = np.zeros(total + 1, np.int64)
    at, length = (np.array([x[k] for x in found], np.int64) for k in ("at", "length"))
    np.add.at(edges, at - 1, 1)
    np.add.at(edges, at - 1 + length, -1)
    return total, *_covered(raw, np.cumsum(edges[:-1]) > 0, list(items or []))


def _schema(docs: DataFrame, id_col: str) -> T.StructType:
    return T.StructType([docs.schema[id_col], T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", SPANS)])


def _measured(benchmark: DataFrame, item_col: str, text_col: str, bound: int) -> tuple[DataFrame, bool]:
    """The items as (item, text), and whether their texts are small enough to broadcast."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)) + F.count(F.lit(1))).first()[0]
    return items, size <= bound


def scan(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``id_col``, ``n_words``, ``n_hit``, ``items`` (ids as sorted strings), ``spans`` (UTF-8 byte offsets of the
    runs of hit words), one row per document."""
    items, small = _measured(benchmark, item_col, item_text_col, max_broadcast)
    if not small:
        return _scan_shuffled(docs, items, n, id_col, text_col)
    windows = docs.sparkSession.sparkContext.broadcast(WindowSet([tuple(r) for r in items.collect()], n))

    def make():
        own = windows.value
        return lambda c: [c[0], *map(list, zip(*(own.scan(x) for x in c[1])))]

    return map_batches(docs.select(F.col(id_col), F.col(text_col).cast("string")), make, _schema(docs, id_col))


def _words(text: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), upper, lower), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(parts, lambda x: x != "")


def _windows_of(length: int) -> Column:
    """All runs of ``length`` words of ``w``: (at, length, window)."""
    starts = F.when(F.size("w") >= length, F.sequence(F.lit(1), F.size("w") - length + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(i.alias("at"), F.lit(length).alias("length"), F.array_join(F.slice("w", i, length), " ").alias("window")))


def _hits(texts: DataFrame, items: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Windows of ``texts`` (``row``, ``text``; a written table) in the benchmark, as (row, at, length, window), and
    the benchmark's windows, as (item, window)."""
    spread = items.select("item", _words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    spread = spread.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1))), lambda i: F.array_join(F.slice("w", i, n), " "))).alias("window")).distinct()
    spread = spread.withColumn("length", F.size(F.split("window", " ")))
    lengths = [r[0] for r in spread.select("length").distinct().collect()]  # n values at most
    at = [_windows_of(k) for k in lengths]
    empty = F.array().cast("array<struct<at:int,length:int,window:string>>")
    hits = texts.select("row", _words(F.col("text")).alias("w")).select("row", F.explode(F.concat(empty, *at)).alias("x")).select("row", "x.*")
    hits = hits.join(spread.select("window").distinct(), "window").select("row", "at", "length", "window")
    return materialise(hits, "decontam-hits"), spread.select("item", "window")


def _scan_shuffled(docs: DataFrame, items: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """The same by joins: document windows meet distinct benchmark windows, each by its words."""
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text"))
    rows = materialise(rows, "decontam-texts")
    hits, spread = _hits(rows, items, n)
    found = hits.groupBy("row").agg(F.collect_list(F.struct("at", "length")).alias("found"))
    owners = hits.select("row", "window").distinct().join(spread.filter("item is not null"), "window").groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    out = rows.join(found, "row", "left").join(owners, "row", "left").select("id", "text", "found", "items")
    return map_batches(out, lambda: lambda c: [c[0], *map(list, zip(*map(_spread, *c[1:])))], _schema(docs, id_col))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Documents without a hit, all their columns; each row for itself, whatever its id."""
    items, small = _measured(benchmark, item_col, item_text_col, max_broadcast)
    if not small:
        rows = materialise(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "decontam-rows")
        hits, _ = _hits(rows.select("row", F.col("doc").getField(text_col).cast("string").alias("text")), items, n)
        return rows.join(hits.select("row").distinct(), "row", "left_anti").select("doc.*")
    windows = docs.sparkSession.sparkContext.broadcast(WindowSet([tuple(r) for r in items.collect()], n))

    def make():
        own = windows.value
        return lambda texts: [own.scan(x)[1] == 0 for x in texts]

    return keep_where(docs, text_col, make)


def cut_spans(text: str, spans: list) -> str:
    """``text`` without the given byte spans."""
    raw, out, last = text.encode(), [], 0
    for start, end in spans:
        out.append(raw[last:start])
        last = end
    return b"".join([*out, raw[last:]]).decode()

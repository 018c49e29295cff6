"""Substring dedup by hashing units of lines.

A text is cut into contiguous units: after each line end, and within a line after sentence marks that white space
follows once a unit has ``UNIT_WORDS`` words. A unit with words is normalised (lower case, white space collapsed) and
hashed (128 bits). Digests are grouped globally by one aggregation; the earliest occurrence in the order of (id, hash
of the text, position) is kept and all others are marked. Marked units of a document form a run while fewer than
``UNIT_WORDS`` words stand between two of them; the marked units of a run go if they hold ``min_words`` words
together, and nothing else goes. So every character that is removed stands in a unit that occurs earlier.

``min_words`` = 1 removes every repeated unit. The default, ``MIN_WORDS``, leaves short lines and sentences that
happen to repeat (headings, license lines) where they are.

Texts are cut and hashed once, in a stage of its own whose result is a table; the joins work on digests and positions.
Offsets of what is removed refer to the original text (characters).

Edge cases: null texts stay null and have no units; empty texts have none; units of white space are never marked; rows
that repeat as a whole are one place, so both keep or lose the same; a text of which all goes becomes empty, its row
stays; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import ROW_KEY, bound_batches, map_batches, row_key, stand_in
from tidewell.session import discard, materialise

#: Words that the marked units of a run hold at least, and words of a sentence that ends a unit (also: of a gap that ends a run).
MIN_WORDS, UNIT_WORDS = 20, 4
_END = re.compile(r"[.!?]+\s+|\n+")
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def cut(text: str | None) -> list[int]:
    """Where units begin, and the end of the text; empty for an empty text."""
    if not text:
        return []
    cuts = [0]
    for m in _END.finditer(text):
        if "\n" in m[0] or len(text[cuts[-1] : m.end()].split(None, UNIT_WORDS)) >= UNIT_WORDS:
            cuts.append(m.end())
    if cuts[-1] < len(text):
        cuts.append(len(text))
    return cuts


def units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: ``none`` (id is null), ``id``, ``th`` (hash of the text), ``cuts`` (where units begin, and
    the end), ``words`` (in front of each cut), ``digests`` (null for a unit without words)."""
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            cuts, words, raw, sizes = [], [], [], []
            for text in batch.column(2).to_pylist():
                own = cut(text)
                cuts += own
                total = 0
                words += [0] * bool(own)
                for a, b in zip(own, own[1:]):
                    unit = text[a:b].lower().split()
                    total += len(unit)
                    words.append(total)
                    raw.append(xxhash.xxh3_128_digest(" ".join(unit).encode()))
                sizes.append(len(own))
            sizes = np.array(sizes, np.int64)
            at = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
            unit_at = pa.array(np.concatenate(([0], np.cumsum(np.maximum(sizes - 1, 0)))), pa.int32())
            words = np.array(words, np.int32)
            starts = np.ones(words.size, bool)
            starts[np.cumsum(sizes)[sizes > 0] - 1] = False
            empty = np.diff(words, append=0)[starts] == 0
            halves = np.frombuffer(b"".join(raw), "<i8").reshape(-1, 2)
            digests = pa.StructArray.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1])], names=["d1", "d2"], mask=pa.array(empty))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(at, pa.array(np.array(cuts, np.int32))), pa.ListArray.from_arrays(at, pa.array(words)), pa.ListArray.from_arrays(unit_at, digests)],
                names=["id", "th", "cuts", "words", "digests"],
            )

    digest = T.StructType([T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType())])
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("th", T.LongType()), T.StructField("cuts", T.ArrayType(T.IntegerType())), T.StructField("words", T.ArrayType(T.IntegerType())), T.StructField("digests", T.ArrayType(digest))])
    return rows.mapInArrow(run, schema).withColumn("none", F.col("id").isNull())


def _stretches(items: Column, new: callable) -> Column:
    """``items`` in slices; ``new(a, b)`` tells whether a slice ends between two neighbours."""
    first = F.filter(F.sequence(F.lit(0), F.size(items) - 1), lambda k: (k == 0) | new(F.get(items, k - 1), F.get(items, k)))
    return F.transform(first, lambda lo, j: F.slice(items, lo + 1, F.coalesce(F.get(first, j + 1), F.size(items)) - lo))


def removed(cut_texts: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``none``, ``id``, ``th``, ``spans`` of the texts that lose something; ``cut_texts`` is the written table of
    :func:`units`."""
    kind = cut_texts.schema["id"].dataType
    found = cut_texts.select(*ROW_KEY, F.posexplode("digests").alias("pos", "d")).filter("d is not null").select(*ROW_KEY, "pos", "d.*")
    place = F.struct("id", "th", "pos")
    first = found.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1").drop("n")
    first = materialise(first, "substrdedup-first")  # apart from the join, so that a hot key of the join can be split
    later = found.join(first, ["d1", "d2"]).filter(place > F.col("first")).drop("d1", "d2", "first")
    marks = later.withColumn("id", stand_in("id", kind)).groupBy(*ROW_KEY).agg(F.sort_array(F.collect_set("pos")).alias("m"))
    texts = cut_texts.select("none", stand_in("id", kind).alias("id"), "th", "cuts", "words")
    before = lambda k: F.get("words", k)
    runs = _stretches(F.col("m"), lambda a, b: before(b) - before(a + 1) >= UNIT_WORDS)
    enough = lambda run: F.aggregate(run, F.lit(0), lambda n, k: n + before(k + 1) - before(k)) >= min_words
    rows = marks.join(texts, ROW_KEY).withColumn("runs", runs).select(*ROW_KEY, "cuts", F.flatten(F.filter("runs", enough)).alias("m")).filter(F.size("m") > 0)
    rows = rows.withColumn("s", _stretches(F.col("m"), lambda a, b: b != a + 1))
    span = lambda s: F.struct(F.get("cuts", F.get(s, F.lit(0))).alias("start"), F.get("cuts", F.element_at(s, -1) + 1).alias("end"))
    rows = rows.select(*ROW_KEY, F.transform("s", span).alias("spans")).groupBy(*ROW_KEY).agg(F.any_value("spans").alias("spans"))  # rows that repeat
    spans = materialise(rows, "substrdedup-spans")
    discard(first)
    return spans


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``id_col``, ``text_col`` cleaned, ``spans`` (characters of the original that go), ``n_removed`` (characters)."""
    cut_texts = materialise(units(docs, id_col, text_col), "substrdedup-units")
    spans = removed(cut_texts, min_words)
    discard(cut_texts)
    rows = docs.select(F.col(id_col).alias("own"), F.col(text_col).cast("string").alias("text"), *row_key(docs, id_col, text_col))
    rows = rows.join(spans, ROW_KEY, "left").select("own", "text", "spans")

    def make():
        def step(columns):
            texts, gone = [], []
            for text, spans in zip(columns[1], columns[2]):
                edges = [0, *(x for s in spans or () for x in (s["start"], s["end"])), len(text or "")]
                texts.append("".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])) if spans else text)
                gone.append(sum(s["end"] - s["start"] for s in spans or ()))
            return [columns[0], texts, [s or [] for s in columns[2]], gone]

        return step

    schema = T.StructType([docs.schema[id_col], T.StructField(text_col, T.StringType()), T.StructField("spans", SPANS), T.StructField("n_removed", T.LongType())])
    return map_batches(rows, make, schema)

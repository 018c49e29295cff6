"""Line dedup over overlapping three-line windows, in DataFrame operations only.

Each run of three consecutive lines of a text is a window; its hash is taken from the hashes of its lines. Windows
that occur more than once, in any document, are found by one global aggregation; every occurrence after the first,
in the order of (id, hash of the text, position), is later. Later occurrences cover their three positions; covered
positions of a document are merged and those lines go. A covered line always has an earlier copy, so at least one
copy of every line stays.

Windows of blank lines only don't count. Window identity is 96 bits: each line is hashed by xxHash64 and by Murmur3, and
a window by both again, each over its own line hashes.

Edge cases: null texts stay null; texts of fewer than three lines stay as they are; a text whose lines all go becomes
the empty text, its row stays; rows that repeat as a whole are one place, so both keep or lose the same lines; other
columns are kept; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialise

#: Lines of a window.
WINDOW = 3


def _windows(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    lines = F.split(F.col(text_col), "\n")
    hashed = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"),
        F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("h"), F.hash(x).alias("g"), (F.trim(x) != "").alias("full"))).alias("l"),
    ).filter(F.size("l") >= size)

    def window(i):
        part = [F.element_at("l", i + k) for k in range(1, size + 1)]
        full = part[0]["full"]
        for x in part[1:]:
            full = full | x["full"]
        return F.struct(i.alias("pos"), F.xxhash64(*(x["h"] for x in part)).alias("w1"), F.hash(*(x["g"] for x in part)).alias("w2"), full.alias("full"))

    at = F.sequence(F.lit(0), F.size("l") - size)
    return hashed.select("id", "th", F.inline(F.filter(F.transform(at, window), lambda w: w["full"]))).drop("full")


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """``id``, ``th`` (hash of the text), ``starts array<int>``: where later occurrences of windows begin."""
    windows = _windows(docs, id_col, text_col, size)
    place = F.struct("id", "th", "pos")
    first = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1").drop("n")
    first = materialise(first, "linededup-first")  # apart from the join, so that a hot key of the join can be split
    later = windows.join(first, ["w1", "w2"]).filter(place > F.col("first"))
    return later.groupBy("id", "th").agg(F.collect_set("pos").alias("starts"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` with ``text_col`` cleaned, and ``n_lines_``, ``n_removed_`` (lines before, lines gone),
    which replace columns of these names."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("h"))
    rows = rows.join(repeated(docs, id_col, text_col, size), F.col("i").eqNullSafe(F.col("id")) & (F.col("h") == F.col("th")), "left")
    covered = F.flatten(F.transform("starts", lambda p: F.sequence(p, p + (size - 1))))
    rows = rows.withColumn("l", F.split("t", "\n"))
    rows = rows.withColumn("kept", F.when(F.col("starts").isNotNull(), F.array_except(F.sequence(F.lit(0), F.size("l") - 1), covered)))
    clean = F.when(F.col("kept").isNull(), F.col("t")).otherwise(F.array_join(F.transform("kept", lambda i: F.get("l", i)), "\n"))
    total = F.when(F.col("t").isNull(), 0).otherwise(F.size("l")).cast("long")
    gone = F.when(F.col("kept").isNull(), 0).otherwise(F.size("l") - F.size("kept")).cast("long")
    columns = [clean.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns if c not in ("n_lines_", "n_removed_")]
    return rows.select(*columns, total.alias("n_lines_"), gone.alias("n_removed_"))

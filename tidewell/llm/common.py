"""What the operators share: bounded Arrow batches and row-wise mapping in Python workers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StringType, StructType

from tidewell.session import ship_code

#: Rows and bytes that one Arrow batch holds at most, so that a worker's memory doesn't follow text length.
BATCH_ROWS, BATCH_BYTES = 256, 8 << 20


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the session's Arrow batches (a smaller bound that it already has stays) and send workers the code."""
    ship_code(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    except Exception:  # a Spark release without that setting
        pass


def map_batches(df: DataFrame, make: Callable[[], Callable[[list[list]], list[list]]], schema: StructType) -> DataFrame:
    """``mapInArrow`` over lists of column values.

    ``make()`` runs once per task and returns a function from input columns to output columns.
    """
    bound_batches(df.sparkSession)
    types = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                columns = step([batch.column(i).to_pylist() for i in range(batch.num_columns)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, types)], schema=types)

    return df.mapInArrow(run, schema)


def keep_where(df: DataFrame, column: str, make: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The rows, all their columns, for which a function of one column is true; no join, no shuffle.

    ``make()`` runs once per task and returns a function from a list of values to a list of booleans.
    """
    bound_batches(df.sparkSession)
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = make()
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(keep(batch.column(at).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


#: Columns that tell rows apart by id and text and can be compared plainly: id is null, id (or a stand-in), hash of the text.
ROW_KEY = ["none", "id", "th"]


def stand_in(column: Column | str, kind: DataType) -> Column:
    """The column, with a value in place of null; :data:`ROW_KEY` has a mark beside it."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("" if isinstance(kind, StringType) else 0).cast(kind))


def row_key(df: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """The columns of :data:`ROW_KEY` for the rows of ``df``."""
    return [F.col(id_col).isNull().alias("none"), stand_in(id_col, df.schema[id_col].dataType).alias("id"), F.xxhash64(text_col).alias("th")]


def fold(doc_id: Column | str, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; 0 marks the held-out rows, null ids fall in fold 0."""
    return F.coalesce(F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary")) % folds, F.lit(0))


def _lowest(df: DataFrame, h: Column, limit: int) -> tuple[int, int | None]:
    """The largest of the ``limit`` lowest values of a hash, and how many rows are below it."""
    low = df.select(h.alias("h")).orderBy("h").limit(limit).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    top, n = low.agg(F.max(F.struct("h", "n")), F.sum("n")).first()
    return (0, None) if top is None else (n - top["n"], top["h"])


def lowest_hashes(df: DataFrame, id_col: str, limit: int) -> DataFrame:
    """The rows whose ids hash lowest, ``limit`` of them at most: a bounded, repeatable sample of whole rows.

    Only hashes are ordered (``limit`` per task); the rows are then filtered by the largest hash that is kept. Where an
    id at that hash repeats past the limit, its rows are taken by the hash of the whole row; rows that are equal in
    every column are as good as each other."""
    h = F.xxhash64(id_col)
    below, at = _lowest(df, h, limit)
    if at is None:
        return df.limit(0)
    if below + df.filter(h == at).count() <= limit:
        return df.filter(h <= at)
    ties, whole = df.filter(h == at), F.xxhash64(*df.columns)
    under, edge = _lowest(ties, whole, limit - below)
    return df.filter(h < at).union(ties.filter(whole < edge)).union(ties.filter(whole == edge).limit(limit - below - under))

"""Chunked arrays (zarr v2 layout) as tables: one row per chunk that exists; absent chunks are absent rows, never zeros."""

from __future__ import annotations

import json
import math
import os
import re
import shutil
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from tidewell.session import ship_code
from tidewell.sources.listing import listing, opened

SCHEMA = "chunk array<int>, origin array<int>, shape array<int>, values array<double>"


def metadata(spark: SparkSession, store: str) -> dict:
    """The array's own description: shape, chunks, dtype, order, compressor. Spark's listings skip names with a
    leading dot, so this one small file is read on the driver, by Hadoop's file system of the path."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(f"{store}/.zarray")
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def decoded(raw: bytes, codec: dict | None) -> bytes:
    """Bytes of a chunk; no compressor, zlib and gzip, and zstd are known."""
    name = (codec or {}).get("id")
    if name is None:
        return raw
    if name in ("zlib", "gzip"):
        return zlib.decompress(raw, 47)
    if name == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    raise ValueError(f"unknown compressor {name}")


class Ranks(InputPartition):
    """Chunks of the grid between two ranks, in C order within bounds for each axis."""

    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class ChunkReader(DataSourceReader):
    """Chunks by their place in the grid: names follow from places, so nothing is listed, and filters on the axes' columns
    bound the places before a file is opened."""

    def __init__(self, store: str, meta: dict, group: int):
        self.store, self.meta, self.group = store, meta, group
        self.bounds = [[0, -(-s // c)] for s, c in zip(meta["shape"], meta["chunks"])]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            axis = int(f.attribute[0][1:]) if hasattr(f, "attribute") and len(f.attribute) == 1 and re.fullmatch(r"c\d+", f.attribute[0]) else None
            if axis is None or not self._bound(self.bounds[axis], f):
                yield f

    @staticmethod
    def _bound(bounds: list[int], f: Filter) -> bool:
        low, high = bounds
        match f:
            case EqualTo(value=v):
                low, high = max(low, v), min(high, v + 1)
            case GreaterThan(value=v):
                low = max(low, v + 1)
            case GreaterThanOrEqual(value=v):
                low = max(low, v)
            case LessThan(value=v):
                high = min(high, v)
            case LessThanOrEqual(value=v):
                high = min(high, v + 1)
            case IsNotNull():
                return True
            case _:
                return False
        bounds[:] = low, max(low, high)
        return True

    def partitions(self) -> list[Ranks]:
        n = math.prod(high - low for low, high in self.bounds)
        return [Ranks(k, min(n, k + self.group)) for k in range(0, max(n, 1), self.group)]

    def read(self, partition: Ranks) -> Iterator[tuple]:
        files, path = opened(self.store)
        shape, chunks, codec = self.meta["shape"], self.meta["chunks"], self.meta.get("compressor")
        kind, order = np.dtype(self.meta["dtype"]), self.meta.get("order", "C")
        sizes = [high - low for low, high in self.bounds]
        for rank in range(partition.low, partition.high):
            at = [int(i) + low for i, (low, _) in zip(np.unravel_index(rank, sizes), self.bounds)]
            raw = self._content(files, path, at)
            if raw is None:
                continue
            origin = [i * c for i, c in zip(at, chunks)]
            real = [min(c, s - o) for c, s, o in zip(chunks, shape, origin)]
            try:
                block = np.frombuffer(decoded(raw, codec), kind).reshape(chunks, order=order)
                values, error = block[tuple(slice(0, n) for n in real)].astype(np.float64).ravel().tolist(), None
            except Exception as broken:  # whatever a codec raises: the chunk is there and can't be read
                values, error = None, f"{type(broken).__name__}: {broken}"
            yield (*at, at, origin, real, values, error)

    @staticmethod
    def _content(files: fs.FileSystem, path: str, at: list[int]) -> bytes | None:
        for sep in "./":
            try:
                with files.open_input_stream(f"{path}/{sep.join(map(str, at))}") as stream:
                    return stream.read()
            except (FileNotFoundError, NotADirectoryError):
                pass
        return None


class ChunkSource(DataSource):
    """``spark.read.format("tidewell_chunks").load(store)``: a chunk that exists is a row, with its place as ``c0``, ``c1``
    ... and what went wrong as ``error``. Option ``group``: places that a task tries."""

    @classmethod
    def name(cls) -> str:
        return "tidewell_chunks"

    def _store(self) -> tuple[str, dict]:
        store = self.options["path"].rstrip("/")
        files, path = opened(store)
        with files.open_input_stream(f"{path}/.zarray") as stream:
            return store, json.loads(stream.read())

    def schema(self) -> str:
        return ", ".join([*(f"c{k} int" for k in range(len(self._store()[1]["shape"]))), SCHEMA, "error string"])

    def reader(self, schema) -> ChunkReader:
        return ChunkReader(*self._store(), int(self.options.get("group", "64")))


def chunk_table(spark: SparkSession, store: str, group: int = 64) -> DataFrame:
    """The store as :class:`ChunkSource` gives it; filters on ``c0``, ``c1`` ... reach the source. The store must be mounted
    everywhere or in a file system that Arrow knows."""
    ship_code(spark)
    spark.dataSource.register(ChunkSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("tidewell_chunks").option("group", str(group)).load(store)


def read_chunks(spark: SparkSession, store: str, within: dict[int, tuple[int, int]] | None = None) -> DataFrame:
    """``chunk`` (grid index), ``origin``, ``shape`` (clipped at the array's end), ``values`` (C order) of each chunk.

    ``within`` keeps, per axis, only chunks that meet the range [low, high): no other file is opened. Chunk names may be
    dotted or nested. A chunk that can't be decoded is an error."""
    rows = chunk_table(spark, store)
    sizes = metadata(spark, store)["chunks"]
    for axis, (low, high) in (within or {}).items():
        rows = rows.filter((F.col(f"c{axis}") >= low // sizes[axis]) & (F.col(f"c{axis}") <= (high - 1) // sizes[axis]))
    whole = F.when(F.col("error").isNull(), F.col("values")).otherwise(F.raise_error(F.concat(F.lit("chunk "), F.to_json("chunk"), F.lit(": "), "error")))
    return rows.select("chunk", "origin", "shape", whole.alias("values"))


def occupancy(spark: SparkSession, store: str) -> float:
    """Share of the array's voxels that aren't zero, absent chunks counting as zeros; -1 if a chunk can't be read."""
    size = math.prod(metadata(spark, store)["shape"])
    full = F.size(F.filter("values", lambda v: v != 0))
    broken, n = chunk_table(spark, store).agg(F.count("error"), F.sum(full)).first()
    return -1.0 if broken else (n or 0) / size


def voxels(chunks: DataFrame, axes: list[str]) -> DataFrame:
    """One row per voxel: its index along each named axis and its value ``v``."""
    rows = chunks.select("origin", "shape", F.posexplode("values").alias("k", "v"))
    step = F.lit(1)
    out = []
    for axis in reversed(range(len(axes))):
        out.append((F.get("origin", axis) + (F.floor(F.col("k") / step) % F.get("shape", axis)).cast("int")).alias(axes[axis]))
        step = step * F.get("shape", axis)
    return rows.select(*reversed(out), "v")


def declared_and_written(spark: SparkSession, store: str) -> tuple[int, int]:
    """Timepoints that a store declares, and those it has chunks of: numbered names at the top, at most the declared."""
    declared = metadata(spark, store)["shape"][0]
    top = listing(spark, store).select(F.regexp_extract("rel", r"^(\d+)(?:[./]|$)", 1).alias("t")).filter("t <> ''")
    return declared, min(declared, top.distinct().count())


def write_store(frames: DataFrame, path: str, shape: tuple[int, int, int], dtype: str, labels: list[str], voxel_um: float, time_interval_s: float = 1.0) -> str:
    """Assemble frames (``t``, ``c``, ``values`` in C order) into one (t, c, z, y, x) store, one chunk for each frame.

    t and c are ranks among those that occur; a missing frame stays a hole, which reads as zeros. Chunks are written by
    the executors into a folder beside the store, which then takes its place in one step. The folder must be mounted
    everywhere. The store's name, channels, voxel size, interval and the frames that are done are its attributes."""
    ship_code(frames.sparkSession)
    times, channels = ([r[0] for r in frames.select(a).distinct().orderBy(a).collect()] for a in ("t", "c"))
    if not times:
        raise FileNotFoundError("no frames")
    target = path.removeprefix("file://").rstrip("/")
    part, kind, names = f"{target}.tmp", np.dtype(dtype), [f"C{c}" for c in channels]
    shutil.rmtree(part, ignore_errors=True)
    os.makedirs(f"{part}/0")
    rank_t, rank_c = {t: k for k, t in enumerate(times)}, {c: k for k, c in enumerate(channels)}

    def run(batches):
        for batch in batches:
            done = []
            for t, c, values in zip(*(batch.column(i) for i in range(3))):
                cell = [rank_t[t.as_py()], rank_c[c.as_py()]]
                block = values.values.to_numpy(zero_copy_only=False).reshape(shape).astype(kind)
                own = f"{part}/0/.{cell[0]}.{cell[1]}.{uuid.uuid4().hex}"
                with open(own, "wb") as out:
                    out.write(zlib.compress(block.tobytes(), 1))
                os.replace(own, f"{part}/0/{cell[0]}.{cell[1]}.0.0.0")  # a repeated task writes the same chunk again
                done.append(cell)
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.int32()) for k in (0, 1)], names=["t", "c"])

    done = sorted((r.t, r.c) for r in frames.select("t", "c", "values").mapInArrow(run, "t int, c int").distinct().collect())
    array = {"zarr_format": 2, "shape": [len(times), len(channels), *shape], "chunks": [1, 1, *shape], "dtype": kind.str, "compressor": {"id": "zlib", "level": 1}, "fill_value": 0, "order": "C", "filters": None, "dimension_separator": "."}
    scale = [time_interval_s, 1.0, voxel_um, voxel_um, voxel_um]
    name = os.path.basename(target)
    attributes = {
        "multiscales": [{"name": name.removesuffix(".ome.zarr"), "axes": list("tczyx"), "datasets": [{"path": "0", "coordinateTransformations": [{"type": "scale", "scale": scale}]}]}],
        "omero": {"name": name, "channels": [{"label": x} for x in (labels or names)]},
        "progress": {"n_t": len(times), "n_c": len(channels), "done": [list(d) for d in done], "state": "complete"},
    }
    for file, document in (("0/.zarray", array), (".zattrs", attributes), (".zgroup", {"zarr_format": 2})):
        with open(f"{part}/{file}", "w") as out:
            json.dump(document, out)
    shutil.rmtree(target, ignore_errors=True)
    os.replace(part, target)
    return target


def mirror_view(chunks_: DataFrame, channel: str, t: str) -> DataFrame:
    """A flat three-dimensional view for each (channel, t): chunks without their time axis; what is no longer in the
    source is in no view."""
    rest = lambda c: F.slice(c, 2, F.size(c) - 1)
    return chunks_.select(channel, F.get("chunk", F.lit(0)).alias(t), *(rest(c).alias(c) for c in ("chunk", "origin", "shape")), "values")


def missing_chunks(grid: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """How many chunks of each store's grid aren't there: ``grid`` (``keys``, ``counts`` array: chunks per axis) against
    ``present`` (``keys``, ``chunk`` array)."""
    full = F.aggregate("counts", F.lit(1).cast("long"), lambda a, n: a * n)
    inside = F.forall(F.arrays_zip("chunk", "counts"), lambda z: z["chunk"] < z["counts"])
    have = grid.join(present, keys).filter(inside).select(*keys, "chunk").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("have"))
    return grid.join(have, keys, "left").select(*keys, full.alias("chunks"), (full - F.coalesce("have", F.lit(0))).alias("missing"))

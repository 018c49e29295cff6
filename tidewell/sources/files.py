"""Sources: JSON, CSV, text and HTML documents, frame and store names (folders: ``listing``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import keyword_labels, regex_ints
from tidewell.sources import layout


def empty_if_absent(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", **options: str) -> DataFrame:
    """The table at ``path``, or an empty one of that schema where nothing is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).options(**options).format(fmt).load(path)


def labels(df: DataFrame) -> DataFrame:
    """Human labels; tables of before the source column count as from a person."""
    source = F.coalesce(F.col("source"), F.lit("human")) if "source" in df.columns else F.lit("human")
    return df.select("dataset_key", "label", F.col("updated_at"), source.alias("source"))


def manifests(spark: SparkSession, pattern: str) -> DataFrame:
    """Distinct names in the ``scans`` arrays of JSON manifests; broken files count as empty."""
    docs = spark.read.schema("scans array<string>").option("multiLine", "true").option("mode", "PERMISSIVE").json(pattern)
    return docs.select(F.explode("scans").alias("scan")).distinct()


def pins(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file without blanks and comments."""
    line = F.trim("value")
    return spark.read.text(path).select(line.alias("pin")).filter((line != "") & ~F.startswith(line, F.lit("#")))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header and a known schema."""
    return spark.read.schema(schema).option("header", "true").csv(path)


def frames(names: DataFrame, name: str = "name") -> DataFrame:
    """Distinct ``c``, ``t`` of frame names ``..C<c>_T<t>.tif``; projections and other names are left out."""
    c, t = regex_ints(F.col(name), r"_C(\d+)_T(\d+)\.tif$", 2)
    rows = names.filter(~F.contains(F.col(name), F.lit("MIP"))).withColumn("c", c).withColumn("t", t).filter("c is not null")
    return rows.dropDuplicates(["c", "t"])


def projections(names: DataFrame, keys: list[str], name: str = "name") -> DataFrame:
    """Per key and channel the projections ``..C<c>_T<t>_MIP_z.tif``: ``frames``, (t, name) in order of t."""
    c, t = regex_ints(F.col(name), r"_C(\d+)_T(\d+)_MIP_z\.tif$", 2)
    rows = names.select(*keys, c.alias("c"), F.struct(t.alias("t"), F.col(name).alias("name")).alias("f")).filter("c is not null")
    return rows.groupBy(*keys, "c").agg(F.sort_array(F.collect_list("f")).alias("frames"))


def device_metrics(outputs: DataFrame, keys: list[str], text: str = "value") -> DataFrame:
    """Figures that a device query printed, a line ``<use>, <memory>`` per device: ``device`` (from 0, by line),
    ``used_percent``, ``memory_mib``. Blank lines don't count; what is no number is null."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    cell = lambda n: F.expr(f"try_cast(trim(split_part(line, ',', {n})) as int)")
    return outputs.select(*keys, F.posexplode(lines).alias("device", "line")).select(*keys, "device", cell(1).alias("used_percent"), cell(2).alias("memory_mib"))


def sessions(df: DataFrame) -> DataFrame:
    """Session documents (``value`` JSON text) with an id; others are dropped."""
    schema = "session_id string, state string, updated_at double, store string, channel_labels array<string>, timepoints_done array<int>, timepoints_failed array<int>, decon_psf string, n_t int, n_c int"
    return df.select(*(c for c in df.columns if c != "value"), F.from_json("value", schema).alias("d")).select(*(c for c in df.columns if c != "value"), "d.*").filter("session_id <> ''")


def latest_session(docs: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key the session of its last document; none where that is broken, no object, or has no id."""
    last = docs.groupBy(*keys).agg(F.max_by("value", F.struct(*order)).alias("value"))
    return sessions(last)


def finished_ticket(doc: Column) -> tuple[Column, Column]:
    """PSF (null for none) and settings fingerprint of a finished ticket's JSON text; ``?`` for both, which equals no
    settings, if it can't be read or lacks its parameters. A plain fingerprint is the parameters but the PSF."""
    params = F.get_json_object(doc, "$.parameters")
    fields = F.from_json(params, "map<string,string>")
    other = F.map_filter(fields, lambda k, _: k != "psf_path")
    mark = F.array_join(F.transform(F.array_sort(F.map_entries(other)), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null")))), ";")
    readable = F.startswith(F.ltrim(params), F.lit("{")) & fields.isNotNull()
    return F.when(readable, F.nullif(F.get_json_object(doc, "$.parameters.psf_path"), F.lit(""))).otherwise("?"), F.when(readable, mark).otherwise("?")


def sample_settings(docs: DataFrame, base: str = "base", rel: str = "rel", text: str = "text") -> DataFrame:
    """Per sub-folder of a base its channel configurations: ``folder``, ``source``, ``configs``, ``detected``.

    The first settings file below the folder, by path, speaks for it (``channels[*].config``); where there is none, or
    nothing is recognised in it, the labels that the folder's name hints at are taken."""
    folder = F.substring_index(F.col(rel), "/", 1)
    rows = docs.select(base, folder.alias("folder"), F.when(F.col(rel).rlike(r"/AcqSettings\.txt$"), F.struct(rel, text)).alias("f"))
    first = rows.groupBy(base, "folder").agg(F.min("f").alias("f"))
    configs = F.coalesce(F.from_json(F.get_json_object(f"f.{text}", "$.channels[*].config"), "array<string>"), F.from_json(F.concat(F.lit("["), F.get_json_object(f"f.{text}", "$.channels[*].config"), F.lit("]")), "array<string>"), F.array().cast("array<string>"))
    out = first.select(base, "folder", F.col(f"f.{rel}").alias("settings"), configs.alias("configs"))
    seen = F.array_distinct(F.flatten(F.transform("configs", lambda c: keyword_labels(c, layout.FLUOROPHORES))))
    named = keyword_labels(F.col("folder"), layout.FLUOROPHORES)
    by_file = F.size(seen) > 0
    return out.select(base, "folder", F.when(by_file, F.col("settings")).otherwise("folder name").alias("source"), "configs", F.when(by_file, seen).otherwise(named).alias("detected"))


def cohort(table: DataFrame, store_steps: DataFrame, labels: list[str], channels: list[int]) -> DataFrame:
    """Specifications of a cohort's cells from a table of JSON objects (``cell``, ``doc``): ``cell``, ``t``, ``stores``
    (of the asked channels), ``z_step_um`` (the table's, else the first store's of ``store_steps``). A cell whose membrane
    isn't channel 0, or without any z step, fails the job by name."""
    raw = [F.get_json_object("doc", f"$.raw.{labels[i]}") for i in channels]
    rows = table.select(
        "cell", F.get_json_object("doc", "$.t").cast("int").alias("t"), F.array(*raw).alias("stores"),
        F.get_json_object("doc", "$.z_step_um").cast("double").alias("own"), F.get_json_object("doc", "$.membrane_ch").cast("int").alias("membrane"),
    )
    rows = rows.withColumn("store", F.get("stores", F.lit(0))).join(store_steps.select("store", "step"), "store", "left")
    step = F.coalesce(F.nullif("own", F.lit(0.0)), F.nullif("step", F.lit(0.0)))
    wrong = F.when(F.col("membrane") != 0, F.concat("cell", F.lit(": membrane channel isn't 0"))).when(step.isNull(), F.concat("cell", F.lit(": no z step")))
    checked = F.when(wrong.isNotNull(), F.raise_error(wrong)).otherwise(step)
    return rows.select("cell", "t", "stores", checked.cast("double").alias("z_step_um"))


# The markup of profiler pages.
_FUNCTION = r"(?is)<td class=\"td-linebottomrt\"><a href=\"(file\d+\.html)\">(.*?)</a>(.*?)</td.*?<td class=\"td-linebottomrt\">(\d+)</td>.*?<td class=\"td-linebottomrt\">([\d.]+) s</td>.*?<td class=\"td-linebottomrt\">([\d.]+) s</td>"
_ROW, _CELL = r"(?s)<tr>(.*?)</tr>", r"(?s)<td[^>]*>(.*?)</td>"


def profile_functions(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """Functions that a profiler's overview page lists: ``href``, ``name``, ``calls``, ``total_s``, ``self_s``."""
    part = lambda k: F.regexp_extract("m", _FUNCTION, k)
    hits = pages.select(*keys, F.explode(F.regexp_extract_all(html, F.lit(_FUNCTION), F.lit(0))).alias("m"))
    name = F.trim(F.replace(F.concat(part(2), part(3)), F.lit("&gt;"), F.lit(">")))
    return hits.select(*keys, part(1).alias("href"), name.alias("name"), part(4).cast("int").alias("calls"), part(5).cast("double").alias("total_s"), part(6).cast("double").alias("self_s"))


def profile_lines(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """Lines that a profiler's function page lists: ``seconds``, ``calls``, ``line``, ``code`` of each table row that
    names a line and has four cells; times that are no number count 0."""
    rows = pages.select(*keys, F.explode(F.regexp_extract_all(html, F.lit(_ROW), F.lit(1))).alias("row")).filter(F.contains("row", F.lit('<a name="Line')))
    cells = rows.select(*keys, F.transform(F.regexp_extract_all("row", F.lit(_CELL), F.lit(1)), lambda c: F.trim(F.regexp_replace(c, "(?s)<[^>]*>", ""))).alias("c")).filter(F.size("c") >= 4)
    at = lambda k: F.get("c", F.lit(k))
    seconds = F.coalesce(F.nullif(F.regexp_extract(at(0), r"([\d.]+)", 1), F.lit("")).try_cast("double"), F.lit(0.0))
    return cells.select(*keys, seconds.alias("seconds"), at(1).try_cast("int").alias("calls"), at(2).try_cast("int").alias("line"), at(3).alias("code"))


def points(spark: SparkSession, path: str, columns: int = 3) -> DataFrame:
    """Points of a CSV without a header, numbered in file order (one small file); rows with a missing number are left out."""
    names = ["z", "y", "x"] if columns == 3 else ["z", "channel", "y", "x"]
    rows = spark.read.schema(", ".join(f"{n} double" for n in names)).csv(path).dropna()
    return rows.coalesce(1).select(F.monotonically_increasing_id().alias("point_id"), *names)


def save_points(rows: DataFrame, path: str) -> None:
    """The points' coordinates in order, as one CSV without a header."""
    rows.orderBy("point_id").select(*(c for c in ("z", "channel", "y", "x") if c in rows.columns)).coalesce(1).write.mode("overwrite").csv(path)


def auto_triage(spark: SparkSession, path: str, fmt: str = "parquet", key: str = "dataset_key", order: str | None = None) -> DataFrame:
    """Verdicts of automatic triage, whatever columns they have: files of any age are merged by column name, a missing
    column is null. One row for each key: the last by ``order``, or any where that isn't given. Nothing at ``path``, or
    files that aren't there, give an empty table with the key alone; rows of null key are left out."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], f"{key} string")
    rows = spark.read.option("mergeSchema", "true").format(fmt).load(path).filter(F.col(key).isNotNull())
    rest = F.struct(*(c for c in rows.columns if c != key))
    last = F.max_by(rest, F.col(order)) if order else F.first(rest)
    return rows.groupBy(key).agg(last.alias("_r")).select(key, "_r.*") if len(rows.columns) > 1 else rows.distinct()


def session_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Session documents as they arrive in a folder, each file one JSON text, as a stream; documents that are broken, no
    objects or without an id are left out. A document that is written again must be a new file."""
    return sessions(spark.readStream.schema("value string").text(folder, wholetext=True))

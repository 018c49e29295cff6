"""Decisions about tickets, outputs, failures, exports and whole copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Folders of the ticket queue, spellings of a claimed ticket, folder names of older results, endings.
LANES, SPELLINGS = ("queue", "queue_live"), ("", ".active_", ".requeue_")
LEGACY_DIRS = ("Decon", "decon")
MIP_FRAME = r"_C(\d+)_T\d+_MIP_z\.tif$"
STORE_SUFFIX, STAGED, MIRRORED = "_dsr.ome.zarr", "decon_stage", "zarr_mirror"


def ticket_states(tickets: DataFrame, entries: DataFrame, ticket: str = "ticket") -> DataFrame:
    """``state`` of each ticket name by the folders (``dir``, ``name``) that hold it: ``done``, ``failed``, ``in flight``
    in a lane under any of its three spellings, else ``lost``. Finished folders count before lanes."""
    spelt = F.regexp_replace("name", r"^\.(active|requeue)_", "")
    rank = F.when(F.col("dir") == "completed", 0).when(F.col("dir") == "failed", 1).when(F.col("dir").isin(*LANES), 2)
    own = entries.select(F.when(F.col("dir").isin(*LANES), spelt).otherwise(F.col("name")).alias(ticket), rank.alias("r")).filter("r is not null")
    best = own.groupBy(ticket).agg(F.min("r").alias("r"))
    state = F.when(F.col("r") == 0, "done").when(F.col("r") == 1, "failed").when(F.col("r") == 2, "in flight").otherwise("lost")
    return tickets.join(best, ticket, "left").withColumn("state", state).drop("r")


def unreadable_class(error: Column, frames: Column) -> Column:
    """``corrupt`` where an error says that the raw file itself can't be read: the parser's own error, or an index error
    raised inside the parser (``frames``: files of the trace). Anything else is null: a fault that can be mended must
    not be taken for lost data."""
    inside = F.coalesce(F.exists(frames, lambda f: F.contains(f, F.lit("tifffile"))), F.lit(False))
    return F.when((error == "TiffFileError") | ((error == "IndexError") & inside), "corrupt")


def legacy_output(children: Column) -> Column:
    """Whether one of a folder's sub-folders is an older result."""
    return F.coalesce(F.arrays_overlap(children, F.array(*(F.lit(n) for n in LEGACY_DIRS))), F.lit(False))


def output_dir(data_dir: Column, deconvolved: Column) -> Column:
    """Where a run writes its result: inside ``Decon`` of the data folder with deconvolution, else beside the data."""
    return F.concat(data_dir, F.when(deconvolved, "/Decon/DSR_decon").otherwise("/DSR_nodecon"))


def first_existing(candidates: list[Column], existing: Column) -> Column:
    """The first candidate path that is in the array of existing ones; null if none is."""
    return F.coalesce(*(F.when(F.array_contains(existing, c), c) for c in candidates))


def floor_dir(source: Column, open_um: Column, view: Column) -> Column:
    """Name of the folder that holds a stage's data less its haze floor (or the floor itself, for a view); the opening
    is named unless it is the usual 3 um."""
    tag = F.when(view, "floorv2").otherwise("bgv2")
    base = F.concat(source, F.lit("_"), tag)
    size = F.regexp_replace(open_um.cast("string"), r"\.0$", "")
    return F.when(open_um == 3.0, base).otherwise(F.concat(base, F.lit("_o"), size))


def failure_category(detail: Column) -> Column:
    """Category of a failed check's text, the first that fits."""
    blank = F.startswith(detail, F.lit("blank")) | F.contains(detail, F.lit("blank:"))
    at_start = (F.regexp_extract(detail, r"timepoint (\d+)", 1) == "0") | F.contains(detail, F.lit("in Cell_"))
    return (
        F.when(F.contains(detail, F.lit("no deskew output")), "no deskew output recorded")
        .when(blank & at_start, "blank at timepoint 0").when(blank, "blank only at the last timepoint")
        .when(F.contains(detail, F.lit("never written")), "live store: planes never written")
        .when(F.contains(detail, F.lit("registry expects")), "timepoint count disagrees with registry").otherwise("other")
    )


def held_bytes(checks: DataFrame, units: DataFrame, key: str) -> DataFrame:
    """Failed checks (``ok``, ``detail``) by category: ``n``, and the bytes of intermediate and viewer files that they
    hold back."""
    failed = checks.filter(~F.col("ok")).select(key, failure_category(F.col("detail")).alias("category"))
    held = units.filter(F.col("cls").isin("intermediate", "viewer_export")).groupBy(key).agg(F.sum("bytes").alias("b"))
    return failed.join(held, key, "left").groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes"))


def layout_label(path: Column) -> Column:
    """Which of the known layouts an output path has, the first that fits."""
    nested = "Decon/DSR_decon"
    has = lambda part: F.contains(path, F.lit(part))
    return (
        F.when(has(STORE_SUFFIX), "viewer OME-Zarr (live lane)").when(has(f"processed_tiff_series_split/{nested}"), f"processed_tiff_series_split/{nested}")
        .when(has(f"{STAGED}/{nested}"), f"{STAGED}/{nested}").when(has("DSR_nodecon"), "DSR_nodecon")
        .when(has(nested), f"<name>_MMStack_Pos0/{nested} (absolute, in-tree)").otherwise("other")
    )


def needs_triage(datasets: DataFrame, stages: DataFrame, key: str) -> DataFrame:
    """Datasets whose signal must still be looked at: not cropped stores, and neither triaged nor encoded."""
    seen = stages.filter((F.col("status") == "done") & F.col("stage").isin("mip_encode", "roi_detect")).select(key).distinct()
    return datasets.filter(F.col("kind") != "zarr_precropped").join(seen, key, "left_anti")


def scan_ages(wanted: DataFrame, scans: DataFrame, key: str, scanned_at: str, now: Column) -> DataFrame:
    """``hours`` since each wanted key's scan, null for one that was never scanned (or whose time can't be read)."""
    age = (F.unix_micros(now) - F.unix_micros(F.try_to_timestamp(scanned_at))) / 3.6e9
    return wanted.select(key).distinct().join(scans.select(key, age.alias("hours")).filter("hours is not null"), key, "left")


def whole_copy(copies: DataFrame, units: DataFrame, raw: DataFrame, key: str) -> DataFrame:
    """What is suggested for each whole copy (``key``, ``nested``): ``tree``, ``scope``, ``path`` below the tree's root,
    ``cls``, ``bytes``, ``nfiles``, ``fingerprint``.

    The leaf and mirror trees go as one folder each (``.``), unless the copy holds a nested dataset or unknown content:
    then each known unit goes by itself, loose files (``dir/*``) as files. The master tree's raw files (``raw``: key,
    tree, rel, size) go by channel store, the first part of their path."""
    own = units.join(copies.select(key, "nested"), key)
    careful = own.groupBy(key).agg((F.bool_or("nested") | F.bool_or(F.col("cls") == "unknown")).alias("careful"))
    own = own.filter(F.col("tree").isin("leaf", "mirror")).join(careful, key)
    mark = F.format_string("%d:%d:%d", "nfiles", "bytes", "newest")
    summed = own.filter("not careful").groupBy(key, "tree").agg(F.sum("bytes").alias("bytes"), F.sum("nfiles").alias("nfiles"), F.max("newest").alias("newest"))
    folders = summed.select(key, "tree", F.lit("dir").alias("scope"), F.lit(".").alias("path"), F.lit("mixed").alias("cls"), "bytes", "nfiles", mark.alias("fingerprint"))
    loose = F.when(F.endswith("unit", F.lit("/*")), "files").otherwise("dir")
    parts = own.filter("careful and cls <> 'unknown'").select(key, "tree", loose.alias("scope"), F.col("unit").alias("path"), "cls", "bytes", "nfiles", mark.alias("fingerprint"))
    stores = raw.filter("tree = 'master'").join(copies.select(key), key, "left_semi").groupBy(key, "tree", F.substring_index("rel", "/", 1).alias("path")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("nfiles"))
    stores = stores.select(key, "tree", F.lit("dir").alias("scope"), "path", F.lit("raw").alias("cls"), "bytes", "nfiles", F.format_string("%d:%d", "nfiles", "bytes").alias("fingerprint"))
    return folders.union(parts).union(stores)


def encode_source(store: Column, result: Column, kind: Column, n_t: Column) -> Column:
    """What the projections of a dataset are made from: its processed store, if the recorded result is that store;
    else ``series`` or ``single`` frames of a cropped store, else ``legacy`` frames."""
    return F.when(store.isNotNull() & store.eqNullSafe(result), "store").when(kind != "zarr_precropped", "legacy").when(n_t > 1, "series").otherwise("single")


def reblend(datasets: DataFrame, stages: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """What is blended anew for each dataset whose movies are done (a recorded output): ``action``, ``source`` (output of
    the deskew stage), ``target`` (of the encode stage). ``files``: ``dir``, ``name``, both of movies and of the
    ``MIPs`` folder of a source.

    A composite movie is made anew from the projections of two channels or more; a preview alone, without any channel's
    movie beside it, from single projections; too few of them make ``failed``. Repeated outputs of a stage: the least."""
    done = lambda stage, name: stages.filter((F.col("stage") == stage) & (F.col("status") == "done") & (F.col("output_path") != "")).groupBy(key).agg(F.min("output_path").alias(name))
    name, has = F.col("name"), lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    composite = F.endswith(name, F.lit("_composite.webm"))
    movies = files.groupBy(F.col("dir").alias("target")).agg(
        has(composite).alias("blended"), has(F.endswith(name, F.lit(".webm")) & ~composite).alias("movie"), has(name == "triage_preview.jpg").alias("preview"),
    )
    channel = F.when(name.rlike(MIP_FRAME), F.regexp_extract(name, MIP_FRAME, 1).cast("long"))
    mips = files.groupBy(F.col("dir").alias("_mips")).agg(F.count_distinct(channel).alias("channels"), F.count(F.when(F.endswith(name, F.lit("_MIP_z.tif")), 1)).alias("mips"))
    rows = datasets.select(key).distinct().join(done("mip_encode", "target"), key).join(done("deskew", "source"), key, "left")
    rows = rows.join(movies, "target", "left").withColumn("_mips", F.concat("source", F.lit("/MIPs"))).join(mips, "_mips", "left")
    action = (
        F.when(F.col("source").isNull(), "skipped: no deskew output")
        .when(F.col("blended"), F.when(F.col("channels") >= 2, "movie composite").otherwise("failed: fewer than two channels"))
        .when(F.col("movie"), "skipped: single channel")
        .when(F.col("preview"), F.when(F.col("mips") > 0, "poster").otherwise("failed: no projections")).otherwise("skipped: nothing to blend")
    )
    return rows.select(key, action.alias("action"), "source", "target")


def outcome_counts(actions: DataFrame) -> DataFrame:
    """``done``, ``skipped``, ``failed``: how many of the actions end so; one row."""
    kind = F.regexp_extract("action", r"^(skipped|failed):", 1)
    return actions.agg(*(F.count(F.when(kind == k, 1)).alias(n) for k, n in (("", "done"), ("skipped", "skipped"), ("failed", "failed"))))


def reapable(files: DataFrame, deconvolved: Column, precropped: Column, keep: bool = False) -> DataFrame:
    """Files (``rel`` below the data folder) that can be made again and may go, ``what`` is done: ``drop`` frames staged
    beside the result (cropped stores only) and, after a deconvolution, frames loose in ``Decon``; its ``psfgen`` is
    copied to the records first (``preserve``). Results and anything else stay; nothing is listed with ``keep``."""
    frame, top = F.endswith("rel", F.lit(".tif")), ~F.contains("rel", F.lit("/"))
    in_decon = F.startswith("rel", F.lit("Decon/")) & (F.size(F.split("rel", "/")) == 2)
    what = F.when(frame & top & precropped, "drop").when(deconvolved & frame & in_decon, "drop").when(deconvolved & F.startswith("rel", F.lit("Decon/psfgen/")), "preserve")
    return files.withColumn("what", what).filter(F.col("what").isNotNull() & F.lit(not keep))


def export_actions(datasets: DataFrame, key: str) -> DataFrame:
    """Steps of the viewer export of each dataset (``format``, ``hold``: why its frames must stay, ``current``: the store
    is up to date, ``n_frames``): ``stamp`` frames for tiff and both, ``write`` the store for ome-zarr and both unless it
    is current, ``delete`` frames that equal the store's, for ome-zarr only and without a hold. ``outcome`` sums it up."""
    tiff, zarr = F.col("format").isin("tiff", "both"), F.col("format").isin("ome-zarr", "both")
    steps = F.array_compact(F.array(
        F.when(tiff, "stamp"), F.when(zarr & ~F.coalesce("current", F.lit(False)), "write"), F.when((F.col("format") == "ome-zarr") & F.col("hold").isNull(), "delete"),
    ))
    empty = F.coalesce(F.col("n_frames"), F.lit(0)) <= 0
    outcome = F.when(empty, "no frames").when(F.size("steps") == 0, F.coalesce("hold", F.lit("nothing to do"))).otherwise(F.array_join("steps", ", "))
    return datasets.withColumn("steps", F.when(empty, F.array().cast("array<string>")).otherwise(steps)).select(key, "steps", outcome.alias("outcome"))


def channel_stores(stores: DataFrame, master: DataFrame, key: str, path: str = "path") -> DataFrame:
    """The stores of each master's sample: the master (``rank`` 0), then the stores of its folder with the same name up
    to the channel label, in order. A master that isn't a channel store is alone."""
    group = lambda c: F.nullif(F.regexp_extract(c, r"^(.*)_[^/_]+_\d+\.ome\.zarr$", 1), F.lit(""))
    own = master.select(key, F.col(path).alias("m"), group(F.col(path)).alias("g"))
    others = stores.select(F.col(path).alias("p"), group(F.col(path)).alias("g")).filter("g is not null").distinct()
    met = own.join(others, "g").filter("p <> m").groupBy(key).agg(F.sort_array(F.collect_set("p")).alias("o"))
    every = own.join(met, key, "left").select(key, F.concat(F.array("m"), F.coalesce("o", F.array().cast("array<string>"))).alias("all"))
    return every.select(key, F.posexplode("all").alias("rank", path))


def raw_digests(files: DataFrame, hashes: DataFrame, registered: DataFrame, key: str) -> DataFrame:
    """Raw files (``path``, ``size``, ``mtime``) of registered datasets with their digest: a cached one counts only for
    the same path, size and time, else it is null."""
    raw = files.filter("cls = 'raw'").select(key, "path", "size", "mtime").join(registered.select(key), key, "left_semi")
    return raw.join(hashes.select("path", "size", "mtime", "sha"), ["path", "size", "mtime"], "left").select(key, "path", "size", "mtime", "sha")


def control_gate(correlations: DataFrame, cell: str, arm: str, controls: list[str], least: float = 0.9999) -> DataFrame:
    """Per cell the first control, by order, whose channels all correlate by ``least`` with production, and the
    interpolation that it stands for; none: ``gate_ok`` is false. A missing correlation fails its arm."""
    ok = correlations.filter(F.col(arm).isin(*controls)).groupBy(cell, arm).agg(F.bool_and(F.coalesce(F.col("r") >= least, F.lit(False))).alias("ok"))
    rank = F.array_position(F.array(*(F.lit(c) for c in controls)), F.col(arm))
    best = ok.groupBy(cell).agg(F.min(F.when(F.col("ok"), F.struct(rank.alias("k"), arm))).alias("b"))
    interp = F.when(F.endswith(f"b.{arm}", F.lit("_cubic")), "cubic").otherwise("linear")
    return best.select(cell, F.col("b").isNotNull().alias("gate_ok"), F.col(f"b.{arm}").alias("control"), F.when(F.col("b").isNotNull(), interp).alias("interpolation"))


def cohort_results(cells: DataFrame, gates: DataFrame, shapes: DataFrame, errors: DataFrame, cell: str) -> DataFrame:
    """Outcome of each cell of a cohort: ``ok``, ``gate failed``, ``shapes differ`` or its error; one bad cell doesn't
    stop the rest. ``shapes``: cell, state (``ok``, ``MISSING`` or else) of every arm and channel."""
    bad = shapes.groupBy(cell).agg(F.bool_and(F.col("state") == "ok").alias("fits"))
    met = cells.select(cell).join(gates, cell, "left").join(bad, cell, "left").join(errors.select(cell, "error"), cell, "left")
    what = F.when(F.col("error").isNotNull(), F.concat(F.lit("error: "), "error")).when(~F.coalesce("gate_ok", F.lit(False)), "gate failed").when(~F.coalesce("fits", F.lit(False)), "shapes differ").otherwise("ok")
    return met.select(cell, "control", "interpolation", what.alias("outcome"))


def variant_path(stage: Column, variant: Column, name: Column, deconvolved: Column, padding: Column) -> Column:
    """Where a variant's volume of that file name lies: beside the staged data without deconvolution, else in a folder of
    the variant's, and with a padding (not null, not 0) in one of padding and variant beside the staging folder."""
    own = F.concat(F.lit("Decon_"), variant, F.lit("/DSR/"), name)
    parent = F.regexp_replace(stage, r"/[^/]*$", "")
    padded = F.concat(parent, F.lit("/pad"), padding.cast("string"), F.lit("_"), variant, F.lit("/"), own)
    return F.when(~F.coalesce(deconvolved, F.lit(False)), F.concat(stage, F.lit("/DSR/"), name)).when(F.coalesce(padding, F.lit(0)) != 0, padded).otherwise(F.concat(stage, F.lit("/"), own))


#: Rows of one summary of a document.
MAX_SUMMARY = 100_000


def document(named: dict[str, DataFrame]) -> DataFrame:
    """The rows of several small summaries as one JSON array each: ``name``, ``json``; rows in order of their columns. A
    summary of more than ``MAX_SUMMARY`` rows is an error: it is a table and should be written as one."""
    out = None
    for name, df in named.items():
        if df.limit(MAX_SUMMARY + 1).count() > MAX_SUMMARY:
            raise ValueError(f"{name} has more than {MAX_SUMMARY} rows: write it as a table")
        row = df.agg(F.to_json(F.sort_array(F.collect_list(F.struct(*df.columns)))).alias("json")).select(F.lit(name).alias("name"), F.coalesce("json", F.lit("[]")).alias("json"))
        out = row if out is None else out.union(row)
    return out


def hot_spots(functions: DataFrame, keys: list[str], name: str, seconds: str, least: float = 0.01, top: int = 5) -> DataFrame:
    """The ``top`` rows of each key by time, of those that take ``least`` seconds, with their percentage of the key's
    total. The limit on the rank reaches below the shuffle (WindowGroupLimit)."""
    total = functions.groupBy(*keys).agg(F.sum(seconds).alias("total"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(seconds), name))
    best = functions.filter(F.col(seconds) >= least).select(*keys, name, seconds, rank.alias("rank")).filter(F.col("rank") <= top)
    return best.join(total, keys).select(*keys, "rank", name, seconds, (100 * F.col(seconds) / F.col("total")).alias("percent"))


def markdown(rows: DataFrame, title: str, columns: list[str]) -> str:
    """A small table as Markdown, in its order."""
    lines = [f"# {title}", "", "| " + " | ".join(columns) + " |", "|" + "-|" * len(columns)]
    for r in rows.select(*columns).toLocalIterator():
        lines.append("| " + " | ".join(f"{v:.3f}" if isinstance(v, float) else str(v) for v in r) + " |")
    return "\n".join(lines) + "\n"


def number_in(name: Column, prefix: str) -> Column:
    """The number that follows a prefix in a name, null without one."""
    return F.nullif(F.regexp_extract(name, prefix + r"_?(-?\d+(?:\.\d+)?)", 1), F.lit("")).cast("double")

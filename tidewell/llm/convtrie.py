"""Prefix trie of conversations by chained digests.

A conversation's turns are numbered in their order; each becomes a digest of its role and text, so texts themselves
never move. The chained digest of a conversation's first d turns is the hash of the digest of its first d - 1 and of
the d-th turn's: one pass over each conversation in order, which holds one digest at a time. Every prefix is a row;
grouping by (depth, digest) gives the nodes.

Subtree sums go up by exploding to ancestors. Nodes with the same smallest member follow one another on that member's
path, so they form a *run*, and the runs of all nodes form a tree. A run is summed within itself, from its end
upwards, and its total is exploded to all runs above it, at the depth where its path leaves them. That gives what
exploding each node to each ancestor gives, but grows with the number of turns: a conversation of n turns has n rows
here and n * n / 2 pairs of node and ancestor.

The members that end at a node are listed in chunks of ``1 << CHUNK_BITS`` ids, and the chunks stream through one hash.

Edge cases: a null role or text is empty; turns go by ``turn``, null first, ties by the digest of the turn, repeated
rows are turns of their own; rows without a conversation id belong to no conversation and are left out; a
conversation whose turns are all taken away by a rule is a member of the root; other columns are ignored; an empty
table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import bound_batches
from tidewell.session import materialise, scratch

#: Ids of one conversation list's chunk lie in a range of ``1 << CHUNK_BITS`` numbers; rows of an Arrow batch here.
CHUNK_BITS, ROWS = 12, 4096
CHAIN = "conv_id long, depth long, parent binary, digest binary, bytes long, last boolean"
ROOT = b""


def turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id``, ``pos`` (from 1), ``turn`` (digest of role and text), ``bytes`` (UTF-8 bytes of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    one = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = conversations.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("at"), one.alias("turn"), F.octet_length(text).cast("long").alias("bytes"))
    order = Window.partitionBy("conv_id").orderBy(F.col("at").asc_nulls_first(), "turn")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "turn", "bytes")


def rebuilt(numbered: DataFrame, base: Column, taken: Column, most: int) -> DataFrame:
    """Conversations that begin as another does: of the conversation ``base`` (an expression of ``conv_id``) the first
    ``taken`` turns (an expression, ``most`` at most), then their own after as many. One row for each turn, as
    ``conv_id``, ``depth``, ``turn``, ``bytes``; a conversation that is left without turns has one row of depth 0."""
    heads = numbered.filter(F.col("pos") <= most).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "turn", "bytes"))).alias("head"))
    ids = numbered.groupBy("conv_id").agg(F.max("pos").alias("n"))
    ids = ids.select("conv_id", "n", base.alias("base"), taken.cast("long").alias("h"))
    ids = ids.join(heads.withColumnRenamed("conv_id", "base"), "base", "left")
    head = F.filter(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), lambda x: x["pos"] <= F.col("h"))
    plan = materialise(ids.select("conv_id", "n", "h", head.alias("head")), "convtrie-heads")
    first = plan.select("conv_id", F.inline("head")).select("conv_id", F.col("pos").alias("depth"), "turn", "bytes")
    shift = plan.select("conv_id", "h", F.size("head").alias("k"))
    own = numbered.join(shift, "conv_id").filter("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("depth"), "turn", "bytes")
    none = plan.filter("size(head) = 0 and n <= h").select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("long").alias("bytes"))
    return first.union(own).union(none)


def chained(rows: DataFrame) -> DataFrame:
    """Every prefix of every conversation: its depth, its digest and that of the prefix before it, the bytes of its
    last text, and whether the conversation ends there."""
    bound_batches(rows.sparkSession, ROWS)
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "depth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
        names = ["conv_id", "depth", "parent", "digest", "bytes", "last"]
        held, digest = None, ROOT
        for batch in batches:
            out = []
            for conv, depth, turn, size in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0] != conv:
                    out.append((*held, True))
                    digest = ROOT
                elif held:
                    out.append((*held, False))
                before, digest = digest, hashlib.sha256(digest + turn).digest() if depth else ROOT
                held = conv, depth, before, digest, size
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((*held, True), types)], names)

    return dealt.select("conv_id", "depth", "turn", "bytes").mapInArrow(run, CHAIN)


def _ends(chain: DataFrame) -> DataFrame:
    """``depth``, ``digest``, ``ends_sha256`` of the nodes at which conversations end."""
    chunk = F.shiftright("conv_id", CHUNK_BITS)
    lists = chain.filter("last").groupBy("depth", "digest", chunk.alias("chunk")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    dealt = lists.repartition("depth", "digest").sortWithinPartitions("depth", "digest", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, hashed = None, None
        for batch in batches:
            out = []
            for depth, digest, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if node == (depth, digest):
                    hashed.update(b"," + ids.encode())
                    continue
                if node:
                    out.append((*node, hashed.hexdigest()))
                node, hashed = (depth, digest), hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.string()))], ["depth", "digest", "ends_sha256"])
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.binary()), pa.array([hashed.hexdigest()])], ["depth", "digest", "ends_sha256"])

    return dealt.select("depth", "digest", "ids").mapInArrow(run, "depth long, digest binary, ends_sha256 string")


def trie(rows: DataFrame) -> DataFrame:
    """Nodes of the trie of ``rows`` (``conv_id``, ``depth`` from 1, ``turn``, ``bytes``; see :func:`rebuilt`):
    ``conv_id`` (smallest member), ``depth``, ``digest``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``."""
    with scratch() as kept:
        chain = materialise(chained(rows), "convtrie-chain")
        grouped = chain.filter("depth > 0").groupBy("depth", "digest").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("bytes").alias("bytes"), F.min("parent").alias("parent"))
        nodes = materialise(grouped, "convtrie-nodes")
        children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("digest")).agg(F.count(F.lit(1)).alias("n_children"))
        saved = (F.col("n_convs") - 1) * F.col("bytes")
        counted = nodes.join(children, ["depth", "digest"], "left").select("*", saved.alias("saved"), F.col("n_children").isNull().cast("long").alias("leaf"))
        counted = materialise(counted.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "convtrie-counted")

        runs = counted.groupBy("conv_id").agg(F.min("depth").alias("top"), F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
        runs = materialise(runs, "convtrie-runs")
        path = chain.filter("depth > 0").join(runs.select("conv_id", "top"), "conv_id").filter("depth < top").select("conv_id", "depth", "digest")
        owners = counted.select("depth", "digest", F.col("conv_id").alias("owner"))
        above = path.join(owners, ["depth", "digest"]).groupBy("conv_id", "owner").agg(F.max("depth").alias("depth"))
        above = materialise(above, "convtrie-above")  # a run and each run above it, with the depth where the path leaves it
        below = above.join(runs, "conv_id").groupBy(F.col("owner").alias("conv_id"), "depth").agg(F.sum("saved").alias("below_saved"), F.sum("leaf").alias("below_leaf"))
        parents = above.groupBy("conv_id").agg(F.max_by("owner", "depth").alias("run_above"))

        least, n_convs = chain.agg(F.min("conv_id"), F.count(F.when(F.col("last"), 1))).first()  # one row
        upwards = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        up = lambda own, more: F.sum(F.col(own) + F.coalesce(more, F.lit(0))).over(upwards)
        sums = counted.join(below, ["conv_id", "depth"], "left").select("conv_id", "depth", "digest", "n_convs", "n_children", up("leaf", "below_leaf").alias("n_leaves"), up("saved", "below_saved").alias("saved_tokens"))
        places = runs.select("conv_id", "top").join(parents, "conv_id", "left").select("conv_id", "top", F.coalesce("run_above", F.lit(least).cast("long")).alias("run_above"))
        inner = sums.join(places, "conv_id").select("conv_id", "depth", "digest", F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("run_above")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens")
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
        roots = counted.agg(F.count(F.when(F.col("depth") == 1, 1)).alias("n_children"), F.greatest(total("leaf"), F.lit(1)).alias("n_leaves"), total("saved").alias("saved_tokens"))
        place = [F.lit(least).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("digest"), F.lit(None).cast("long").alias("parent_conv_id")]
        top = roots.filter(F.lit(n_convs > 0)).select(*place, F.lit(n_convs).cast("long").alias("n_convs"), "n_children", "n_leaves", "saved_tokens")
        out = inner.union(top).join(_ends(chain), ["depth", "digest"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
        kept.append(materialise(out, "convtrie"))
    return kept[0]

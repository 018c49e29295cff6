"""MinHash near-dedup with bottom-k sketches of one hash function.

A document's set is its distinct word shingles, each a 64-bit hash; its sketch is the ``K`` least of them. Documents
with one set are one class from the start. Two classes link where 100 * intersection >= percent * union.

Of the K least hashes of the union of two sets that link, each is in both with the probability of their similarity,
and then in both sketches. At least :func:`least_shared` of them are, but for a chance of ``MISS`` for each pair (none
where the sketches hold the whole sets). So:

1. Inverted lists: sketch values that one class alone holds are dropped, and a class left with fewer than it must
   share has no partner. The others list a class under its rarest values only, so many that two classes that share
   enough must meet in a list; frequent shingles are hardly ever among them.
2. Overlaps out of the lists, first linear in their length: each member meets two leaders of its list, the one
   whose values are the most common ones (the original of many copies), and in its longest list a random one. After those links are
   verified, lists whose members are one component are done. Of the others, members of different components meet in
   lists of up to ``SHORT``.
3. The members of longer lists get lists anew, of their full sets (``refined``). There a set's rarest fifth must meet,
   without chance, and a value's place in both sets bounds how much they can share: copies of one original that differ
   from each other by more drop out, so hardly any list is left that isn't one component. What is left meets in one
   task up to ``CELL`` members, beyond by pairs of blocks. Nothing is left out.
4. Whoever meets over sketches is held against a map of the sketch of 256 bits (a set has as many values that the
   other lacks as its map has bits that the other's lacks, at least), then against the union sketch's estimate and maps
   of the full sets of 2,048 bits; who meets over full sets, against these maps. All that is left is verified on the full
   sets.

Edge cases: null and empty texts and texts without words have no shingles and link with nothing; with fewer words than
a shingle has, the whole sequence is one; repeated rows give repeated results; a null id never becomes a component's
id unless all its ids are null; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import ROW_KEY, map_batches, row_key, stand_in
from tidewell.operators.graph import components
from tidewell.session import discard, materialise, scratch

#: Words of a shingle, percent of similarity, values of a sketch, chance of a missed pair, members of a list of sketches that
#: all meet, members of a list of full sets that meet in one task.
SHINGLE, PERCENT, K, MISS, SHORT, CELL = 5, 80, 64, 1e-10, 32, 512
#: Longs of the maps of a sketch and of a full set.
WORDS, FULL = 4, 32


def least_shared(k: int = K, percent: int = PERCENT, miss: float = MISS) -> int:
    """The most values of which two linked sets share fewer with a chance of ``miss`` at most (binomial tail)."""
    p, tail, t = percent / 100, 0.0, 0
    while t < k:
        tail += math.comb(k, t) * p**t * (1 - p) ** (k - t)
        if tail > miss:
            break
        t += 1
    return max(t, 1)


def shingles(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Each text's set as sorted 64-bit hashes: words are hashed once a batch, a shingle from its words' hashes."""
    known: dict[bytes, int] = {}
    out = []
    for text in texts:
        words = text.encode().lower().split() if text else []
        if not words:
            out.append(np.zeros(0, np.int64))
            continue
        known |= {w: xxhash.xxh64_intdigest(w) for w in set(words) if w not in known}
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(words) - size + 1)
        key = np.full(n, min(len(words), size), np.uint64)
        for at in range(min(len(words), size)):
            key = (key ^ h[at : at + n]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
            key *= np.uint64(0xBF58476D1CE4E5B9)
            key ^= key >> np.uint64(32)
        out.append(np.unique(key.view(np.int64)))
    return out


def full_map(values: np.ndarray) -> np.ndarray:
    """Map of a full set: a bit for each value."""
    bits = np.zeros(64 * FULL, np.uint8)
    bits[values.view(np.uint64) % np.uint64(64 * FULL)] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def _maps_may_link(percent: int) -> Column:
    """Whether the full sets' maps (``mu``, ``mv``; sizes ``nu``, ``nv``) allow a link."""
    lacks = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))), F.lit(0), lambda s, x: s + x)
    least = (F.col("nu") + F.col("nv")) * percent
    return ((F.col("nu") - lacks("mu", "mv")) * (100 + percent) >= least) & ((F.col("nv") - lacks("mv", "mu")) * (100 + percent) >= least)


def _shared(n: Column, k: int, percent: int, miss: float) -> Column:
    """Values that a class of ``n`` shingles must share with one that it links to, in their sketches."""
    whole = F.floor((n * percent + 99) / 100).cast("int")  # both sketches hold the whole sets
    return F.when(n * 100 <= k * percent, whole).otherwise(F.least(F.lit(least_shared(k, percent, miss)), whole))


def _bits(values: Column) -> Column:
    """The map: ``WORDS`` longs with a bit set for each value."""
    word = lambda w: F.aggregate(
        values, F.lit(0).cast("long"), lambda m, v: F.when(F.pmod(F.shiftrightunsigned(v, 6), F.lit(WORDS)) == w, m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), v.bitwiseAND(F.lit(63)).cast("int")))).otherwise(m)
    )
    return F.array(*(word(w) for w in range(WORDS)))


def _lacks(a: str, b: str) -> Column:
    """Bits of ``a``'s map that ``b``'s lacks."""
    out = F.lit(0)
    for w in range(WORDS):
        out = out + F.bit_count(F.col(f"{a}.bits")[w].bitwiseAND(F.bitwise_not(F.col(f"{b}.bits")[w])))
    return out


def _may_link(percent: int) -> Column:
    """Whether the sizes and maps of ``x`` and ``y`` allow a link."""
    sizes = (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent) & (F.col("x.cid") != F.col("y.cid"))
    return sizes & (_lacks("x", "y") <= F.col("x.spare")) & (_lacks("y", "x") <= F.col("y.spare"))


def _classes(rows: DataFrame) -> DataFrame:
    """One row for each distinct set: a number, its size and sketch, and the key of its first row."""
    one = rows.filter("n > 0").groupBy("digest").agg(F.min("place").alias("first"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("map").alias("map"))
    return materialise(one.withColumn("cid", F.monotonically_increasing_id()), "minhash-classes")


def index(classes: DataFrame, k: int = K, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """The inverted lists: ``value``, the member ``m`` (``cid``, ``n``, ``spare``: values the partner may lack,
    ``score``, ``bits``), and whether the list is the ``longest`` that the member is in."""
    keyed = classes.select("cid", "n", F.explode("sketch").alias("value"))
    often = materialise(keyed.groupBy("value").agg(F.count(F.lit(1)).alias("often")).filter("often > 1"), "minhash-often")
    held = materialise(keyed.join(often, "value"), "minhash-held")
    own = held.groupBy("cid", "n").agg(F.array_sort(F.collect_list(F.struct("often", "value"))).alias("v"), F.sum(F.log2("often")).alias("score"))
    own = own.withColumn("shared", _shared(F.col("n"), k, percent, miss)).filter("size(v) >= shared")
    own = own.join(classes.select("cid", "sketch"), "cid")
    member = F.struct("cid", "n", (F.least(F.col("n"), F.lit(k)) - F.col("shared")).cast("int").alias("spare"), F.col("score").cast("float").alias("score"), _bits(F.col("sketch")).alias("bits"))
    placed = own.select(member.alias("m"), (F.size("v") - F.col("shared")).alias("last"), F.slice("v", F.lit(1), F.size("v") - F.col("shared") + 1).alias("v"))
    return materialise(placed.select("m", "last", F.posexplode(F.col("v.value")).alias("at", "value")).select("value", "m", (F.col("at") == F.col("last")).alias("longest")), "minhash-index")


def _meet_leaders(lists: DataFrame, percent: int) -> DataFrame:
    """Members with the central leader of each of their lists and a random one of their longest, where they may link."""
    leaders = lists.groupBy("value").agg(
        F.count(F.lit(1)).alias("members"), F.max(F.struct(F.col("m.score").alias("s"), F.col("m").alias("m")))["m"].alias("central"),
        F.min(F.struct(F.xxhash64("m.cid", "value").alias("h"), F.col("m").alias("m")))["m"].alias("random"),
    ).filter("members > 1").drop("members")
    met = lists.join(materialise(leaders, "minhash-leaders"), "value").select(F.col("m").alias("x"), F.explode(F.when(F.col("longest"), F.array("central", "random")).otherwise(F.array("central"))).alias("y"))
    return _pairs(met.filter(_may_link(percent)))


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("x.cid", "y.cid").alias("u"), F.greatest("x.cid", "y.cid").alias("v")).distinct()


def _labelled(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The lists with each member's component."""
    named = labels.select(F.col("node").alias("of"), "label")
    return lists.join(named, F.col("m.cid") == F.col("of"), "left").select("value", "m", F.coalesce("label", "m.cid").alias("label"))


def _open(labelled: DataFrame) -> DataFrame:
    """``value`` and ``members`` of the lists that hold more than one component."""
    sizes = labelled.groupBy("value").agg(F.count(F.lit(1)).alias("members"), F.min("label").alias("low"), F.max("label").alias("high"))
    return sizes.filter("low < high").select("value", "members")


_MET = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


def _meet_all(cells: DataFrame, fits: Callable[[dict[str, np.ndarray], int, np.ndarray], np.ndarray], percent: int) -> DataFrame:
    """Pairs of ``cells`` (``i``, ``j``: blocks; ``members``) that may link."""

    def make():
        return lambda c: list(map(list, zip(*{e for i, j, x in zip(*c) for e in meetings(x, i, j, percent, fits)}))) or [[], []]

    return map_batches(cells.select("i", "j", "members"), make, _MET).distinct()


def meetings(members: list[dict], i: int, j: int, percent: int, fits) -> list[tuple[int, int]]:
    """Pairs of one cell that may link and are in different components; in a cell of two blocks only those across."""
    m = {k: np.array([x[k] for x in members], np.int64) for k in members[0]}
    cid, n, label, out = m["cid"], m["n"], m["label"], []
    for at in range(len(cid) - 1):
        rest = slice(at + 1, None)
        ok = (label[rest] != label[at]) & (np.minimum(n[rest], n[at]) * 100 >= np.maximum(n[rest], n[at]) * percent)
        if i != j:
            ok &= m["own"][rest] != m["own"][at]
        k = np.flatnonzero(ok) + at + 1
        if k.size:
            out += [(int(min(cid[at], c)), int(max(cid[at], c))) for c in cid[k[fits(m, at, k)]]]
    return out


def _maps_fit(m: dict[str, np.ndarray], at: int, k: np.ndarray) -> np.ndarray:
    bits, spare = m["bits"], m["spare"]
    lacks = lambda x: np.bitwise_count(x.view(np.uint64)).sum(axis=1, dtype=np.int64)
    return (lacks(bits[at] & ~bits[k]) <= spare[at]) & (lacks(~bits[at] & bits[k]) <= spare[k])


def _meet_in_short_lists(labelled: DataFrame, open_: DataFrame, percent: int) -> DataFrame:
    """Members of different components that share a short list and may link."""
    held = labelled.join(open_.select("value"), "value")
    cells = held.groupBy("value").agg(F.collect_list(F.struct("m.cid", "m.n", "m.spare", "m.bits", "label")).alias("members"))
    return _meet_all(cells.withColumn("i", F.lit(0)).withColumn("j", F.lit(0)), _maps_fit, percent)


def refined(sets: DataFrame, percent: int) -> DataFrame:
    """Inverted lists of full sets (``cid``, ``set``): a set is listed under its rarest values, so many that two that
    link must meet (with their first common value in the order of rarity). ``m``: ``cid``, ``n``, and ``left``, the
    values from the listed one on, which bound what the set can share with another that it first meets there."""
    keyed = sets.select("cid", F.size("set").alias("n"), F.explode("set").alias("value"))
    often = materialise(keyed.groupBy("value").agg(F.count(F.lit(1)).alias("often")).filter("often > 1"), "minhash-often")
    own = keyed.join(often, "value").groupBy("cid", "n").agg(F.array_sort(F.collect_list(F.struct("often", "value"))).alias("v"))
    least = F.floor((F.col("n") * percent + 99) / 100).cast("int")
    placed = own.filter(F.size("v") >= least).select("cid", "n", F.size("v").alias("held"), F.posexplode(F.slice("v", F.lit(1), F.size("v") - least + 1)).alias("at", "x"))
    return materialise(placed.select(F.col("x.value").alias("value"), F.struct("cid", "n", (F.col("held") - F.col("at")).alias("left")).alias("m")), "minhash-refined")


def _meet_refined(lists: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, cell: int) -> DataFrame:
    """Members of different components that share a list of ``sets`` and may link, by their places and maps."""
    labelled = materialise(_labelled(lists, labels), "minhash-labelled")
    smallest = labelled.groupBy("value", "label").agg(F.min("m.n").alias("n"))
    two = smallest.withColumn("k", F.row_number().over(Window.partitionBy("value").orderBy("n", "label"))).filter("k <= 2")
    two = two.groupBy("value").agg(F.count(F.lit(1)).alias("labels"), F.min_by("label", "k").alias("first"), F.min("n").alias("n1"), F.max("n").alias("n2")).filter("labels = 2")
    met = labelled.join(materialise(two, "minhash-smallest"), "value")
    other = F.greatest(F.when(F.col("label") == F.col("first"), F.col("n2")).otherwise(F.col("n1")), F.floor((F.col("m.n") * percent + 99) / 100))  # size of the least partner
    able = materialise(met.filter(F.col("m.left") * (100 + percent) >= (F.col("m.n") + other) * percent).select("value", "m", "label"), "minhash-able")
    blocks = F.when(F.col("members") <= cell, 1).otherwise(F.ceil(F.col("members") * 2 / cell)).cast("int")
    held = materialise(able.join(_open(able).select("value", blocks.alias("blocks")), "value"), "minhash-open-members")  # apart from the grouping: a long list can be split
    own = held.join(sets.select(F.col("cid").alias("of"), "map"), F.col("m.cid") == F.col("of")).select("value", "m", "map", "label", "blocks", F.pmod(F.xxhash64("m.cid"), F.col("blocks")).cast("int").alias("own"))
    sent = own.select("value", "m", "map", "label", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = sent.groupBy("value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    cells = cells.agg(F.collect_list(F.struct("m.cid", "m.n", "m.left", "map", "label", "own")).alias("members"))

    def fits(m: dict[str, np.ndarray], at: int, k: np.ndarray) -> np.ndarray:
        least = (m["n"][k] + m["n"][at]) * percent
        ok = np.minimum(m["left"][k], m["left"][at]) * (100 + percent) >= least
        k, least = k[ok], least[ok]
        one, other = m["map"][at], m["map"][k]
        lacks = lambda x: np.bitwise_count(x.view(np.uint64)).sum(axis=1, dtype=np.int64)
        ok[ok] = ((m["n"][at] - lacks(one & ~other)) * (100 + percent) >= least) & ((m["n"][k] - lacks(~one & other)) * (100 + percent) >= least)
        return ok

    return _meet_all(cells, fits, percent)


def _likely(pairs: DataFrame, classes: DataFrame, k: int, percent: int, miss: float) -> DataFrame:
    """Pairs whose full sets' maps and union sketch allow a link."""
    side = lambda e, sketch: classes.select(F.col("cid").alias(e), F.col("n").alias(f"n{e}"), F.col("map").alias(f"m{e}"), F.col("sketch").alias(sketch))
    both = pairs.join(side("u", "a"), "u").join(side("v", "b"), "v").filter(_maps_may_link(percent)).select("u", "v", F.slice(F.array_sort(F.array_union("a", "b")), 1, k).alias("union"), F.array_intersect("a", "b").alias("both"))
    shared = F.size(F.array_intersect("union", "both"))
    enough = F.when(F.size("union") < k, shared * 100 >= F.size("union") * percent).otherwise(shared >= least_shared(k, percent, miss))
    return both.filter(enough).select("u", "v")


def _sets(need: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``cid``, ``set``, ``map`` of the classes ``need`` (column ``cid``), made anew from the text of their first rows."""
    keys = need.distinct().join(classes.select("cid", "first"), "cid").select("cid", *(F.col(f"first.{k}").alias(k) for k in ROW_KEY))
    texts = docs.select(*row_key(docs, id_col, text_col), F.col(text_col).cast("string").alias("text")).join(keys, ROW_KEY).select("cid", "text")

    def make():
        def step(c):
            sets = shingles(c[1], size)
            return [c[0], sets, [full_map(s) for s in sets]]

        return step

    schema = T.StructType([T.StructField("cid", T.LongType()), T.StructField("set", T.ArrayType(T.LongType())), T.StructField("map", T.ArrayType(T.LongType()))])
    return materialise(map_batches(texts, make, schema).groupBy("cid").agg(F.first("set").alias("set"), F.first("map").alias("map")), "minhash-sets")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("u", "v")).alias("cid"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that link on their full sets."""
    both = pairs.join(sets.select(F.col("cid").alias("u"), F.col("set").alias("a")), "u").join(sets.select(F.col("cid").alias("v"), F.col("set").alias("b")), "v")
    common = F.size(F.array_intersect("a", "b")).cast("long")
    counted = both.select("u", "v", common.alias("common"), (F.size("a") + F.size("b")).cast("long").alias("total"))
    return materialise(counted.filter(F.col("common") * 100 >= (F.col("total") - F.col("common")) * percent).select("u", "v"), "minhash-links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT, k: int = K, miss: float = MISS, short: int = SHORT, cell: int = CELL) -> DataFrame:
    """``id_col``, ``n_shingles``, ``component_id``: the smallest id that links reach from the row."""

    def make():
        def step(c):
            sets = shingles(c[3], size)
            return [c[0], c[1], c[2], [s.size for s in sets], [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], [s[:k] for s in sets], [full_map(s) for s in sets]]

        return step

    kind = docs.schema[id_col].dataType
    fields = [docs.schema[id_col], T.StructField("none", T.BooleanType()), T.StructField("th", T.LongType()), T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("sketch", T.ArrayType(T.LongType())), T.StructField("map", T.ArrayType(T.LongType()))]
    found = map_batches(docs.select(F.col(id_col), F.col(id_col).isNull().alias("none"), F.xxhash64(text_col).alias("th"), F.col(text_col).cast("string").alias("text")), make, T.StructType(fields))
    with scratch() as kept:
        rows = materialise(found.withColumn("place", F.struct("none", stand_in(id_col, kind).alias("id"), "th")), "minhash-rows")
        classes = _classes(rows)
        lists = index(classes, k, percent, miss)
        first = materialise(_likely(_meet_leaders(lists, percent), classes, k, percent, miss), "minhash-likely")
        sets = _sets(_ends(first), classes, docs, id_col, text_col, size)
        links = _verified(first, sets, percent)
        discard(sets)
        labels = materialise(components(links), "minhash-labels")

        labelled = materialise(_labelled(lists, labels), "minhash-labelled")
        open_ = materialise(_open(labelled), "minhash-open")
        more = materialise(_likely(_meet_in_short_lists(labelled, open_.filter(F.col("members") <= short), percent), classes, k, percent, miss), "minhash-likely")
        long = materialise(labelled.join(open_.filter(F.col("members") > short), "value", "left_semi").select("m.cid").distinct(), "minhash-long")
        sets = _sets(_ends(more).union(long), classes, docs, id_col, text_col, size)
        rest = _meet_refined(refined(sets.join(long, "cid", "left_semi"), percent), sets, labels, percent, cell)
        added = _verified(more.union(rest).distinct(), sets, percent)
        discard(sets)
        if not added.isEmpty():
            labels = components(links.union(added).distinct())
        named = classes.select("digest", "first", "cid").join(labels.select(F.col("node").alias("cid"), "label"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
        least = named.groupBy("label").agg(F.min("first").alias("best"))
        every = materialise(named.join(least, "label").select("digest", "best"), "minhash-every")
        kept += [rows, every]
    out = rows.join(every, "digest", "left")
    alone = F.when(F.col("best").isNull(), F.col(id_col)).when(~F.col("best.none"), F.col("best.id"))
    return out.select(id_col, F.col("n").alias("n_shingles"), alone.alias("component_id"))

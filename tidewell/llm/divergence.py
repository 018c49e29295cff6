"""Audit of how far a language's sources diverge in their vocabulary.

Terms are the runs of letters a-z (A-Z lower-cased) and non-ASCII characters. A language keeps the terms of at least
``MIN_DOCS`` of its documents. A group (language and source), and the language as a whole, gives each kept term the
share p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V)), all integers, where N sums the group's counts over
the V kept terms.

Count columns are deduplicated: the terms of a language with the same sparse vector of counts by source are one
vector with a multiplicity. Every pair of sources is evaluated once for each distinct vector, and the difference of
shares is multiplied by the multiplicity. The terms themselves are ranked one by one against the whole language.

Python tokenizes and pre-aggregates (a task holds ``HELD`` counts at most, then passes them on); everything after is
DataFrames. A language's shares are exploded to pairs row by row, so memory follows the number of sources, and the
result has a row for each ordered pair of them by definition.

Edge cases: null text, language and source are ''; a document is a row, so repeated rows count again; groups without
terms take part with count 0; a language without kept terms has pairs of value 0; a language of one source has no
pairs; ties go by the item's UTF-8 bytes; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import bound_batches
from tidewell.session import materialise, scratch

#: Least documents of a kept term, smoothing, scale of shares, ranks of the term report, counts that a task holds.
MIN_DOCS, SMOOTH, SCALE, TOP, HELD = 30, 5, 1_000_000_000, 50, 400_000

_TO_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
COUNTS = "lang string, source string, term string, n long, docs long"


def _read(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(k) for c, k in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))


def counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences), ``docs`` (documents with the term), one row or more for each
    combination, of ``docs`` (``lang``, ``source``, ``text``)."""
    bound_batches(docs.sparkSession)
    names = ["lang", "source", "term", "n", "docs"]

    def rows(seen, in_docs):
        where = [(*key, term, n, in_docs[key][term]) for key, terms in seen.items() for term, n in terms.items()]
        for at in range(0, len(where), 1 << 15):
            lang, source, term, n, d = zip(*where[at : at + (1 << 15)])
            yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(source), pa.array([t.decode() for t in term]), pa.array(n, pa.int64()), pa.array(d, pa.int64())], names)

    def run(batches):
        seen: dict[tuple, Counter] = {}
        in_docs: dict[tuple, Counter] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = Counter(text.translate(_TO_TERMS).split())
                own, own_docs = seen.setdefault((lang, source), Counter()), in_docs.setdefault((lang, source), Counter())
                size -= len(own)
                own.update(found)
                own_docs.update(found.keys())
                size += len(own)
                if size > held:
                    yield from rows(seen, in_docs)
                    seen, in_docs, size = {}, {}, 0
        if size:
            yield from rows(seen, in_docs)

    return docs.select("lang", "source", F.col("text").cast("binary")).mapInArrow(run, COUNTS)


def share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * count / total), exact: the scale is multiplied in two steps, each with its remainder."""
    a, b = 31_250, SCALE // 31_250
    whole, rest = F.call_function("div", count * a, total), F.pmod(count * a, total)
    return 1 + whole * b + F.call_function("div", rest * b, total)


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS, held: int = HELD) -> DataFrame:
    """``lang``, ``term``, ``counts``: its occurrences by source, as an array of (source, n) in the order of sources."""
    one = counts(docs, held).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = one.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("counts"))
    return whole.filter(F.col("docs") >= min_docs).select("lang", "term", "counts")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, top: int = TOP, held: int = HELD) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item`` (other source or term), ``value``, ``rank``."""
    rows = _read(docs, text_col, lang_col, source_col)
    with scratch() as kept:
        terms = materialise(kept_terms(rows, min_docs, held), "divergence-terms")
        spread = terms.select("lang", "term", F.inline("counts"))
        sizes = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
        totals = spread.groupBy("lang", "source").agg(F.sum("n").alias("n"))
        groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
        groups = groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"))
        groups = materialise(groups.withColumn("whole", F.col("n") + SMOOTH * F.col("v")), "divergence-groups")

        kept.append(materialise(_pairs(terms, groups).union(_terms(spread, terms, groups, top)), "divergence"))
    return kept[0]


def _ranked(found: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """Each source against each other of its language, over the distinct vectors."""
    vectors = materialise(terms.groupBy("lang", "counts").agg(F.count(F.lit(1)).alias("times")), "divergence-vectors")
    sources = groups.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "whole"))).alias("sources"))
    of = F.map_from_entries("counts")
    shares = F.transform("sources", lambda s: share(F.coalesce(F.element_at(F.col("of"), s["source"]), F.lit(0)) + SMOOTH, s["whole"]))
    dense = vectors.select("lang", "times", of.alias("of")).join(sources, "lang").select("lang", "times", shares.alias("p"))
    each = dense.select("lang", "times", "p", F.posexplode("p").alias("i", "a"))
    both = each.select("lang", "times", "i", "a", F.posexplode(F.slice("p", F.col("i") + 2, F.size("p"))).alias("k", "b"))
    sums = both.groupBy("lang", "i", (F.col("i") + 1 + F.col("k")).alias("j")).agg(F.sum(F.abs(F.col("a") - F.col("b")) * F.col("times")).alias("value"))
    sums = sums.select("lang", F.inline(F.array(F.struct(F.col("i"), F.col("j"), F.col("value")), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), F.col("value")))))
    every = sources.select("lang", F.posexplode(F.col("sources.source")).alias("i", "source"), F.col("sources.source").alias("others"))
    every = every.select("lang", "i", "source", F.posexplode("others").alias("j", "item")).filter("i <> j")
    found = every.join(sums, ["lang", "i", "j"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))
    return _ranked(found, "pair")


def _terms(spread: DataFrame, terms: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The terms that a source has more of than its language."""
    whole = groups.groupBy("lang").agg((F.sum("n") + SMOOTH * F.max("v")).alias("all"))
    own = terms.select("lang", "term", F.inline("counts"), F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("every"))
    held = own.join(groups.select("lang", "source", "whole"), ["lang", "source"]).join(whole, "lang")
    value = share(F.col("n") + SMOOTH, F.col("whole")) - share(F.col("every") + SMOOTH, F.col("all"))
    found = held.select("lang", "source", F.col("term").alias("item"), value.alias("value")).filter("value > 0")
    return _ranked(found, "term").filter(F.col("rank") <= top)

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewell.llm import divergence

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top=50):
    rows = [tuple(x or "" for x in r) for r in rows]
    words = [(la, so, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(LOW))) for la, so, t in rows]
    out = []
    for lang in {la for la, _, _ in words}:
        docs = Counter(t for la, _, w in words if la == lang for t in set(w))
        kept = {t for t, n in docs.items() if n >= least}
        by = {so: Counter() for la, so, _ in words if la == lang}
        for la, so, w in words:
            if la == lang:
                by[so].update(t for t in w if t in kept)
        every = sum(by.values(), Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))
        for so, c in by.items():
            pairs = [(x, sum(abs(share(c, t) - share(d, t)) for t in kept)) for x, d in by.items() if x != so]
            terms = [(t, share(c, t) - share(every, t)) for t in kept if c[t] and share(c, t) > share(every, t)]
            for part, found in (("pair", pairs), ("term", terms)):
                order = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, so, part, item, value, k) for k, (item, value) in enumerate(order, 1) if part == "pair" or k <= top]
    return out


def audited(spark, rows, **how):
    df = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("term", F.lit(1)).withColumn("n", F.lit("x")).withColumn("value", F.lit(0))
    return sorted(tuple(r) for r in divergence.audit(df, **how).collect())


@pytest.mark.parametrize("held", [3, 400_000])
def test_equals_plain(spark, held):
    rng = random.Random(held)
    words = ["The", "the", "straße", "Ünter", "a", "b", "won't", "x1y", "日本", "rare"]
    rows = [(rng.choice(["de", "en", None]), rng.choice(["s0", "s0", "s0", "s1", "s2", None, "é"]), " ".join(rng.choices(words, k=rng.randrange(12)))) for _ in range(150)]
    rows += [("en", "s9", None), ("en", "s8", "12 34"), ("xx", "s1", "few words"), ("xx", "s2", ""), ("one", "s1", "alone " * 9)] + [rows[0]] * 40
    assert audited(spark, rows, min_docs=5, held=held) == sorted(plain(rows, 5))


def test_top_and_one_vector_for_many_terms(spark):
    """Terms that always occur together have one vector; the report stops at its rank, ties by bytes."""
    text = " ".join("".join(chr(97 + (i // 26**k) % 26) for k in range(3)) for i in range(120))
    rows = [("en", f"s{k % 3}", text + (" zz" if k % 3 else "")) for k in range(30)] + [("en", "s1", "zz"), ("en", "s3", "ÿ")]
    got = audited(spark, rows, min_docs=3)
    assert got == sorted(plain(rows, 3))
    assert sum(r[2] == "term" and r[1] == "s0" for r in got) == 50


def test_shares_are_exact(spark):
    cases = [(5, 7), (10**11 + 3, 10**12 + 1), (2 * 10**14 - 1, 2 * 10**14), (1, 10**14), (3, 3)]
    df = spark.createDataFrame(cases, "c long, d long")
    got = {(r.c, r.d): r.p for r in df.select("c", "d", divergence.share(F.col("c"), F.col("d")).alias("p")).collect()}
    assert got == {(c, d): 1 + 10**9 * c // d for c, d in cases}


def test_empty(spark):
    df = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(df).count() == 0

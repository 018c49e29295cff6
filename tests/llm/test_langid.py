import collections
import math
import random
import zlib

import numpy as np

from tidewell.llm import langid, queries
from tidewell.llm.common import lowest_hashes


def test_grams():
    assert langid.grams(None).size == langid.grams("12 !?").size == langid.grams("").size == 0
    # space, a, b, space: 2 letters, 3 pairs, 2 triples, none of them blank
    assert langid.grams("Ab").size == 2 + 3 + 2
    assert np.array_equal(langid.grams("ab"), langid.grams("AB")) and not np.array_equal(langid.grams("ab"), langid.grams("ba"))


def test_posterior_is_plain_naive_bayes(spark):
    rows = [(i, ("the cat and the hat" if i % 2 else "der hund und die katze") + f" {'abc'[i % 3]}", "en" if i % 2 else "de") for i in range(60)]
    odd = [(100, None, "en"), (101, "123", "de"), (102, "", None), (None, "the hat", "en"), (1, rows[1][1], "en")]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").selectExpr("*", "1 as id", "2 as score", "3 as n")
    model = langid.train(df)
    assert model[0] == ["de", "en"]
    got = langid.identify(df, model).collect()
    assert len(got) == 65
    for r, (_, text, _) in zip(got, rows + odd):
        found = langid.grams(text)
        if not found.size:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        z = [model[1][k] + sum(float(model[2][g, k]) for g in found) for k in (0, 1)]
        assert r.lang_pred == model[0][int(z[1] > z[0])]
        assert math.isclose(r.score, 1 / (1 + math.exp(min(z) - max(z))), rel_tol=1e-4)
    assert langid.identify(df.limit(0), model).count() == 0
    none = langid.train(df.limit(0))
    assert {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}


def plain_grams(text):
    """Character n-grams of the lower-cased text, letters kept, all else a space; blank ones don't count."""
    low = "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} ")
    return [low[i : i + n] for n in (1, 2, 3) for i in range(len(low) - n + 1) if low[i : i + n].strip()]


def test_training_counts_are_those_of_the_texts(spark):
    rows = [(i, f"{'the cat; thé' if i % 2 else 'der hund'} {'ab'[i % 2] * (i % 5)}", "en" if i % 2 else "de") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, prior, matrix = langid.train(df)
    kept = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    for k, lang in enumerate(langs):
        texts = [t for _, t, l in kept if l == lang]
        assert math.isclose(prior[k], math.log(len(texts) / len(kept)))
        count = collections.Counter(g for t in texts for g in plain_grams(t))
        bucket = {}
        for t in texts:  # n-grams in the order of size, then place: the same in both
            for g, b in zip(plain_grams(t), langid.grams(t).tolist()):
                assert bucket.setdefault(g, b) == b
        by_bucket = collections.Counter()
        for g, n in count.items():
            by_bucket[bucket[g]] += n
        total = sum(by_bucket.values()) + langid.ALPHA * (1 << langid.BITS)
        for b, n in by_bucket.items():
            assert math.isclose(matrix[b, k], math.log((n + langid.ALPHA) / total), rel_tol=1e-5)


def test_pieces_and_batches_change_nothing(monkeypatch):
    texts = ["The cat Σas; ΑΣ.", None, "", "123", "x" * 100, "Ünï cödé " * 30, "a"]
    want = [sorted(langid.grams(t).tolist()) for t in texts]
    for block in (1, 2, 3, 7, 50):
        monkeypatch.setattr(langid, "BLOCK", block)
        got = [[] for _ in texts]
        for text, bucket in langid.batch_grams(texts):
            for k, b in zip(text.tolist(), bucket.tolist()):
                got[k].append(b)
        assert [sorted(g) for g in got] == want
    assert [len(w) for w in want] == [len(plain_grams(t)) for t in texts]


def test_blocks_of_languages_change_nothing(spark, monkeypatch):
    r = random.Random(3)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(40)]
    rows = [(i, f"{words[i % 40]} " * (1 + i % 3), f"l{i % 40:02}") for i in range(400)] + [(7, None, None), (None, "123", None), (7, words[3], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as row", "2 as top")
    model = langid.train(df)
    assert len(model[0]) == 40 and model[2].shape == (1 << 16, 40)
    whole = sorted(map(tuple, langid.identify(df, model).collect()), key=str)
    for block in (1, 7, 39):
        monkeypatch.setattr(langid, "LANGS", block)
        parts = sorted(map(tuple, langid.identify(df, model).collect()), key=str)
        assert [p[:2] for p in parts] == [w[:2] for w in whole] and np.allclose([p[2] for p in parts], [w[2] for w in whole], rtol=1e-9)
    assert langid.predict([f"{w} {w}" for w in words], model)[0] == [f"l{k:02}" for k in range(40)]


def test_sample_is_bounded_by_rows(spark):
    rows = [(1, f"t{k % 7}") for k in range(500)] + [(None, "n")] * 300 + [(k, "x") for k in range(2, 60)]
    df = spark.createDataFrame(rows, "id long, text string")
    for limit in (1, 10, 100, 400, 1000):
        got = [sorted((str(r.id), r.text) for r in lowest_hashes(df.repartition(n), "id", limit).collect()) for n in (1, 5)]
        assert len(got[0]) == min(limit, len(rows)) and got[0] == got[1]
    assert lowest_hashes(df.limit(0), "id", 5).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op4_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.filter("held_out").collect()
    assert got.count() == 1000 and sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)

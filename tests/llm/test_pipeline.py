import hashlib

import numpy as np
import tiktoken  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_decontam import words
from tests.llm.test_linededup import plain as plain_lines
from tests.llm.test_simhash import plain as plain_fp
from tests.llm.test_simhash import plain_components
from tidewell.llm import bpe, toxicity


def test_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(docs, labels)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(i, t) for i, t in rows if model is None or toxicity.scores([t], model)[0] < 0.5]
    rows = list(plain_lines(rows).items())
    fps = {i: plain_fp(t) for i, t in rows}
    comp = plain_components(fps.values())
    first = {}
    for i, _ in sorted(rows):
        first.setdefault(comp[fps[i]], i)
    rows = [(i, t) for i, t in rows if i in set(first.values())]
    wins = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = words(r.text)
        wins |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in wins}
    hit = lambda w: any(tuple(w[k : k + n]) in wins for n in sizes for k in range(len(w) - n + 1))
    rows = [(i, t) for i, t in rows if not hit(words(t))]
    enc = bpe.Codec.cached(bpe.read_ranks(corpus_pipeline.RANKS), corpus_pipeline.public_tokenizers.PATTERN).encoding
    want = {i: enc.encode_ordinary(t or "") for i, t in rows}
    got = corpus_pipeline.run(spark, sf).collect()
    assert len(got) == len(want) and {r.doc_id: list(r.ids) for r in got} == want
    assert all(r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest() for r in got)


def test_stages_keep_columns_and_stand_odd_rows(spark, sf, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "x\ny\nz", "en", "s", 5), (3, "x\ny\nz", "en", "s", 5), (4, "w " * 30000, None, "s", 60000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("fp", F.lit(1)).withColumn("score", F.lit("s"))
    for frame in (docs, docs.limit(0)):
        now = frame
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, sf)
            assert name == corpus_pipeline.STAGES[-1][0] or out.columns == docs.columns
            out.write.mode("overwrite").parquet(f"{tmp_path}/{len(frame.columns)}-{name}")
            now = spark.read.parquet(f"{tmp_path}/{len(frame.columns)}-{name}")
        assert (now.count() > 0) == (frame is docs)

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidewell.llm import convtrie, queries
from tidewell.sources.tables import read_table

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """The contract over (conv_id, turn, role, text), by walking every node's members."""
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    convs = {c: [x[2:] for x in sorted(v, key=lambda y: (y[:2], hashlib.sha256(f"{len(y[2].encode())}:{y[2]}{y[3]}".encode()).digest()))] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(convs.get(c - c % 5, [])[:h] + own[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    out = []
    for seq, who in members.items():
        below = [s for s in members if s[: len(seq)] == seq]
        leaves = [s for s in below if not any(len(x) == len(s) + 1 and x[: len(s)] == s for x in members)]
        saved = sum((len(members[s]) - 1) * len(s[-1][1].encode()) for s in below if s)
        ends = ",".join(map(str, sorted(c for c in who if built[c] == seq)))
        kids = sum(len(s) == len(seq) + 1 for s in below)
        out.append((min(who), len(seq), min(members[seq[:-1]]) if seq else None, len(who), kids, len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def found(df):
    return sorted((tuple(r) for r in queries.conversation_nodes(df).select(*COLUMNS).collect()), key=str)


def test_random_conversations(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", None, ""]), rng.choice(["a", "b", "é", None])) for c in range(60) if c % 7 for t in range(rng.randrange(1, 12))]
    rows += [(2, None, "user", "first"), (2, None, "user", "first"), (None, 1, "user", "nobody"), (61, 1, "u", "x" * 5000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("clash")).withColumn("digest", F.lit(1))
    assert found(df) == sorted(plain(rows), key=str)


def test_copies_of_one_conversation_and_a_long_one(spark):
    rows = [(5 * c, t, "user", f"same {t}") for c in range(200) for t in range(3)] + [(7, t, "u", str(t % 3)) for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert found(df) == sorted(plain(rows), key=str)


def test_lists_of_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(convtrie, "CHUNK_BITS", 2)
    rows = [(c * 5, 0, "user", "x") for c in range(90)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found(df) == sorted(plain(rows), key=str)


def test_empty(spark, sf):
    assert queries.conversation_nodes(read_table(spark, sf, "conversations").limit(0)).count() == 0


@pytest.mark.parametrize("text", ["", None])
def test_root_alone(spark, text):
    """Its own turn goes and there is no conversation to begin from: a member of the root."""
    c = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    df = spark.createDataFrame([(c, 0, "user", text)], "conv_id long, turn long, role string, text string")
    assert found(df) == plain([(c, 0, "user", text)])

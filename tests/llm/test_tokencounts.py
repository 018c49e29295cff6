import collections
import functools
import math
import random

import public_tokenizers as P
import pytest

from tidewell.llm import tokencounts as t

MODEL = P.path("piece_bpe_32k.model")
SCORES = t.by_rank(t.read_pieces(MODEL))


def brute(word, scores, lowest):
    """Count of pieces and the pieces of the best segmentation."""
    marked = t.MARK + word

    @functools.cache
    def best(end):
        if not end:
            return 0.0, 0, ()
        prev, n, own = best(end - 1)
        size = len(marked[end - 1].encode())
        options = [(prev + size * lowest, -(n + size), own)]
        for start in range(max(0, end - 40), end):
            if marked[start:end] in scores:
                z, n, own = best(start)
                options.append((z + scores[marked[start:end]], -(n + 1), (*own, marked[start:end])))
        z, n, own = max(options, key=lambda x: x[:2])
        return z, -n, own

    for end in range(len(marked)):
        best(end)
    return best(len(marked))[1:]


def test_counts_and_segments_equal_plain_search():
    r = random.Random(4)
    words = ["".join(r.choice("theangoré漢😀x") for _ in range(r.randrange(1, 14))) for _ in range(300)] + ["the", "then", "thenth", "a" * 300]
    lowest = min(SCORES.values())
    trie = t.Trie(SCORES)
    for w in words:
        n, own = brute(w, SCORES, lowest)
        assert trie.tokens(w) == n == trie.tokens(w) and tuple(reversed(trie.segments(w))) == own
    small = {t.MARK: -1.0, "a": -1.0, "aa": -2.0, "b": -3.0}
    trie = t.Trie(small)
    assert [trie.tokens(w) for w in ("aa", "aab", "ab", "c")] == [brute(w, small, -3.0)[0] for w in ("aa", "aab", "ab", "c")]


def test_prefixes_are_shared_and_nodes_bounded():
    trie = t.Trie(SCORES)
    trie.tokens("theatre")
    made = len(trie.best)
    assert made == len(t.MARK + "theatre") + 1
    trie.tokens("theatres")
    trie.tokens("the")
    assert len(trie.best) == made + 1 and trie.terminal.keys() == {"theatre", "theatres", "the"}
    few = t.Trie(SCORES, nodes=20)
    words = [f"word{k}" for k in range(50)]
    assert [few.tokens(w) for w in words] == [trie.tokens(w) for w in words] and len(few.best) < 40 and len(few.terminal) < 10


@pytest.mark.parametrize("word", ["theangoré漢😀x" * 9, "a" * 700])
def test_long_pretokens(word):
    assert t.Trie(SCORES).long(word) == brute(word, SCORES, min(SCORES.values()))[0]
    assert t.Trie({}).long("é") == t.Trie({}).tokens("é") == len((t.MARK + "é").encode())


def texts(n=60):
    r = random.Random(9)
    words = ["the", "cat", "catalogue", "Haus", "häuser", "x" * 30, "漢字", "theatre"]
    return [" ".join(r.choices(words, k=r.randrange(20))) for _ in range(n)] + [None, "", " \t", "one" * 20]


def learned(rows, long):
    """The scores by counting every word's pieces."""
    lowest, count = min(SCORES.values()), collections.Counter()
    for x in rows:
        for w in (x or "").split():
            for at in range(0, len(w), long):
                count.update(brute(w[at : at + long], SCORES, lowest)[1])
    total = sum(count.values()) + t.SMOOTH * len(SCORES)
    return {p: math.log((count[p] + t.SMOOTH) / total) for p in SCORES}


@pytest.mark.parametrize("held", [2, 1000])
def test_words_and_scores_are_those_of_all_documents(spark, held):
    rows = texts()
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "doc_id long, text string").repartition(5)
    words = t.word_counts(df, held=held, long=25)
    got = {r.word: r.n for r in words.collect()}
    assert got == collections.Counter(w[at : at + 25] for x in rows for w in (x or "").split() for at in range(0, len(w), 25))
    scores, want = t.learn(words, t.read_pieces(MODEL)), learned(rows, 25)
    assert scores.keys() == want.keys() and all(math.isclose(scores[p], want[p], rel_tol=1e-9) for p in want)


@pytest.mark.parametrize("common", [0, 3, 1000])
def test_frame(spark, monkeypatch, common):
    monkeypatch.setattr(t, "COMMON", common)
    rows = [(i, x) for i, x in enumerate(texts())] + [(1, "the cat  the\nhat"), (1, "the cat  the\nhat"), (None, "x" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_tokens", "2 as word")
    got = [(r.doc_id, r.n_pretokens, r.n_tokens) for r in t.count_tokens(df, MODEL).collect()]
    scores = learned([x for _, x in rows], t.LONG)
    lowest = min(scores.values())
    want = [(i, len((x or "").split()), sum(brute(w, scores, lowest)[0] for w in (x or "").split())) for i, x in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert t.count_tokens(df.limit(0), MODEL).count() == 0


def test_common_words_are_chosen_by_count(spark):
    df = spark.createDataFrame([(str(i), n) for i, n in enumerate([9, 7, 7, 3, 3, 3, 1, 1])], "word string, n long")
    assert [t.least_count(df, k) for k in (0, 1, 2, 3, 5, 6, 8, 99)] == [1 << 62, 9, 9, 7, 7, 3, 1, 1]
    assert t.least_count(df.limit(0), 5) == 1 << 62


import numpy as np
import pytest

from tidewell.llm import queries, toxicity


def test_features_do_not_depend_on_neighbours():
    texts = ["Hello wörld hello", None, "", "a" * 5000, "x y z\n" * 50, "Hello wörld hello"]
    off, idx = toxicity.features(texts)
    assert len(off) == len(texts) + 1 and off[1] == off[2] == off[3]
    for i, t in enumerate(texts):
        o, x = toxicity.features([t])
        assert np.array_equal(x, idx[off[i] : off[i + 1]])
    assert toxicity.features([]) [0].tolist() == [0]


def test_learns_from_positive_and_unlabelled(spark):
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        words = [f"w{rng.integers(200)}" for _ in range(30)] + (["vilebad", "grimtext"] if toxic else [])
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    rows += [(900, None), (901, ""), (None, "vilebad grimtext"), (0, rows[0][1])]
    labels += [(None, 1), (3, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as toxic", "2 as id", "3 as score")
    l = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(d, l)
    got = [(r.doc_id, r.score) for r in toxicity.score(d, model).collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s in got)
    wrong = sum((s >= 0.5) != (i % 6 == 0) for i, s in got if i is not None and i < 900)
    assert wrong < 15
    assert all(s < 0.5 for i, s in got if i in (900, 901))
    assert toxicity.score(d.limit(0), model).count() == 0
    assert toxicity.train(d, l.limit(0)) is None
    assert toxicity.train(d.limit(0), l) is None
    assert {r.score for r in toxicity.score(d, None).collect()} == {0.0}


@pytest.mark.parametrize("shift", [-3.0, 0.0, 3.0])
def test_slopes_are_the_gradient_of_the_risk(shift):
    rng = np.random.default_rng(7)
    zp, zu, prior = rng.normal(2, 1, 30), rng.normal(shift, 1, 50), 0.4
    loss = lambda z, sign: np.mean([np.log1p(np.exp(-sign * v)) for v in z])
    second = lambda p, u: loss(u, -1) - prior * loss(p, -1)
    positive = second(zp, zu) >= 0
    target = (lambda p, u: prior * loss(p, 1) + second(p, u)) if positive else (lambda p, u: -second(p, u))
    dp, du = toxicity.slopes(zp, zu, prior)
    for z, d, other in ((zp, dp, 0), (zu, du, 1)):
        for k in (0, 7, 29):
            up, down = z.copy(), z.copy()
            up[k] += 1e-5
            down[k] -= 1e-5
            numeric = (target(up, zu) - target(down, zu) if not other else target(zp, up) - target(zp, down)) / 2e-5
            assert abs(numeric - d[k]) < 1e-7
    assert positive == (shift != -3.0)


def test_fit_lowers_the_risk_of_the_estimator():
    rng = np.random.default_rng(9)
    row = lambda toxic: np.unique(np.concatenate((rng.integers(100, 400, 12), [1, 2, 3] if toxic else [])).astype(np.int64))
    positive, unlabelled = [row(True) for _ in range(200)], [row(k % 5 == 0) for k in range(800)]
    weights, bias = toxicity.fit_nnpu(positive, unlabelled, 0.2)
    z = lambda rows: np.array([weights[x].sum() + bias for x in rows])
    assert (z(positive) > 0).all() and [v > 0 for v in z(unlabelled)] == [k % 5 == 0 for k in range(800)]
    assert np.flatnonzero(weights).tolist() == [1, 2, 3]


def _of(text):
    return set(toxicity.features([text])[1].tolist())


def test_words_count_to_their_end():
    a, b = "incomprehensibilities", "incomprehensibilityxx"
    assert a[:16] == b[:16] and _of(a) != _of(b)
    assert len({frozenset(_of("x" * 40 + c)) for c in "abcdefg"}) == 7
    assert _of("clean\u00a0vilebad\u3002Grimtext") == _of("clean vilebad grimtext")
    assert _of("a\u200cb") != _of("a b")


def test_parts_of_runs_without_spaces_count():
    han = "".join(chr(0x4E00 + k) for k in range(3000))
    full = _of(han)
    for k in (0, 7, 1500, 2990):
        assert _of(han[k : k + 3]) & full, k
        assert full - _of(han[:k] + "\u9f8d" + han[k + 1 :]), k
    tail = "donaudampfschifffahrtsgesellschafts"
    assert len((_of(tail + "grimtext") & _of("hauptverwaltungsrats" + "grimtext")) - _of(tail)) >= 10
    texts = [han, None, "a b", "wörld" * 9, "", "x" * 17, "x" * 16]
    off, idx = toxicity.features(texts)
    assert all(set(idx[off[i] : off[i + 1]].tolist()) == (_of(t) if t else set()) for i, t in enumerate(texts))


def test_learns_without_spaces(spark):
    rng = np.random.default_rng(1)
    run = lambda n: "".join(chr(0x4E00 + c) for c in rng.integers(0, 400, n))
    rows = [(i, run(40) + ("\u9f8d\u9f9c\u9f9f" if i % 6 == 0 else "") + run(40)) for i in range(900)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    l = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(0, 900, 2)], "doc_id long, toxic int")
    got = toxicity.score(d, toxicity.train(d, l)).collect()
    assert sum((r.score >= 0.5) != (r.doc_id % 6 == 0) for r in got) < 15


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op10_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").select("toxic", "score").collect()
    pos, neg = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.85 and got.count() == 1000


def plain_fit(positive, unlabelled, prior, steps=400, rate=0.05, decay=5e-5):
    """The fit on dense rows, each step by the risk's own definition: lift, non-negative gradient, Adam, calibration."""
    count = lambda rows: {f: sum(f in r for r in rows) for f in {f for r in rows for f in r.tolist()}}
    in_p, in_u = count(positive), count(unlabelled)
    used = []
    for f, n in in_p.items():
        share = (in_u.get(f, 0) + 0.5) / (len(unlabelled) + 1)
        lift = (n - len(positive) * share) / (len(positive) * share * (1 - share)) ** 0.5
        if n >= min(toxicity.MIN_POSITIVE, max(1, len(positive) // 2)) and lift >= min(toxicity.MIN_LIFT, len(positive) ** 0.5 / 2):
            used.append(f)
    used.sort()
    dense = lambda rows: np.array([[f in set(r.tolist()) for f in used] + [1] for r in rows], float)
    p, u = dense(positive), dense(unlabelled)
    w = np.append(np.zeros(len(used)), np.log(prior / (1 - prior)))
    m, v = np.zeros_like(w), np.zeros_like(w)
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    for t in range(1, steps + 1):
        zp, zu = p @ w, u @ w
        to_positive = lambda z, x: ((sigmoid(z) - 1)[:, None] * x).mean(axis=0)
        to_negative = lambda z, x: (sigmoid(z)[:, None] * x).mean(axis=0)
        rest = np.log1p(np.exp(zu)).mean() - prior * np.log1p(np.exp(zp)).mean()
        slope = to_negative(zu, u) - prior * to_negative(zp, p)
        grad = prior * to_positive(zp, p) + slope if rest >= 0 else -slope
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w = np.append((w[:-1] - step[:-1]) * (1 - rate * decay * 100), w[-1] - step[-1])
    margins = u[:, :-1] @ w[:-1]
    return dict(zip(used, w[:-1])), -max(np.quantile(margins, 1 - prior), 1e-3)


@pytest.mark.parametrize("prior", [0.15, 0.5])
def test_whole_fit_equals_a_plain_one(prior):
    rng = np.random.default_rng(int(prior * 100))
    row = lambda toxic: np.unique(np.concatenate((rng.integers(50, 120, 10), rng.choice(8, 3) if toxic else rng.choice(40, 2))).astype(np.int64))
    positive, unlabelled = [row(True) for _ in range(80)], [row(k % 5 == 0) for k in range(240)]
    weights, bias = toxicity.fit_nnpu(positive, unlabelled, prior)
    want, cut = plain_fit(positive, unlabelled, prior)
    assert set(np.flatnonzero(weights)) <= set(want) and len(want) > 2
    assert np.allclose([weights[f] for f in want], list(want.values()), rtol=1e-4, atol=1e-5) and abs(bias - cut) < 1e-4

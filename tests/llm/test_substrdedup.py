import random
import re

import pytest

from tidewell.llm import substrdedup as s


def plain_units(text):
    """Line by line, sentence by sentence, without the module's pattern."""
    out, line_parts = [], re.split(r"(\n+)", text)
    for body, end in zip(line_parts[::2], [*line_parts[1::2], ""]):
        pieces, rest = [], body
        while m := re.search(r"[.!?]+[^\S\n]+", rest):
            pieces.append(rest[: m.end()])
            rest = rest[m.end() :]
        tail_joins = pieces and not rest  # sentence mark, blanks, then the line's end: one end
        pieces = pieces[:-1] + [pieces[-1] + end] if tail_joins else [*pieces, rest + end]
        unit = ""
        for k, p in enumerate(pieces):
            unit += p
            if k == len(pieces) - 1 or len(unit.split()) >= 4:
                out.append(unit)
                unit = ""
    merged = []
    for u in out:  # white space at the start of a line that follows a sentence end belongs to that end
        if merged and merged[-1].endswith("\n") and re.search(r"[.!?]\s+$", merged[-1]) and u and not u.strip():
            merged[-1] += u
        elif u:
            merged.append(u)
    return merged


def brute(rows, min_words):
    """{row: spans}: quadratic look-back over normalised units, greedy runs."""
    seen, out = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        at, marked, words = 0, [], 0
        for k in range(len(c := s.cut(t)) - 1):
            unit = t[c[k] : c[k + 1]]
            key = " ".join(unit.lower().split())
            if key:
                if key in seen and seen[key] != (i, c[k]):
                    marked.append((c[k], c[k + 1], words, words + len(key.split())))
                else:
                    seen[key] = (i, c[k])
            words += len(unit.split())
        runs = []
        for m in marked:
            if runs and m[2] - runs[-1][-1][3] < 4:
                runs[-1].append(m)
            else:
                runs.append([m])
        spans = []
        for run in runs:
            if sum(m[3] - m[2] for m in run) >= min_words:
                for a, b, _, _ in run:
                    if spans and spans[-1][1] == a:
                        spans[-1] = (spans[-1][0], b)
                    else:
                        spans.append((a, b))
        out[i] = spans
    return out


def text(r, n):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 7))) + r.choice(["", "", "", "", ".", "!", "\n"]) for _ in range(n))


def test_cuts_cover_text():
    for t in ("", "a", "A b. C d!\n\n e", " . x", "no end", "x.\n", "one two three four. five. six\nseven"):
        c = s.cut(t)
        assert "".join(t[a:b] for a, b in zip(c, c[1:])) == t
    r = random.Random(8)
    for _ in range(50):
        t = " ".join(r.choice(["a", "b.", "c!", "dd"]) for _ in range(30)) + "\n" + " ".join(r.choice(["a", "b.", "dd"]) for _ in range(9))
        c = s.cut(t)
        assert [t[a:b] for a, b in zip(c, c[1:])] == plain_units(t)


@pytest.mark.parametrize("min_words", [1, s.MIN_WORDS])
def test_equals_brute_force(spark, min_words):
    r = random.Random(2)
    passage = "Start of it. " + text(r, 70) + ". End of it. "
    rows = [(i, text(r, 120)) for i in range(40)]
    rows += [(100 + i, text(r, 30) + ". " + passage + text(r, 30)) for i in range(6)]
    rows += [(200, rows[3][1]), (201, None), (202, ""), (203, passage * 300), (204, passage.upper()), (205, " \n \n"), (206, "Über " + passage + "é ñ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as th", "3 as pos", "4 as none", "5 as n_removed")
    got = s.dedup_substrings(df, min_words=min_words).collect()
    want = brute(rows, min_words)
    texts = dict(rows)
    assert len(got) == len(rows)
    for x in got:
        assert [tuple(p) for p in x.spans] == want[x.doc_id], x.doc_id
        edges = [0, *(e for p in want[x.doc_id] for e in p), len(texts[x.doc_id] or "")]
        assert x.text == (None if texts[x.doc_id] is None else "".join(texts[x.doc_id][a:b] for a, b in zip(edges[::2], edges[1::2])))
        assert x.n_removed == sum(b - a for a, b in want[x.doc_id])
    assert (min_words == 1 or not want[100]) and all(want[100 + i] for i in range(1, 6)) and want[200] and want[206]
    assert s.dedup_substrings(df.limit(0)).count() == 0


def test_only_what_occurs_earlier_goes(spark):
    one, two = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda.\n", "Red green blue cyan magenta yellow black white grey pink brown.\n"
    df = spark.createDataFrame([(1, one + two), (2, one + "CODE 4711 UNIQUE\n" + two), (3, one + "CODE 4711 UNIQUE\n")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in s.dedup_substrings(df).collect()}
    assert got == {1: one + two, 2: "CODE 4711 UNIQUE\n", 3: one + "CODE 4711 UNIQUE\n"}  # 11 and 3 words are no passage
    assert {r.doc_id: r.text for r in s.dedup_substrings(df, min_words=1).collect()} == {1: one + two, 2: "CODE 4711 UNIQUE\n", 3: ""}


def test_repeated_rows_and_null_ids(spark):
    t = "one two three four five six. " * 2 + "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    df = spark.createDataFrame([(1, t), (1, t), (None, t + " q"), (None, t), (0, t)], "doc_id long, text string")
    got = s.dedup_substrings(df).collect()
    by = {}
    for r in got:
        by.setdefault((r.doc_id, r.text is not None), []).append(r.n_removed)
    assert len(got) == 5 and len(set(by[1, True])) == 1 and min(by[1, True]) > 0 and by[0, True][0] > 0
    names = df.selectExpr("cast(doc_id as string) as doc_id", "text")
    assert sorted(r.n_removed for r in s.dedup_substrings(names).collect()) == sorted(r.n_removed for r in got)

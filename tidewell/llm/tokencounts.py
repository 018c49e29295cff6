"""Token counts under a unigram model by trie-shared dynamic programming.

Pre-tokens are the words between white space, each with a leading word mark. Distinct ones are inserted in a trie; a
node's forward score, the best sum of piece scores of any segmentation of its prefix, is computed once, when the node is
made, and shared by all pre-tokens below. At a terminal node the number of pieces of the best segmentation is stored;
a text's count is the sum over its pre-tokens.

The pieces are a public vocabulary's, a fixed file, which has ranks but no probabilities. These are learned from the
documents by one step of hard expectation and maximisation: all pre-tokens of all documents are counted over all tasks
(each task counts ``HELD`` words at most, then passes them on), distinct ones are dealt by their order, so that prefixes
meet, and segmented once under Zipf's law of the ranks; the pieces' counts in these segmentations, plus ``SMOOTH``, are
the model's probabilities. Characters without a piece count as their UTF-8 bytes, at the lowest score each. Ties go
to the segmentation with fewer pieces.

The ``COMMON`` most frequent words are segmented once over all tasks and their counts broadcast (at most as many words
as that, ``LONG`` characters each). Other words are segmented by the task that meets them, in a trie that a worker keeps
from task to task up to ``NODES`` nodes and then begins anew. Pieces are matched by an automaton over the vocabulary.
Pre-tokens of over ``LONG`` characters stay out of the trie; they are counted with only as many scores as a piece can
reach back, and learned from in parts of that length.

Edge cases: null and empty texts and texts of white space count 0; repeated rows give repeated results, and count again
in what is learned; other columns are ignored; without documents the scores are those of the smoothing alone.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import bound_batches, map_batches
from tidewell.session import materialise, scratch

#: Word mark; characters of a long pre-token; nodes of a trie; words a task counts; words that are known to all; smoothing.
MARK, LONG, NODES, HELD, COMMON, SMOOTH = "▁", 4096, 400_000, 400_000, 1 << 18, 0.5

_KEPT: dict[str, "Trie"] = {}


def read_pieces(path: str) -> list[str]:
    """Pieces of a sentencepiece model file by rank; control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


def by_rank(pieces: list[str]) -> dict[str, float]:
    """Log probabilities by Zipf's law."""
    total = math.log(sum(1 / r for r in range(1, len(pieces) + 1))) if pieces else 0.0
    return {p: -math.log(r) - total for r, p in enumerate(pieces, 1)}


class Trie:
    """Prefixes of pre-tokens with their forward scores, made once each.

    Node 0 is the empty prefix. A node has the best score of its prefix, the number of pieces of the segmentation that
    has it, and the length of that segmentation's last piece (0: a character by bytes)."""

    def __init__(self, scores: dict[str, float], nodes: int = NODES):
        self.lowest, self.longest, self.limit = min(scores.values(), default=-1.0), max(map(len, scores), default=1), nodes
        self.pieces = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.pieces.add_word(piece, (len(piece), score))
        if scores:
            self.pieces.make_automaton()
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.best, self.count, self.last = [0.0], [0], [0]
        self.terminal: dict[str, int] = {}

    def insert(self, token: str) -> list[int]:
        """Nodes of the pre-token's prefixes; those that aren't there yet are made from the scores above them."""
        marked, path, node = MARK + token, [0], 0
        for c in marked:
            node = self.child.get(node << 21 | ord(c), -1)
            if node < 0:
                break
            path.append(node)
        shared = len(path) - 1
        if shared < len(marked):
            best, count, last = self.best, self.count, self.last
            start = max(0, shared - self.longest)
            ends: list[list[tuple[int, float]]] = [[] for _ in range(len(marked) - shared)]
            for at, piece in self.pieces.iter(marked, start) if len(self.pieces) else ():
                if at >= shared:
                    ends[at - shared].append(piece)
            for at in range(shared, len(marked)):
                size = 1 if marked[at] < "\x80" else len(marked[at].encode())
                above = path[at]
                top, fewest, length = best[above] + size * self.lowest, count[above] + size, 0
                for n, score in ends[at - shared]:
                    start_node = path[at + 1 - n]
                    z, k = best[start_node] + score, count[start_node] + 1
                    if z > top or z == top and k < fewest:
                        top, fewest, length = z, k, n
                self.child[above << 21 | ord(marked[at])] = len(best)
                path.append(len(best))
                best.append(top)
                count.append(fewest)
                last.append(length)
        return path

    def tokens(self, token: str) -> int:
        """Pieces of a pre-token's best segmentation, stored at its terminal."""
        found = self.terminal.get(token)
        if found is None:
            if len(self.best) > self.limit:
                self.clear()
            found = self.terminal[token] = self.count[self.insert(token)[-1]]
        return found

    def segments(self, token: str) -> list[str]:
        """The pieces of the best segmentation, without characters that go by bytes."""
        if len(self.best) > self.limit:
            self.clear()
        path, marked, out = self.insert(token), MARK + token, []
        at = len(marked)
        while at:
            n = self.last[path[at]]
            if n:
                out.append(marked[at - n : at])
            at -= max(n, 1)
        return out

    def long(self, token: str) -> int:
        """Pieces of a long pre-token, with scores only as far back as a piece reaches."""
        marked, base, best, count = MARK + token, 0, [0.0], [0]
        matches = self.pieces.iter(marked) if len(self.pieces) else iter(())
        end, found = next(matches, (len(marked), None))
        for at, c in enumerate(marked):
            n = len(c.encode())
            top, fewest = best[-1] + n * self.lowest, count[-1] + n
            while end == at:
                k = at + 1 - found[0] - base
                z = best[k] + found[1]
                if z > top or z == top and count[k] + 1 < fewest:
                    top, fewest = z, count[k] + 1
                end, found = next(matches, (len(marked), None))
            best.append(top)
            count.append(fewest)
            if len(best) > 4 * self.longest:
                gone = len(best) - self.longest
                base += gone
                del best[:gone], count[:gone]
        return count[-1]


def _words(text: str, long: int) -> list[str]:
    """Pre-tokens, long ones in parts."""
    words = text.split()
    if max(map(len, words), default=0) <= long:
        return words
    return [w[at : at + long] for w in words for at in range(0, len(w), long)]


def word_counts(docs: DataFrame, text_col: str = "text", held: int = HELD, long: int = LONG) -> DataFrame:
    """``word``, ``n`` over all documents, each word once, long ones in parts."""
    bound_batches(docs.sparkSession)

    def rows(counter):
        found = list(counter.items())
        for at in range(0, len(found), 1 << 15):
            words, n = zip(*found[at : at + (1 << 15)])
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(n, pa.int64())], ["word", "n"])

    def run(batches):
        counter: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    counter.update(_words(text, long))
                    if len(counter) > held:
                        yield from rows(counter)
                        counter = Counter()
        yield from rows(counter)

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def learn(words: DataFrame, pieces: list[str]) -> dict[str, float]:
    """Log probability of each piece, from its count in the words' best segmentations under Zipf's law."""
    shared = words.sparkSession.sparkContext.broadcast(by_rank(pieces))
    dealt = words.repartitionByRange("word").sortWithinPartitions("word")

    def run(batches):
        trie, total = Trie(shared.value), Counter()
        for batch in batches:
            for word, n in zip(*(c.to_pylist() for c in batch.columns)):
                for piece in trie.segments(word):
                    total[piece] += n
        if total:
            names, n = zip(*total.items())
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n, pa.int64())], ["piece", "n"])

    found = {r["piece"]: r["n"] for r in dealt.mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()}  # the vocabulary at most
    total = math.log(sum(found.values()) + SMOOTH * len(pieces)) if pieces else 0.0
    return {p: math.log(found.get(p, 0) + SMOOTH) - total for p in pieces}


def least_count(words: DataFrame, most: int) -> int:
    """The least count that a word of the ``most`` commonest has, words of one count being all in or all out; only
    counts are ordered, of which no more are read than words are wanted."""
    least, held = None, 0
    by_count = words.groupBy("n").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("n")).limit(most)
    for r in by_count.toLocalIterator():
        held += r["k"]
        if held > most:
            break
        least = r["n"]
    return (1 << 62) if least is None else least


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", scores: dict[str, float] | None = None) -> DataFrame:
    """``id_col``, ``n_pretokens``, ``n_tokens``; ``scores`` are learned from ``docs`` where they aren't given."""
    context, known = docs.sparkSession.sparkContext, {}
    if scores is None:
        with scratch():
            words = materialise(word_counts(docs, text_col), "tokencounts-words")
            scores = learn(words, read_pieces(model_path))
            common = words.filter(F.col("n") >= least_count(words, COMMON)).repartitionByRange("word").sortWithinPartitions("word")
            shared = context.broadcast(scores)

            def make_common():
                trie = Trie(shared.value)
                return lambda c: [c[0], [trie.tokens(w) for w in c[0]]]

            schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
            known = {r["word"]: r["n"] for r in map_batches(common.select("word"), make_common, schema).toLocalIterator()}
    shared, key = context.broadcast((scores, known)), hashlib.sha256(repr(sorted(scores.items())).encode()).hexdigest()

    def make():
        if key not in _KEPT:
            _KEPT.clear()
            _KEPT[key] = Trie(shared.value[0])
        trie, common = _KEPT[key], shared.value[1]

        def step(c):
            split = [(t or "").split() for t in c[1]]
            of = {w: trie.long(w) if len(w) > LONG else common[w] if w in common else trie.tokens(w) for w in {w for x in split for w in x}}
            return [c[0], [len(x) for x in split], [sum(map(of.__getitem__, x)) for x in split]]

        return step

    schema = T.StructType([docs.schema[id_col], T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return map_batches(docs.select(F.col(id_col), F.col(text_col).cast("string")), make, schema)

"""Byte-level BPE encoding and decoding as a monoid tree reduction.

An encoded stretch ``text[lo:hi]`` is a monoid element. A text is halved recursively down to leaves; two neighbours
are joined by encoding anew a window around their seam. The window grows outward on each side until it meets a
*stable cut*: a space or line feed that follows a character which isn't white space. No match of the pre-token
pattern crosses such a place, whatever stands before or after it (a match has white space only as its first
character or is white space throughout), and merges never cross pre-tokens; so all tokens outside the window are
those of the whole text. Where a side has no stable cut the window takes the whole side.

Edge cases: a null text counts as the empty text (no tokens, digests of the empty string); repeated rows give
repeated results; other columns of the input are ignored; text of any length stays within one row's memory.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import map_batches

#: Characters of a leaf, ids of a leaf when decoding, and the first reach of a seam's window on either side.
LEAF, LEAF_IDS, REACH = 8192, 8192, 64

_CODECS: dict[bytes, "Codec"] = {}


class Codec:
    """Encoder and decoder for one rank file (its bytes) and one pre-token pattern."""

    def __init__(self, ranks: bytes, pattern: str, leaf: int = LEAF, reach: int = REACH):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.bytes_of = [b""] * (max(table.values()) + 1)
        for token, rank in table.items():
            self.bytes_of[rank] = token
        self.lengths = np.array([len(x) for x in self.bytes_of], np.int64)
        self.leaf, self.reach = max(2, leaf), reach

    @classmethod
    def cached(cls, ranks: bytes, pattern: str) -> "Codec":
        """One codec per Python worker and rank file."""
        key = hashlib.sha256(ranks + pattern.encode()).digest()
        if key not in _CODECS:
            _CODECS[key] = cls(ranks, pattern)
        return _CODECS[key]

    def encode(self, text: str) -> np.ndarray:
        """Token ids of the whole text."""
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, lo: int, hi: int) -> np.ndarray:
        if hi - lo <= self.leaf:
            return np.array(self.encoding.encode_ordinary(text[lo:hi]), np.uint32)
        mid = (lo + hi) // 2
        return self.join(text, lo, mid, hi, self._encode(text, lo, mid), self._encode(text, mid, hi))

    def join(self, text: str, lo: int, mid: int, hi: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The monoid's product: ids of ``text[lo:hi]`` from those of ``text[lo:mid]`` and ``text[mid:hi]``."""
        a, b = self._cut_before(text, lo, mid), self._cut_after(text, mid, hi)
        kept = left.size - self._tokens_over(left[::-1], len(text[a:mid].encode()))
        gone = self._tokens_over(right, len(text[mid:b].encode()))
        seam = np.array(self.encoding.encode_ordinary(text[a:b]), np.uint32)
        return np.concatenate((left[:kept], seam, right[gone:]))

    def _cut_before(self, text: str, lo: int, mid: int) -> int:
        reach = self.reach
        while True:
            start = max(lo, mid - reach)
            for p in range(mid - 1, start, -1):
                if text[p] in " \n" and not text[p - 1].isspace():
                    return p
            if start == lo:
                return lo
            reach *= 2

    def _cut_after(self, text: str, mid: int, hi: int) -> int:
        reach = self.reach
        while True:
            end = min(hi, mid + reach)
            for p in range(mid + 1, end):
                if text[p] in " \n" and not text[p - 1].isspace():
                    return p
            if end == hi:
                return hi
            reach *= 2

    def _tokens_over(self, ids: np.ndarray, n_bytes: int) -> int:
        """How many of the first ids make up exactly ``n_bytes`` bytes."""
        return 0 if not n_bytes else int(np.searchsorted(np.cumsum(self.lengths[ids[:n_bytes]]), n_bytes)) + 1

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids: leaves are looked up, neighbours concatenated up the tree."""
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


def read_ranks(path: str) -> bytes:
    """Bytes of a rank file on the driver; its size is that of a vocabulary, a few MB."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids array<int>``: the token ids of each text; the vocabulary (a fixed file) is broadcast."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def make():
        codec = Codec.cached(ranks.value, pattern)
        return lambda c: [c[0], [codec.encode(x or "").astype(np.int32) for x in c[1]]]

    schema = T.StructType([docs.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return map_batches(docs.select(F.col(id_col), F.col(text_col).cast("string")), make, schema)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, ``bytes binary``: what the ids of each row stand for; null ids count as none."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def make():
        codec = Codec.cached(ranks.value, pattern)
        return lambda c: [c[0], [codec.decode(np.asarray(x or [], np.uint32)) for x in c[1]]]

    schema = T.StructType([encoded.schema[id_col], T.StructField("bytes", T.BinaryType())])
    return map_batches(encoded.select(id_col, ids_col), make, schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode and decode each text: ``id_col``, ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned 32-bit
    integers), ``decoded_sha256``, and ``ids`` if asked for. One pass; the decoded bytes don't leave the worker."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def make():
        codec = Codec.cached(ranks.value, pattern)

        def step(columns):
            n, ids_sha, decoded_sha, kept = [], [], [], []
            for text in columns[1]:
                ids = codec.encode(text or "")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                if with_ids:
                    kept.append(ids.astype(np.int32))
            return [columns[0], n, ids_sha, decoded_sha, *[kept] * with_ids]

        return step

    schema = T.StructType([docs.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()), *[T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids])
    return map_batches(docs.select(F.col(id_col), F.col(text_col).cast("string")), make, schema)

"""Byte-pair encoding of whole corpora by a public vocabulary, in numpy.

Texts are cut into pieces by the vocabulary's pattern. Every distinct piece is
a row of a padded matrix of token ids, together with pieces of about its own
length. In each round every row looks up the ranks of its adjacent pairs in a
hash table, merges its leftmost pair of minimum rank and closes the gap; rows
without a mergeable pair are finished and leave the matrix.

The round goes on to the right with the later places of that rank as long as
the next rounds would do just that: merging one place makes two new pairs, and
while neither has a smaller rank, the next place of the rank is again the
leftmost pair of minimum rank. A place whose merge makes a smaller pair is the
last of its row's round. So rows of any length come out as by single merges.

Defined results: a null or empty text has an empty list; strings that look
like special tokens are ordinary text; a text of any length is encoded whole.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Fixed value: the pattern that cuts texts into pieces, as published with the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEFAULT = "/opt/tokenizers/byte_bpe_50k.tiktoken"
NONE = np.int32(2**31 - 1)
#: Bounds of a worker's memory: pieces remembered, characters of text in work.
MOST_PIECES, CHARS = 200_000, 4_000_000


class Vocabulary:
    """Ranks of a vocabulary file and the hash table of its mergeable pairs."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.is_byte = np.zeros(max(ranks.values()) + 1, bool)
        self.is_byte[self.byte[128:]] = True
        left, right, to = [], [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    to.append(rank)
        keys = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.to = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE, np.int32)
        at, values, self.steps = self._slot(keys), np.array(to, np.int32), 0
        while len(keys):  # of the pairs that want one slot, the first takes it and the rest move on
            self.steps += 1
            free = self.keys[at] == -1
            _, first = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            win = first[free[first]]
            self.keys[at[win]], self.to[at[win]] = keys[win], values[win]
            rest = np.ones(len(keys), bool)
            rest[win] = False
            keys, values, at = keys[rest], values[rest], (at[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where it does not merge or holds padding (-1)."""
        out = np.full(a.shape, NONE, np.int32)
        todo = np.flatnonzero((a >= 0) & (b >= 0))
        keys = (a.ravel()[todo].astype(np.int64) << 32) | b.ravel()[todo].astype(np.int64)
        at, flat = self._slot(keys), out.ravel()
        while len(todo):
            found = self.keys[at]
            hit = found == keys
            flat[todo[hit]] = self.to[at[hit]]
            go = ~hit & (found != -1)
            todo, keys, at = todo[go], keys[go], (at[go] + 1) & self.mask
        return out

    def encode_rows(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        lengths = np.array([len(p) for p in pieces], np.int64)
        order = np.argsort(lengths, kind="stable")
        i = int(np.searchsorted(lengths[order], 1))
        while i < len(order):  # a bucket: rows up to 1.25 times as long as its first, at most a few million cells
            short = int(lengths[order[i]])
            j = int(np.searchsorted(lengths[order], int(short * 1.25) + 1, "left"))
            j = max(i + 1, min(j, i + max(1, 2_000_000 // max(1, int(short * 1.25)))))
            self._bucket(pieces, order[i:j], int(lengths[order[j - 1]]), out)
            i = j
        return out

    def _places(self, m: np.ndarray, ranks: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Where this round merges: see the module's text."""
        merge = np.zeros(m.shape, bool)
        same = ranks == best[:, None]
        place = np.arange(same.shape[1])
        last = np.maximum.accumulate(np.where(same, -1, place), axis=1)
        merge[:, :-1] = same & ((place - last) % 2 == 1)
        row, at = np.nonzero(merge)
        if len(row) == len(m):
            return merge
        token = best[row]
        # the neighbours as they are when the places to the left are merged and those to the right are not
        left = np.where(at > 0, m[row, at - 1], -1)
        left = np.where((at > 1) & merge[row, at - 2], token, left)
        right = np.where(at + 2 < m.shape[1], m[row, np.minimum(at + 2, m.shape[1] - 1)], -1)
        smaller = np.minimum(self.rank(left, token), self.rank(token, right)) < token
        if smaller.any():
            stop = np.full(len(m), m.shape[1])
            np.minimum.at(stop, row[smaller], at[smaller])
            merge &= np.arange(m.shape[1]) <= stop[:, None]
        return merge

    def _bucket(self, pieces: list[bytes], rows: np.ndarray, width: int, out: list[np.ndarray]) -> None:
        size = np.array([len(pieces[r]) for r in rows])
        m = np.full((len(rows), width), -1, np.int32)
        m[np.arange(width) < size[:, None]] = self.byte[np.frombuffer(b"".join(pieces[r] for r in rows), np.uint8)]
        ranks = self.rank(m[:, :-1], m[:, 1:])
        while True:
            best = ranks.min(1) if ranks.shape[1] else np.full(len(m), NONE, np.int32)
            over = best == NONE
            if over.any():
                for r, row in zip(rows[over], m[over]):
                    out[r] = row[row >= 0]
                rows, m, ranks, best = rows[~over], m[~over], ranks[~over], best[~over]
            if not len(rows):
                return
            merge = self._places(m, ranks, best)
            m = np.where(merge, best[:, None], m)
            keep = m >= 0
            keep[:, 1:] &= ~merge[:, :-1]
            size = keep.sum(1)
            wide = int(size.max())
            closed = np.full((len(m), wide), -1, np.int32)
            closed[np.arange(wide) < size[:, None]] = m[keep]
            m = closed
            ranks = self.rank(m[:, :-1], m[:, 1:])


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Loaded once a worker."""
    return Vocabulary(path)


class Encoder:
    """Encodes texts, remembering the ids of pieces up to a bound."""

    def __init__(self, path: str) -> None:
        import regex

        self.vocabulary, self.cut = vocabulary(path), regex.compile(PATTERN).findall
        self._reset()

    def _reset(self) -> None:
        self.at: dict[str, int] = {}
        self.start, self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (one more than texts) and the ids of all texts one after the other."""
        at = self.at
        if len(at) > MOST_PIECES:
            self._reset()
            at = self.at
        before, codes, counts = len(at), [], []
        for t in texts:
            found = self.cut(t) if t else ()
            counts.append(len(found))
            codes += [at.setdefault(p, len(at)) for p in found]
        if len(at) > before:
            new = list(at)[before:] if before else list(at)
            rows = self.vocabulary.encode_rows([p.encode("utf-8", "surrogatepass") for p in new])
            n = np.array([len(r) for r in rows], np.int64)
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(n) - n])
            self.length = np.concatenate([self.length, n])
            self.ids = np.concatenate([self.ids, *rows])
        codes = np.array(codes, np.int64)
        n = self.length[codes]
        total = np.cumsum(n)
        flat = self.ids[np.repeat(self.start[codes] - (total - n), n) + np.arange(int(n.sum()))] if len(codes) else np.zeros(0, np.int32)
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        return np.concatenate([[0], total])[ends], flat


_SENT: set[tuple[str, str]] = set()


def sent(spark: SparkSession, path: str) -> Callable[[], str]:
    """Sends a vocabulary file with the job, once an application; returns what gives its place in a worker."""
    sc = spark.sparkContext
    if (sc.applicationId, path) not in _SENT:
        sc.addFile(path)
        _SENT.add((sc.applicationId, path))
    name = os.path.basename(path)

    def place() -> str:
        from pyspark import SparkFiles

        return SparkFiles.get(name)

    return place


def encode(df: DataFrame, key: str, text: str, path: str = DEFAULT) -> DataFrame:
    """Columns: the key and ids, one row per row of ``df``. The vocabulary is read by the driver and sent with the job."""
    place = sent(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(place())
        for b in batches:
            keys, texts = b.column(0), b.column(1).to_pylist()
            i = 0
            while i < len(texts):
                j, chars = i, 0
                while j < len(texts) and (j == i or chars + len(texts[j] or "") <= CHARS):
                    chars += len(texts[j] or "")
                    j += 1
                offsets, ids = encoder.encode(texts[i:j])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.record_batch([keys.slice(i, j - i), lists], names=["_key", "ids"])
                i = j

    return df.select(key, text).mapInArrow(run, f"_key {dict(df.dtypes)[key]}, ids array<int>").withColumnRenamed("_key", key)

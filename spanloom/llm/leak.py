"""Evaluation passages in training text, by suffix arrays of the training text.

Every shard of the corpus (a run of documents inside one partition, of bounded
size) gets a suffix array of its words. Every suffix of the evaluation text is
then binary-searched in it, all at once; the range it meets are the places
that hold its first ``min_words`` words, and following both on gives the
longest verbatim match of a document and an item, and where it is. Nothing is shuffled: a document lies in one shard, and
the evaluation text visits all of them in blocks of bounded size.

Words are compared bare (:class:`spanloom.llm.forms.BareWords`): no marks,
accents, punctuation, case, invisible characters or look-alikes.

Defined results: null and empty texts, and items under ``min_words`` words,
match nothing; repeated documents each get their rows; a document with all of
several items has a row for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.forms import BareWords

#: Words of one shard; bytes of evaluation text that visit the corpus together.
SHARD_WORDS, BLOCK_BYTES = 1_000_000, 32_000_000
#: Pairs of places that are followed, and rows that leave, at once.
PAIRS = 500_000


class Items:
    """A block of evaluation items as word numbers; 0 stands for any other word."""

    def __init__(self, items: list[tuple[int, str]], min_words: int) -> None:
        bare = BareWords(split=True)
        self.number: dict[str, int] = {}
        kinds: dict[bytes, list[int]] = {}
        for item, text in items:
            words = [self.number.setdefault(w, len(self.number) + 1) for w in bare.words(text or "")]
            if len(words) >= min_words:
                kinds.setdefault(np.array(words, np.int32).tobytes(), []).append(item)
        # items of the same words are one, with the ids that have them; a 0 stands before, between and after the items
        parts = [np.frombuffer(x, np.int32) for x in kinds]
        none = np.zeros(1, np.int32)
        self.words = np.concatenate([none, *[x for p in parts for x in (p, none)]])
        self.owner = np.repeat(np.arange(len(parts) + 1), [len(p) + 1 for p in parts] + [1])
        self.copies = np.array([i for x in kinds.values() for i in x], np.int64)
        self.copy_at = np.concatenate([[0], np.cumsum([len(x) for x in kinds.values()])]).astype(np.int64)
        self.starts = whole_windows(self.words, min_words)


def whole_windows(words: np.ndarray, n: int) -> np.ndarray:
    """Positions whose next ``n`` words are all evaluation words."""
    if len(words) < n:
        return np.zeros(0, np.int64)
    gaps = np.concatenate([[0], np.cumsum(words == 0)])
    return np.flatnonzero(gaps[n:] == gaps[:-n])


def suffix_array(words: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """``starts`` in the order of their suffixes by at least ``depth`` words, by prefix doubling, and the rank of every position."""
    rank, done = words.astype(np.int64), 1
    while done < depth:
        later = np.zeros_like(rank)
        later[:-done] = rank[done:] + 1
        rank = np.unique(rank * (int(later.max(initial=0)) + 1) + later, return_inverse=True)[1].astype(np.int64)
        done *= 2
    return starts[np.argsort(rank[starts], kind="stable")], rank


def _first(words: np.ndarray, array: np.ndarray, other: np.ndarray, queries: np.ndarray, n: int, upper: bool) -> np.ndarray:
    """For each query (a start in ``other``), the first of ``array`` whose first ``n`` words are not before (with ``upper``: are after) its own."""
    lo, hi = np.zeros(len(queries), np.int64), np.full(len(queries), len(array), np.int64)
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        at = array[np.minimum(mid, len(array) - 1)]
        before, tied = np.zeros(len(queries), bool), open_.copy()
        for k in range(n):
            a, b = words[at + k], other[queries + k]
            before |= tied & (a < b)
            tied &= a == b
            if not tied.any():
                break
        down = before | (tied if upper else False)
        lo, hi = np.where(open_ & down, mid + 1, lo), np.where(open_ & ~down, mid, hi)
    return lo


def find(docs: list[np.ndarray], items: Items, min_words: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(document, item, length, place in the document) of the longest match of each pair, in parts of bounded size.

    Equal documents, and equal items, are matched once. A match is followed
    only from its first word: test suffixes that meet the same range of the
    array are one class, and of a class only the places are taken whose word
    before is not that of the suffix. So a match of any length is one pair of
    places, not one for each of its suffixes.
    """
    number: dict[bytes, int] = {}
    of_doc = np.array([number.setdefault(d.tobytes(), len(number)) for d in docs], np.int64)
    kinds = [np.frombuffer(x, np.int32) for x in number]
    words = np.concatenate([np.zeros(1, np.int32), *[x for d in kinds for x in (d, np.zeros(1, np.int32))]])
    starts = whole_windows(words, min_words)
    if not len(starts) or not len(items.starts):
        return
    begin = 1 + np.concatenate([[0], np.cumsum([len(d) + 1 for d in kinds])])
    array, _ = suffix_array(words, starts, min_words)
    lo, hi = (_first(words, array, items.words, items.starts, min_words, u) for u in (False, True))
    met = hi > lo
    q, lo, hi = items.starts[met], lo[met], hi[met]
    if not len(q):
        return
    # Inside each met class the places are put in the order of the word before them; 0 there is no word of any item.
    bounds, owner = np.unique(lo, return_inverse=True)
    ends = np.zeros(len(bounds), np.int64)
    ends[owner] = hi
    cls = np.repeat(np.arange(len(bounds)), ends - bounds)
    places = array[np.repeat(bounds - np.concatenate([[0], np.cumsum(ends - bounds)[:-1]]), ends - bounds) + np.arange(len(cls))]
    radix = np.int64(len(items.number) + 2)
    key = cls * radix + words[places - 1]
    order = np.argsort(key, kind="stable")
    places, key = places[order], key[order]
    c_lo = np.searchsorted(key, owner * radix)
    c_hi = np.searchsorted(key, (owner + 1) * radix)
    same = items.words[q - 1]  # 0 at an item's first word: that matches nothing before it
    s_lo = np.where(same > 0, np.searchsorted(key, owner * radix + same), c_lo)
    s_hi = np.where(same > 0, np.searchsorted(key, owner * radix + same, "right"), c_lo)
    parts = [(c_lo, s_lo), (s_hi, c_hi)]
    of_kind = np.argsort(of_doc, kind="stable")
    kind_at = np.concatenate([[0], np.cumsum(np.bincount(of_doc, minlength=len(kinds)))])
    best: list[tuple[np.ndarray, ...]] = []
    for a, b in parts:
        total = np.cumsum(b - a)
        i = 0
        while i < len(q):  # suffixes whose places are a bounded number, or one suffix
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + PAIRS, "right")))
            n = (b - a)[i:j]
            if n.sum():
                at = places[np.repeat(a[i:j] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
                best.append(_longest(words, items, np.repeat(q[i:j], n), at, begin, min_words))
                if len(best) > 16:
                    best = [_top(*(np.concatenate(x) for x in zip(*best)))]
            i = j
    if not best:
        return
    kind, item, length, at = _top(*(np.concatenate(x) for x in zip(*best)))
    # every document of the kind with every item of the same words, again in parts
    n = (kind_at[kind + 1] - kind_at[kind]) * (items.copy_at[item + 1] - items.copy_at[item])
    total = np.cumsum(n)
    for i in range(0, int(total[-1]), PAIRS):
        flat = np.arange(i, min(i + PAIRS, int(total[-1])))
        r = np.searchsorted(total, flat, "right")
        k = flat - (total[r] - n[r])
        wide = items.copy_at[item[r] + 1] - items.copy_at[item[r]]
        yield of_kind[kind_at[kind[r]] + k // wide], items.copies[items.copy_at[item[r]] + k % wide], length[r], at[r]


def _longest(words: np.ndarray, items: Items, q: np.ndarray, at: np.ndarray, begin: np.ndarray, min_words: int) -> tuple[np.ndarray, ...]:
    """The longest match of each (document, item) among the pairs of places (at, q)."""
    length = np.full(len(q), min_words, np.int64)
    grow = np.arange(len(q))
    while len(grow):
        a, b = at[grow] + length[grow], q[grow] + length[grow]
        same = (a < len(words)) & (b < len(items.words))
        same[same] = (words[a[same]] == items.words[b[same]]) & (words[a[same]] != 0)
        grow = grow[same]
        length[grow] += 1
    doc = np.searchsorted(begin, at, "right") - 1
    return _top(doc, items.owner[q].astype(np.int64), length, at - begin[doc])


def _top(doc: np.ndarray, item: np.ndarray, length: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each (doc, item) the longest, the first in the document of equals."""
    order = np.lexsort((at, -length, item, doc))
    doc, item = doc[order], item[order]
    first = np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])])
    keep = order[first]
    return doc[first], item[first], length[keep], at[keep]


def blocks(items: DataFrame, item_key: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The evaluation items in blocks of at most about BLOCK_BYTES each, whatever their number."""
    size = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = int(size // BLOCK_BYTES) + 1
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64(item_key), F.lit(n)) == i) if n > 1 else items
        yield [(r[0], r[1]) for r in part.select(item_key, text).toLocalIterator()]


def leaks(df: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, min_words: int = 12) -> DataFrame:
    """Columns: the key, item_id, n_words, at_word: each document with each item that leaked into it."""
    key_type, item_type = dict(df.dtypes)[key], dict(items.dtypes)[item_key]
    spark, out = df.sparkSession, None
    for block in blocks(items, item_key, item_text):
        sent = spark.sparkContext.broadcast(Items(block, min_words))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own, bare, docs, keys, n = sent.value, BareWords(split=True), [], [], 0
            schema = pa.schema([("_key", pa.int64()), ("item_id", pa.int64()), ("n_words", pa.int32()), ("at_word", pa.int32())])

            def shard() -> Iterator[pa.RecordBatch]:
                of = np.array(keys, np.int64)
                for d, i, length, at in find(docs, own, min_words):
                    yield pa.record_batch([pa.array(of[d]), pa.array(i), pa.array(length.astype(np.int32)), pa.array(at.astype(np.int32))], schema=schema)

            for b in batches:
                for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                    words = bare.words(t.as_py())
                    get = own.number.get
                    docs.append(np.array([get(w, 0) for w in words], np.int32))
                    keys.append(k)
                    n += len(words) + 1
                    if n >= SHARD_WORDS:
                        yield from shard()
                        docs, keys, n = [], [], 0
            if docs:
                yield from shard()

        part = df.select(F.col(key).cast("long"), text).where(F.length(text) > 0).mapInArrow(run, "_key bigint, item_id bigint, n_words int, at_word int")
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("_key").cast(key_type).alias(key), F.col("item_id").cast(item_type).alias("item_id"), "n_words", "at_word")

"""Finding passages in documents: seeds, diagonals, extension, scores.

Pairs of neighbouring words that are rare in the corpus seed candidates by an
equi-join. Both indices of an alignment move together, so a seed lies on a
diagonal (document place minus passage place), and the part of the document
that can matter to a (document, passage) pair is a slice per diagonal. Only
these slices go to the Arrow kernel, which walks both ways from each seed,
scores the spans and keeps the best.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.config import Config
from spanloom.functions import scores
from spanloom.operators import corpus

#: Cells of one padded matrix of words.
CELLS = 2_000_000
RAW = "doc bigint, verse_id int, first_seed int, word_start int, word_end int, verse_start int, verse_end int, matched int, verse_tokens int, score double, conf double"


def seeds(arrays: DataFrame, passages: DataFrame, cap: int | None) -> DataFrame:
    """doc, tpos, verse_id, vpos of every rare pair of words that both have."""
    stream = corpus.bigrams(arrays.select("doc", F.col("words.norm").alias("tokens")), "doc", "tokens", "tpos")
    return stream.join(corpus.postings(passages, cap), ["w1", "w2"]).select("doc", "tpos", "verse_id", "vpos")


def diagonals(found: DataFrame) -> DataFrame:
    """doc, verse_id, diagonal, n_seeds, first_tpos, last_tpos."""
    return found.groupBy("doc", "verse_id", (F.col("tpos") - F.col("vpos")).alias("diagonal")).agg(F.count("*").alias("n_seeds"), F.min("tpos").alias("first_tpos"), F.max("tpos").alias("last_tpos"))


class Alike:
    """Numbers words and remembers which distinct ones count as the same."""

    def __init__(self) -> None:
        self.known: dict[tuple[str, str], bool] = {}

    def matches(self, words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether ``words[a]`` and ``words[b]`` are alike, for arrays of numbers; a negative number is no word."""
        out = (a == b) & (a >= 0)
        at = np.flatnonzero(~out & (a >= 0) & (b >= 0))
        pairs, back = np.unique(a[at].astype(np.int64) * len(words) + b[at], return_inverse=True)
        if len(self.known) > 2_000_000:
            self.known.clear()
        known, verdict = self.known, np.zeros(len(pairs), bool)
        for k, (x, y) in enumerate(zip(words[pairs // len(words)].tolist(), words[pairs % len(words)].tolist())):
            got = known.get((x, y))
            if got is None:
                got = known[x, y] = scores.alike(x, y)
            verdict[k] = got
        out[at] = verdict[back]
        return out


def walk(match: np.ndarray, at: np.ndarray, step: int, budget: np.ndarray) -> np.ndarray:
    """For each row of ``match``, the last matching place from ``at`` in the direction ``step`` before more than ``budget`` mismatches."""
    width = match.shape[1]
    place = np.arange(width)
    seen = (place > at[:, None]) if step > 0 else (place < at[:, None])
    miss = (seen & ~match).astype(np.int32)
    upto = np.cumsum(miss, 1) if step > 0 else np.cumsum(miss[:, ::-1], 1)[:, ::-1]
    good = seen & match & (upto <= budget[:, None])
    if step > 0:
        return np.where(good.any(1), width - 1 - good[:, ::-1].argmax(1), at)
    return np.where(good.any(1), good.argmax(1), at)


def extend(alike: Alike, words: np.ndarray, passage: np.ndarray, p_at: np.ndarray, p_len: np.ndarray, stream: np.ndarray, s_at: np.ndarray, s_len: np.ndarray, vpos: np.ndarray, tpos: np.ndarray, base: int) -> tuple[np.ndarray, ...]:
    """Alignments through seeds: matched words, score, first and last place in the passage.

    ``passage`` and ``stream`` hold the numbers of words one list after the
    other; a seed has its passage at ``p_at`` (``p_len`` words), its document's
    words at ``s_at`` (``s_len`` words), and its places in both. Seeds go in
    groups of about one passage length, as padded matrices.
    """
    n = len(vpos)
    matched, score, first, last = np.zeros(n, np.int32), np.zeros(n), np.zeros(n, np.int32), np.zeros(n, np.int32)
    order = np.argsort(p_len, kind="stable")
    i = 0
    while i < n:
        short = max(8, int(p_len[order[i]]))
        j = int(np.searchsorted(p_len[order], short * 2, "right"))
        rows = order[i : min(j, i + max(1, CELLS // (short * 2)))]
        i += len(rows)
        width = int(p_len[rows].max())
        place = np.arange(width)
        diagonal = (tpos - vpos)[rows, None]
        inside = (place < p_len[rows, None]) & (place + diagonal >= 0) & (place + diagonal < s_len[rows, None])
        a = np.full(inside.shape, -1, np.int64)
        b = np.full(inside.shape, -2, np.int64)
        a[inside] = passage[(p_at[rows, None] + place)[inside]]
        b[inside] = stream[(s_at[rows, None] + diagonal + place)[inside]]
        match = alike.matches(words, a.ravel(), b.ravel()).reshape(a.shape)
        # Beyond the ends of either there is nothing to walk to: such places break any budget.
        budget = base + p_len[rows] // 6
        lo = walk(np.where(inside, match, False), vpos[rows], -1, budget)
        hi = walk(np.where(inside, match, False), vpos[rows] + 1, 1, budget)
        matched[rows], first[rows], last[rows] = hi - lo + 1, lo, hi
        same = ((a == b) | (place < lo[:, None]) | (place > hi[:, None])).all(1)
        score[rows[same]] = 100.0
        for k in np.flatnonzero(~same):
            span = slice(lo[k], hi[k] + 1)
            score[rows[k]] = ratio(" ".join(words[b[k, span]].tolist()), " ".join(words[a[k, span]].tolist()))
    return matched, score, first, last


@lru_cache(maxsize=200_000)
def ratio(a: str, b: str) -> float:
    return scores.ratio(a, b)


def best_of(groups: np.ndarray, matched: np.ndarray, score: np.ndarray, vpos: np.ndarray) -> np.ndarray:
    """Of each group (sorted, equal numbers together) the alignment with most words, then score, then the first in the passage."""
    order = np.lexsort((vpos, -score, -matched, groups))
    return order[np.concatenate([[True], groups[order][1:] != groups[order][:-1]])] if len(order) else order


def numbered(*lists: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct words of several string arrays, and each array as numbers of them."""
    all_ = pa.chunked_array([x.cast(pa.string()) for x in lists]).combine_chunks() if len(lists) > 1 else lists[0]
    d = pc.dictionary_encode(all_ if not isinstance(all_, pa.ChunkedArray) else all_.combine_chunks())
    codes = d.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum([len(x) for x in lists])
    return np.array(d.dictionary.to_pylist(), object), np.split(codes, ends[:-1])


def offsets(lists: pa.Array) -> np.ndarray:
    """Where each list begins among the flattened values, and the end; null lists are empty."""
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(n)]).astype(np.int64)


def _key(row: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (row.astype(np.int64) << 32) + x


class Laid:
    """A batch of :func:`candidates` as numbers: every seed with its passage and its slice of the document."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.doc, self.verse, tokens, places, slices = (batch.column(i) for i in range(5))
        self.n = batch.num_rows
        p_off, s_off, d_off = offsets(tokens), offsets(places), offsets(slices)
        place, cut = pc.list_flatten(places), pc.list_flatten(slices)
        w_lists = pc.struct_field(cut, "w")
        w_off = offsets(w_lists)
        self.words, (self.passage, self.stream) = numbered(pc.list_flatten(tokens), pc.list_flatten(w_lists))
        self.tpos, self.vpos = (pc.struct_field(place, c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("tpos", "vpos"))
        self.row = np.repeat(np.arange(self.n), np.diff(s_off))
        # the slice of each seed: the one of its row with its diagonal
        d, at = (pc.struct_field(cut, c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("d", "at"))
        keys = _key(np.repeat(np.arange(self.n), np.diff(d_off)), d)
        order = np.argsort(keys)
        mine = order[np.searchsorted(keys[order], _key(self.row, self.tpos - self.vpos))]
        self.size = np.diff(p_off)
        self.p_at, self.s_at, self.s_len = p_off[self.row], w_off[mine] - at[mine], at[mine] + np.diff(w_off)[mine]

    def extend(self, alike: Alike, base: int) -> tuple[np.ndarray, ...]:
        return extend(alike, self.words, self.passage, self.p_at, self.size[self.row], self.stream, self.s_at, self.s_len, self.vpos, self.tpos, base)


def spans_of_batch(x: Laid, alike: Alike, least: float, base: int) -> pa.RecordBatch:
    """The RAW rows of a batch."""
    matched, score, first, last = x.extend(alike, base)
    row, tpos, vpos = x.row, x.tpos, x.vpos
    # the best alignment of each document place, in the order of the places
    group = np.unique(_key(row, tpos), return_inverse=True)[1]
    top = best_of(group, matched, score, vpos)
    t_row, t_pos, t_dia = row[top], tpos[top], (tpos - vpos)[top]
    lo, hi, ok = first[top] + t_dia, last[top] + t_dia, score[top] >= least
    keep = ok.copy()
    crowded = np.flatnonzero(np.bincount(t_row, minlength=x.n) > 1)
    begin, end = np.searchsorted(t_row, crowded), np.searchsorted(t_row, crowded, "right")
    for b, e in zip(begin.tolist(), end.tolist()):  # a seed inside a span already accepted for the passage is passed over
        taken: list[tuple[int, int]] = []
        for k in range(b, e):
            if keep[k]:
                if any(i <= t_pos[k] <= j for i, j in taken):
                    keep[k] = False
                else:
                    taken.append((lo[k], hi[k]))
    k, r = top[keep], t_row[keep]
    first_seed = np.zeros(x.n, np.int64)
    heads = np.concatenate([[True], t_row[1:] != t_row[:-1]]) if len(t_row) else np.zeros(0, bool)
    first_seed[t_row[heads]] = t_pos[heads]
    conf = np.array([round(s / 100.0 * scores.factor(n), 4) for s, n in zip(score[k].tolist(), matched[k].tolist())], float)
    take = pa.array(r, pa.int64())
    numbers = lambda c: pa.array(c.astype(np.int32))
    return pa.record_batch(
        [x.doc.take(take), x.verse.take(take), numbers(first_seed[r]), numbers(lo[keep]), numbers(hi[keep]), numbers(first[k]), numbers(last[k]), numbers(matched[k]), numbers(x.size[r]), pa.array(score[k]), pa.array(conf)],
        names=[c.split()[0] for c in RAW.split(", ")],
    )


def candidates(arrays: DataFrame, passages: DataFrame, cfg: Config = Config()) -> DataFrame:
    """doc, verse_id, tokens, places (of the seeds) and slices (the document's words under each diagonal)."""
    found = seeds(arrays, passages, cfg.bigram_df_cap)
    # Few bytes but much work a row: the number of tasks must not be cut down to the bytes.
    found = found.repartition(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc")
    pairs = found.groupBy("doc", "verse_id").agg(F.collect_list(F.struct("tpos", "vpos")).alias("places"))
    pairs = pairs.join(passages.select("verse_id", "tokens"), "verse_id")
    placed = pairs.join(arrays.select("doc", F.col("words.norm").alias("t")), "doc")
    ds = F.array_distinct(F.transform("places", lambda p: p["tpos"] - p["vpos"]))

    def piece(d):  # the words of the document under the passage
        lo = F.greatest(d, F.lit(0))
        return F.struct(d.alias("d"), lo.alias("at"), F.slice("t", lo + 1, F.least(F.size("t") - lo, d + F.size("tokens") - lo)).alias("w"))

    return placed.select("doc", "verse_id", "tokens", "places", F.transform(ds, piece).alias("slices"))


def raw_matches(arrays: DataFrame, passages: DataFrame, cfg: Config = Config()) -> DataFrame:
    """RAW columns: every accepted span of every passage in every document.

    ``first_seed`` is the document's first seed of the passage; spans tie in
    the order (first_seed, verse_id, word_start). A ``bigram_df_cap`` of None
    seeds by every pair of words, however common.
    """
    least, base = cfg.min_score, cfg.budget_base

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alike = Alike()
        for b in batches:
            if b.num_rows:
                yield spans_of_batch(Laid(b), alike, least, base)

    return candidates(arrays, passages, cfg).mapInArrow(run, RAW)


def extensions(arrays: DataFrame, passages: DataFrame, cfg: Config = Config()) -> DataFrame:
    """doc, verse_id, tpos, vpos, verse_start, verse_end, matched, score: how far each seed reaches both ways, before any is chosen."""
    base = cfg.budget_base

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alike = Alike()
        for b in batches:
            if b.num_rows:
                x = Laid(b)
                matched, score, first, last = x.extend(alike, base)
                row = pa.array(x.row, pa.int64())
                numbers = [pa.array(c.astype(np.int32)) for c in (x.tpos, x.vpos, first, last, matched)]
                yield pa.record_batch([b.column(0).take(row), b.column(1).take(row), *numbers, pa.array(score)], names=["doc", "verse_id", "tpos", "vpos", "verse_start", "verse_end", "matched", "score"])

    return candidates(arrays, passages, cfg).mapInArrow(run, "doc bigint, verse_id int, tpos int, vpos int, verse_start int, verse_end int, matched int, score double")

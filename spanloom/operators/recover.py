"""Recovering the neighbours of found passages, and chaining runs of them.

Recovery is a work list that changes what it looks up, so it is the one step
that runs per document in Python (Arrow batches). Each document's row has its
words, its matches and the passages of the groups it quotes; the corpus is
joined to it, never broadcast as a whole.

Defined results: documents without matches have none; the last match of a
passage in a document stays unless ``keep_repeats``; a recovered span may
overlap another match. ``max_pops`` bounds the search of a document as a fixed
value; None is without bound, and ``cut_off`` tells where the bound ended it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.config import Config
from spanloom.functions import scores
from spanloom.operators.align import offsets

_MATCH = {"verse_id": "int", "word_start": "int", "word_end": "int", "verse_start": "int", "verse_end": "int", "matched": "int", "score": "double", "confidence": "double", "status": "string", "cross_group": "boolean"}
_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}


def reach(match: Sequence[bool], at: int, step: int, budget: int) -> int:
    """The last matching place from ``at`` in the direction ``step`` before more than ``budget`` mismatches."""
    best, misses, i = at, 0, at + step
    while 0 <= i < len(match):
        if match[i]:
            best = i
        else:
            misses += 1
            if misses > budget:
                break
        i += step
    return best


def probe(passage: Sequence[str], words: Sequence[str], lo: int, hi: int, base: int) -> tuple[int, float, int, int, int] | None:
    """The alignment (matched, score, verse_start, verse_end, diagonal) with the most words through any pair of words in [lo, hi); the first of equals.

    Each diagonal is laid once, whatever the number of its pairs.
    """
    heads: dict[tuple[str, str], list[int]] = {}
    for v, pair in enumerate(zip(passage, passage[1:])):
        heads.setdefault(pair, []).append(v)
    budget, best = base + len(passage) // 6, None
    laid: dict[int, tuple[int, list[bool]]] = {}
    known: dict[tuple[int, int, int], float] = {}
    for p in range(lo, min(hi, len(words) - 1)):
        top = None
        for v in heads.get((words[p], words[p + 1]), ()):
            d = p - v
            if d not in laid:
                at = max(0, d)
                laid[d] = at, [scores.alike(w, passage[i - d]) for i, w in enumerate(words[at : d + len(passage)], at)]
            at, match = laid[d]
            a, b = reach(match, p - at, -1, budget) + at, reach(match, p + 1 - at, 1, budget) + at
            if (d, a, b) not in known:
                known[d, a, b] = scores.ratio(" ".join(words[a : b + 1]), " ".join(passage[a - d : b - d + 1]))
            got = (b - a + 1, known[d, a, b], a - d, b - d, d)
            if top is None or got[:2] > top[:2]:
                top = got
        if top and (best is None or top[0] > best[0]):
            best = top
    return best


def recover_one(words: Sequence[str], matches: list[dict], verses: Mapping[int, tuple[int, Sequence[str]]], cfg: Config) -> tuple[list[dict], bool]:
    """Matches of one document with their neighbours, and whether ``max_pops`` ended the search: a work list, the latest span first."""
    todo = sorted(matches, key=lambda m: (m["word_start"], m["verse_id"]))
    have = {m["verse_id"]: m for m in todo}
    spare = [m for m in todo if have[m["verse_id"]] is not m] if cfg.keep_repeats else []
    gap, n, left = cfg.max_gap_words, len(words), cfg.max_pops
    while todo and left != 0:
        m = todo.pop()
        left = None if left is None else left - 1
        for side in (1, -1):
            v = m["verse_id"] + side
            if v in have or v not in verses or verses[v][0] != verses[m["verse_id"]][0]:
                continue
            passage = verses[v][1]
            if side > 0:
                got = probe(passage, words, max(0, m["word_end"]), min(n - 1, m["word_end"] + 1 + len(passage) + gap), cfg.budget_base)
                apart = got and got[2] + got[4] - m["word_end"] - 1
            else:
                got = probe(passage, words, max(0, m["word_start"] - len(passage) - gap), min(n - 1, m["word_start"] + 1), cfg.budget_base)
                apart = got and m["word_start"] - (got[3] + got[4]) - 1
            if got and got[1] >= cfg.extend_score and apart <= gap:
                matched, score, a, b, d = got
                conf = round(score / 100.0 * scores.factor(matched), 4)
                new = {"verse_id": v, "word_start": a + d, "word_end": b + d, "verse_start": a, "verse_end": b, "matched": matched, "score": score, "confidence": conf, "status": "accepted" if conf >= cfg.recover_accept else "review", "cross_group": m["cross_group"], "recovered": True}
                have[v] = new
                todo.append(new)
    return sorted([*have.values(), *spare], key=lambda m: m["word_start"]), bool(todo)


class Passages(Mapping):
    """verse_id -> (group, words) of one document's row; words leave Arrow when they are asked for."""

    def __init__(self, ids: Sequence[int], groups: Sequence[int], tokens: pa.Array) -> None:
        self.at, self.groups, self.tokens, self.known = {v: i for i, v in enumerate(ids)}, groups, tokens, {}

    def __getitem__(self, v: int) -> tuple[int, Sequence[str]]:
        if v not in self.known:
            i = self.at[v]
            self.known[v] = self.groups[i], self.tokens[i].as_py() or []
        return self.known[v]

    def __contains__(self, v: object) -> bool:
        return v in self.at

    def __iter__(self) -> Iterator[int]:
        return iter(self.at)

    def __len__(self) -> int:
        return len(self.at)


def recover(arrays: DataFrame, kept: DataFrame, passages: DataFrame, cfg: Config = Config()) -> DataFrame:
    """doc, the columns of a match, recovered, cut_off (whether ``max_pops`` ended the document's search). ``kept`` has doc, group_no and the columns of a match."""
    # The groups of a document ride with its matches, so ``kept`` is worked out once.
    groups = passages.groupBy("group_no").agg(F.collect_list(F.struct("verse_id", "group_no", "tokens")).alias("v"))
    per = kept.groupBy("doc").agg(F.collect_list(F.struct(*_MATCH)).alias("m"), F.collect_set("group_no").alias("g")).select("doc", "m", F.explode("g").alias("group_no"))
    near = per.join(groups, "group_no").groupBy("doc").agg(F.first("m").alias("m"), F.flatten(F.collect_list("v")).alias("v"))
    rows = near.join(arrays.select("doc", F.col("words.norm").alias("t")), "doc").select("doc", "t", "m", "v")
    cols = {"doc": "bigint"} | _MATCH | {"recovered": "boolean", "cut_off": "boolean"}
    schema = pa.schema([(n, _ARROW[t]) for n, t in cols.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, words, matches, out = b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), []
            ends, v = offsets(b.column(3)).tolist(), pc.list_flatten(b.column(3))
            ids, groups, tokens = pc.struct_field(v, "verse_id").to_pylist(), pc.struct_field(v, "group_no").to_pylist(), pc.struct_field(v, "tokens")
            for i, doc in enumerate(docs):
                here = slice(ends[i], ends[i + 1])
                got, cut_off = recover_one(words[i].as_py(), matches[i], Passages(ids[here], groups[here], tokens[here]), cfg)
                out += [{"doc": doc, "recovered": False, "cut_off": cut_off} | m for m in got]
            yield pa.RecordBatch.from_pylist(out, schema)

    return rows.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in cols.items()))


def chain(matches: DataFrame, key: str, group: str, item: str, lo: str, hi: str, tie: str, max_gap: int, most: int) -> DataFrame:
    """Adds chain_id (from 1 in each key, null outside chains) and item_end, the last item of the chain.

    Neighbours in place are linked if the second is the next item of the same
    group and begins 0 to ``max_gap`` words after the first; runs are cut at
    ``most`` members.
    """
    by = Window.partitionBy(key).orderBy(lo, tie)
    gap = F.col(lo) - F.lag(hi).over(by) - 1
    linked = (F.col(group) == F.lag(group).over(by)) & (F.col(item) == F.lag(item).over(by) + 1) & (gap >= 0) & (gap <= max_gap)
    out = matches.withColumn("_b", F.when(F.coalesce(linked, F.lit(False)), 0).otherwise(1))
    out = out.withColumn("_i", F.sum("_b").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    out = out.withColumn("_c", F.floor((F.row_number().over(Window.partitionBy(key, "_i").orderBy(lo, tie)) - 1) / most))
    one = Window.partitionBy(key, "_i", "_c")
    out = out.withColumn("_n", F.count("*").over(one)).withColumn("_e", F.last(item).over(one.orderBy(lo, tie).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    out = out.withColumn("_head", F.when((F.col("_n") > 1) & (F.row_number().over(one.orderBy(lo, tie)) == 1), 1).otherwise(0))
    number = F.sum("_head").over(by.rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumn("chain_id", F.when(F.col("_n") > 1, number).cast("int")).withColumn("item_end", F.when(F.col("_n") > 1, F.col("_e")).otherwise(F.col(item))).drop("_b", "_i", "_c", "_n", "_e", "_head")


def last_of_each(matches: DataFrame, key: str, item: str, lo: str, tie: str) -> DataFrame:
    """The last match of every passage in a document."""
    top = Window.partitionBy(key, item).orderBy(F.col(lo).desc(), F.col(tie).desc())
    return matches.withColumn("_r", F.row_number().over(top)).where("_r = 1").drop("_r")

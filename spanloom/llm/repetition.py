"""Repetition inside single texts, with the fertility of public tokenizers.

Per text, of its bare words (:class:`spanloom.llm.forms.BareWords`), by two
public vocabularies: characters per token, share of tokens that are a lone
byte of a character, entropy of the tokens; and the share of repeated words.

The tokens reject texts in two ways. *Bands* per language, and per script
where a text has none, are fitted to labelled clean samples
(:func:`table_bands`: all of a table's); a text outside its band is flagged. And where only texts
with a share of ``half`` or more are wanted (``bounded``), the number of kinds
of token and their entropy reject what cannot have it: every token of a
repeated word came before, so a text of T tokens whose lightest half of the
words has L tokens has at most T - L kinds of token, and an entropy of at most
log2(T - L), if half its words are repeated. No case is lost to this. The share
itself cannot be read off tokens, so it is counted in the texts that are left.

Defined results: null, empty and letterless texts have no row; a text of any
length is read whole; a transcript without segments has no row; a segment with
a null id has no place in the order of ids, so it has no row and is no part of
the whole transcript's text; without samples no text is outside its band.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import bpe, langid
from spanloom.llm.forms import BareWords

MULTI = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How far beyond the samples a band reaches: characters per token and byte share as a factor and a share, evenness of the entropy.
SLACK, BYTE_SLACK, EVEN_SLACK = 1.3, 0.1, 0.05
FIELDS = "n_words int, n_repeated int, n_tokens int, chars_per_token double, byte_share double, entropy double, chars_per_token_multi double, byte_share_multi double, script string, band string, outside boolean, exact boolean, share double"


def repeated_words(words: list[str]) -> int:
    """Words that lie in three consecutive ones that occur in that order earlier."""
    seen: set[tuple[str, str, str]] = set()
    n, upto = 0, 0
    for i, three in enumerate(zip(words, words[1:], words[2:])):
        if three in seen:
            n += i + 3 - max(i, upto)
            upto = i + 3
        else:
            seen.add(three)
    return n


def script(text: str) -> str:
    for ch in text:
        if ch.isalpha():
            name = unicodedata.name(ch, "")
            return "ARABIC" if name.startswith("ARABIC") else "LATIN" if name.startswith("LATIN") else "OTHER"
    return "OTHER"


class Tokens:
    """What one vocabulary says about lists of words."""

    def __init__(self, path: str) -> None:
        self.encoder = bpe.Encoder(path)
        self.is_byte = self.encoder.vocabulary.is_byte

    def of(self, kinds: list[str], code: np.ndarray, text_of_word: np.ndarray, n_texts: int, rank: np.ndarray, repeated: np.ndarray) -> dict[str, np.ndarray]:
        """Per text: tokens, lone bytes, entropy, kinds of token, and the tokens of its lightest words, ``repeated`` of them; and per text and kind of token (``of``, ``token``) its ``count``."""
        off, ids = self.encoder.encode([" " + w for w in kinds])
        n = np.diff(off)[code] if len(code) else np.zeros(0, np.int64)
        tokens = ids[np.repeat(off[:-1][code] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))] if len(code) else np.zeros(0, np.int32)
        owner = np.repeat(text_of_word, n)
        total = np.bincount(owner, minlength=n_texts).astype(float)
        key, count = np.unique(owner.astype(np.int64) * len(self.is_byte) + tokens, return_counts=True)
        of, token = np.divmod(key, len(self.is_byte))
        p = count / total[of]
        light = np.lexsort((n, text_of_word))
        lightest = np.bincount(text_of_word[light], weights=n[light] * (rank < repeated[text_of_word[light]]), minlength=n_texts)
        return {
            "total": total, "lone": np.bincount(owner, weights=self.is_byte[tokens], minlength=n_texts),
            "entropy": np.bincount(of, weights=-p * np.log2(p), minlength=n_texts), "kinds": np.bincount(of, minlength=n_texts), "lightest": lightest,
            "of": of, "token": token, "count": count,
        }


class Measure:
    """Measures lists of words, remembering the tokens of each word."""

    def __init__(self, path: str, multi: str = MULTI) -> None:
        self.bare, self.vocabularies = BareWords(split=False), [Tokens(path), Tokens(multi)]

    def tokens(self, texts: list[list[str]], half: float) -> list[dict[str, np.ndarray]]:
        flat = [w for words in texts for w in words]
        kinds = {w: i for i, w in enumerate(dict.fromkeys(flat))}
        code = np.array([kinds[w] for w in flat], np.int64)
        sizes = np.array([len(w) for w in texts], np.int64)
        rank = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return [v.of(list(kinds), code, np.repeat(np.arange(len(texts)), sizes), len(texts), rank, np.ceil(sizes * half - 1e-9)) for v in self.vocabularies]

    def all(self, texts: list[list[str]], least: int, half: float, bounded: bool = False, langs: list[str | None] | None = None, bands: dict | None = None) -> list[tuple]:
        """FIELDS of each text; with ``bounded`` only texts that may be a case are counted."""
        sizes = np.array([len(w) for w in texts], np.int64)
        got = self.tokens(texts, half)
        may = np.ones(len(texts), bool)
        if bounded:
            may = sizes >= least
            for g in got:
                most = g["total"] - g["lightest"]
                may &= (g["kinds"] <= most + 1e-9) & (g["entropy"] <= np.log2(np.maximum(1.0, most)) + 1e-6)
        out = []
        for i, words in enumerate(texts):
            w, (g, h) = len(words), got
            s = script(words[0]) if w else "OTHER"
            chars, t, t2 = sum(map(len, words)), g["total"][i], h["total"][i]
            cpt, cpt2 = (chars / t, chars / t2) if t else (0.0, 0.0)
            lone, lone2 = (g["lone"][i] / t, h["lone"][i] / t2) if t else (0.0, 0.0)
            lang = ((langs[i] if langs else None) or "").strip().lower()[:2]
            band = lang if bands and lang in bands else s if bands and s in bands else None
            outside = band is not None and w >= least and not _inside(bands[band], (cpt, cpt2), (lone, lone2), (g["entropy"][i], h["entropy"][i]), (t, t2))
            n_rep = repeated_words(words) if may[i] else -1
            out.append((w, n_rep, int(t), float(cpt), float(lone), float(g["entropy"][i]), float(cpt2), float(lone2), s, band, bool(outside), bool(may[i]), n_rep / w if may[i] and w else None))
        return out


def _even(entropy: float, total: float) -> float:
    """Entropy as a share of the largest one that the number of tokens allows."""
    return entropy / np.log2(total) if total > 1 else 1.0


def _inside(band: tuple, cpt: tuple, lone: tuple, entropy: tuple, total: tuple) -> bool:
    for (low, high, byte, line), c, b, e, t in zip(band, cpt, lone, entropy, total):
        # the evenness of clean text falls with its length: between a short and a long text, in the logarithm of the tokens
        floor = np.interp(np.log2(max(t, 1)), line[0], line[1]) - EVEN_SLACK
        if not (low <= c <= high and b <= byte and _even(e, t) >= floor):
            return False
    return True


def fit_bands(samples: list[tuple[str, str]], path: str = bpe.DEFAULT, multi: str = MULTI) -> dict[str, tuple]:
    """Per language, and per script, and per vocabulary: least and most characters per token, most lone bytes, and the least evenness at two lengths.

    ``samples`` are (language, clean text), few enough for one list;
    :func:`table_bands` says the same of a table.
    """
    m = Measure(path, multi)
    groups: dict[str, list[list[str]]] = {}
    for lang, text in samples:
        words = m.bare.words(text)
        if words:
            groups.setdefault(lang, []).append(words)
            groups.setdefault(script(words[0]), []).append(words)
    bands = {}
    for name, texts in groups.items():
        texts = [*texts, [w for t in texts for w in t]]  # the last is the longest text there is of the group
        band = []
        for g in m.tokens(texts, 0.5):
            cpt = np.array([sum(map(len, w)) for w in texts]) / g["total"]
            even = np.array([_even(e, t) for e, t in zip(g["entropy"], g["total"])])
            band.append(_band(cpt.min(), cpt.max(), (g["lone"] / g["total"]).max(), np.median(g["total"][:-1]), even[:-1].min(), g["total"][-1], even[-1]))
        bands[name] = tuple(band)
    return bands


def _band(low: float, high: float, lone: float, middle: float, even: float, total: float, whole: float) -> tuple:
    """The band of texts of ``middle`` tokens in the middle and an evenness of ``even`` at least, and of ``whole`` over all their ``total`` tokens."""
    return low / SLACK, high * SLACK, float(lone + BYTE_SLACK), (np.log2([middle, max(total, middle + 1)]), [even, whole])


def table_bands(samples: DataFrame, lang: str, text: str, path: str = bpe.DEFAULT, multi: str = MULTI) -> dict[str, tuple]:
    """The bands of :func:`fit_bands` from every labelled sample of a table, of any number.

    Samples are measured where they lie and leave as the number of each token
    and the figures of each text, which are summed per group; the driver gets
    one row of a group and vocabulary.
    """
    places = [bpe.sent(samples.sparkSession, p) for p in (path, multi)]
    fields = "lang string, script string, vocabulary int, token int, total int, n long, low double, high double, lone double, even double"
    arrow = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    types = {f.split()[0]: arrow[f.split()[1]] for f in fields.split(", ")}

    def rows(cols: dict[str, list | np.ndarray]) -> pa.RecordBatch:
        n = len(cols["lang"])
        return pa.record_batch([pa.array(cols[c], t) if c in cols else pa.nulls(n, t) for c, t in types.items()], names=list(types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Measure(*(p() for p in places))
        for big in batches:
            for at in range(0, big.num_rows, 200):
                b = big.slice(at, 200)
                read = [(l, m.bare.words(t)) for l, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
                of = [(l, script(w[0])) for l, w in read if w]
                texts = [w for _, w in read if w]
                if not texts:
                    continue
                kinds = {k: i for i, k in enumerate(dict.fromkeys(of))}
                names, group = list(kinds), np.array([kinds[k] for k in of], np.int64)
                chars = np.array([sum(map(len, w)) for w in texts])
                for v, g in enumerate(m.tokens(texts, 0.5)):
                    cpt, even = chars / g["total"], [_even(e, t) for e, t in zip(g["entropy"], g["total"])]
                    yield rows({
                        "lang": [k[0] for k in of], "script": [k[1] for k in of], "vocabulary": np.full(len(of), v), "total": g["total"].astype(np.int64),
                        "n": np.ones(len(of), np.int64), "low": cpt, "high": cpt, "lone": g["lone"] / g["total"], "even": even,
                    })
                    size = int(g["token"].max()) + 1
                    key, back = np.unique(group[g["of"]] * size + g["token"], return_inverse=True)
                    n = np.bincount(back, weights=g["count"]).astype(np.int64)
                    k = [names[i] for i in key // size]
                    yield rows({"lang": [x[0] for x in k], "script": [x[1] for x in k], "vocabulary": np.full(len(k), v), "token": key % size, "n": n})

    parts = samples.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(lang, text).mapInArrow(run, fields)
    parts = parts.withColumn("name", F.explode(F.array("lang", "script"))).groupBy("name", "vocabulary", "token", "total")
    figures = [F.min("low").alias("low"), F.max("high").alias("high"), F.max("lone").alias("lone"), F.min("even").alias("even")]
    # n log2 n of each token of the vocabulary, added in one order however the rows lie
    spread = F.aggregate(F.sort_array(F.collect_list(F.when(F.col("token").isNotNull(), F.col("n") * F.log2("n")))), F.lit(0.0), lambda a, x: a + x)
    tokens = F.sum(F.when(F.col("token").isNotNull(), F.col("n")))
    groups = parts.agg(F.sum("n").alias("n"), *figures).groupBy("name", "vocabulary").agg(*figures, F.expr("percentile(total, 0.5, n)").alias("middle"), tokens.alias("tokens"), spread.alias("spread"))
    bands: dict[str, tuple] = {}
    for r in sorted(groups.collect(), key=lambda r: (r["name"], r["vocabulary"])):
        whole = _even(np.log2(r["tokens"]) - r["spread"] / r["tokens"], r["tokens"])
        bands[r["name"]] = (*bands.get(r["name"], ()), _band(r["low"], r["high"], r["lone"], r["middle"], r["even"], r["tokens"], whole))
    return bands


def measure(df: DataFrame, key: str, segments: str, path: str = bpe.DEFAULT, least: int = 8, half: float = 0.5, bounded: bool = False, language: str | None = None, bands: dict | None = None, multi: str = MULTI) -> DataFrame:
    """Columns: the key, segment_id (-1 for all segments in the order of their ids), avg_logprob, FIELDS.

    n_repeated and share are of every text. With ``bounded``, n_repeated is -1
    and share null where the tokens show that fewer than ``half`` of the words
    are repeated, or where the text has fewer than ``least`` words; ``exact``
    says that it was counted. ``band`` is the one of :func:`table_bands` the text
    was held against.
    """
    s = F.col(segments)
    lang = F.col(language) if language else F.lit(None).cast("string")
    src = df.select(key, s["id"].alias("i"), s["text"].alias("t"), s["avg_logprob"].alias("p"), lang.alias("l")).where("size(i) > 0")
    types = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.float64(), pa.float64(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.float64()]

    places = [bpe.sent(df.sparkSession, p) for p in (path, multi)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Measure(*(p() for p in places))
        for big in batches:
            for at in range(0, big.num_rows, 200):
                b = big.slice(at, 200)
                rows, ids, probs, texts, langs = [], [], [], [], []
                for r, (i, t, p, l) in enumerate(zip(*(b.column(c).to_pylist() for c in (1, 2, 3, 4)))):
                    order = sorted((x for x in range(len(i)) if i[x] is not None), key=lambda x: i[x])
                    words = {x: m.bare.words(t[x]) for x in order if t[x]}
                    whole = [w for x in order if x in words for w in words[x]]
                    for x in order:
                        if words.get(x):
                            rows.append(r), ids.append(i[x]), probs.append(p[x]), texts.append(words[x]), langs.append(l)
                    if whole:
                        rows.append(r), ids.append(-1), probs.append(None), texts.append(whole), langs.append(l)
                cols = list(zip(*m.all(texts, least, half, bounded, langs, bands))) or [[]] * len(types)
                yield pa.record_batch(
                    [b.column(0).take(pa.array(rows, pa.int64())), pa.array(ids, pa.int32()), pa.array(probs, pa.float64()), *[pa.array(c, t) for c, t in zip(cols, types)]],
                    names=["_key", "segment_id", "avg_logprob", *[f.split()[0] for f in FIELDS.split(", ")]],
                )

    out = src.mapInArrow(run, f"_key {dict(df.dtypes)[key]}, segment_id int, avg_logprob double, {FIELDS}")
    return out.withColumnRenamed("_key", key)

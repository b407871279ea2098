"""Language of documents, and of the lines of mixed ones, by a linear-chain CRF.

The words of a line are a chain. Affixes, character n-grams, the word itself
(the lexicon) and its script score each language for each word; learned
transitions score each change of language; forward-backward gives the
probability of every language for every word. A line or document has the
language of most of its words, and the mean probability as its confidence.

The model is fitted on the driver to labelled samples, at most
``PER_LANGUAGE`` of each language (a bound on what is collected), put together
into mixed lines as well, so that changes of language are learned too.

Defined results: null and empty texts, and texts and lines without letters,
have no row; ties go to the language with the larger sum of probabilities;
a text of any length is read whole; repeated rows give the same rows again;
without labelled samples there are no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Labelled samples of a language that are collected at most, and rounds of fitting.
PER_LANGUAGE, ROUNDS = 2000, 60
CELLS = 400_000

# A tag of any length begins with its name; a lone "<" between words is none.
_MARKUP = re.compile(r"</?[A-Za-z!?][^<>]*>|&#?\w{1,10};|https?://\S+|www\.\S+|\S+@\S+")


def fold(piece: str) -> str:
    """The letters of a piece, folded; '' where it has none."""
    t = unicodedata.normalize("NFKC", piece).lower()
    return "".join(c for c in t if c.isalpha())


def features(word: str) -> list[str]:
    f = ["w:" + word]
    f += [f"p{n}:{word[:n]}" for n in (1, 2, 3) if len(word) >= n]
    f += [f"s{n}:{word[-n:]}" for n in (1, 2, 3) if len(word) >= n]
    t = f"^{word}$"
    f += [f"g:{t[i : i + n]}" for n in (2, 3) for i in range(len(t) - n + 1)]
    f += ["x:" + unicodedata.name(c, "?").split()[0] for c in dict.fromkeys(word[:1] + word[-1:])]
    f += ["c:" + c for c in dict.fromkeys(word)]
    return list(dict.fromkeys(f))


def forward_backward(scores: np.ndarray, lengths: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Probabilities of the states of padded chains, sorted from long to short. scores: chain, place, state."""
    n, width, k = scores.shape
    e = np.exp(scores - scores.max(2, keepdims=True))
    live = [int(np.searchsorted(-lengths, -t, "left")) for t in range(width)]  # chains longer than t
    alpha, beta = np.empty_like(e), np.ones_like(e)
    a = e[:, 0] / e[:, 0].sum(1, keepdims=True)
    alpha[:, 0] = a
    for t in range(1, width):
        m = live[t]
        x = (alpha[:m, t - 1] @ change) * e[:m, t]
        alpha[:m, t] = x / x.sum(1, keepdims=True)
    for t in range(width - 2, -1, -1):
        m = live[t + 1]
        x = (beta[:m, t + 1] * e[:m, t + 1]) @ change.T
        beta[:m, t] = x / x.sum(1, keepdims=True)
    p = alpha * beta
    p[np.arange(width) >= lengths[:, None]] = 0
    return p / np.maximum(p.sum(2, keepdims=True), 1e-300)


class Model:
    """Weights of the features per language, and the transitions."""

    def __init__(self, samples: list[tuple[str, str]], seed: int = 7) -> None:
        self.langs = sorted({lang for lang, _ in samples})
        number = {x: i for i, x in enumerate(self.langs)}
        rng = np.random.default_rng(seed)
        plain = [([w for p in text.split() if (w := fold(p))], number[lang]) for lang, text in samples]
        plain = [(w, x) for w, x in plain if w]
        if not plain:
            self.langs = []
            return
        chains = [(w, [x] * len(w)) for w, x in plain]
        for w, x in plain:  # mixed lines: a part of each sample inside another one
            o, y = plain[int(rng.integers(len(plain)))]
            i, j = sorted(int(v) for v in rng.integers(0, len(w) + 1, 2))
            a = int(rng.integers(0, len(o)))
            part = o[a : a + int(rng.integers(3, 12))]
            chains.append((w[:i] + part + w[i:], [x] * i + [y] * len(part) + [x] * (len(w) - i)))
        self.index: dict[str, int] = {}
        words = dict.fromkeys(w for c, _ in chains for w in c)
        of = {w: [self.index.setdefault(f, len(self.index)) for f in features(w)] for w in words}
        self._fit(chains, of)
        self.known: dict[str, np.ndarray] = {}

    def _fit(self, chains: list[tuple[list[str], list[int]]], of: dict[str, list[int]]) -> None:
        k = len(self.langs)
        chains = sorted(chains, key=lambda c: -len(c[0]))
        lengths = np.array([len(c) for c, _ in chains])
        mask = np.arange(lengths[0]) < lengths[:, None]
        truth = np.zeros(mask.shape, np.int64)
        truth[mask] = np.concatenate([y for _, y in chains])
        kinds = {w: i for i, w in enumerate(of)}
        code = np.array([kinds[w] for c, _ in chains for w in c])
        counts = np.array([len(v) for v in of.values()])
        feature, owner = np.concatenate([np.array(v) for v in of.values()]), np.repeat(np.arange(len(of)), counts)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.w, self.t = np.zeros((len(self.index), k)), np.zeros((k, k))
        gw, gt = np.full_like(self.w, 1e-6), np.full_like(self.t, 1e-6)
        hot = np.eye(k)
        for _ in range(ROUNDS):
            by_word = np.add.reduceat(self.w[feature], starts)
            scores = np.zeros((*mask.shape, k))
            scores[mask] = by_word[code]
            change = np.exp(self.t - self.t.max())
            p = forward_backward(scores, lengths, change)
            diff = hot[truth[mask]] - p[mask]
            d_word = np.stack([np.bincount(code, diff[:, c], len(of)) for c in range(k)], 1)
            d_w = np.stack([np.bincount(feature, d_word[owner, c], len(self.index)) for c in range(k)], 1) - 0.05 * self.w
            both = mask[:, 1:]
            seen = np.bincount((truth[:, :-1][both] * k + truth[:, 1:][both]), minlength=k * k).reshape(k, k)
            # the probability of each pair of neighbours under the model
            e = np.exp(scores - scores.max(2, keepdims=True))
            left, right = p[:, :-1][both], p[:, 1:][both]
            ahead = left[:, :, None] * change[None] * e[:, 1:][both][:, None, :]
            ahead *= (right / np.maximum(ahead.sum(1), 1e-300))[:, None, :]
            d_t = seen - ahead.sum(0) - 0.05 * self.t
            gw += d_w**2
            gt += d_t**2
            self.w += 0.5 * d_w / np.sqrt(gw)
            self.t += 0.3 * d_t / np.sqrt(gt)
        self.change = np.exp(self.t - self.t.max())

    def score(self, word: str) -> np.ndarray:
        at = [i for f in features(word) if (i := self.index.get(f)) is not None]
        return self.w[at].sum(0) if at else np.zeros(len(self.langs))

    def label(self, lines: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Per line: number of words of each language, and the sums of their probabilities."""
        k = len(self.langs)
        count, mass = np.zeros((len(lines), k)), np.zeros((len(lines), k))
        kinds = {w: i for i, w in enumerate(dict.fromkeys(w for x in lines for w in x))}
        if not kinds:
            return count, mass
        scores = np.stack([self._score(w) for w in kinds])
        order = sorted((i for i, x in enumerate(lines) if x), key=lambda i: -len(lines[i]))
        at = 0
        while at < len(order):  # padded groups of lines of about one length
            width = len(lines[order[at]])
            end = at
            while end < len(order) and (end - at + 1) * width <= max(CELLS, width) and len(lines[order[end]]) * 2 >= width:
                end += 1
            rows = order[at:end]
            lengths = np.array([len(lines[i]) for i in rows])
            mask = np.arange(width) < lengths[:, None]
            e = np.zeros((len(rows), width, k))
            e[mask] = scores[[kinds[w] for i in rows for w in lines[i]]]
            p = forward_backward(e, lengths, self.change)
            mass[rows] = p.sum(1)
            best = p.argmax(2)
            count[rows] = np.stack([((best == c) & mask).sum(1) for c in range(k)], 1)
            at = end
        return count, mass

    def _score(self, word: str) -> np.ndarray:
        got = self.known.get(word)
        if got is None:
            if len(self.known) > 300_000:
                self.known.clear()
            got = self.known[word] = self.score(word)
        return got


def labelled(samples: DataFrame, key: str, lang: str, text: str) -> list[tuple[str, str]]:
    """(language, text) of at most PER_LANGUAGE labelled samples of each language, the first by key."""
    some = samples.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(key, lang, text)
    some = some.withColumn("_n", F.row_number().over(Window.partitionBy(lang).orderBy(key))).where(F.col("_n") <= PER_LANGUAGE)
    return [(r[1], r[2]) for r in sorted(some.collect(), key=lambda r: (r[1], r[0]))]


@lru_cache(maxsize=4)
def fitted(samples: tuple[tuple[str, str], ...]) -> Model:
    """The model of these samples, fitted once a process."""
    return Model(list(samples))


def train(samples: DataFrame, key: str, lang: str, text: str) -> Model:
    return fitted(tuple(labelled(samples, key, lang, text)))


def words_of_line(line: str, known: dict[str, str]) -> list[str]:
    out = []
    for p in (_MARKUP.sub(" ", line) if "<" in line or "&" in line or "." in line or "@" in line else line).split():
        w = known.get(p)
        if w is None:
            w = fold(p)
            if len(p) < 100:
                known[p] = w
        if w:
            out.append(w)
    return out


def languages(df: DataFrame, key: str, text: str, label: str, samples: DataFrame, sample_key: str) -> DataFrame:
    """Columns: the key, line_no, lang, confidence, mixed, agrees.

    line_no 0 is the document; a document with lines of different languages
    (``mixed``) also has a row for each of its lines with letters, numbered
    from 1. ``agrees`` says whether the label stands for the language.
    """
    schema = f"_key {dict(df.dtypes)[key]}, line_no int, lang string, confidence double, mixed boolean, agrees boolean"
    model = train(samples, sample_key, "lang", "text")
    if not model.langs:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("_key", key)
    sent = df.sparkSession.sparkContext.broadcast(model)
    names = ["_key", "line_no", "lang", "confidence", "mixed", "agrees"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = sent.value, {}
        k = len(model.langs)
        for big in batches:
            for at in range(0, big.num_rows, 1000):
                b = big.slice(at, 1000)
                texts, labels = b.column(1).to_pylist(), b.column(2).to_pylist()
                lines, doc, no = [], [], []
                if len(known) > 300_000:
                    known.clear()
                for r, t in enumerate(texts):
                    for n, line in enumerate(t.split("\n"), 1):
                        if words := words_of_line(line, known):
                            lines.append(words), doc.append(r), no.append(n)
                count, mass = model.label(lines)
                doc_at = np.array(doc, np.int64)
                d_count, d_mass = np.zeros((len(texts), k)), np.zeros((len(texts), k))
                np.add.at(d_count, doc_at, count)
                np.add.at(d_mass, doc_at, mass)
                pick = lambda c, m: (c + m / (1 + m.sum(1, keepdims=True))).argmax(1)
                line_lang, doc_lang = (pick(count, mass), pick(d_count, d_mass)) if len(lines) else ([], pick(d_count, d_mass))
                low, high = np.full(len(texts), k), np.full(len(texts), -1)
                np.minimum.at(low, doc_at, line_lang)
                np.maximum.at(high, doc_at, line_lang)
                rows: list[tuple] = []
                for r in range(len(texts)):
                    if high[r] >= 0:
                        c = int(doc_lang[r])
                        rows.append((r, 0, model.langs[c], float(d_mass[r, c] / d_mass[r].sum()), bool(low[r] != high[r]), (labels[r] or "").strip().lower()[:2] == model.langs[c]))
                for i, r in enumerate(doc):
                    if low[r] != high[r]:
                        c = int(line_lang[i])
                        rows.append((r, no[i], model.langs[c], float(mass[i, c] / mass[i].sum()), True, (labels[r] or "").strip().lower()[:2] == model.langs[c]))
                cols = list(zip(*rows)) or [[]] * 6
                types = [pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.bool_(), pa.bool_()]
                arrays = [pa.array(c, t) for c, t in zip(cols, types)]
                yield pa.record_batch([b.column(0).take(arrays[0]), *arrays[1:]], names=names)

    src = df.select(key, text, label).where(F.length(text) > 0)
    return src.mapInArrow(run, schema).withColumnRenamed("_key", key)

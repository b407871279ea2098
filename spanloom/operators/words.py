"""The ordered, timed, normalized word stream of a document.

A document is one row with its segments; its words are made there as one
array, so the dense word number needs no window and no shuffle.

Defined results: null segments, and documents without any, have no words; a
word without letters is dropped and leaves a gap in ``pos`` but not in ``g``;
missing times come from the segment, then 0.0; a segment without words has its
text cut at white space and its time spread evenly; a segment without an id
is number 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.config import NormRules
from spanloom.functions import scores, textnorm

STRIP = r"(?U)\A\s+|\s+\z"


def _zero(*cols: Column) -> Column:
    return F.coalesce(*cols, F.lit(0.0))


#: Stands between words while a whole document is normalized at once; in a word itself it is no letter.
_BETWEEN = "\u0001"


def raw_words(s: Column, seg_pos: Column) -> Column:
    """Words of one segment before normalization: ARRAY<STRUCT<raw, seg_pos, seg_id, pos, start, end>>."""
    def word(raw: Column, pos: Column, start: Column, end: Column) -> Column:
        return F.struct(raw.alias("raw"), seg_pos.alias("seg_pos"), F.coalesce(s["id"], F.lit(0)).alias("seg_id"), pos.alias("pos"), start.alias("start"), end.alias("end"))

    timed = F.transform(s["words"], lambda w, i: word(F.regexp_replace(F.coalesce(w["word"], F.lit("")), STRIP, ""), i, _zero(w["start"], s["start"]), _zero(w["end"], s["end"])))
    # The parameter of an outer function, so that the text is cut once and not once a word.
    cut = F.array(F.struct(textnorm.pieces(s["text"]).alias("p"), _zero(s["start"]).alias("lo"), _zero(s["end"]).alias("hi")))
    step = lambda c: (c["hi"] - c["lo"]) / F.greatest(F.size(c["p"]), F.lit(1))
    spread = F.flatten(F.transform(cut, lambda c: F.transform(c["p"], lambda w, i: word(w, i, c["lo"] + i * step(c), c["lo"] + (i + 1) * step(c)))))
    return F.when(F.size(s["words"]) > 0, timed).otherwise(spread)


def normals(raw: Column, rules: NormRules = NormRules()) -> Column:
    """The normal form of every word of ``raw``, an array of raw words.

    The words are normalized as one string, so the patterns run once a
    document and not once a word.
    """
    joined = F.array_join(F.transform(raw, lambda w: F.replace(w, F.lit(_BETWEEN), F.lit(" "))), _BETWEEN)
    return F.split(F.regexp_replace(textnorm.arabic(joined, rules, keep=_BETWEEN), f" *{_BETWEEN} *", _BETWEEN), _BETWEEN)


_ARRAY = "array<struct<raw:string,norm:string,seg_pos:int,seg_id:int,pos:int,start:double,end:double>>"


def word_arrays(docs: DataFrame, key: str, segments: str = "segments", keep: tuple[str, ...] = (), rules: NormRules = NormRules()) -> DataFrame:
    """Columns: the key as doc, ``keep``, words (g is the place in the array)."""
    live = F.filter(F.col(segments), lambda s: s.isNotNull())
    raw = docs.select(F.col(key).alias("doc"), *keep, F.flatten(F.transform(live, raw_words)).alias("_raw"))

    def both(w: Column, i: Column, n: Column) -> Column:
        return F.struct(w["raw"].alias("raw"), F.get(n, i).alias("norm"), *[w[c].alias(c) for c in ("seg_pos", "seg_id", "pos", "start", "end")])

    # The parameter of an outer function, so that the normal forms are made once a document.
    one = F.array(F.struct(F.col("_raw").alias("r"), normals(F.transform("_raw", lambda w: w["raw"]), rules).alias("n")))
    words = F.flatten(F.transform(one, lambda d: F.filter(F.transform(d["r"], lambda w, i: both(w, i, d["n"])), lambda w: w["norm"] != "")))
    return raw.select("doc", *keep, F.coalesce(F.when(F.size("_raw") > 0, words), F.array().cast(_ARRAY)).alias("words"))


def word_rows(arrays: DataFrame) -> DataFrame:
    """One row per word: doc, g, raw, norm, seg_pos, seg_id, pos, start, end."""
    return arrays.select("doc", F.posexplode("words").alias("g", "w")).select("doc", "g", "w.*")


def full_text(segments: Column) -> Column:
    """The trimmed texts of the segments, joined by spaces."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s.isNotNull()), lambda s: F.regexp_replace(F.coalesce(s["text"], F.lit("")), STRIP, "")), " ")


def reliable(segments: Column, least_logprob: float = -1.0, most_no_speech: float = 0.6) -> Column:
    """The segments the recognizer was sure of."""
    return F.filter(segments, lambda s: (s["avg_logprob"] >= least_logprob) & (s["no_speech_prob"] <= most_no_speech))


def rounded(doc: Column) -> Column:
    """A recognizer's document as it is kept: times to 3 digits, probabilities to 4, the duration to 2, texts trimmed, segments numbered from 0."""
    r = scores.half_even
    word = lambda w: F.struct(w["word"].alias("word"), r(w["start"], 3).alias("start"), r(w["end"], 3).alias("end"), r(w["probability"], 4).alias("probability"))
    seg = lambda s, i: F.struct(
        i.alias("id"), r(s["start"], 3).alias("start"), r(s["end"], 3).alias("end"), F.regexp_replace(s["text"], STRIP, "").alias("text"),
        r(s["avg_logprob"], 4).alias("avg_logprob"), r(s["no_speech_prob"], 4).alias("no_speech_prob"), F.transform(s["words"], word).alias("words"),
    )
    return doc.withField("language_probability", r(doc["language_probability"], 4)).withField("duration_seconds", r(doc["duration_seconds"], 2)).withField("segments", F.transform(doc["segments"], seg))

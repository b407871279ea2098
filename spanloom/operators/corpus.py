"""The fixed corpus of passages: numbering, alignment, postings, neighbours.

Defined results: a passage without text has no words and no postings; a null
or empty alignment stands for one source piece per word; a pair of words twice
in a passage counts twice for the frequency cap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions import textnorm
from spanloom.operators.manifest import numbered


def number(raw: DataFrame) -> DataFrame:
    """Passages (group_no, group_name, item_no, text) in the corpus format, numbered from 1 in order."""
    return numbered(raw, ["group_no", "item_no"], "verse_id").select(
        F.col("verse_id").cast("int").alias("verse_id"), F.col("group_no").alias("surah_no"), F.col("group_name").alias("surah_name"), F.col("item_no").alias("ayah_no"),
        F.col("text").alias("text_uthmani"), textnorm.arabic(F.col("text")).alias("text_norm"), textnorm.alignment(F.col("text")).alias("uth_align"),
    )


def passages(verses: DataFrame) -> DataFrame:
    """verse_id, group_no, group_name, item_no, source, align, tokens."""
    return verses.select(
        "verse_id", F.col("surah_no").alias("group_no"), F.col("surah_name").alias("group_name"), F.col("ayah_no").alias("item_no"),
        F.col("text_uthmani").alias("source"), F.col("uth_align").alias("align"), textnorm.tokens(F.coalesce("text_norm", F.lit(""))).alias("tokens"),
    )


def bigrams(df: DataFrame, key: str, tokens: str, place: str) -> DataFrame:
    """One row per pair of neighbouring words: the key, place, w1, w2."""
    t = F.col(tokens)
    pairs = F.transform(F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))), lambda w, i: F.struct(F.get(t, i).alias("w1"), w.alias("w2")))
    return df.select(key, F.posexplode(pairs).alias(place, "p")).select(key, place, "p.w1", "p.w2")


def postings(passages: DataFrame, cap: int | None = None) -> DataFrame:
    """w1, w2, verse_id, vpos, df; only pairs that occur at most ``cap`` times."""
    rows = bigrams(passages, "verse_id", "tokens", "vpos")
    out = rows.withColumn("df", F.count("*").over(Window.partitionBy("w1", "w2")))
    return out if cap is None else out.where(F.col("df") <= cap)


def seed_cap(passages: DataFrame, cap: int | None) -> DataFrame:
    """One row: pairs_over_cap, places_over_cap, and passages_unseeded, those with pairs of words of which all are over the cap."""
    rows = postings(passages).withColumn("over", F.lit(False) if cap is None else F.col("df") > cap)
    places = rows.groupBy("verse_id").agg(F.count_if("over").alias("n_over"), F.count("*").alias("n"))
    per_pair = rows.groupBy("w1", "w2").agg(F.max("over").alias("over"))
    pairs = per_pair.agg(F.count_if("over")).scalar()
    return places.agg(pairs.alias("pairs_over_cap"), F.coalesce(F.sum("n_over"), F.lit(0)).cast("long").alias("places_over_cap"), F.count_if(F.col("n_over") == F.col("n")).alias("passages_unseeded"))


def frequencies(passages: DataFrame) -> DataFrame:
    return bigrams(passages, "verse_id", "tokens", "vpos").groupBy("w1", "w2").agg(F.count("*").alias("df"))


def neighbours(passages: DataFrame) -> DataFrame:
    """verse_id with the one before and the one after in its group, where they follow directly."""
    by = Window.partitionBy("group_no").orderBy("verse_id")
    before, after = F.lag("verse_id").over(by), F.lead("verse_id").over(by)
    return passages.select("verse_id", "group_no", F.when(before == F.col("verse_id") - 1, before).alias("prev_id"), F.when(after == F.col("verse_id") + 1, after).alias("next_id"))

"""Keyword search over a corpus: BM25 and all-terms.

Okapi BM25 as published: k1 1.5, b 0.75; a negative idf is replaced by 0.25 x
the mean idf. Defined results: query words count as often as they occur;
scores of 0 and less are no hits; ties go to the smaller id; a null id of a
passage or query matches nothing in :func:`all_terms`; passages without
words have length 1 (a word that matches nothing).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K1, B, EPSILON = 1.5, 0.75, 0.25


def terms(passages: DataFrame, key: str, tokens: str) -> DataFrame:
    """key, token, tf, dl."""
    filled = F.when(F.size(tokens) > 0, F.col(tokens)).otherwise(F.array(F.lit("\u0000")))
    return passages.select(key, F.size(filled).alias("dl"), F.explode(filled).alias("token")).groupBy(key, "token").agg(F.count("*").alias("tf"), F.first("dl").alias("dl"))


def bm25(passages: DataFrame, key: str, tokens: str, queries: DataFrame, query: str, words: str, k: int, digits: int = 6) -> DataFrame:
    """query, key, score, rank: the top ``k`` of each query; scores that are equal to ``digits`` places tie."""
    tf = terms(passages, key, tokens)
    size = tf.groupBy(key).agg(F.first("dl").alias("dl")).agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))
    n, avgdl = size.select("n").scalar(), size.select("avgdl").scalar()
    raw = tf.groupBy("token").agg(F.count("*").alias("df")).select("token", (F.log(n - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).alias("raw"))
    mean = raw.agg(F.avg("raw")).scalar()
    idf = raw.select("token", F.when(F.col("raw") < 0, F.lit(EPSILON) * mean).otherwise(F.col("raw")).alias("idf"))
    q = queries.select(query, F.explode(words).alias("token")).groupBy(query, "token").agg(F.count("*").alias("qf"))
    weight = F.col("qf") * F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / avgdl))
    score = q.join(idf, "token").join(tf, "token").groupBy(query, key).agg(F.sum(weight).alias("score")).where("score > 0")
    top = Window.partitionBy(query).orderBy(F.round("score", digits).desc(), F.col(key))
    return score.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k)


def all_terms(passages: DataFrame, key: str, tokens: str, queries: DataFrame, query: str, words: str) -> DataFrame:
    """query, key: the passages that have every word of the query.

    Each query looks up its rarest word alone; the passages that have it are
    then asked for the other words. So a word that most passages hold is
    looked up only by queries that have no other.
    """
    inverted = passages.select(key, F.explode(F.array_distinct(tokens)).alias("token"))
    df = inverted.groupBy("token").agg(F.count("*").alias("df"))
    q = queries.select(query, F.array_distinct(words).alias("w")).where(F.size("w") > 0)
    rare = q.select(query, "w", F.explode("w").alias("token")).join(df, "token").groupBy(query).agg(F.min_by("token", F.struct("df", "token")).alias("token"), F.first("w").alias("w"), F.count("*").alias("n"))
    hits = rare.where(F.col("n") == F.size("w")).join(inverted, "token").select(query, key, "w")
    return hits.join(passages.select(key, F.col(tokens).alias("_t")), key).where(F.size(F.array_except("w", "_t")) == 0).select(query, key)


def near_tokens(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct tokens one edit apart, without comparing all with all.

    Two such tokens share the token itself or one with a letter left out; the
    equi-join is on these. ``left`` and ``right`` have one column ``token``.
    """

    def keys(df: DataFrame, name: str) -> DataFrame:
        cuts = F.transform(F.sequence(F.lit(1), F.greatest(F.length("token"), F.lit(1))), lambda i: F.concat(F.substring("token", F.lit(1), i - 1), F.substring("token", i + 1, F.length("token"))))
        return df.select("token").distinct().select(F.col("token").alias(name), F.explode(F.array_distinct(F.array_append(cuts, F.col("token")))).alias("k"))

    pairs = keys(left, "a").join(keys(right, "b"), "k").where("a <> b").select("a", "b").distinct()
    return pairs.where(F.levenshtein("a", "b") == 1)

"""Writing found passages back into the text, and rolling matches up.

Defined results: only accepted matches are written; only segments where a
match starts get a text; of two matches with one start the later in order
wins; a match that starts inside another is written too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.config import Config
from spanloom.functions import scores
from spanloom.operators.words import word_rows


def rendering(cfg: Config, quoted: Column, full: Column, group: Column, item: Column) -> Column:
    """The marked passage with its [group:item]; the full passage where nothing quoted is known."""
    text = F.coalesce(F.nullif(quoted, F.lit("")), full) if cfg.replace_with == "quoted" else full
    return F.concat(F.lit(cfg.open_mark), F.coalesce(text, F.lit("")), F.lit(cfg.close_mark), F.lit(" ["), scores.label(group, item, F.lit(None)), F.lit("]"))


def rewrite(arrays: DataFrame, matches: DataFrame) -> DataFrame:
    """doc, seg_id, enriched_text. ``matches`` has doc, word_start, word_end, ord, status and put (the text written)."""
    m = matches.where("status = 'accepted' AND word_start <= word_end").select("doc", "word_start", "word_end", "ord", "put")
    starts = m.groupBy("doc", F.col("word_start").alias("g")).agg(F.max_by("put", "ord").alias("put"))
    covered = m.select("doc", F.explode(F.sequence("word_start", "word_end")).alias("g")).distinct().withColumn("inside", F.lit(True))
    marks = covered.join(starts, ["doc", "g"], "left")
    w = word_rows(arrays).select("doc", "g", "raw", "seg_id").join(marks, ["doc", "g"], "left")
    part = F.when(F.col("put").isNotNull(), F.trim("put")).when(F.col("inside").isNull(), F.col("raw"))
    per = w.groupBy("doc", "seg_id").agg(F.array_sort(F.collect_list(F.struct("g", part.alias("x")))).alias("a"), F.max(F.col("put").isNotNull()).alias("touched"))
    texts = F.filter(F.transform("a", lambda e: e["x"]), lambda x: x.isNotNull() & (x != ""))
    return per.where("touched").select("doc", "seg_id", F.array_join(texts, " ").alias("enriched_text"))


def rollup(matches: DataFrame, key: str, cross: str) -> DataFrame:
    """Per document: total_matches, accepted, review, cross."""
    return matches.groupBy(key).agg(
        F.count("*").alias("total_matches"), F.count_if(F.col("status") == "accepted").alias("accepted"), F.count_if(F.col("status") == "review").alias("review"), F.count_if(F.coalesce(F.col(cross), F.lit(False))).alias("cross_group")
    )


def run_stats(rollups: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """One row over all documents; ``errors`` has doc and error."""
    s = rollups.agg(F.count("*").alias("ok"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total_matches", "accepted", "review", "cross_group")])
    failed = F.lit(0).cast("bigint") if errors is None else errors.agg(F.count("*")).scalar()
    return s.select((F.col("ok") + failed).alias("documents"), "ok", failed.alias("failed"), "total_matches", "accepted", "review", "cross_group")

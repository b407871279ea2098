"""The text fields the queries work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.sources.tables import table


def segments(spark: SparkSession, d: str) -> DataFrame:
    """field_name, transcript_id, item_id, text, language of all segments."""
    s = table(spark, d, "transcripts").select("transcript_id", "language", F.explode(F.arrays_zip(F.col("segments.id").alias("id"), F.col("segments.text").alias("text"))).alias("s"))
    return s.select(F.lit("segment_text").alias("field_name"), "transcript_id", F.col("s.id").cast("long").alias("item_id"), F.col("s.text").alias("text"), "language")


def match_texts(spark: SparkSession, d: str, *fields: str) -> DataFrame:
    """The same of text fields of the matches, in one scan."""
    m = table(spark, d, "verified_matches")
    f = F.explode(F.array(*[F.struct(F.lit(n).alias("field_name"), F.col(n).alias("text")) for n in fields])).alias("f")
    return m.select("transcript_id", F.col("match_id").cast("long").alias("item_id"), f).select("f.field_name", "transcript_id", "item_id", "f.text", F.lit(None).cast("string").alias("language"))


def all_passages(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).unionByName(match_texts(spark, d, "transcript_text", "canonical_quoted"))

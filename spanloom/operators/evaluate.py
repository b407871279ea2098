"""Precision, recall and F1 against an annotated sheet, and drawing the sheet.

Defined results: a zero denominator gives 0; keys count once; blank items are
left out of the truth.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def truth_and_negatives(sheet: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys (episode, surah, ayah) annotated as right, and as wrong."""
    s = sheet.where(F.col("ayah").isNotNull()).select(F.trim("episode").alias("episode"), F.trim("surah").alias("surah"), "ayah", F.trim("VERDICT").alias("v"))
    return s.where("v = '1'").drop("v").distinct(), s.where("v = '0'").drop("v").distinct()


def prf(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """One row: tp, fp, fn, precision, recall, f1 of two sets of keys."""
    cols = truth.columns
    t = truth.distinct().withColumn("_t", F.lit(1))
    p = predicted.select(*cols).distinct().withColumn("_p", F.lit(1))
    both = t.unionByName(p, allowMissingColumns=True).groupBy(*cols).agg(F.max("_t").alias("t"), F.max("_p").alias("p"))
    n = both.agg(F.count_if(F.col("t").isNotNull() & F.col("p").isNotNull()).alias("tp"), F.count_if(F.col("t").isNull()).alias("fp"), F.count_if(F.col("p").isNull()).alias("fn"))

    def part(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / F.when(b > 0, b)).otherwise(F.lit(0.0))

    n = n.withColumn("precision", part(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", part(F.col("tp"), F.col("tp") + F.col("fn")))
    return n.withColumn("f1", part(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def misses(truth: DataFrame, predicted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """False positives and false negatives."""
    return predicted.select(*truth.columns).distinct().join(truth.distinct(), truth.columns, "left_anti"), truth.distinct().join(predicted.select(*truth.columns).distinct(), truth.columns, "left_anti")


def round_robin(df: DataFrame, stratum: str, order: Sequence[Column], n: int) -> DataFrame:
    """``n`` rows, one of each stratum per round, in an order that stands for chance.

    Only the first ``n`` of a stratum can be drawn; Spark's group limit drops
    the rest before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy(*order))
    return df.withColumn("round", rank).where(F.col("round") <= n).orderBy("round", F.md5(F.coalesce(F.col(stratum), F.lit(""))), stratum).limit(n)

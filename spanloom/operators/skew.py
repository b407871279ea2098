"""Per-key results where a handful of keys hold most of the rows.

Value-frequency compression: rows are first grouped by (key, value), which
partial aggregation shrinks before the shuffle and hashing spreads over all
tasks however hot the key; the per-key result is then derived from weighted
values. Nothing is sampled.

Defined results: null values count in ``n_rows`` but not as values; a null key
is a key of its own; an empty input has no keys; ties of the mode go to the
smallest value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.sources.tables import cut


def compress(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per (key, value) with its weight: columns k0.., value, weight."""
    k = [F.col(c).alias(f"k{i}") for i, c in enumerate(keys)]
    return df.select(*k, F.col(value).alias("value")).groupBy(*[f"k{i}" for i in range(len(keys))], "value").agg(F.count("*").alias("weight"))


def distinct_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Columns ``keys``, n_rows, n_distinct."""
    k = [f"k{i}" for i in range(len(keys))]
    out = compress(df, keys, value).groupBy(*k).agg(F.sum("weight").alias("n_rows"), F.count("value").alias("n_distinct"))
    return out.select(*[F.col(n).alias(c) for n, c in zip(k, keys)], "n_rows", "n_distinct")


def profile(df: DataFrame, keys: Sequence[str], value: str, at: float = 0.5) -> DataFrame:
    """Columns ``keys``, n_rows, n_values, n_distinct, mode, mode_rows, low, high, quantile.

    ``quantile`` is the smallest value whose cumulative weight reaches
    ``at`` x the weight of all non-null values. To find it in a hot key
    without sorting the key in one task, the weighted values are
    range-partitioned by (key, value), whose bounds are quantiles of the rows
    themselves, so outliers do no harm; a key's sums per partition tell which
    one holds the rank, and only that one's part of the key is ordered.
    """
    k = [f"k{i}" for i in range(len(keys))]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written once, as the number of a row's partition must be the same for both readers.
    c = cut(compress(df, keys, value).repartitionByRange(n, *k, "value").withColumn("_p", F.spark_partition_id()))
    mode = F.max_by(F.struct("value", "weight"), F.struct(F.when(F.col("value").isNotNull(), F.col("weight")).alias("w"), (-F.col("value").cast("double")).alias("v")))
    real = F.when(F.col("value").isNotNull(), F.col("weight")).otherwise(0)
    parts = c.groupBy(*k, "_p").agg(F.sum("weight").alias("rows"), F.sum(real).alias("w"), F.count("value").alias("d"), mode.alias("m"), F.min("value").alias("low"), F.max("value").alias("high"))
    best = F.max_by("m", F.struct(F.when(F.col("m.value").isNotNull(), F.col("m.weight")).alias("w"), (-F.col("m.value").cast("double")).alias("v")))
    totals = parts.groupBy(*k).agg(F.sum("rows").alias("n_rows"), F.sum("w").alias("n_values"), F.sum("d").alias("n_distinct"), best.alias("m"), F.min("low").alias("low"), F.max("high").alias("high"))
    upto = Window.partitionBy(*k).orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    holds = parts.withColumn("to", F.sum("w").over(upto)).withColumn("target", F.greatest(F.ceil(F.sum("w").over(Window.partitionBy(*k)) * F.lit(float(at))), F.lit(1)))
    holds = holds.where((F.col("to") >= F.col("target")) & (F.col("to") - F.col("w") < F.col("target"))).select(*k, "_p", (F.col("to") - F.col("w")).alias("before"), "target")
    inside = Window.partitionBy(*[f"p.{x}" for x in k]).orderBy("p.value").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        c.where("value IS NOT NULL").alias("p")
        .join(holds.alias("h"), [F.col(f"p.{x}").eqNullSafe(F.col(f"h.{x}")) for x in k] + [F.col("p._p") == F.col("h._p")])
        .withColumn("reach", F.col("h.before") + F.sum("p.weight").over(inside))
        .where(F.col("reach") >= F.col("target"))
        .groupBy(*[F.col(f"p.{x}").alias(x) for x in k])
        .agg(F.min("p.value").alias("quantile"))
    )
    out = totals.alias("t").join(found.alias("f"), [F.col(f"t.{x}").eqNullSafe(F.col(f"f.{x}")) for x in k], "left")
    return out.select(*[F.col(f"t.{x}").alias(y) for x, y in zip(k, keys)], "n_rows", "n_values", "n_distinct",
                      F.when(F.col("n_values") > 0, F.col("m.value")).alias("mode"), F.when(F.col("n_values") > 0, F.col("m.weight")).alias("mode_rows"), "low", "high", "quantile")

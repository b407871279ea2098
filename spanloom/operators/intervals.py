"""Continuous coverage and gaps of overlapping intervals, per entity.

Two levels. Intervals are clipped into shards of fixed width, merged inside
each shard, and only what touches a shard boundary is stitched per entity.

Bounds that keep every task small whatever the skew and however far apart the
coordinates are:

* coordinates are whole numbers and equal starts are reduced to their largest
  end before anything is sorted, so a shard holds at most ``width + 2`` rows;
* there are no outermost shards: a shard is any whole number;
* an interval over many shards is two clips and one bridge between them, never
  a row per shard; a bridge reaches only the shards that hold something;
* the stitching step sees at most four rows per (entity, non-empty shard), and
  one per shard where bridges begin.

Defined results for odd input: intervals with a null or NaN bound, or with
lo > hi, are left out; a null entity key is an entity of its own; repeated
rows change nothing; a point (lo = hi) is an interval; an empty input gives an
empty output. Only the named columns are read, so other columns may have any
name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def whole(col: Column, scale: float = 1.0) -> Column:
    """A double as a whole number after scaling; null where it is not finite or beyond the whole numbers of 64 bits."""
    x = col.cast("double") * F.lit(float(scale))
    return F.when(F.abs(x) < F.lit(9.2e18), F.round(x).cast("long"))


def merge_intervals(intervals: DataFrame, keys: Sequence[str], lo: str, hi: str, width: int | Column = 60_000) -> DataFrame:
    """Columns ``keys``, kind ('period' or 'gap'), lo, hi.

    Closed intervals that share a point belong to one period; a gap runs from
    the end of a period to the start of the next. For integer positions where
    neighbours touch, pass hi + 1 and take the 1 off again (see
    :func:`merge_positions`). ``width`` is that of a shard; a column of it must
    be a function of the keys.
    """
    k = [f"k{i}" for i in range(len(keys))]
    size = F.lit(width) if isinstance(width, int) else width
    base = intervals.select(
        *[F.col(c).alias(n) for c, n in zip(keys, k)], F.col(lo).cast("long").alias("lo"), F.col(hi).cast("long").alias("hi"), size.cast("long").alias("w")
    ).where("lo <= hi")
    k = [*k, "w"]
    # whole-number division that rounds down, also below zero
    base = base.withColumn("s_lo", F.expr("lo div w - if(lo % w < 0, 1, 0)")).withColumn("s_hi", F.expr("hi div w - if(hi % w < 0, 1, 0)"))

    def start(s: Column) -> Column:
        return F.coalesce(F.try_multiply(s, F.col("w")), F.when(s < 0, F.lit(-(2**63))).otherwise(F.lit(2**63 - 1)))

    def end(s: Column) -> Column:
        return start(s + 1)

    head = F.struct(F.col("s_lo").alias("shard"), F.col("lo").alias("lo"), F.when(F.col("s_lo") == F.col("s_hi"), F.col("hi")).otherwise(end(F.col("s_lo"))).alias("hi"))
    tail = F.struct(F.col("s_hi").alias("shard"), start(F.col("s_hi")).alias("lo"), F.col("hi").alias("hi"))
    clips = base.select(*k, F.explode(F.when(F.col("s_lo") == F.col("s_hi"), F.array(head)).otherwise(F.array(head, tail))).alias("c")).select(*k, "c.*")

    # Bridges: the shards between the two clips of an interval, all of them covered whole. Of equal starts the longest.
    bridges = base.where("s_hi - s_lo > 1").groupBy(*k, (F.col("s_lo") + 1).alias("shard")).agg(F.max(F.col("s_hi") - 1).alias("upto"))
    # The shards with clips that some bridge covers are covered whole too.
    met = clips.select(*k, "shard", F.lit(None).cast("long").alias("upto")).distinct().unionByName(bridges)
    reach = F.max("upto").over(Window.partitionBy(*k).orderBy("shard").rangeBetween(Window.unboundedPreceding, 0))
    covered = met.withColumn("reach", reach).where(F.col("upto").isNull() & (F.col("reach") >= F.col("shard")))
    covered = covered.select(*k, "shard", start(F.col("shard")).alias("lo"), end(F.col("shard")).alias("hi"))

    # One row per start, by partial aggregation; then the union inside each shard.
    thin = clips.unionByName(covered).groupBy(*k, "shard", "lo").agg(F.max("hi").alias("hi"))
    in_shard = Window.partitionBy(*k, "shard").orderBy("lo")
    fresh = F.col("lo") > F.max("hi").over(in_shard.rowsBetween(Window.unboundedPreceding, -1))
    local = (
        thin.withColumn("fresh", F.coalesce(fresh, F.lit(True)).cast("int"))
        .withColumn("piece", F.sum("fresh").over(in_shard.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*k, "shard", "piece")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .withColumn("next_lo", F.lead("lo").over(in_shard))
        .withColumn("first", F.row_number().over(in_shard) == 1)
        .withColumn("inner", (F.col("lo") != start(F.col("shard"))) & (F.col("hi") != end(F.col("shard"))))
    )
    span = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.alias("lo"), b.alias("hi"))
    # In the shard: pieces away from its boundaries are periods, and what lies between two pieces is a gap.
    done = local.select(*k, F.explode(F.array_compact(F.array(
        F.when(F.col("inner"), span("period", F.col("lo"), F.col("hi"))),
        F.when(F.col("next_lo").isNotNull(), span("gap", F.col("hi"), F.col("next_lo"))),
    ))).alias("r")).select(*k, "r.*")
    # For the second level: pieces at a boundary, and where the shard's coverage opens and closes.
    ends = local.select(*k, F.explode(F.array_compact(F.array(
        F.when(~F.col("inner"), span("piece", F.col("lo"), F.col("hi"))),
        F.when(F.col("first"), span("open", F.col("lo"), F.col("lo"))),
        F.when(F.col("next_lo").isNull(), span("shut", F.col("hi"), F.col("hi"))),
    ))).alias("r")).select(*k, "r.*")
    ends = ends.unionByName(bridges.select(*k, F.lit("piece").alias("kind"), start(F.col("shard")).alias("lo"), end(F.col("upto")).alias("hi")))

    # At a place, what opens comes first: what reached it from a shard before has a piece that begins earlier. A gap ends where coverage opens beyond all that came before.
    along = Window.partitionBy(*k).orderBy("lo", "kind", "hi")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    edge = F.col("kind") == "piece"
    stitched = (
        ends.withColumn("seen", F.max("hi").over(before))
        .withColumn("met", F.max(F.when(edge, F.col("hi"))).over(before))
        .withColumn("is_gap", (F.col("kind") == "open") & F.coalesce(F.col("lo") > F.col("seen"), F.lit(False)))
        .withColumn("fresh", (F.col("is_gap") | (edge & F.coalesce(F.col("lo") > F.col("met"), F.lit(True)))).cast("int"))
        .withColumn("run", F.sum("fresh").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*k, "run")
        .agg(F.min(F.when(edge, F.col("lo"))).alias("p_lo"), F.max(F.when(edge, F.col("hi"))).alias("p_hi"), F.max(F.when(F.col("is_gap"), F.col("seen"))).alias("g_lo"), F.max(F.when(F.col("is_gap"), F.col("lo"))).alias("g_hi"))
    )
    stitched = stitched.select(*k, F.explode(F.array_compact(F.array(
        F.when(F.col("p_lo").isNotNull(), span("period", F.col("p_lo"), F.col("p_hi"))),
        F.when(F.col("g_lo").isNotNull(), span("gap", F.col("g_lo"), F.col("g_hi"))),
    ))).alias("r")).select(*k, "r.*")
    return done.unionByName(stitched).select(*[F.col(n).alias(c) for c, n in zip(keys, k)], "kind", "lo", "hi")


def merge_positions(intervals: DataFrame, keys: Sequence[str], lo: str, hi: str, discrete: str, width: int | Column = 60_000) -> DataFrame:
    """As :func:`merge_intervals`, where rows with the boolean column ``discrete`` hold inclusive positions.

    Neighbouring positions then touch, and a gap runs from the first to the
    last position in it. ``discrete`` must be a function of the keys and comes
    back as a column.
    """
    at = intervals.withColumn("_hi", F.col(hi) + F.col(discrete).cast("int"))
    out = merge_intervals(at.where(F.col(lo) <= F.col(hi)), [*keys, discrete], lo, "_hi", width)
    return out.withColumn("hi", F.col("hi") - F.col(discrete).cast("int"))

"""Resumable state of work: the latest event of a key is its state.

Defined results: events with a null key or time are left out; ties in time go
to the larger sequence number; a failed key is pending again; a change of a key
that was never registered raises.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.sources.tables import cut


def state(events: DataFrame, key: str, status: str, ts: str, seq: str) -> DataFrame:
    """key, status, at: by partial aggregation, so a key with a third of all events is no burden."""
    e = events.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    return e.groupBy(F.col(key).alias("key")).agg(F.max_by(status, F.struct(ts, seq)).alias("status"), F.max(ts).alias("at"))


COLUMNS = {"key": "string", "status": "string", "output_path": "string", "error": "string", "at": "string"}


def _filled(df: DataFrame, current: DataFrame) -> DataFrame:
    """``df`` with the columns of ``current``; those it lacks are null."""
    types = dict(current.dtypes)
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in current.columns])


def register(current: DataFrame, keys: DataFrame) -> DataFrame:
    """``current`` with the rows of ``keys`` whose key it lacks as pending."""
    new = keys.dropDuplicates(["key"]).join(current.select("key"), "key", "left_anti").withColumn("status", F.lit("pending"))
    return current.unionByName(_filled(new, current))


def apply(current: DataFrame, changes: DataFrame) -> DataFrame:
    """``current`` with the status changes (key, status, at, and error where known) put in; a key it does not have raises."""
    named = [c for c in ("status", "error", "at") if c in changes.columns and c in current.columns]
    c = changes.groupBy("key").agg(F.max_by(F.struct(*named), "at").alias("_new"))
    here = current.withColumn("_known", F.lit(True)).join(c, "key", "full")
    unknown = F.raise_error(F.concat(F.lit("not registered: "), F.col("key").cast("string")))
    changed = F.when(F.col("_known").isNull(), unknown.cast("boolean")).otherwise(F.col("_new").isNotNull())
    here = here.withColumn("_changed", changed)
    return here.select(*[(F.when(F.col("_changed"), F.col("_new")[n]).otherwise(F.col(n)) if n in named else F.col(n)).alias(n) for n in current.columns])


def counts(current: DataFrame) -> DataFrame:
    done, failed = F.count_if(F.col("status") == "done"), F.count_if(F.col("status") == "failed")
    return current.agg(F.count("*").alias("total"), done.alias("done"), failed.alias("failed"), (F.count("*") - done - failed).alias("pending"))


def pending(work: DataFrame, key: str, current: DataFrame) -> DataFrame:
    """The work whose key is not done."""
    return work.join(current.where("status = 'done'").select(F.col("key").alias(key)), key, "left_anti")


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Adds ``name``, the place of each row in the order given, from 1.

    Rows are range-partitioned and numbered in their partition, and the
    partitions' counts give the offsets, so no task holds all rows.
    """
    n = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    # Written once, as the number of a row's partition must be the same for both readers.
    ranged = cut(df.repartitionByRange(int(n), *order).withColumn("_p", F.spark_partition_id()))
    ranged = ranged.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    before = ranged.groupBy("_p").agg(F.count("*").alias("_n")).withColumn("_b", F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).drop("_n")
    return ranged.join(before, "_p").withColumn(name, F.col("_b") + F.col("_r")).drop("_p", "_r", "_b")


def batches(df: DataFrame, order: str, size: int) -> DataFrame:
    """Adds batch_no from 1: ``size`` rows each in the order given."""
    return numbered(df, [order], "_at").withColumn("batch_no", F.floor((F.col("_at") - 1) / size).cast("int") + 1).drop("_at")


def reconcile(current: DataFrame, outputs: DataFrame) -> DataFrame:
    """Keys whose output exists are done."""
    here = outputs.select("key").distinct().withColumn("_here", F.lit(True))
    status = F.when(F.col("_here"), "done").otherwise(F.col("status"))
    return current.join(here, "key", "left").select(*[(status if c == "status" else F.col(c)).alias(c) for c in current.columns])

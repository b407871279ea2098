"""Reading tables, and cutting lineage on storage that outlives an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from spanloom.sources.package import ship


def table(spark: SparkSession, sf_dir: str, name: str, ddl: str | None = None) -> DataFrame:
    """A table; with ``ddl`` only the columns and nested fields named there are read."""
    ship(spark)
    reader = spark.read if ddl is None else spark.read.schema(ddl)
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``.

    Where none is named, a local session gets a temporary folder; on several
    machines executors could not share one, so there it is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spanloom-ckpt-"))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the checkpoint folder and go on from there; later steps read only the columns they use.

    The folder is the cluster's, and so is clearing it: a lost executor reads the table again.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt_out(df: DataFrame, key: str) -> DataFrame:
    """``df`` over all cores where it comes in fewer pieces than there are, else as it is.

    A table in a few small files is read by a few tasks only; before costly
    work per row its rows are hashed over the cores. A large table comes in
    more pieces than cores and is not shuffled.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n, key) if df.rdd.getNumPartitions() < n else df

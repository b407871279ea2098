"""The pipeline over files as they arrive, and windowed rates of events.

Runs are resumable: Structured Streaming's checkpoint remembers the files that
were done, and a run takes what is new and ends (AvailableNow).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.config import Config
from spanloom.plans import pipeline
from spanloom.sources.tables import dealt_out, ensure_checkpoint_dir


def enrich_new(docs: DataFrame, verses: DataFrame, out: str, state: str, key: str = "transcript_id", primary: str = "surah_order", cfg: Config = Config()) -> None:
    """The new documents of the stream ``docs`` through the whole pipeline: matches, texts and roll-ups below ``out``.

    A batch that is repeated replaces its own rows.
    """

    def write(batch: DataFrame, number: int) -> None:
        e = pipeline.enrich(dealt_out(batch, key), verses, key, primary, cfg)
        for name, rows in (("matches", e.matches), ("texts", e.texts), ("rollups", e.rollups)):
            rows.write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")

    docs.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def table_stream(spark: SparkSession, path: str, ddl: str, files: int = 50) -> DataFrame:
    """A stream of the files of a parquet table that is a folder or a single file."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    r = spark.readStream.schema(ddl).format("parquet").option("maxFilesPerTrigger", files)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        return r.load(path)
    return r.option("pathGlobFilter", p.getName()).load(str(p.getParent()))


def work_folder(spark: SparkSession) -> str:
    """A new folder for a stream's state and output, in the checkpoint folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"


def windowed_counts(events: DataFrame, ts: str, kind: str, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events of each kind per window of event time; late rows count until the watermark passes."""
    w = events.withWatermark(ts, late).groupBy(F.window(ts, width), kind).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("window.start").alias("window_start"), kind, "n", "total")


def run_windowed(events: DataFrame, out: str, state: str, **how: str) -> None:
    """:func:`windowed_counts` over the stream ``events`` until all are read, as the changes of each batch below ``out``.

    Update mode: a batch writes only the windows that it changed, and the state
    of a window is dropped when the watermark has passed it. Read with
    :func:`latest`.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    q = windowed_counts(events, "ts", "event_type", **how).writeStream.outputMode("update").foreachBatch(write)
    q.option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def latest(changes: DataFrame, key: Sequence[str] = ("window_start", "event_type")) -> DataFrame:
    """Of the changes that batches wrote, the last of each key."""
    rest = [c for c in changes.columns if c not in (*key, "batch")]
    return changes.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("x")).select(*key, "x.*")

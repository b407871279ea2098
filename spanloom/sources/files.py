"""Readers and writers of the formats around the pipeline.

A missing folder or file raises; an empty corpus raises. Malformed JSON
documents come back with their text in ``_corrupt_record`` instead of ending
the run (``strict`` raises instead). Paths may be on any file system that
Hadoop knows; files written one by one go through pyarrow's file systems.
"""

from __future__ import annotations

import shutil
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.operators import catalog, corpus
from spanloom.operators.manifest import COLUMNS as STATE
from spanloom.sources.package import ship


def listing(spark: SparkSession, folder: str, recursive: bool = False, glob: str | None = None) -> DataFrame:
    """path of the files in a folder, in order; their contents are not read. Files without a byte are left out."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(folder).select("path").orderBy("path")


def videos(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Parsed and unmatched video files of one folder."""
    files = listing(spark, folder).where(F.col("path").rlike(catalog.VIDEO))
    return catalog.route(catalog.parse(files, "path"))


def corpus_xml(spark: SparkSession, path: str) -> DataFrame:
    """The corpus of an XML file of sura/aya elements, numbered from 1."""
    x = spark.read.format("xml").option("rowTag", "sura").schema(schema.CORPUS_XML).load(path)
    rows = x.select(F.col("_index").alias("group_no"), F.col("_name").alias("group_name"), F.explode("aya").alias("a")).select("group_no", "group_name", F.col("a._index").alias("item_no"), F.col("a._text").alias("text"))
    return corpus.number(rows)


def _hadoop(spark: SparkSession, path: str):
    """The path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop(spark, path)
    return fs.getFileStatus(p).isDirectory()


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as it stands in front of the files' own paths."""
    p, fs = _hadoop(spark, path)
    return fs.makeQualified(p).toUri().toString().rstrip("/")


def locate(spark: SparkSession, path: str, *fallbacks: str) -> str:
    """The first of the paths that exists."""
    for p in (path, *fallbacks):
        if exists(spark, p):
            return p
    raise FileNotFoundError(path)


def copy_if_missing(spark: SparkSession, source: str, to: str) -> None:
    if not exists(spark, to):
        (a, from_fs), (b, to_fs) = _hadoop(spark, source), _hadoop(spark, to)
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(from_fs, a, to_fs, b, False, spark._jsc.hadoopConfiguration())


def corpus_jsonl(spark: SparkSession, path: str) -> DataFrame:
    out = spark.read.schema(schema.VERSE).json(path)
    if out.isEmpty():
        raise ValueError(f"no passages in {path}")
    return out


def documents(spark: SparkSession, path: str, ddl: str, glob: str = "*.json", strict: bool = False) -> DataFrame:
    """One row per JSON document below a folder, with its path; bad ones have ``_corrupt_record``.

    A file is one document over any number of lines, or holds one document a
    line. A row is a whole file before it is parsed, so tables of many
    documents are better read as JSON lines (``spark.read.json``).
    """
    mode = {"mode": "FAILFAST"} if strict else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    kept = ddl if strict else ddl + ", _corrupt_record string"
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    files = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("_v"))
    lines = F.filter(F.split("_v", r"\r?\n"), lambda x: F.trim(x) != "")
    # Several lines that are all complete JSON values are documents of their own.
    several = (F.size(lines) > 1) & F.forall(lines, lambda x: F.get_json_object(x, "$").isNotNull())
    parts = files.select("path", F.explode(F.when(several, lines).otherwise(F.array("_v"))).alias("_t"))
    return parts.select("path", F.from_json("_t", kept, mode).alias("_d")).select("_d.*", "path")


def transcripts(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    return documents(spark, path, schema.TRANSCRIPT, strict=strict)


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema(schema.CATALOGUE).json(path).select(F.explode("videos").alias("v")).select("v.*")


def orders(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema(schema.ORDERS).json(path).select(F.explode("surahs").alias("s")).select("s.name", "s.order")


def gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema.GOLD, multiLine=True, escape='"')


def decoded(path: Column) -> Column:
    """A file's path as it is written, without percent signs for its letters."""
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def episode_key(path: Column) -> Column:
    """folder/file of a document's path."""
    return F.regexp_extract(decoded(path), r"([^/]+/[^/]+)$", 1)


def below(path: Column, root: str) -> Column:
    """The path below ``root``; folder/file where it is not below it."""
    p = decoded(path)
    return F.when(F.startswith(p, F.lit(root + "/")), F.substring(p, F.lit(len(root) + 2), F.length(p))).otherwise(episode_key(path))


def predictions(spark: SparkSession, path: str, episodes: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Keys (episode, surah, ayah) of the matches of the named episodes' enriched documents, which mirror the transcripts' folders."""
    d = documents(spark, path, schema.ENRICHED).withColumn("episode_path", episode_key(F.col("path")))
    d = d.join(episodes.select(F.col("episode").alias("episode_path")).distinct(), "episode_path", "left_semi")
    m = d.select("episode_path", F.explode("matches").alias("m")).where(F.col("m.status").isin(*statuses))
    return m.select(F.col("episode_path").alias("episode"), F.col("m.surah").alias("surah"), F.col("m.ayah").alias("ayah")).distinct()


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """key, status, output_path, error, at: the latest state saved at ``path``, or a JSON manifest file; empty where there is none yet."""
    names = list(STATE)
    if not exists(spark, path):
        return spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in STATE.items()))
    if is_folder(spark, path):
        p, fs = _hadoop(spark, path)
        saved = [f.getPath() for f in fs.listStatus(p) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
        last = max(saved, key=lambda x: int(x.getName()), default=None)
        if last is not None:
            return spark.read.parquet(last.toString())
    m = spark.read.option("multiLine", True).schema(schema.MANIFEST).json(path).select(F.explode("records").alias("key", "r"))
    return m.select("key", "r.status", "r.output_path", "r.error", F.col("r.processed_at").alias("at")).select(*names)


def save_manifest(current: DataFrame, path: str) -> DataFrame:
    """The state as a new table below ``path``; a run that ends in between leaves the one before. Returns what was saved."""
    spark = current.sparkSession
    p, fs = _hadoop(spark, path)
    number = 1 + max((int(f.getPath().getName()) for f in fs.listStatus(p)), default=0) if fs.exists(p) else 1
    current.write.mode("overwrite").parquet(f"{path}/{number}")
    return spark.read.parquet(f"{path}/{number}")


def utc_now() -> Column:
    """The time now in UTC, as ISO text."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def write_json(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).partitionBy(*by).json(path)


def write_mirrored(df: DataFrame, name: str, body: str, root: str) -> None:
    """One file per row at root/name, written by the tasks; root is a folder or URI that all of them share."""
    ship(df.sparkSession)
    uri = qualified(df.sparkSession, root)

    def put(rows: Iterator) -> None:
        from pyarrow import fs as pafs

        fs, base = pafs.FileSystem.from_uri(uri)
        for r in rows:
            to = f"{base}/{r[0]}"
            fs.create_dir(to.rsplit("/", 1)[0], recursive=True)
            with fs.open_output_stream(to) as f:
                f.write(r[1].encode("utf-8"))

    df.select(name, body).foreachPartition(put)


def write_gold_sheet(df: DataFrame, path: str) -> None:
    """The sheet with its two columns for the annotator left blank."""
    df.withColumn("VERDICT", F.lit("")).withColumn("NOTE", F.lit("")).write.mode("overwrite").csv(path, header=True, escape='"')


def fulltext_tables(passages: DataFrame, database: str) -> None:
    """A table of the passages and one of (token, verse_id, pos) for searching by terms."""
    passages.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    passages.write.mode("overwrite").saveAsTable(f"{database}.passages")
    passages.select("verse_id", F.posexplode("tokens").alias("pos", "token")).write.mode("overwrite").saveAsTable(f"{database}.postings")


#: What is left of the message of a failed program.
_TAIL_LINES = 5
# How sound is taken out of a video (16 kHz, one channel, 16 bit).
DECODER = ("ffmpeg", "-y", "-i", "{input}", "-vn", "-acodec", "pcm_s16le", "-ar", "16000", "-ac", "1", "{output}")


def command(template: Sequence[str]) -> Callable[[], Callable[[str, str], str]]:
    """A loader for :func:`run_model` that runs an external program per file; {input} and {output} stand for the two paths."""

    def load() -> Callable[[str, str], str]:
        import subprocess

        external_tool(template[0])

        def run(source: str, to: str) -> str:
            Path(to).parent.mkdir(parents=True, exist_ok=True)
            done = subprocess.run([t.format(input=source, output=to) for t in template], stdout=subprocess.DEVNULL, stderr=subprocess.PIPE, encoding="utf-8", errors="replace")
            if done.returncode:
                raise RuntimeError("\n".join(done.stderr.strip().splitlines()[-_TAIL_LINES:]))
            return to

        return run

    return load


def run_model(files: DataFrame, load: Callable[[], Callable[..., str]], columns: Sequence[str] = ("path",)) -> DataFrame:
    """path, body, error: ``columns`` (path first) through a model that is loaded once per task; a failing row gives its error and the run goes on.

    ``load`` returns a function from the columns' values to a text, such as a
    JSON body (a recognizer, a decoder, an external program).
    """
    ship(files.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        try:
            for b in batches:
                rows = []
                for values in zip(*(b[c] for c in columns)):
                    try:
                        rows.append((values[0], model(*values), None))
                    except Exception as e:  # noqa: BLE001 - one bad file must not end the run
                        rows.append((values[0], None, f"{type(e).__name__}: {e}"))
                yield pd.DataFrame(rows, columns=["path", "body", "error"])
        finally:
            if hasattr(model, "close"):
                model.close()

    return files.select(*columns).mapInPandas(run, "path string, body string, error string")


def external_tool(name: str) -> str:
    """Where an external program is; raises where it is not."""
    at = shutil.which(name)
    if at is None:
        raise RuntimeError(f"{name} is not installed")
    return at

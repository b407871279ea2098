"""Command line: python -m spanloom build | demo | enrich-file | enrich-all | catalogue | ingest | gold-sheet | evaluate.

Under spark-submit the session's own settings hold.
"""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.config import load_config
from spanloom.operators import catalog, corpus, evaluate, manifest
from spanloom.plans import pipeline
from spanloom.schema import SEGMENT
from spanloom.sources import files
from spanloom.sources.package import ship
from spanloom.sources.tables import cut


def _docs(spark: SparkSession, path: str):
    """Readable transcripts with a key and their name below the folder, and the unreadable ones with their error; the documents are parsed once."""
    d = cut(files.transcripts(spark, path))
    bad = d.where("_corrupt_record IS NOT NULL").select(F.col("path").alias("doc"), F.lit("not a JSON document").alias("error"))
    good = d.where("_corrupt_record IS NULL").drop("_corrupt_record").withColumn("name", files.below(F.col("path"), files.qualified(spark, path)))
    return good.withColumn("transcript_id", F.xxhash64("path", F.to_json(F.struct("surah", "episode")))), bad


def _settings(a: argparse.Namespace):
    return load_config(a.config) if a.config else load_config()


def build(spark: SparkSession, a: argparse.Namespace) -> None:
    c = files.corpus_xml(spark, files.locate(spark, a.xml, *a.fallback))
    files.write_json(c, a.out)
    if a.copy_xml:
        files.copy_if_missing(spark, a.xml, a.copy_xml)
    if a.database:
        files.fulltext_tables(corpus.passages(files.corpus_jsonl(spark, a.out)), a.database)
    print(f"{files.corpus_jsonl(spark, a.out).count()} passages -> {a.out}")


def demo(spark: SparkSession, a: argparse.Namespace) -> None:
    text = a.text
    docs = spark.createDataFrame([(0, a.group, [(0, 0.0, float(len(text.split())), text, 0.0, 0.0, None)])], f"transcript_id long, surah_order int, segments array<{SEGMENT}>")
    e = pipeline.enrich(docs, files.corpus_jsonl(spark, a.corpus), cfg=_settings(a))
    e.matches.select("status", "confidence", "surah", "ayah", "transcript_text", "canonical_quoted").show(truncate=False)
    e.texts.show(truncate=False)


def enrich_all(spark: SparkSession, a: argparse.Namespace) -> None:
    """documents/ mirrors the transcripts' folders, one JSON file each; matches/, run_stats/ and errors/ are tables."""
    began = time.time()
    docs, bad = _docs(spark, a.transcripts)
    if a.limit:
        docs = docs.orderBy("path").limit(a.limit)
    e = pipeline.enrich(docs, files.corpus_jsonl(spark, a.corpus), cfg=_settings(a))
    full = pipeline.enriched_documents(docs, e)
    if a.out == "-":
        for r in full.drop("doc").toJSON().toLocalIterator():
            print(r)
        return
    body = F.to_json(F.struct(*[c for c in full.columns if c != "doc"]), {"ignoreNullFields": "false"})
    files.write_mirrored(full.join(docs.select(F.col("transcript_id").alias("doc"), "name"), "doc").select("name", body.alias("body")), "name", "body", f"{a.out}/documents")
    files.write_json(pipeline.match_lines(e, docs), f"{a.out}/matches")
    stats = e.stats.first().asDict() | {"failed": bad.count(), "seconds": round(time.time() - began, 1)} | e.limits.first().asDict()
    files.write_json(spark.createDataFrame([(json.dumps(stats),)], "stats string"), f"{a.out}/run_stats")
    files.write_json(bad, f"{a.out}/errors")
    print(json.dumps(stats))


def gold_sheet(spark: SparkSession, a: argparse.Namespace) -> None:
    """A sheet of the matches of some transcripts, drawn in rounds over the groups, for an annotator to judge."""
    docs, _ = _docs(spark, a.transcripts)
    chance = [F.md5(F.concat(F.lit(f"{a.seed}:"), "name")), F.col("name")]
    docs = cut(evaluate.round_robin(docs, "surah", chance, a.sample).drop("round"))
    e = pipeline.enrich(docs, files.corpus_jsonl(spark, a.corpus), cfg=_settings(a))
    shown = ["accepted", "review"] if a.include_review else ["accepted"]
    rows = e.matches.where(F.col("status").isin(*shown)).join(docs.select(F.col("transcript_id").alias("doc"), files.episode_key(F.col("name")).alias("key"), "name"), "doc")
    rows = rows.orderBy("name", "word_start", "verse_id").select(F.when(F.col("key") != "", F.col("key")).otherwise(F.col("name")).alias("episode"), "surah", "ayah", "status", "confidence", "start", "end", "transcript_text", "canonical_quoted")
    files.write_gold_sheet(rows, a.out)
    print(f"{docs.count()} transcripts, {files.gold(spark, a.out).count()} matches -> {a.out}")


def _named(spark: SparkSession, a: argparse.Namespace):
    """Files with group, number and order, and the paths that are reported: without a pattern or without a known order."""
    good, bad = files.videos(spark, a.videos)
    named = catalog.with_order(good, "group", files.orders(spark, a.orders), "name", "order", F.col("is_intro"))
    return named, bad.select("path").unionByName(catalog.without_order(named).select("path"))


def catalogue(spark: SparkSession, a: argparse.Namespace) -> None:
    named, bad = _named(spark, a)
    files.write_json(named.orderBy("group_order", "number", "path"), f"{a.out}/metadata")
    files.write_json(catalog.statistics(named, "group", "group_order").orderBy("group_order"), f"{a.out}/statistics")
    files.write_json(bad, f"{a.out}/unmatched")
    todo = manifest.pending(named, "path", files.manifest(spark, a.manifest)) if a.manifest else named
    if a.dry_run:
        _show_pending(todo)
    else:
        numbered = manifest.batches(todo, "path", a.batch_size)
        files.write_json(numbered.orderBy("path").limit(a.limit) if a.limit else numbered, f"{a.out}/pending")


def _show_pending(todo: DataFrame) -> None:
    print(f"{todo.count()} pending")
    todo.orderBy("group_order", "number", "path").show(20, truncate=False)


def ingest(spark: SparkSession, a: argparse.Namespace) -> None:
    """Every pending file through an external program, in batches, the state saved after each; what has its output is not done again."""
    named, _ = _named(spark, a)
    to = catalog.output_path(a.out, F.col("group"), F.col("number"), catalog.stem(F.col("path")), a.extension)
    work = cut(named.withColumn("output_path", to))
    state = manifest.register(files.manifest(spark, a.manifest), work.select(F.col("path").alias("key"), "output_path"))
    if files.exists(spark, a.out):
        root = files.qualified(spark, a.out)
        done = files.listing(spark, a.out, recursive=True, glob=f"*.{a.extension}").select(F.concat(F.lit(a.out.rstrip("/") + "/"), files.below(F.col("path"), root)).alias("output_path"))
        state = manifest.reconcile(state, work.join(done, "output_path", "left_semi").select(F.col("path").alias("key")))
    state = files.save_manifest(state, a.manifest)
    todo = manifest.pending(work, "path", state)
    if a.dry_run:
        return _show_pending(todo)
    todo = todo.orderBy("group_order", "number", "path").limit(a.limit) if a.limit else todo
    todo = cut(manifest.batches(todo, "path", a.batch_size))
    for n in range(1, (todo.agg(F.max("batch_no")).first()[0] or 0) + 1):
        source = todo.where(F.col("batch_no") == n).select("path", F.regexp_replace(files.decoded(F.col("path")), "^file:/+", "/").alias("source"), "output_path")
        got = cut(files.run_model(source, _of_columns(files.command(a.command)), ("path", "source", "output_path")))
        changes = got.select(F.col("path").alias("key"), F.when(F.col("error").isNull(), "done").otherwise("failed").alias("status"), "error", files.utc_now().alias("at"))
        state = files.save_manifest(manifest.apply(state, changes), a.manifest)
    print(json.dumps(manifest.counts(state).first().asDict()))


def _of_columns(load):
    """The loader of a function of (source, target), called with (key, source, target)."""

    def loaded():
        run = load()
        return lambda _, source, to: run(source, to)

    return loaded


def evaluation(spark: SparkSession, a: argparse.Namespace) -> None:
    truth, wrong = evaluate.truth_and_negatives(files.gold(spark, files.locate(spark, a.gold)))
    found = cut(files.predictions(spark, a.documents, truth.unionByName(wrong), a.status))
    print(json.dumps(evaluate.prf(truth, found).first().asDict()))
    for name, rows in zip(("not in the truth", "missed"), evaluate.misses(truth, found)):
        print(name)
        rows.orderBy("episode", "surah", "ayah").show(a.show, truncate=False)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="spanloom")
    s = p.add_subparsers(dest="command", required=True)
    b = s.add_parser("build")
    b.add_argument("xml"), b.add_argument("out"), b.add_argument("--fallback", nargs="*", default=[]), b.add_argument("--copy-xml"), b.add_argument("--database")
    b.set_defaults(run=build)
    d = s.add_parser("demo")
    d.add_argument("corpus"), d.add_argument("text"), d.add_argument("--group", type=int, default=1), d.add_argument("--config")
    d.set_defaults(run=demo)
    for name in ("enrich-file", "enrich-all"):
        e = s.add_parser(name)
        e.add_argument("transcripts"), e.add_argument("corpus"), e.add_argument("out", nargs="?", default="-"), e.add_argument("--limit", type=int, default=0), e.add_argument("--config")
        e.set_defaults(run=enrich_all)
    c = s.add_parser("catalogue")
    c.add_argument("videos"), c.add_argument("orders"), c.add_argument("out"), c.add_argument("--manifest"), c.add_argument("--batch-size", type=int, default=100), c.add_argument("--limit", type=int, default=0), c.add_argument("--dry-run", action="store_true")
    c.set_defaults(run=catalogue)
    g = s.add_parser("gold-sheet")
    g.add_argument("transcripts"), g.add_argument("corpus"), g.add_argument("out"), g.add_argument("--sample", type=int, default=25), g.add_argument("--seed", type=int, default=7), g.add_argument("--include-review", action="store_true"), g.add_argument("--config")
    g.set_defaults(run=gold_sheet)
    i = s.add_parser("ingest")
    i.add_argument("videos"), i.add_argument("orders"), i.add_argument("out"), i.add_argument("--manifest", required=True), i.add_argument("--extension", default="wav"), i.add_argument("--batch-size", type=int, default=100), i.add_argument("--limit", type=int, default=0), i.add_argument("--dry-run", action="store_true"), i.add_argument("--command", nargs="+", default=list(files.DECODER))
    i.set_defaults(run=ingest)
    v = s.add_parser("evaluate")
    v.add_argument("gold"), v.add_argument("documents"), v.add_argument("--status", nargs="*", default=["accepted"]), v.add_argument("--show", type=int, default=20)
    v.set_defaults(run=evaluation)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("spanloom").getOrCreate()
    ship(spark)
    a.run(spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())

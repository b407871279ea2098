"""The whole quotation pipeline as one plan, and what it returns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.config import Config
from spanloom.functions import scores, textnorm
from spanloom.operators import align, corpus, decide, recover, rewrite, words
from spanloom.sources.tables import cut

MATCH_COLUMNS = (
    "doc", "surah", "surah_no", "ayah", "ayah_end", "verse_id", "canonical_text", "canonical_quoted", "confidence", "status", "start", "end",
    "word_start", "word_end", "transcript_text", "fuzz_score", "coverage", "is_cross_surah", "chain_id",
)


@dataclass
class Enriched:
    """matches (MATCH_COLUMNS), texts (doc, seg_id, enriched_text), rollups per document, stats (one row), limits (one row: what the bounds left out)."""

    arrays: DataFrame
    matches: DataFrame
    texts: DataFrame
    rollups: DataFrame
    stats: DataFrame
    limits: DataFrame


def finish(arrays: DataFrame, found: DataFrame, passages: DataFrame) -> DataFrame:
    """Spans with what the document and the passage say about them."""
    m = found.join(passages.drop("group_no"), "verse_id").join(arrays.select("doc", "words"), "doc")
    w = F.col("words")
    text = F.array_join(F.transform(F.slice("words", F.col("word_start") + 1, F.col("word_end") - F.col("word_start") + 1), lambda x: x["raw"]), " ")
    return m.select(
        "doc", F.col("group_name").alias("surah"), F.col("group_no").alias("surah_no"), F.col("item_no").alias("ayah"), "item_end", "verse_id", F.col("source").alias("canonical_text"),
        textnorm.fragment(F.col("source"), F.col("align"), F.col("verse_start"), F.col("verse_end")).alias("canonical_quoted"), "confidence", "status",
        F.get(w, F.col("word_start"))["start"].alias("start"), F.get(w, F.col("word_end"))["end"].alias("end"), "word_start", "word_end", text.alias("transcript_text"),
        scores.half_even(F.col("score"), 2).alias("fuzz_score"), scores.coverage(F.col("matched"), F.size("tokens")).alias("coverage"), F.col("cross_group").alias("is_cross_surah"), "chain_id",
    ).withColumnRenamed("item_end", "ayah_end").select(*MATCH_COLUMNS)


def enrich(docs: DataFrame, verses: DataFrame, key: str = "transcript_id", primary: str = "surah_order", cfg: Config = Config()) -> Enriched:
    """Find, verify, recover, chain and write back the passages that the documents quote.

    ``docs`` has the key, ``primary`` and segments; ``verses`` is a corpus
    table. The word arrays and the raw spans are written once, as several
    later steps read them.
    """
    arrays = cut(words.word_arrays(docs, key, rules=cfg.rules))
    own = docs.select(F.col(key).alias("doc"), F.col(primary).alias("primary_no"))
    passages = corpus.passages(verses)
    raw = cut(align.raw_matches(arrays, passages, cfg))
    verified = decide.decide(raw, passages, own, cfg)
    kept = verified.where("status <> 'rejected'").withColumn("cross_group", F.coalesce(F.col("group_no") != F.col("primary_no"), F.lit(True)))
    recovered = cut(recover.recover(arrays, kept, passages, cfg))
    found = recovered.join(passages.select("verse_id", "group_no", F.col("item_no").alias("item")), "verse_id")
    chained = recover.chain(found, "doc", "group_no", "item", "word_start", "word_end", "verse_id", cfg.max_gap_words, cfg.max_chain)
    if not cfg.keep_review:
        chained = chained.where("status = 'accepted'")
    matches = cut(finish(arrays, chained, passages))
    put = rewrite.rendering(cfg, F.col("canonical_quoted"), F.col("canonical_text"), F.col("surah"), F.col("ayah"))
    texts = rewrite.rewrite(arrays, matches.select("doc", "word_start", "word_end", F.col("verse_id").alias("ord"), "status", put.alias("put")))
    if not cfg.write_text:
        texts = texts.limit(0)
    rollups = own.select("doc").join(rewrite.rollup(matches, "doc", "is_cross_surah"), "doc", "left").na.fill(0)
    return Enriched(arrays, matches, texts, rollups, rewrite.run_stats(rollups), limits(passages, recovered, cfg))


def limits(passages: DataFrame, recovered: DataFrame, cfg: Config = Config()) -> DataFrame:
    """One row: pairs of words over ``bigram_df_cap`` and their places, passages left without a seed, and documents whose recovery ``max_pops`` ended.

    Both bounds are fixed values of the results; None for either is the exact run.
    """
    p = corpus.seed_cap(passages, cfg.bigram_df_cap)
    return p.withColumn("documents_cut_off", recovered.where("cut_off").agg(F.count_distinct("doc")).scalar())


def by_segment(arrays: DataFrame, matches: DataFrame) -> DataFrame:
    """``matches`` with seg_id, the segment in which each begins."""
    first = words.word_rows(arrays).select("doc", F.col("g").alias("word_start"), "seg_id")
    return matches.join(first, ["doc", "word_start"])


def enriched_documents(docs: DataFrame, e: Enriched, key: str = "transcript_id") -> DataFrame:
    """Nested documents: counts, matches, and segments with their matches and text."""
    names = [c for c in MATCH_COLUMNS if c != "doc"]
    m = by_segment(e.arrays, e.matches)
    order = F.struct("word_start", "verse_id", F.struct(*names).alias("m"))
    plain = lambda c: F.transform(F.array_sort(F.collect_list(c)), lambda x: x["m"])
    per_doc = m.groupBy("doc").agg(plain(order).alias("matches"))
    per_seg = m.groupBy("doc", "seg_id").agg(plain(order).alias("matches"))
    segs = docs.select(F.col(key).alias("doc"), F.posexplode(F.filter("segments", lambda s: s.isNotNull())).alias("at", "s")).select("doc", "at", F.coalesce("s.id", F.lit(0)).alias("seg_id"), "s.start", "s.end", "s.text")
    segs = segs.join(e.texts, ["doc", "seg_id"], "left").join(per_seg, ["doc", "seg_id"], "left")
    none = F.array().cast(dict(per_seg.dtypes)["matches"])
    seg = F.struct("at", F.struct(F.col("seg_id").alias("id"), F.coalesce("start", F.lit(0.0)).alias("start"), F.coalesce("end", F.lit(0.0)).alias("end"), F.coalesce("text", F.lit("")).alias("text"), "enriched_text", F.coalesce("matches", none).alias("matches")).alias("m"))
    segs = segs.groupBy("doc").agg(plain(seg).alias("segments"))
    head = docs.select(F.col(key).alias("doc"), "surah", "surah_order", "episode", F.col("source_audio").alias("source_transcript"))
    out = head.join(e.rollups, "doc").join(per_doc, "doc", "left").join(segs, "doc", "left")
    return out.select(F.lit("enrich-1.0").alias("schema_version"), "doc", "surah", "surah_order", "episode", "source_transcript", F.col("surah_order").alias("primary_surah_no"), "total_matches", "accepted", "review", F.col("cross_group").alias("cross_surah"), F.coalesce("matches", none).alias("matches"), "segments")


def match_lines(e: Enriched, docs: DataFrame, key: str = "transcript_id") -> DataFrame:
    """Flat match lines with the document's path and its own group.

    The path is the column ``name`` of ``docs``, or made of group and episode
    where there is none.
    """
    made = F.concat(F.coalesce("surah", F.lit("_")), F.lit("/ep_"), F.format_string("%03d", F.coalesce("episode", F.lit(0))), F.lit(".json"))
    path = F.col("name") if "name" in docs.columns else made
    d = docs.select(F.col(key).alias("doc"), path.alias("episode_path"), F.col("surah").alias("primary_surah"))
    return e.matches.join(d, "doc").select("episode_path", "primary_surah", "surah", "ayah", "ayah_end", "verse_id", "confidence", "status", "start", "end", "is_cross_surah", "transcript_text", "canonical_quoted")


def detect(docs: DataFrame, verses: DataFrame, cfg: Config = Config()) -> DataFrame:
    """The matches alone."""
    return enrich(docs, verses, cfg=cfg).matches

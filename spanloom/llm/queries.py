"""Queries of the training-text problems, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import bpe, langid, leak, lookalikes, repetition, spans, texts
from spanloom.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Runs of words that another transcript has verbatim, 16 words or more."""
    return spans.shared_spans(texts.all_passages(spark, d), "transcript_id", 16)


def p2_share(spark: SparkSession, d: str) -> DataFrame:
    """How many words of each text are shared, of how many, and the longest doubled length found elsewhere."""
    return spans.shared_share(texts.all_passages(spark, d), "transcript_id", 16)


def p3_measures(spark: SparkSession, d: str) -> DataFrame:
    """Fertility, byte share and entropy by two vocabularies against the bands of the language, and the share of repeated words, of every segment and transcript."""
    bands = repetition.table_bands(table(spark, d, "lang_samples"), "lang", "text")
    return repetition.measure(table(spark, d, "transcripts"), "transcript_id", "segments", language="language", bands=bands)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Segments and transcripts of at least 8 words, half of them repeated."""
    m = repetition.measure(table(spark, d, "transcripts"), "transcript_id", "segments", bounded=True)
    return m.where("exact AND n_words >= 8 AND 2 * n_repeated >= n_words").select("transcript_id", "segment_id")


def _looks(spark: SparkSession, d: str) -> DataFrame:
    """The four fields as field_name, record_id, segment_id, text, wider."""
    v = table(spark, d, "verses").select(F.col("verse_id").cast("long").alias("record_id"), F.explode(F.array(*[F.struct(F.lit(n).alias("field_name"), F.col(n).alias("text")) for n in ("text_uthmani", "text_norm")])).alias("f"))
    v = v.select("f.field_name", "record_id", F.lit(-1).alias("segment_id"), "f.text", F.lit(False).alias("wider"))
    s = texts.segments(spark, d).select("field_name", F.col("transcript_id").alias("record_id"), F.col("item_id").cast("int").alias("segment_id"), "text", F.col("language").isin("fa", "ur").alias("wider"))
    m = texts.match_texts(spark, d, "canonical_quoted").select("field_name", F.col("item_id").alias("record_id"), F.lit(-1).alias("segment_id"), "text", F.lit(False).alias("wider"))
    return v.unionByName(s).unionByName(m)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Texts that are not in their ordinary spelling."""
    return lookalikes.consistent(_looks(spark, d), ["field_name", "record_id", "segment_id"], "text", "wider", True, False).drop("odd")


def p5_forms(spark: SparkSession, d: str) -> DataFrame:
    """Those texts with their consistent form and skeleton."""
    return lookalikes.consistent(_looks(spark, d), ["field_name", "record_id", "segment_id"], "text", "wider", True, True).drop("odd")


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    """Different spellings that look the same."""
    return lookalikes.groups(_looks(spark, d), "text", "wider")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids of every document by byte_bpe_50k."""
    return bpe.encode(table(spark, d, "documents"), "doc_id", "text")


def p9_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Leaked items of each document with the longest verbatim match and its place."""
    return leak.leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text", 12)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with at least 12 consecutive words of an evaluation item."""
    return leak.leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text", 12).select("doc_id", "item_id")


def p9_clean(spark: SparkSession, d: str) -> DataFrame:
    """The documents that are left when the affected ones are removed."""
    return table(spark, d, "documents").join(p9_found(spark, d).select("doc_id"), "doc_id", "left_anti").select("doc_id", "source", "n_chars")


def p10_langs(spark: SparkSession, d: str) -> DataFrame:
    """Language and confidence of every document, and of the lines of mixed ones."""
    return langid.languages(table(spark, d, "documents"), "doc_id", "text", "lang", table(spark, d, "lang_samples"), "sample_id")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a missing or wrong label, and the lines of mixed documents."""
    return p10_langs(spark, d).where("line_no > 0 OR NOT agrees").select("doc_id", "line_no", "lang")


QUERIES: dict[str, Query] = {f.__name__: f for f in (p2_found, p2_share, p3_found, p3_measures, p5_found, p5_forms, p5_groups, p8_ids, p9_found, p9_leaks, p9_clean, p10_found, p10_langs)}

_P2_TEXTS = """
t AS (
  SELECT 'segment_text' AS field_name, transcript_id, CAST(s.id AS BIGINT) AS item_id, s.text AS text FROM (SELECT transcript_id, unnest(segments) AS s FROM transcripts)
  UNION ALL SELECT 'transcript_text', transcript_id, match_id, transcript_text FROM verified_matches
  UNION ALL SELECT 'canonical_quoted', transcript_id, match_id, canonical_quoted FROM verified_matches
),
w AS (SELECT field_name, transcript_id, item_id, list_filter(string_split(text, ' '), lambda x: x <> '') AS w FROM t)
"""
P2_SQL = f"""
WITH {_P2_TEXTS},
p AS (SELECT field_name, transcript_id, item_id, w, unnest(range(0, len(w) - 15)) AS pos FROM w WHERE len(w) >= 16),
k AS (SELECT field_name, transcript_id, item_id, pos, array_to_string(w[pos + 1 : pos + 16], ' ') AS k FROM p),
r AS (SELECT k FROM k GROUP BY k HAVING count(DISTINCT transcript_id) > 1),
h AS (SELECT field_name, transcript_id, item_id, pos, CASE WHEN pos > lag(pos) OVER (PARTITION BY field_name, transcript_id, item_id ORDER BY pos) + 16 THEN 1 ELSE 0 END AS fresh FROM k SEMI JOIN r USING (k)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY field_name, transcript_id, item_id ORDER BY pos) AS run FROM h)
SELECT field_name, transcript_id, item_id, CAST(min(pos) AS INT) AS first_word, CAST(max(pos) + 15 AS INT) AS last_word FROM g GROUP BY field_name, transcript_id, item_id, run
"""


def _p2_level(n: int) -> str:
    """Texts with a window of ``n`` words that another transcript has."""
    return f"""SELECT field_name, transcript_id, item_id, {n} AS level FROM (
  SELECT *, min(transcript_id) OVER (PARTITION BY k) < max(transcript_id) OVER (PARTITION BY k) AS shared FROM (
    SELECT field_name, transcript_id, item_id, array_to_string(w[pos + 1 : pos + {n}], ' ') AS k FROM (SELECT field_name, transcript_id, item_id, w, unnest(range(0, len(w) - {n - 1})) AS pos FROM w WHERE len(w) >= {n}))) WHERE shared"""


P2_SHARE_SQL = f"""
WITH runs AS ({P2_SQL}), {_P2_TEXTS},
n AS (SELECT field_name, transcript_id, item_id, max(len(w)) AS n_words FROM w WHERE w IS NOT NULL GROUP BY ALL),
c AS (SELECT field_name, transcript_id, item_id, CAST(sum(last_word - first_word + 1) AS BIGINT) AS n_shared FROM runs GROUP BY ALL),
l AS (SELECT field_name, transcript_id, item_id, max(level) AS level FROM ({" UNION ALL ".join(_p2_level(16 * 2**i) for i in range(8))}) GROUP BY ALL)
SELECT field_name, transcript_id, item_id, n_words, coalesce(n_shared, 0) AS n_shared, coalesce(n_shared / n_words, 0.0) AS share, coalesce(level, 0) AS level
FROM n LEFT JOIN c USING (field_name, transcript_id, item_id) LEFT JOIN l USING (field_name, transcript_id, item_id)
"""

# The ordinary characters as TESTDATA.md states them, by code points: ASCII; Arabic letters, vowel and reading signs, digits and punctuation.
_ORDINARY_SQL = (
    r"\x{0009}\x{000A}\x{000D}\x{0020}-\x{007E}\x{060C}\x{0610}-\x{061B}\x{061F}\x{0621}-\x{063A}\x{0641}-\x{065F}\x{0660}-\x{066D}\x{0670}\x{0671}\x{06D6}-\x{06DC}\x{06DE}-\x{06E8}\x{06EA}-\x{06ED}"
)
# The usual letters, joiners, digits and full stop of Persian and Urdu.
_WIDER_SQL = r"\x{200C}\x{200D}\x{0679}\x{067E}\x{0686}\x{0688}\x{0691}\x{0698}\x{06A9}\x{06AF}\x{06BA}\x{06BE}\x{06C0}-\x{06C3}\x{06CC}\x{06D2}-\x{06D4}\x{06F0}-\x{06F9}"


def _class(wider: bool = False) -> str:
    return f"[^{_ORDINARY_SQL}{_WIDER_SQL if wider else ''}]"


P5_SQL = f"""
WITH t AS (
  SELECT 'text_uthmani' AS field_name, CAST(verse_id AS BIGINT) AS record_id, -1 AS segment_id, text_uthmani AS text, false AS wider FROM verses
  UNION ALL SELECT 'text_norm', verse_id, -1, text_norm, false FROM verses
  UNION ALL SELECT 'segment_text', transcript_id, s.id, s.text, coalesce(language IN ('fa', 'ur'), false) FROM (SELECT transcript_id, language, unnest(segments) AS s FROM transcripts)
  UNION ALL SELECT 'canonical_quoted', match_id, -1, canonical_quoted, false FROM verified_matches
)
SELECT field_name, record_id, segment_id FROM t WHERE text IS NOT NULL AND (nfc_normalize(text) <> text OR CASE WHEN wider THEN regexp_matches(text, '{_class(True)}') ELSE regexp_matches(text, '{_class()}') END)
"""

#: SQL where it can say the same; the other queries are tested against brute force and libraries.
ORACLES: dict[str, str] = {"p2_found": P2_SQL, "p2_share": P2_SHARE_SQL, "p5_found": P5_SQL}

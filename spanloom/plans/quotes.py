"""Queries of the quotation engine's operators, over whole tables, and their SQL.

Passages are the verses, documents the transcripts (and, where a query says
so, the documents table).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.config import NormRules
from spanloom.functions import scores, textnorm
from spanloom.operators import align, catalog, corpus, decide, evaluate, manifest, recover, rewrite, search, words
from spanloom.plans import pipeline
from spanloom.schema import SEGMENT
from spanloom.sources.tables import cut, dealt_out, table
from spanloom.streaming import incremental

#: Of the transcripts, what word streams are made of.
SPOKEN = "transcript_id bigint, surah_order int, segments array<struct<id:int,start:double,end:double,text:string,words:array<struct<word:string,start:double,end:double>>>>"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def sql_arabic(x: str) -> str:
    """The Arabic profile in SQL."""
    t = f"replace(coalesce({x}, ''), 'ـ', '')"
    t = f"regexp_replace({t}, '{textnorm.MARKS}', '', 'g')"
    t = f"replace(translate({t}, 'آأإٱىةؤئ', 'اااايهوي'), 'ء', '')"
    t = f"regexp_replace({t}, '{textnorm.NOT_LETTERS}', ' ', 'g')"
    return f"trim(regexp_replace({t}, ' +', ' ', 'g'))"


#: White space as the reader sees it, for cutting pieces.
_WS = "[\\s\\x{001C}-\\x{001F}\\x{0085}\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"


def sql_pieces(x: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({x}, ''), '{_WS}'), lambda w: w <> '')"


_WORDS_SQL = f"""
s AS (SELECT transcript_id AS doc, unnest(list_filter(segments, lambda s: s IS NOT NULL)) AS s, generate_subscripts(list_filter(segments, lambda s: s IS NOT NULL), 1) - 1 AS seg_pos FROM transcripts),
timed AS (SELECT doc, seg_pos, coalesce(s.id, 0) AS seg_id, unnest(s.words) AS w, generate_subscripts(s.words, 1) - 1 AS pos, s FROM s WHERE coalesce(len(s.words), 0) > 0),
cut AS (SELECT doc, seg_pos, coalesce(s.id, 0) AS seg_id, s, {sql_pieces('s.text')} AS p FROM s WHERE coalesce(len(s.words), 0) = 0),
spread AS (SELECT doc, seg_pos, seg_id, s, len(p) AS n, unnest(p) AS raw, generate_subscripts(p, 1) - 1 AS pos FROM cut),
w0 AS (
  SELECT doc, seg_pos, seg_id, pos, trim(coalesce(w.word, '')) AS raw, coalesce(w.start, s.start, 0.0) AS "start", coalesce(w."end", s."end", 0.0) AS "end" FROM timed
  UNION ALL
  SELECT doc, seg_pos, seg_id, pos, raw, coalesce(s.start, 0.0) + pos * ((coalesce(s."end", 0.0) - coalesce(s.start, 0.0)) / greatest(n, 1)),
    coalesce(s.start, 0.0) + (pos + 1) * ((coalesce(s."end", 0.0) - coalesce(s.start, 0.0)) / greatest(n, 1)) FROM spread
),
w1 AS (SELECT *, {sql_arabic('raw')} AS norm FROM w0),
words AS (SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY seg_pos, pos) - 1 AS INT) AS g, raw, norm, CAST(seg_pos AS INT) AS seg_pos, CAST(seg_id AS INT) AS seg_id, CAST(pos AS INT) AS pos, "start", "end" FROM w1 WHERE norm <> '')
"""

_PASSAGES_SQL = """
passages AS (SELECT verse_id, surah_no AS group_no, ayah_no AS item_no, list_filter(string_split(coalesce(text_norm, ''), ' '), lambda w: w <> '') AS tokens FROM verses)
"""

_POSTINGS_SQL = (
    _PASSAGES_SQL
    + """,
vt AS (SELECT verse_id, unnest(tokens) AS w, generate_subscripts(tokens, 1) - 1 AS vpos FROM passages),
vb AS (SELECT a.verse_id, CAST(a.vpos AS INT) AS vpos, a.w AS w1, b.w AS w2 FROM vt a JOIN vt b ON a.verse_id = b.verse_id AND b.vpos = a.vpos + 1),
postings AS (SELECT *, count(*) OVER (PARTITION BY w1, w2) AS df FROM vb)
"""
)

_SEEDS_SQL = f"""
WITH {_WORDS_SQL}, {_POSTINGS_SQL},
seeds AS (SELECT a.doc, a.g AS tpos, p.verse_id, p.vpos FROM words a JOIN words b ON a.doc = b.doc AND b.g = a.g + 1 JOIN postings p ON p.w1 = a.norm AND p.w2 = b.norm WHERE p.df <= 50)
"""


def _arrays(spark: SparkSession, d: str, *keep: str) -> DataFrame:
    return words.word_arrays(_transcripts(spark, d, "segments", *keep), "transcript_id", keep=keep)


def _transcripts(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return dealt_out(table(spark, d, "transcripts", SPOKEN).select("transcript_id", *cols), "transcript_id")


def _passages(spark: SparkSession, d: str) -> DataFrame:
    return corpus.passages(table(spark, d, "verses"))


@_query(f"SELECT doc_id AS id, 'document' AS kind, {sql_arabic('text')} AS norm FROM documents UNION ALL SELECT verse_id, 'verse', {sql_arabic('text_uthmani')} FROM verses")
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.lit("document").alias("kind"), textnorm.arabic(F.col("text")).alias("norm"))
    b = table(spark, d, "verses").select(F.col("verse_id").cast("long").alias("id"), F.lit("verse").alias("kind"), textnorm.arabic(F.col("text_uthmani")).alias("norm"))
    return a.unionByName(b)


@_query(f"""
SELECT verse_id, trim(regexp_replace(regexp_replace(translate(replace(nfc_normalize(coalesce(text_uthmani, '')), 'ـ', ''), 'آأإٱىة', 'اااايه'), '{_WS}', ' ', 'g'), ' +', ' ', 'g')) AS norm FROM verses""")
def normalize_rules_off(spark: SparkSession, d: str) -> DataFrame:
    """The verses with marks, hamza and other characters kept, composed first."""
    rules = NormRules(drop_marks=False, unify_hamza=False, letters_only=False)
    return table(spark, d, "verses").select("verse_id", textnorm.arabic(F.col("text_uthmani"), rules).alias("norm"))


@_query(f"WITH {_WORDS_SQL} SELECT * FROM words")
def tokenize_words(spark: SparkSession, d: str) -> DataFrame:
    return words.word_rows(_arrays(spark, d))


@_query("SELECT transcript_id, string_agg(trim(coalesce(s.text, '')), ' ' ORDER BY i) AS full_text FROM (SELECT transcript_id, unnest(segments) AS s, generate_subscripts(segments, 1) AS i FROM transcripts) WHERE s IS NOT NULL GROUP BY transcript_id UNION ALL SELECT transcript_id, CASE WHEN segments IS NULL THEN NULL ELSE '' END FROM transcripts WHERE coalesce(len(segments), 0) = 0")
def full_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "transcripts").select("transcript_id", words.full_text(F.col("segments")).alias("full_text"))


@_query("SELECT transcript_id, s.id AS segment_id, s.text AS text FROM (SELECT transcript_id, unnest(segments) AS s FROM transcripts) WHERE s.avg_logprob >= -1.0 AND s.no_speech_prob <= 0.6")
def reliable_segments(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "transcripts").select("transcript_id", F.explode(words.reliable(F.col("segments"))).alias("s"))
    return s.select("transcript_id", F.col("s.id").alias("segment_id"), F.col("s.text").alias("text"))


@_query(f"""
WITH p AS (SELECT *, {sql_pieces('text_uthmani')} AS p FROM verses),
u AS (SELECT verse_id, unnest(p) AS w, generate_subscripts(p, 1) - 1 AS i FROM p),
t AS (SELECT verse_id, i, list_filter(string_split({sql_arabic('w')}, ' '), lambda x: x <> '') AS t FROM u),
f AS (SELECT verse_id, i, unnest(t) AS x, generate_subscripts(t, 1) AS j FROM t)
SELECT CAST(row_number() OVER (ORDER BY v.surah_no, v.ayah_no) AS INT) AS verse_id, v.surah_no, v.ayah_no, coalesce(string_agg(CAST(f.i AS VARCHAR), ',' ORDER BY f.i, f.j), '') AS align
FROM verses v LEFT JOIN f USING (verse_id) GROUP BY v.surah_no, v.ayah_no, v.verse_id""")
def corpus_numbering_alignment(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "verses").select(F.col("surah_no").alias("group_no"), F.col("surah_name").alias("group_name"), F.col("ayah_no").alias("item_no"), F.col("text_uthmani").alias("text"))
    return corpus.number(raw).select("verse_id", "surah_no", "ayah_no", F.array_join("uth_align", ",").alias("align"))


@_query(f"""
WITH p AS (SELECT verse_id, text_uthmani, {sql_pieces('text_uthmani')} AS p, uth_align FROM verses),
a AS (SELECT *, CASE WHEN coalesce(len(uth_align), 0) > 0 THEN uth_align ELSE range(len(p)) END AS a FROM p),
r AS (SELECT *, unnest(range(0, len(a))) AS i FROM a)
SELECT verse_id, CAST(i AS INT) AS first_word, CASE WHEN a[i + 1] IS NULL OR a[len(a)] IS NULL THEN text_uthmani ELSE array_to_string(p[a[i + 1] + 1 : a[len(a)] + 1], ' ') END AS quoted FROM r""")
def quoted_fragments(spark: SparkSession, d: str) -> DataFrame:
    """The source pieces behind the normalized words of each verse from every one of them to the last."""
    p = _passages(spark, d).withColumn("n", F.when(F.size("align") > 0, F.size("align")).otherwise(F.size(textnorm.pieces(F.col("source"))))).where("n > 0")
    p = p.withColumn("first_word", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return p.select("verse_id", "first_word", textnorm.fragment(F.col("source"), F.col("align"), F.col("first_word"), F.col("n") - 1).alias("quoted"))


@_query(f"""
WITH {_POSTINGS_SQL}, v AS (SELECT verse_id, count(*) AS n, count(*) FILTER (df > 50) AS n_over FROM postings GROUP BY verse_id)
SELECT (SELECT count(*) FROM (SELECT DISTINCT w1, w2 FROM postings WHERE df > 50)) AS pairs_over_cap, CAST(coalesce(sum(n_over), 0) AS BIGINT) AS places_over_cap, count(*) FILTER (n = n_over) AS passages_unseeded FROM v""")
def seed_cap_effect(spark: SparkSession, d: str) -> DataFrame:
    """What the cap on common pairs of words leaves out of the seeds."""
    return corpus.seed_cap(_passages(spark, d), 50)


@_query(f"WITH {_POSTINGS_SQL} SELECT w1, w2, count(*) AS df FROM vb GROUP BY w1, w2")
def bigram_postings_df(spark: SparkSession, d: str) -> DataFrame:
    return corpus.frequencies(_passages(spark, d))


@_query(_SEEDS_SQL + "SELECT * FROM seeds")
def bigram_seeds_capped(spark: SparkSession, d: str) -> DataFrame:
    return align.seeds(_arrays(spark, d), _passages(spark, d), 50)


@_query(_SEEDS_SQL + "SELECT doc, verse_id, tpos - vpos AS diagonal, count(*) AS n_seeds, min(tpos) AS first_tpos, max(tpos) AS last_tpos FROM seeds GROUP BY ALL")
def seed_diagonals(spark: SparkSession, d: str) -> DataFrame:
    return align.diagonals(align.seeds(_arrays(spark, d), _passages(spark, d), 50))


@_query(f"""
WITH {_WORDS_SQL}, {_PASSAGES_SQL}, a AS (SELECT DISTINCT norm AS t FROM words), b AS (SELECT DISTINCT unnest(tokens) AS t FROM passages),
ac AS (SELECT t, i, substr(t, 1, i - 1) || substr(t, i + 1) AS c FROM (SELECT t, unnest(range(1, length(t) + 1)) AS i FROM a)),
bc AS (SELECT t, i, substr(t, 1, i - 1) || substr(t, i + 1) AS c FROM (SELECT t, unnest(range(1, length(t) + 1)) AS i FROM b))
SELECT ac.t AS a, bc.t AS b FROM ac JOIN bc ON ac.c = bc.c AND ac.i = bc.i AND ac.t <> bc.t
UNION SELECT ac.t, b.t FROM ac JOIN b ON ac.c = b.t
UNION SELECT a.t, bc.t FROM a JOIN bc ON bc.c = a.t""")
def token_fuzzy_match(spark: SparkSession, d: str) -> DataFrame:
    """Words of the transcripts one edit from a word of the corpus."""
    a = words.word_rows(_arrays(spark, d)).select(F.col("norm").alias("token"))
    b = _passages(spark, d).select(F.explode("tokens").alias("token"))
    return search.near_tokens(a, b)


def _sql_lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence of two strings: one row of the table for each letter of the first."""
    step = f"lambda row, x: list_reduce(range(1, length({b}) + 1), lambda new, j: list_append(new, CASE WHEN substr({b}, CAST(j AS INT), 1) = x[1] THEN row[j] + 1 ELSE greatest(row[j + 1], new[-1]) END), [0])"
    letters = f"list_transform(range(1, length({a}) + 1), lambda i: [substr({a}, CAST(i AS INT), 1)])"
    return f"list_reduce({letters}, {step}, list_transform(range(0, length({b}) + 1), lambda i: 0))[-1]"


def _sql_one_edit(a: str, b: str) -> str:
    """Whether two different strings are one letter apart, counted in characters."""
    left_out = lambda x, y: f"len(list_filter(range(1, length({x}) + 1), lambda i: substr({x}, 1, CAST(i AS INT) - 1) || substr({x}, CAST(i AS INT) + 1) = {y})) > 0"
    changed = f"len(list_filter(range(1, length({a}) + 1), lambda i: substr({a}, CAST(i AS INT), 1) <> substr({b}, CAST(i AS INT), 1))) <= 1"
    return f"CASE length({a}) - length({b}) WHEN 0 THEN {changed} WHEN 1 THEN {left_out(a, b)} WHEN -1 THEN {left_out(b, a)} ELSE false END"


def _sql_reach(n: str) -> str:
    """CTEs from seeds{n} to reach{n}.

    Diagonals laid out word by word: which words are alike (equal, one edit
    apart, or both of four letters and 85 % similar), how far each seed reaches
    within its budget of mismatches, and the score of what it reaches.
    """
    return f"""
laid{n} AS (SELECT DISTINCT doc, verse_id, tpos - vpos AS d FROM seeds{n}),
cells{n} AS (
  SELECT l.doc, l.verse_id, l.d, v.vpos AS v, v.w AS p, w.norm AS t FROM laid{n} l JOIN vt v USING (verse_id) JOIN words w ON w.doc = l.doc AND w.g = v.vpos + l.d
),
pairs{n} AS (SELECT DISTINCT p, t FROM cells{n} WHERE p <> t),
near{n} AS (
  SELECT p, t FROM pairs{n} WHERE {_sql_one_edit("p", "t")}
  UNION SELECT p, t FROM pairs{n} WHERE least(length(p), length(t)) >= 4 AND 200 * least(length(p), length(t)) >= 85 * (length(p) + length(t)) AND 200.0 * {_sql_lcs("p", "t")} / (length(p) + length(t)) >= 85.0
),
hits{n} AS (SELECT c.*, c.p = c.t OR n.p IS NOT NULL AS hit FROM cells{n} c LEFT JOIN near{n} n ON n.p = c.p AND n.t = c.t),
sides{n} AS (
  SELECT s.doc, s.verse_id, s.tpos, s.vpos, h.v, h.hit, z.budget,
    sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY s.doc, s.verse_id, s.tpos, s.vpos, h.v > s.vpos ORDER BY abs(h.v - s.vpos)) AS miss
  FROM seeds{n} s JOIN size z USING (verse_id) JOIN hits{n} h ON h.doc = s.doc AND h.verse_id = s.verse_id AND h.d = s.tpos - s.vpos AND h.v NOT IN (s.vpos, s.vpos + 1)
),
ends{n} AS (
  SELECT s.doc, s.verse_id, s.tpos, s.vpos, coalesce(min(x.v) FILTER (x.v < s.vpos), s.vpos) AS a, coalesce(max(x.v) FILTER (x.v > s.vpos), s.vpos + 1) AS b
  FROM seeds{n} s LEFT JOIN (SELECT * FROM sides{n} WHERE hit AND miss <= budget) x USING (doc, verse_id, tpos, vpos) GROUP BY s.doc, s.verse_id, s.tpos, s.vpos
),
texts{n} AS (
  SELECT e.doc, e.verse_id, e.tpos, e.vpos, e.a, e.b, string_agg(c.p, ' ' ORDER BY c.v) AS p, string_agg(c.t, ' ' ORDER BY c.v) AS t
  FROM ends{n} e JOIN cells{n} c ON c.doc = e.doc AND c.verse_id = e.verse_id AND c.d = e.tpos - e.vpos AND c.v BETWEEN e.a AND e.b GROUP BY ALL
),
ratios{n} AS (SELECT p, t, CASE WHEN p = t THEN 100.0 ELSE 200.0 * {_sql_lcs("p", "t")} / (length(p) + length(t)) END AS score FROM (SELECT DISTINCT p, t FROM texts{n})),
reach{n} AS (SELECT doc, verse_id, tpos, vpos, CAST(a AS INT) AS verse_start, CAST(b AS INT) AS verse_end, CAST(b - a + 1 AS INT) AS matched, score FROM texts{n} JOIN ratios{n} USING (p, t))
"""


_REACH_SQL = _SEEDS_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + ", size AS (SELECT verse_id, len(tokens) AS n, 2 + len(tokens) // 6 AS budget FROM passages)," + _sql_reach("")

_FACTOR_SQL = "CASE WHEN matched >= 5 THEN 1.0 WHEN matched = 4 THEN 0.96 WHEN matched = 3 THEN 0.85 WHEN matched = 2 THEN 0.66 ELSE 0.40 END"
# Per place the best reach; then in the order of places those of a passage that lie in no accepted span.
_RAW_SQL = (
    _REACH_SQL
    + f""",
tops AS (
  SELECT *, row_number() OVER (PARTITION BY doc, verse_id ORDER BY tpos) AS k, min(tpos) OVER (PARTITION BY doc, verse_id) AS first_seed
  FROM (SELECT *, tpos - vpos + verse_start AS lo, tpos - vpos + verse_end AS hi FROM reach QUALIFY row_number() OVER (PARTITION BY doc, verse_id, tpos ORDER BY matched DESC, score DESC, vpos) = 1)
),
fold AS (
  SELECT doc, verse_id, k, score >= 78 AS good, CASE WHEN score >= 78 THEN [{{'lo': lo, 'hi': hi}}] ELSE [] END AS taken FROM tops WHERE k = 1
  UNION ALL
  SELECT t.doc, t.verse_id, t.k, t.score >= 78 AND len(list_filter(f.taken, lambda x: t.tpos BETWEEN x.lo AND x.hi)) = 0,
    CASE WHEN t.score >= 78 AND len(list_filter(f.taken, lambda x: t.tpos BETWEEN x.lo AND x.hi)) = 0 THEN list_append(f.taken, {{'lo': t.lo, 'hi': t.hi}}) ELSE f.taken END
  FROM fold f JOIN tops t ON t.doc = f.doc AND t.verse_id = f.verse_id AND t.k = f.k + 1
),
raw AS (
  SELECT doc, verse_id, CAST(first_seed AS INT) AS first_seed, CAST(lo AS INT) AS word_start, CAST(hi AS INT) AS word_end, verse_start, verse_end, matched, CAST(n AS INT) AS verse_tokens, score,
    round_even(score / 100.0 * {_FACTOR_SQL}, 4) AS conf
  FROM tops JOIN fold USING (doc, verse_id, k) JOIN size USING (verse_id) WHERE good
)
"""
)


@_query(_REACH_SQL + "SELECT * FROM reach")
def directional_extension(spark: SparkSession, d: str) -> DataFrame:
    """How far each seed of every transcript reaches both ways, and with what score."""
    return align.extensions(_arrays(spark, d), _passages(spark, d))


@_query(_RAW_SQL + "SELECT * EXCLUDE (first_seed) FROM raw")
def quote_matches(spark: SparkSession, d: str) -> DataFrame:
    """Which verses the transcripts quote, where, and how well: every accepted raw span."""
    return align.raw_matches(_arrays(spark, d), _passages(spark, d)).drop("first_seed")


# Spans chosen greedily, then held against the raw ones of other passages over about the same words.
_DECIDED_SQL = (
    _RAW_SQL
    + """,
scored AS (
  SELECT r.*, p.group_no, x.surah_order AS primary_no, coalesce(p.group_no = x.surah_order, false) AS own,
    CASE WHEN coalesce(p.group_no = x.surah_order, false) THEN least(1.0, conf + 0.03) ELSE conf END AS c
  FROM raw r JOIN passages p USING (verse_id) JOIN transcripts x ON x.transcript_id = r.doc
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY c DESC, matched DESC, score DESC, first_seed, verse_id, word_start) AS k FROM scored),
chosen AS (
  SELECT doc, k, [{'lo': word_start, 'hi': word_end, 'k': k}] AS taken FROM ranked WHERE k = 1
  UNION ALL
  SELECT r.doc, r.k, CASE WHEN len(list_filter(f.taken, lambda x: x.lo <= r.word_end AND r.word_start <= x.hi)) > 0 THEN f.taken ELSE list_append(f.taken, {'lo': r.word_start, 'hi': r.word_end, 'k': r.k}) END
  FROM chosen f JOIN ranked r ON r.doc = f.doc AND r.k = f.k + 1
),
kept AS (SELECT r.* FROM ranked r JOIN (SELECT doc, unnest(taken).k AS k FROM (SELECT doc, taken FROM chosen QUALIFY row_number() OVER (PARTITION BY doc ORDER BY k DESC) = 1)) USING (doc, k)),
rivals AS (
  SELECT a.doc, a.k, bool_or(b.own) AS rival_own FROM kept a JOIN scored b ON a.doc = b.doc AND a.verse_id <> b.verse_id AND abs(a.score - b.score) <= 2.0 AND b.word_start <= a.word_end AND a.word_start <= b.word_end
  WHERE (least(a.word_end, b.word_end) - greatest(a.word_start, b.word_start) + 1) / CAST(a.matched + b.matched - (least(a.word_end, b.word_end) - greatest(a.word_start, b.word_start) + 1) AS DOUBLE) >= 0.6 GROUP BY ALL
),
decided AS (
  SELECT kept.* EXCLUDE (c, conf), CASE WHEN rival_own IS NOT NULL AND NOT (own AND NOT rival_own) THEN greatest(0.0, c - 0.12) ELSE c END AS c FROM kept LEFT JOIN rivals USING (doc, k)
)
"""
)
_STATUS_SQL = "CASE WHEN c >= 0.82 AND matched >= 3 THEN 'accepted' WHEN c >= 0.70 THEN 'review' ELSE 'rejected' END AS status, round_even(c, 4) AS confidence"


def _decided(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The word arrays, and the spans decided on, before neighbours are recovered."""
    arrays, passages = cut(_arrays(spark, d, "surah_order")), _passages(spark, d)
    own = arrays.select("doc", F.col("surah_order").alias("primary_no"))
    return arrays, decide.decide(cut(align.raw_matches(arrays, passages)), passages, own)


@_query(_DECIDED_SQL + f"SELECT doc, verse_id, first_seed, word_start, word_end, verse_start, verse_end, matched, verse_tokens, score, group_no, primary_no, {_STATUS_SQL} FROM decided")
def decide_spans(spark: SparkSession, d: str) -> DataFrame:
    """The disjoint spans of every transcript with their confidence and tier."""
    return _decided(spark, d)[1].drop("id")


def _sql_finished(spans: str) -> str:
    """The fields of spans (doc, k, verse_id, its group and item, item_end, chain_id, places, score, confidence, status, cross)."""
    return _sql_places(spans) + _SELECT_FIELDS


def _sql_places(spans: str) -> str:
    return f"""
z AS (SELECT d.*, v.surah_name, v.text_uthmani, v.uth_align, {sql_pieces("v.text_uthmani")} AS pieces FROM {spans} d JOIN verses v USING (verse_id)),
y AS (SELECT *, CASE WHEN coalesce(len(uth_align), 0) > 0 THEN uth_align ELSE range(len(pieces)) END AS a FROM z),
spoken AS (SELECT y.doc, y.k, string_agg(w.raw, ' ' ORDER BY w.g) AS said, min(w.start) FILTER (w.g = y.word_start) AS "start", min(w."end") FILTER (w.g = y.word_end) AS "end" FROM y JOIN words w ON w.doc = y.doc AND w.g BETWEEN y.word_start AND y.word_end GROUP BY ALL)
"""


_SELECT_FIELDS = """SELECT y.doc, surah_name AS surah, group_no AS surah_no, item_no AS ayah, item_end AS ayah_end, verse_id, text_uthmani AS canonical_text,
  CASE WHEN verse_end < len(a) AND a[verse_start + 1] IS NOT NULL AND a[verse_end + 1] IS NOT NULL THEN array_to_string(pieces[a[verse_start + 1] + 1 : a[verse_end + 1] + 1], ' ') ELSE text_uthmani END AS canonical_quoted,
  confidence, status, s."start", s."end", word_start, word_end, said AS transcript_text, round_even(score, 2) AS fuzz_score, round_even(least(1.0, matched / verse_tokens), 4) AS coverage,
  is_cross AS is_cross_surah, chain_id
FROM y JOIN spoken s USING (doc, k)"""


_KEPT_SQL = _DECIDED_SQL + f""",
good AS (
  SELECT *, item_no AS item_end, group_no IS DISTINCT FROM primary_no AS is_cross, CAST(NULL AS INT) AS chain_id
  FROM (SELECT d.*, p.item_no, {_STATUS_SQL} FROM decided d JOIN passages p USING (verse_id)) WHERE status <> 'rejected'
)"""

# Neighbours of the latest span first: the best reach of the next and the last passage of the group around it, through any pair of words.
_PROBE_SQL = """list_reduce(list_filter(c{i}.at, lambda x: x.tpos >= {lo} AND x.tpos < {hi}), lambda a, b: CASE WHEN b.matched > a.matched THEN b ELSE a END, CAST({{'tpos': 0, 'lo': 0, 'hi': 0, 'verse_start': 0, 'verse_end': 0, 'matched': 0, 'score': 0.0}} AS {at}))"""
_AT = "STRUCT(tpos INT, lo INT, hi INT, verse_start INT, verse_end INT, matched INT, score DOUBLE)"
_NEW = "{{'verse_id': c{i}.verse_id, 'group_no': c{i}.group_no, 'word_start': CAST(p{i}.lo AS INT), 'word_end': CAST(p{i}.hi AS INT), 'is_cross': m.is_cross, 'verse_start': p{i}.verse_start, 'verse_end': p{i}.verse_end, 'matched': p{i}.matched, 'score': p{i}.score, 'is_new': true}}"
_ITEM = "{'verse_id': verse_id, 'group_no': group_no, 'word_start': word_start, 'word_end': word_end, 'is_cross': is_cross, 'verse_start': verse_start, 'verse_end': verse_end, 'matched': matched, 'score': score, 'is_new': false}"
_RECOVERED_SQL = (
    _KEPT_SQL
    + f""",
quoted AS (SELECT DISTINCT doc, group_no FROM good),
seeds2 AS (SELECT a.doc, a.g AS tpos, p.verse_id, p.vpos FROM quoted q JOIN words a ON a.doc = q.doc JOIN words b ON a.doc = b.doc AND b.g = a.g + 1 JOIN postings p ON p.w1 = a.norm AND p.w2 = b.norm JOIN passages x ON x.verse_id = p.verse_id AND x.group_no = q.group_no),
{_sql_reach("2")},
tops2 AS (SELECT * FROM reach2 QUALIFY row_number() OVER (PARTITION BY doc, verse_id, tpos ORDER BY matched DESC, score DESC, vpos) = 1),
cand AS (
  SELECT doc, verse_id, any_value(group_no) AS group_no, any_value(len(tokens)) AS n,
    list(CAST({{'tpos': tpos, 'lo': tpos - vpos + verse_start, 'hi': tpos - vpos + verse_end, 'verse_start': verse_start, 'verse_end': verse_end, 'matched': matched, 'score': score}} AS {_AT}) ORDER BY tpos) AS at
  FROM tops2 JOIN passages USING (verse_id) GROUP BY doc, verse_id
),
long AS (SELECT doc, max(g) + 1 AS n_words FROM words GROUP BY doc),
work AS (
  SELECT doc, list({_ITEM} ORDER BY word_start, verse_id) AS todo, list(DISTINCT verse_id) AS have, CAST([] AS STRUCT(verse_id INT, group_no INT, word_start INT, word_end INT, is_cross BOOLEAN, verse_start INT, verse_end INT, matched INT, score DOUBLE, is_new BOOLEAN)[]) AS found
  FROM good GROUP BY doc
  UNION ALL
  SELECT doc, todo[1 : len(todo) - 1] || new_ones, have || list_transform(new_ones, lambda x: x.verse_id), found || new_ones FROM (
    SELECT doc, todo, have, found,
      CASE WHEN p1.score >= 72.0 AND p1.lo - m.word_end - 1 <= 4 THEN [{_NEW.format(i=1)}] ELSE [] END || CASE WHEN p2.score >= 72.0 AND m.word_start - p2.hi - 1 <= 4 THEN [{_NEW.format(i=2)}] ELSE [] END AS new_ones
    FROM (
      SELECT f.doc, f.todo, f.have, f.found, f.m, c1, c2,
        {_PROBE_SQL.format(i=1, at=_AT, lo="greatest(0, f.m.word_end)", hi="least(l.n_words - 1, f.m.word_end + 1 + c1.n + 4)")} AS p1,
        {_PROBE_SQL.format(i=2, at=_AT, lo="greatest(0, f.m.word_start - c2.n - 4)", hi="least(l.n_words - 1, f.m.word_start + 1)")} AS p2
      FROM (SELECT *, todo[-1] AS m FROM work WHERE len(todo) > 0) f JOIN long l ON l.doc = f.doc
      LEFT JOIN cand c1 ON c1.doc = f.doc AND c1.verse_id = f.m.verse_id + 1 AND c1.group_no = f.m.group_no AND NOT list_contains(f.have, c1.verse_id)
      LEFT JOIN cand c2 ON c2.doc = f.doc AND c2.verse_id = f.m.verse_id - 1 AND c2.group_no = f.m.group_no AND NOT list_contains(f.have, c2.verse_id)
    )
  )
),
fresh AS (SELECT doc, unnest(found, max_depth := 2) FROM work WHERE len(todo) = 0),
every AS (
  SELECT doc, verse_id, group_no, item_no, word_start, word_end, is_cross, verse_start, verse_end, matched, verse_tokens, score, confidence, status FROM good QUALIFY row_number() OVER (PARTITION BY doc, verse_id ORDER BY word_start DESC) = 1
  UNION ALL
  SELECT doc, verse_id, group_no, item_no, word_start, word_end, is_cross, verse_start, verse_end, matched, n, score, conf, CASE WHEN conf >= 0.82 THEN 'accepted' ELSE 'review' END
  FROM (SELECT f.*, p.item_no, len(p.tokens) AS n, round_even(score / 100.0 * {_FACTOR_SQL}, 4) AS conf FROM fresh f JOIN passages p USING (verse_id))
),
lagged AS (SELECT *, word_start - lag(word_end) OVER w - 1 AS gap, lag(group_no) OVER w AS pg, lag(item_no) OVER w AS pa FROM every WINDOW w AS (PARTITION BY doc ORDER BY word_start, verse_id)),
isles AS (SELECT *, sum(CASE WHEN group_no = pg AND item_no = pa + 1 AND gap BETWEEN 0 AND 4 THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY word_start, verse_id) AS isle FROM lagged),
parts AS (SELECT *, (row_number() OVER (PARTITION BY doc, isle ORDER BY word_start, verse_id) - 1) // 12 AS part FROM isles),
linked AS (SELECT *, count(*) OVER one AS n_in, last_value(item_no) OVER (PARTITION BY doc, isle, part ORDER BY word_start, verse_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS e, row_number() OVER (PARTITION BY doc, isle, part ORDER BY word_start, verse_id) AS r FROM parts WINDOW one AS (PARTITION BY doc, isle, part)),
counted AS (SELECT *, sum(CASE WHEN n_in > 1 AND r = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY word_start, verse_id) AS c FROM linked),
chained AS (SELECT * EXCLUDE (c, gap, pg, pa, isle, part, n_in, e, r), verse_id AS k, CAST(CASE WHEN n_in > 1 THEN c END AS INT) AS chain_id, CASE WHEN n_in > 1 THEN e ELSE item_no END AS item_end FROM counted)
"""
)


@_query(_KEPT_SQL + "," + _sql_finished("good"))
def finish_fields(spark: SparkSession, d: str) -> DataFrame:
    """Times, texts, coverage and the quoted fragment of the spans decided on, before neighbours are recovered."""
    arrays, spans = _decided(spark, d)
    passages = _passages(spark, d)
    kept = spans.where("status <> 'rejected'").withColumn("cross_group", F.coalesce(F.col("group_no") != F.col("primary_no"), F.lit(True)))
    kept = kept.join(passages.select("verse_id", F.col("item_no").alias("item_end")), "verse_id").withColumn("chain_id", F.lit(None).cast("int"))
    return pipeline.finish(arrays, kept, passages)


@_query("""
WITH n AS (SELECT verse_id, len(list_filter(string_split(coalesce(text_norm, ''), ' '), lambda w: w <> '')) AS n FROM verses),
m AS (SELECT match_id, least(word_end - word_start + 1, n) AS m, n FROM verified_matches JOIN n USING (verse_id) WHERE word_start <= word_end)
SELECT match_id, CASE WHEN n > 0 THEN ((10000 * m) // n + CASE WHEN 2 * ((10000 * m) % n) > n OR (2 * ((10000 * m) % n) = n AND ((10000 * m) // n) % 2 = 1) THEN 1 ELSE 0 END) / 10000.0 ELSE 0.0 END AS coverage FROM m""")
def coverage_round(spark: SparkSession, d: str) -> DataFrame:
    """The share of the verse that each match covers, to four digits, ties to even."""
    p = _passages(spark, d).select("verse_id", F.size("tokens").alias("of"))
    return _spans(spark, d).join(p, "verse_id").select("match_id", scores.coverage(F.col("n"), F.col("of")).alias("coverage"))


@_query("SELECT a.verse_id, a.surah_no AS group_no, p.verse_id AS prev_id, n.verse_id AS next_id FROM verses a LEFT JOIN verses p ON p.verse_id = a.verse_id - 1 AND p.surah_no = a.surah_no LEFT JOIN verses n ON n.verse_id = a.verse_id + 1 AND n.surah_no = a.surah_no")
def neighbour_lookup(spark: SparkSession, d: str) -> DataFrame:
    return corpus.neighbours(_passages(spark, d))


_SPANS_SQL = "spans AS (SELECT match_id, transcript_id, verse_id, surah_no, ayah, confidence, fuzz_score, status, word_start AS lo, word_end AS hi, CAST(word_end - word_start + 1 AS INT) AS n FROM verified_matches WHERE word_start <= word_end)"


def _spans(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "verified_matches").where("word_start <= word_end").select("match_id", "transcript_id", "verse_id", "surah_no", "ayah", "confidence", "fuzz_score", "status", F.col("word_start").alias("lo"), F.col("word_end").alias("hi"), (F.col("word_end") - F.col("word_start") + 1).alias("n"))


@_query(f"""
WITH RECURSIVE {_SPANS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY coalesce(confidence, 0) DESC, n DESC, match_id) AS k FROM spans),
f AS (
  SELECT transcript_id, CAST(0 AS BIGINT) AS k, CAST([] AS STRUCT(lo INT, hi INT, id BIGINT)[]) AS t FROM (SELECT DISTINCT transcript_id FROM spans)
  UNION ALL
  SELECT f.transcript_id, r.k, CASE WHEN len(list_filter(f.t, lambda x: x.lo <= r.hi AND r.lo <= x.hi)) > 0 THEN f.t ELSE list_append(f.t, {{'lo': r.lo, 'hi': r.hi, 'id': r.match_id}}) END
  FROM f JOIN r ON r.transcript_id = f.transcript_id AND r.k = f.k + 1
),
z AS (SELECT transcript_id, t FROM f QUALIFY row_number() OVER (PARTITION BY transcript_id ORDER BY k DESC) = 1)
SELECT transcript_id, unnest(t).id AS match_id FROM z""")
def greedy_disjoint_spans(spark: SparkSession, d: str) -> DataFrame:
    rank = [-F.coalesce("confidence", F.lit(0.0)), -F.col("n"), F.col("match_id")]
    return decide.greedy_disjoint(_spans(spark, d), "transcript_id", "lo", "hi", rank, "match_id")


@_query(f"""
WITH {_SPANS_SQL}
SELECT a.transcript_id, a.match_id AS id, b.match_id AS other FROM spans a JOIN spans b ON a.transcript_id = b.transcript_id AND a.verse_id <> b.verse_id AND abs(b.fuzz_score - a.fuzz_score) <= 2.0 AND b.lo <= a.hi AND a.lo <= b.hi
WHERE (least(a.hi, b.hi) - greatest(a.lo, b.lo) + 1) / CAST(a.n + b.n - (least(a.hi, b.hi) - greatest(a.lo, b.lo) + 1) AS DOUBLE) >= 0.6""")
def ambiguity_pairs(spark: SparkSession, d: str) -> DataFrame:
    s = _spans(spark, d).select("transcript_id", F.col("match_id").alias("id"), "verse_id", "lo", "hi", F.col("fuzz_score").alias("score"))
    return decide.competitors(s, s, "transcript_id", 0.6, 2.0)


@_query(f"""
WITH {_SPANS_SQL}, c AS (SELECT *, fuzz_score / 100.0 * CASE WHEN n >= 5 THEN 1.0 WHEN n = 4 THEN 0.96 WHEN n = 3 THEN 0.85 WHEN n = 2 THEN 0.66 ELSE 0.40 END AS c FROM spans)
SELECT match_id, CASE WHEN c >= 0.82 AND n >= 3 THEN 'accepted' WHEN c >= 0.70 THEN 'review' ELSE 'rejected' END AS tier FROM c""")
def status_tiers(spark: SparkSession, d: str) -> DataFrame:
    c = _spans(spark, d).withColumn("c", F.col("fuzz_score") / 100.0 * scores.length_factor(F.col("n")))
    return c.select("match_id", scores.status(F.col("c"), F.col("n"), 0.82, 0.70, 3).alias("tier"))


@_query("SELECT m.match_id, v.surah_no IS DISTINCT FROM t.surah_order AS cross_group FROM verified_matches m JOIN verses v USING (verse_id) JOIN transcripts t USING (transcript_id)")
def cross_group_flag(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "verified_matches").select("match_id", "verse_id", "transcript_id")
    v = table(spark, d, "verses").select("verse_id", F.col("surah_no").alias("g"))
    t = table(spark, d, "transcripts").select("transcript_id", "surah_order")
    return m.join(v, "verse_id").join(t, "transcript_id").select("match_id", (~F.col("g").eqNullSafe(F.col("surah_order"))).alias("cross_group"))


@_query(f"""
WITH {_SPANS_SQL},
l AS (SELECT *, lo - lag(hi) OVER w - 1 AS gap, lag(surah_no) OVER w AS pg, lag(ayah) OVER w AS pa FROM spans WINDOW w AS (PARTITION BY transcript_id ORDER BY lo, match_id)),
i AS (SELECT *, sum(CASE WHEN surah_no = pg AND ayah = pa + 1 AND gap BETWEEN 0 AND 4 THEN 0 ELSE 1 END) OVER (PARTITION BY transcript_id ORDER BY lo, match_id) AS i FROM l),
c AS (SELECT *, (row_number() OVER (PARTITION BY transcript_id, i ORDER BY lo, match_id) - 1) // 12 AS c FROM i),
n AS (SELECT *, count(*) OVER (PARTITION BY transcript_id, i, c) AS n_in, last_value(ayah) OVER (PARTITION BY transcript_id, i, c ORDER BY lo, match_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS e, row_number() OVER (PARTITION BY transcript_id, i, c ORDER BY lo, match_id) AS r FROM c),
h AS (SELECT *, sum(CASE WHEN n_in > 1 AND r = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY transcript_id ORDER BY lo, match_id) AS k FROM n)
SELECT transcript_id, match_id, CAST(CASE WHEN n_in > 1 THEN k END AS INT) AS chain_id, CASE WHEN n_in > 1 THEN e ELSE ayah END AS item_end FROM h""")
def chain_islands(spark: SparkSession, d: str) -> DataFrame:
    return recover.chain(_spans(spark, d), "transcript_id", "surah_no", "ayah", "lo", "hi", "match_id", 4, 12).select("transcript_id", "match_id", "chain_id", "item_end")


@_query(f"WITH {_SPANS_SQL} SELECT transcript_id, verse_id, match_id FROM spans QUALIFY row_number() OVER (PARTITION BY transcript_id, verse_id ORDER BY lo DESC, match_id DESC) = 1")
def last_occurrence_wins(spark: SparkSession, d: str) -> DataFrame:
    return recover.last_of_each(_spans(spark, d), "transcript_id", "verse_id", "lo", "match_id").select("transcript_id", "verse_id", "match_id")


@_query(_RECOVERED_SQL + "," + _sql_finished("chained"))
def recover_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Verified matches of every transcript with their recovered neighbours, chained."""
    e = pipeline.enrich(_transcripts(spark, d, "segments", "surah_order"), table(spark, d, "verses"))
    return e.matches


@_query(_RECOVERED_SQL + "," + _sql_places("chained") + f""", fields AS ({_SELECT_FIELDS})
SELECT coalesce(t.surah, '_') || '/ep_' || printf('%03d', coalesce(t.episode, 0)) || '.json' AS episode_path, t.surah AS primary_surah,
  f.surah, ayah, ayah_end, verse_id, confidence, status, "start", "end", is_cross_surah, transcript_text, canonical_quoted FROM fields f JOIN transcripts t ON t.transcript_id = f.doc""")
def match_lines(spark: SparkSession, d: str) -> DataFrame:
    """The flat lines of the whole pipeline's matches."""
    docs = dealt_out(table(spark, d, "transcripts").select("transcript_id", "segments", "surah_order", "surah", "episode"), "transcript_id")
    return pipeline.match_lines(pipeline.enrich(docs, table(spark, d, "verses")), docs)


@_query(f"WITH {_WORDS_SQL} SELECT m.transcript_id AS doc, m.match_id, w.seg_id FROM verified_matches m JOIN words w ON w.doc = m.transcript_id AND w.g = m.word_start")
def matches_by_segment(spark: SparkSession, d: str) -> DataFrame:
    """The segment in which each match begins."""
    m = table(spark, d, "verified_matches").select(F.col("transcript_id").alias("doc"), "match_id", "word_start")
    return pipeline.by_segment(_arrays(spark, d), m).select("doc", "match_id", "seg_id")


@_query("SELECT match_id, surah || ':' || ayah || CASE WHEN ayah_end IS NOT NULL AND ayah_end <> ayah THEN '-' || ayah_end ELSE '' END AS label FROM verified_matches")
def match_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "verified_matches").select("match_id", scores.label(F.col("surah"), F.col("ayah"), F.col("ayah_end")).alias("label"))


@_query(f"""
WITH {_WORDS_SQL},
m AS (SELECT transcript_id AS doc, word_start, word_end, match_id, '﴿ ' || coalesce(nullif(canonical_quoted, ''), canonical_text, '') || ' ﴾ [' || surah || ':' || ayah || ']' AS put FROM verified_matches WHERE status = 'accepted' AND word_start <= word_end),
st AS (SELECT doc, word_start AS g, arg_max(put, match_id) AS put FROM m GROUP BY ALL),
cv AS (SELECT DISTINCT doc, CAST(unnest(range(word_start, word_end + 1)) AS INT) AS g FROM m),
k AS (SELECT w.doc, w.seg_id, w.g, w.raw, st.put, cv.g IS NOT NULL AS inside FROM words w LEFT JOIN st USING (doc, g) LEFT JOIN cv ON cv.doc = w.doc AND cv.g = w.g),
p AS (SELECT *, CASE WHEN put IS NOT NULL THEN trim(put) WHEN NOT inside THEN raw END AS x FROM k)
SELECT doc, seg_id, string_agg(x, ' ' ORDER BY g) FILTER (x IS NOT NULL AND x <> '') AS enriched_text FROM p GROUP BY doc, seg_id HAVING bool_or(put IS NOT NULL)""")
def rewrite_segments(spark: SparkSession, d: str) -> DataFrame:
    """The accepted matches of the table written into the transcripts' segments."""
    m = table(spark, d, "verified_matches")
    put = rewrite.rendering(pipeline.Config(), F.col("canonical_quoted"), F.col("canonical_text"), F.col("surah"), F.col("ayah"))
    m = m.select(F.col("transcript_id").alias("doc"), "word_start", "word_end", F.col("match_id").alias("ord"), "status", put.alias("put"))
    return rewrite.rewrite(_arrays(spark, d), m)


@_query("SELECT transcript_id, count(*) AS total_matches, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'review') AS review, count(*) FILTER (coalesce(is_cross_surah, false)) AS cross_group FROM verified_matches GROUP BY transcript_id")
def enrichment_rollup(spark: SparkSession, d: str) -> DataFrame:
    return rewrite.rollup(table(spark, d, "verified_matches"), "transcript_id", "is_cross_surah")


@_query("""
WITH m AS (SELECT count(DISTINCT transcript_id) AS ok, count(*) AS total_matches, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'review') AS review, count(*) FILTER (coalesce(is_cross_surah, false)) AS cross_group FROM verified_matches),
f AS (SELECT count(*) AS failed FROM transcripts WHERE surah IS NULL)
SELECT ok + failed AS documents, ok, failed, total_matches, accepted, review, cross_group FROM m, f""")
def run_statistics(spark: SparkSession, d: str) -> DataFrame:
    """The statistics of the matches' table, transcripts without a surah standing for those that failed."""
    errors = table(spark, d, "transcripts").where("surah IS NULL").select(F.col("transcript_id").alias("doc"), F.lit("no surah").alias("error"))
    return rewrite.run_stats(rewrite.rollup(table(spark, d, "verified_matches"), "transcript_id", "is_cross_surah"), errors)


@_query("""
SELECT transcript_id, segment_no, round_even(s.start, 3) AS "start", round_even(s."end", 3) AS "end", round_even(s.avg_logprob, 4) AS avg_logprob, round_even(s.no_speech_prob, 4) AS no_speech_prob, round_even(duration_seconds, 2) AS duration_seconds, round_even(language_probability, 4) AS language_probability
FROM (SELECT transcript_id, duration_seconds, language_probability, unnest(segments) AS s, CAST(generate_subscripts(segments, 1) - 1 AS INT) AS segment_no FROM transcripts)""")
def recognizer_rounding(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts as a recognizer's output is kept: rounded, the segments numbered anew."""
    t = table(spark, d, "transcripts").select("transcript_id", words.rounded(F.struct("duration_seconds", "language_probability", "segments")).alias("d"))
    t = t.select("transcript_id", "d.duration_seconds", "d.language_probability", F.explode("d.segments").alias("s"))
    return t.select("transcript_id", F.col("s.id").alias("segment_no"), "s.start", "s.end", "s.avg_logprob", "s.no_speech_prob", "duration_seconds", "language_probability")


_NAMES = "CASE transcript_id % 8 WHEN 0 THEN 'تفسير سورة ' || n || ' رقم ' || e WHEN 1 THEN 'سورة ' || n || ' حلقة رقم ' || e WHEN 2 THEN 'سورة ' || n || ' الحلقة رقم ' || e WHEN 3 THEN 'سورة ' || n || 'الحلقة رقم ' || e WHEN 4 THEN 'سورة ' || n || ' الحلقات رقم ' || e || ' +1' WHEN 5 THEN 'سورة  ' || n || ' رقم ' || e WHEN 6 THEN 'مقدمة رقم ' || e ELSE n || ' ' || e END || '.mp4'"
_FILES_SQL = f"files AS (SELECT transcript_id, 'videos/' || {_NAMES} AS path FROM (SELECT transcript_id, coalesce(surah, 'ابراهيم') AS n, CAST(coalesce(episode, 0) AS VARCHAR) AS e FROM transcripts))"


def _files(spark: SparkSession, d: str) -> DataFrame:
    """File names of every pattern, made of the transcripts' groups and episodes."""
    t = table(spark, d, "transcripts").select("transcript_id", F.coalesce("surah", F.lit("ابراهيم")).alias("n"), F.coalesce("episode", F.lit(0)).cast("string").alias("e"))
    return t.select("transcript_id", F.expr(f"'videos/' || {_NAMES}").alias("path"))


def _sql_parse() -> str:
    p = [x for x in catalog.PATTERNS]
    g = "CASE " + " ".join(f"WHEN regexp_matches(s, '{x}') THEN regexp_extract(s, '{x}', 1)" for x in p) + " END"
    n = "CASE " + " ".join(f"WHEN regexp_matches(s, '{x}') THEN regexp_extract(s, '{x}', 2)" for x in p) + " END"
    i = catalog.INTRO
    return f"""{_FILES_SQL}, st AS (SELECT *, regexp_replace(regexp_extract(path, '[^/]+$'), '\\.[^.]*$', '') AS s FROM files),
h AS (SELECT transcript_id, path, regexp_matches(s, '{i}') AS is_intro, CASE WHEN regexp_matches(s, '{i}') THEN regexp_extract(s, '{i}', 1) ELSE {n} END AS n, {g} AS g FROM st),
parsed AS (SELECT transcript_id, path, CASE WHEN is_intro THEN '{catalog.INTRO_NAME}' WHEN trim(g) = 'ابراهيم' THEN 'إبراهيم' ELSE trim(regexp_replace(g, '\\s+', ' ', 'g')) END AS "group", CAST(n AS INT) AS number, is_intro FROM h)"""


@_query(f'WITH {_sql_parse()} SELECT * FROM parsed WHERE "group" IS NOT NULL')
def file_pattern_parse(spark: SparkSession, d: str) -> DataFrame:
    return catalog.route(catalog.parse(_files(spark, d), "path"))[0]


@_query(f'WITH {_sql_parse()} SELECT transcript_id, path FROM parsed WHERE "group" IS NULL')
def unmatched_route(spark: SparkSession, d: str) -> DataFrame:
    return catalog.route(catalog.parse(_files(spark, d), "path"))[1].select("transcript_id", "path")


@_query("""
WITH o AS (SELECT DISTINCT surah_name AS name, surah_no AS ord FROM verses)
SELECT t.transcript_id, t.surah, coalesce(nullif(a.ord, 0), b.ord, 9999) AS group_order FROM transcripts t LEFT JOIN o a ON a.name = t.surah LEFT JOIN o b ON b.name = trim(replace(t.surah, 'ال ', 'ال'))""")
def lookup_with_default(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "verses").select("surah_name", "surah_no").distinct()
    return catalog.with_order(table(spark, d, "transcripts").select("transcript_id", "surah"), "surah", o, "surah_name", "surah_no")


@_query(f"""
WITH {_sql_parse()}, o AS (SELECT DISTINCT surah_name AS name FROM verses WHERE surah_no % 2 = 0)
SELECT transcript_id, path FROM parsed p LEFT JOIN o a ON a.name = p."group" LEFT JOIN o b ON b.name = trim(replace(p."group", 'ال ', 'ال'))
WHERE "group" IS NULL OR (NOT is_intro AND a.name IS NULL AND b.name IS NULL)""")
def reported_files(spark: SparkSession, d: str) -> DataFrame:
    """Files whose name fits no pattern, and those whose group has no order in a list of every other surah."""
    good, bad = catalog.route(catalog.parse(_files(spark, d), "path"))
    o = table(spark, d, "verses").where("surah_no % 2 = 0").select("surah_name", "surah_no").distinct()
    named = catalog.with_order(good, "group", o, "surah_name", "surah_no", F.col("is_intro"))
    return bad.select("transcript_id", "path").unionByName(catalog.without_order(named).select("transcript_id", "path"))


@_query("SELECT surah, min(surah_order) AS group_order, count(*) AS n_rows FROM transcripts GROUP BY surah")
def group_statistics(spark: SparkSession, d: str) -> DataFrame:
    return catalog.statistics(table(spark, d, "transcripts"), "surah", "surah_order")


_STEMS = "CASE transcript_id % 6 WHEN 0 THEN 'الجزء الأول' WHEN 1 THEN 'الجزء الثاني' WHEN 2 THEN 'الجزء_الثالث' WHEN 3 THEN 'الجزء الرابع' WHEN 4 THEN 'الجزء' ELSE '' END"


@_query(f"""SELECT transcript_id, 'data/audio/' || surah || '/ep_' || printf('%03d', episode) || CASE transcript_id % 6 WHEN 0 THEN '_part1' WHEN 1 THEN '_part2' WHEN 2 THEN '_part3' WHEN 3 THEN '_part4' ELSE '' END || '.wav' AS path FROM transcripts""")
def path_render(spark: SparkSession, d: str) -> DataFrame:
    """Paths of the sound files, with the part that a file's name may tell."""
    t = table(spark, d, "transcripts")
    return t.select("transcript_id", catalog.output_path("data/audio", F.col("surah"), F.col("episode"), F.concat("surah", F.lit(" "), F.expr(_STEMS)), "wav").alias("path"))


_STATE_SQL = "state AS (SELECT user_id AS key, CASE event_type WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' ELSE 'pending' END AS status, ts AS since FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)"


def _state(spark: SparkSession, d: str) -> DataFrame:
    s = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "error", "failed").otherwise("pending")
    return manifest.state(table(spark, d, "events").withColumn("s", s), "user_id", "s", "ts", "event_id")


@_query(f"WITH {_STATE_SQL} SELECT key, status, since FROM state")
def manifest_state(spark: SparkSession, d: str) -> DataFrame:
    return _state(spark, d).withColumnRenamed("at", "since")


@_query(f"WITH {_STATE_SQL} SELECT count(*) AS total, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status NOT IN ('done', 'failed')) AS pending FROM state")
def manifest_counts(spark: SparkSession, d: str) -> DataFrame:
    return manifest.counts(_state(spark, d))


@_query(f"WITH {_STATE_SQL} SELECT c_custkey, CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 50 + 1 AS INT) AS batch_no FROM customer WHERE c_custkey NOT IN (SELECT key FROM state WHERE status = 'done')")
def pending_work(spark: SparkSession, d: str) -> DataFrame:
    """Customers whose last event is no purchase, in batches of 50."""
    p = manifest.pending(table(spark, d, "customer").select("c_custkey"), "c_custkey", _state(spark, d))
    return manifest.batches(p, "c_custkey", 50).select("c_custkey", "batch_no")


@_query(f"""
WITH {_STATE_SQL}, r AS (SELECT key, status FROM state UNION ALL SELECT c_custkey, 'pending' FROM customer WHERE c_custkey NOT IN (SELECT key FROM state))
SELECT key, CASE WHEN key IN (SELECT o_custkey FROM orders) THEN 'done' ELSE status END AS status FROM r""")
def manifest_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """The customers registered in the state of the events, those with an order taken as done."""
    reg = manifest.register(_state(spark, d), table(spark, d, "customer").select(F.col("c_custkey").alias("key")))
    return manifest.reconcile(reg, table(spark, d, "orders").select(F.col("o_custkey").alias("key"))).select("key", "status")


_PR_SQL = """
t AS (SELECT DISTINCT transcript_id, surah, ayah FROM verified_matches WHERE status = 'accepted' AND ayah IS NOT NULL),
p AS (SELECT DISTINCT transcript_id, surah, ayah FROM verified_matches WHERE fuzz_score >= 90 AND ayah IS NOT NULL)
"""


@_query(f"""
WITH {_PR_SQL},
n AS (SELECT (SELECT count(*) FROM (SELECT * FROM t INTERSECT SELECT * FROM p)) AS tp, (SELECT count(*) FROM (SELECT * FROM p EXCEPT SELECT * FROM t)) AS fp, (SELECT count(*) FROM (SELECT * FROM t EXCEPT SELECT * FROM p)) AS fn),
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS "precision", CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM n)
SELECT *, CASE WHEN "precision" + recall > 0 THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0.0 END AS f1 FROM m""")
def pr_f1(spark: SparkSession, d: str) -> DataFrame:
    """Matches with a score of 90 and more as predictions of the accepted ones."""
    m = table(spark, d, "verified_matches").where("ayah IS NOT NULL")
    key = ["transcript_id", "surah", "ayah"]
    return evaluate.prf(m.where("status = 'accepted'").select(*key), m.where("fuzz_score >= 90").select(*key))


@_query("""
WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS round FROM documents)
SELECT doc_id, source, CAST(round AS INT) AS round FROM r ORDER BY round, md5(coalesce(source, '')), source LIMIT 100""")
def stratified_pick(spark: SparkSession, d: str) -> DataFrame:
    """100 documents in rounds over the sources (drawing a sample is the feature)."""
    docs = table(spark, d, "documents").select("doc_id", "source")
    return evaluate.round_robin(docs, "source", [F.md5(F.col("doc_id").cast("string")), F.col("doc_id")], 100)


_QUERY_WORDS = f"q AS (SELECT item_id, list_filter(string_split({sql_arabic('text')}, ' '), lambda w: w <> '') AS w FROM eval_items)"


@_query(f"""
WITH {_PASSAGES_SQL}, {_QUERY_WORDS},
f AS (SELECT verse_id, CASE WHEN len(tokens) > 0 THEN tokens ELSE ['∅'] END AS t FROM passages),
tf AS (SELECT verse_id, w AS token, count(*) AS tf, any_value(dl) AS dl FROM (SELECT verse_id, len(t) AS dl, unnest(t) AS w FROM f) GROUP BY verse_id, w),
z AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM f),
i AS (SELECT token, ln(n - df + 0.5) - ln(df + 0.5) AS raw FROM (SELECT token, count(*) AS df FROM tf GROUP BY token), z),
j AS (SELECT token, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM i) ELSE raw END AS idf FROM i),
qt AS (SELECT item_id, w AS token, count(*) AS qf FROM (SELECT item_id, unnest(w) AS w FROM q) GROUP BY ALL),
s AS (SELECT item_id, verse_id, sum(qf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM qt JOIN j USING (token) JOIN tf USING (token), z GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, verse_id) AS rank FROM s WHERE score > 0)
SELECT item_id, verse_id, CAST(rank AS INT) AS rank FROM r WHERE rank <= 10""")
def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    """The ten best verses for every evaluation item; scores are compared to six places."""
    q = table(spark, d, "eval_items").select("item_id", textnorm.tokens(textnorm.arabic(F.col("text"))).alias("w"))
    return search.bm25(_passages(spark, d), "verse_id", "tokens", q, "item_id", "w", 10).select("item_id", "verse_id", "rank")


@_query(f"""
WITH {_PASSAGES_SQL}, q AS (SELECT verse_id AS query_id, list_distinct(tokens) AS w FROM passages WHERE len(tokens) > 0)
SELECT query_id, p.verse_id FROM q JOIN passages p ON list_has_all(p.tokens, q.w)""")
def fts_all_terms(spark: SparkSession, d: str) -> DataFrame:
    """The verses that have all the words of each verse."""
    p = _passages(spark, d)
    q = p.select(F.col("verse_id").alias("query_id"), F.col("tokens").alias("w"))
    return search.all_terms(p, "verse_id", "tokens", q, "query_id", "w")


@_query("SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE ts IS NOT NULL GROUP BY ALL")
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events per hour and kind: the batch form of the streaming query."""
    return incremental.windowed_counts(table(spark, d, "events").where("ts IS NOT NULL"), "ts", "event_type").withColumn("total", F.round("total", 4))


@_query(ORACLES["event_windows"])
def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """The same by Structured Streaming over the table's files, late rows included."""
    at = incremental.work_folder(spark)
    events = incremental.table_stream(spark, f"{d}/events.parquet", "ts timestamp_ntz, event_type string, value double").where("ts IS NOT NULL")
    incremental.run_windowed(events.withColumn("ts", F.col("ts").cast("timestamp")), f"{at}/out", f"{at}/state")  # watermarks need a time with a zone
    return incremental.latest(spark.read.parquet(f"{at}/out")).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


@_query()
def stream_enrich(spark: SparkSession, d: str) -> DataFrame:
    """The matches of the transcripts, verified, recovered and chained, file by file by Structured Streaming."""
    at = incremental.work_folder(spark)
    docs = incremental.table_stream(spark, f"{d}/transcripts.parquet", f"transcript_id long, surah_order int, segments array<{SEGMENT}>", 4)
    incremental.enrich_new(docs, table(spark, d, "verses"), f"{at}/out", f"{at}/state")
    return spark.read.parquet(f"{at}/out/matches").drop("batch")

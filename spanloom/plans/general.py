"""Queries of the general data problems, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators import intervals, nested, pieces, skew
from spanloom.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

#: The nested documents in raw_records: their lists, and the lists below.
DOC_LISTS = {"segments": {"words": "array<struct<word: string>>", "matches": "array<struct<status: string>>"}, "matches": {}}
DOC_NODES = {"segment": ("segments",), "word": ("segments", "words"), "match": ("matches",), "segment_match": ("segments", "matches")}


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Quoted periods and gaps of each transcript on its word and time axes."""
    m = table(spark, d, "verified_matches")
    axes = F.array(
        F.struct(F.lit("word").alias("axis"), F.lit(True).alias("positions"), F.col("word_start").cast("long").alias("lo"), F.col("word_end").cast("long").alias("hi")),
        F.struct(F.lit("time").alias("axis"), F.lit(False).alias("positions"), intervals.whole(F.col("start"), 1000).alias("lo"), intervals.whole(F.col("end"), 1000).alias("hi")),
    )
    rows = m.select("transcript_id", F.explode(axes).alias("a")).select("transcript_id", "a.*")
    width = F.when(F.col("positions"), 256).otherwise(60_000)  # words, and milliseconds
    out = intervals.merge_positions(rows, ["transcript_id", "axis"], "lo", "hi", "positions", width)
    return out.select("transcript_id", "axis", "kind", "lo", "hi")


P1_SQL = """
WITH i AS (
  SELECT transcript_id, 'word' AS axis, CAST(word_start AS BIGINT) AS lo, CAST(word_end AS BIGINT) AS hi, 1 AS u FROM verified_matches
  UNION ALL
  SELECT transcript_id, 'time', CAST(round(start * 1000) AS BIGINT), CAST(round("end" * 1000) AS BIGINT), 0 FROM verified_matches
), v AS (SELECT * FROM i WHERE lo <= hi),
b AS (SELECT *, max(hi) OVER (PARTITION BY transcript_id, axis ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM v),
n AS (SELECT *, sum(CASE WHEN seen IS NULL OR lo > seen + u THEN 1 ELSE 0 END) OVER (PARTITION BY transcript_id, axis ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM b),
p AS (SELECT transcript_id, axis, g, min(lo) AS lo, max(hi) AS hi, max(u) AS u FROM n GROUP BY ALL),
q AS (SELECT *, lead(lo) OVER (PARTITION BY transcript_id, axis ORDER BY g) AS nxt FROM p)
SELECT transcript_id, axis, 'period' AS kind, lo, hi FROM p
UNION ALL
SELECT transcript_id, axis, 'gap', hi + u, nxt - u FROM q WHERE nxt IS NOT NULL
"""


def p4_documents(spark: SparkSession, d: str) -> DataFrame:
    return nested.parse_documents(table(spark, d, "raw_records"), "record_id", "body", DOC_LISTS, {"segments": "id: string", "matches": "status: string"})


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Every child object of every JSON body with its parent's and its own position."""
    import pyarrow as pa

    emit = nested.node_rows(DOC_NODES, pa.int64())
    out = nested.flatten(p4_documents(spark, d), "record_id", emit, "doc", "key bigint, node string, parent_pos int, pos int")
    return out.withColumnRenamed("key", "record_id")


def _typed(df: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
    """Leaves of text bodies in their types; what does not fit is null."""
    keys = [c for c in ("record_id", "parent_pos", "pos") if c in df.columns]
    return df.select(*keys, *[F.col(n).try_cast(t).alias(n) for n, t in fields])


DOC_FIELDS = [("schema_version", "string"), ("surah", "string"), ("surah_order", "int"), ("episode", "int"), ("source_audio", "string"), ("transcribed_at", "string"), ("model", "string"), ("language", "string"), ("language_probability", "double"), ("duration_seconds", "double"), ("source_transcript", "string"), ("primary_surah_no", "int"), ("total_matches", "int"), ("accepted", "int"), ("review", "int"), ("cross_surah", "int")]
SEGMENT_FIELDS = [("id", "int"), ("start", "double"), ("end", "double"), ("text", "string"), ("avg_logprob", "double"), ("no_speech_prob", "double"), ("enriched_text", "string")]
WORD_FIELDS = [("word", "string"), ("start", "double"), ("end", "double"), ("probability", "double")]
MATCH_FIELDS = [("surah", "string"), ("surah_no", "int"), ("ayah", "int"), ("ayah_end", "int"), ("verse_id", "int"), ("confidence", "double"), ("status", "string"), ("start", "double"), ("end", "double"), ("word_start", "int"), ("word_end", "int"), ("transcript_text", "string"), ("canonical_quoted", "string"), ("fuzz_score", "double"), ("coverage", "double"), ("is_cross_surah", "boolean"), ("chain_id", "int")]


def _children(spark: SparkSession, d: str, path: list[str], fields: list[tuple[str, str]]) -> DataFrame:
    leaf = ", ".join(f"`{n}`: string" for n, _ in fields)
    lists, leaves = {"segments": {}, "matches": {}}, {"segments": "id: string", "matches": "status: string"}
    if len(path) == 2:
        lists[path[0]] = {path[1]: f"array<struct<{leaf}>>"}
    else:
        leaves[path[0]] = leaf
    docs = nested.parse_documents(table(spark, d, "raw_records"), "record_id", "body", lists, leaves)
    return _typed(nested.child_table(docs, "record_id", "doc", path, [(n, "string") for n, _ in fields]), fields)


def p4_parents(spark: SparkSession, d: str) -> DataFrame:
    """The documents of all JSON bodies with their own fields: what record_id in the other tables points to."""
    return _typed(nested.parent_table(table(spark, d, "raw_records"), "record_id", "body", ["segments", "matches"], [n for n, _ in DOC_FIELDS]), DOC_FIELDS)


def p4_segments(spark: SparkSession, d: str) -> DataFrame:
    """The segments of all JSON bodies as a flat typed table."""
    return _children(spark, d, ["segments"], SEGMENT_FIELDS)


def p4_matches(spark: SparkSession, d: str) -> DataFrame:
    """The matches of all JSON bodies as a flat typed table."""
    return _children(spark, d, ["matches"], MATCH_FIELDS)


def p4_segment_words(spark: SparkSession, d: str) -> DataFrame:
    """The words of the segments of all JSON bodies as a flat typed table."""
    return _children(spark, d, ["segments", "words"], WORD_FIELDS)


def p4_segment_matches(spark: SparkSession, d: str) -> DataFrame:
    """The matches of the segments of all JSON bodies as a flat typed table."""
    return _children(spark, d, ["segments", "matches"], MATCH_FIELDS)


def p4_words(spark: SparkSession, d: str) -> DataFrame:
    """The words of all segments of the typed transcripts as a flat table."""
    t = table(spark, d, "transcripts").select("transcript_id", F.struct("segments").alias("doc"))
    fields = [("word", "string"), ("start", "double"), ("end", "double"), ("probability", "double")]
    return nested.child_table(t, "transcript_id", "doc", ["segments", "words"], fields)


# The documents of the bodies: one layer of envelope or quoting a step, until none is left.
_DOCS_SQL = """
u AS (
  SELECT record_id, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS j, true AS more FROM raw_records
  UNION ALL
  SELECT record_id,
    CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j ->> '$') THEN CAST(j ->> '$' AS JSON) END
         WHEN json_type(j) = 'OBJECT' AND coalesce(json_type(j, '$.payload'), 'NULL') <> 'NULL' AND coalesce(json_type(j, '$.segments'), 'NULL') = 'NULL' AND coalesce(json_type(j, '$.matches'), 'NULL') = 'NULL' THEN j -> '$.payload'
         ELSE j END,
    json_type(j) = 'VARCHAR' OR (json_type(j) = 'OBJECT' AND coalesce(json_type(j, '$.payload'), 'NULL') <> 'NULL' AND coalesce(json_type(j, '$.segments'), 'NULL') = 'NULL' AND coalesce(json_type(j, '$.matches'), 'NULL') = 'NULL')
  FROM u WHERE more AND j IS NOT NULL
),
docs AS (SELECT record_id, j AS d FROM u WHERE NOT more AND json_type(j) = 'OBJECT')
"""


def _sql_children(parent: str, up: str, column: str, path: str) -> str:
    """record_id, parent_pos, pos, e of the objects at a path; a lone object is its list's element 0."""
    at = f"{column} -> '$.{path}'"
    a = f"CASE WHEN json_type({at}) = 'ARRAY' THEN from_json({at}, '[\"json\"]') WHEN json_type({at}) = 'OBJECT' THEN [{at}] END"
    return f"SELECT * FROM (SELECT record_id, CAST({up} AS INT) AS parent_pos, CAST(unnest(range(len({a}))) AS INT) AS pos, unnest({a}) AS e FROM {parent}) WHERE json_type(e) = 'OBJECT'"


_NODES_SQL = f"""
WITH RECURSIVE {_DOCS_SQL},
seg AS ({_sql_children("docs", "-1", "d", "segments")}),
mat AS ({_sql_children("docs", "-1", "d", "matches")}),
wor AS ({_sql_children("seg", "pos", "e", "words")}),
sem AS ({_sql_children("seg", "pos", "e", "matches")})
"""
P4_SQL = _NODES_SQL + " UNION ALL ".join(f"SELECT record_id, '{node}' AS node, parent_pos, pos FROM {t}" for node, t in (("segment", "seg"), ("word", "wor"), ("match", "mat"), ("segment_match", "sem")))


def _sql_fields(fields: list[tuple[str, str]], column: str) -> str:
    kinds = {"string": "VARCHAR", "int": "INT", "double": "DOUBLE", "boolean": "BOOLEAN"}
    return ", ".join(f"""TRY_CAST({column} ->> '$.{n}' AS {kinds[t]}) AS "{n}\"""" for n, t in fields)


def _sql_table(t: str, fields: list[tuple[str, str]]) -> str:
    return f"{_NODES_SQL} SELECT record_id, parent_pos, pos, {_sql_fields(fields, 'e')} FROM {t}"


P4_WORDS_SQL = """
WITH s AS (SELECT transcript_id, unnest(segments) AS s, generate_subscripts(segments, 1) - 1 AS parent_pos FROM transcripts),
w AS (SELECT transcript_id, parent_pos, unnest(s.words) AS w, generate_subscripts(s.words, 1) - 1 AS pos FROM s)
SELECT transcript_id, CAST(parent_pos AS INT) AS parent_pos, CAST(pos AS INT) AS pos, w.word AS word, w.start AS start, w."end" AS "end", w.probability AS probability
FROM w WHERE w IS NOT NULL
"""


def _timed(segments: str) -> Column:
    """Valid segments as (lo, id, hi) in milliseconds; of the segments only these three fields are read."""
    parts = F.arrays_zip(*[F.col(f"{segments}.{n}").alias(n) for n in ("id", "start", "end")])
    t = F.transform(parts, lambda s: F.struct(intervals.whole(s["start"], 1000).alias("lo"), s["id"].alias("id"), intervals.whole(s["end"], 1000).alias("hi")))
    return F.filter(t, lambda s: s["lo"] <= s["hi"])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Pieces of at most 60 s of every longer transcript, one segment of overlap."""
    t = table(spark, d, "transcripts")
    out = pieces.split_sequence(t, "transcript_id", _timed("segments"), 60_000)
    return out.select("transcript_id", "piece_no", F.col("first_part").alias("first_segment"), F.col("last_part").alias("last_segment"))


P6_SQL = """
WITH RECURSIVE s AS (SELECT transcript_id, unnest(segments) AS s FROM transcripts),
m AS (SELECT transcript_id, s.id AS id, CAST(round(s.start * 1000) AS BIGINT) AS lo, CAST(round(s."end" * 1000) AS BIGINT) AS hi FROM s),
v AS (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY lo, id) AS i FROM m WHERE lo <= hi),
n AS (SELECT transcript_id, max(i) AS n FROM v GROUP BY transcript_id HAVING max(hi) - min(lo) > 60000),
j AS (
  SELECT a.transcript_id, a.i, greatest(a.i, coalesce(min(b.i) - 1, any_value(n.n))) AS j
  FROM v a JOIN n USING (transcript_id) LEFT JOIN v b ON b.transcript_id = a.transcript_id AND b.i >= a.i AND b.hi > a.lo + 60000 GROUP BY a.transcript_id, a.i
),
x AS (
  SELECT j.transcript_id, j.i, j.j, CASE WHEN j.j > j.i AND greatest(l.hi, f.hi) - l.lo <= 60000 THEN j.j ELSE j.j + 1 END AS nxt, n.n
  FROM j JOIN n USING (transcript_id) JOIN v l ON l.transcript_id = j.transcript_id AND l.i = j.j LEFT JOIN v f ON f.transcript_id = j.transcript_id AND f.i = j.j + 1
),
p AS (
  SELECT transcript_id, 1 AS piece_no, i, j, nxt, n FROM x WHERE i = 1
  UNION ALL SELECT x.transcript_id, p.piece_no + 1, x.i, x.j, x.nxt, x.n FROM p JOIN x ON x.transcript_id = p.transcript_id AND x.i = p.nxt WHERE p.j < p.n
)
SELECT p.transcript_id, p.piece_no, a.id AS first_segment, b.id AS last_segment FROM p JOIN v a ON a.transcript_id = p.transcript_id AND a.i = p.i JOIN v b ON b.transcript_id = p.transcript_id AND b.i = p.j
"""


def p6_texts(spark: SparkSession, d: str) -> DataFrame:
    """All documents in pieces of at most 1,000 characters, up to 100 of them from the piece before."""
    return pieces.split_text(table(spark, d, "documents"), "doc_id", "text", 1000, 100)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Stated episode counts that differ from the distinct episodes of the scan."""
    seen = table(spark, d, "transcripts").where("surah IS NOT NULL")
    n = skew.distinct_counts(seen, ["scan_no", "surah"], "episode").select("scan_no", "surah", "n_distinct")
    s = table(spark, d, "statistics").where("episode_count IS NOT NULL").select("scan_no", "surah", "episode_count")
    return s.join(n, ["scan_no", "surah"], "left").where(F.coalesce("n_distinct", F.lit(0)) != F.col("episode_count")).select("scan_no", "surah")


P7_SQL = """
SELECT s.scan_no, s.surah FROM statistics s
LEFT JOIN (SELECT scan_no, surah, count(DISTINCT episode) AS n FROM transcripts WHERE surah IS NOT NULL GROUP BY ALL) t
  ON t.scan_no = s.scan_no AND t.surah = s.surah
WHERE s.episode_count IS NOT NULL AND s.episode_count <> coalesce(t.n, 0)
"""


def p7_matches(spark: SparkSession, d: str) -> DataFrame:
    """Per primary surah: matches, distinct verses, the most quoted verse and the median verse."""
    return skew.profile(table(spark, d, "verified_matches"), ["primary_surah"], "verse_id")


P7_MATCHES_SQL = """
WITH c AS (SELECT primary_surah, verse_id, count(*) AS w FROM verified_matches GROUP BY ALL),
n AS (SELECT primary_surah, CAST(sum(w) AS BIGINT) AS n_rows, CAST(coalesce(sum(w) FILTER (verse_id IS NOT NULL), 0) AS BIGINT) AS n_values, count(verse_id) AS n_distinct, min(verse_id) AS low, max(verse_id) AS high FROM c GROUP BY ALL),
m AS (SELECT *, row_number() OVER (PARTITION BY primary_surah ORDER BY w DESC, verse_id) AS r FROM c WHERE verse_id IS NOT NULL),
u AS (SELECT *, sum(w) OVER (PARTITION BY primary_surah ORDER BY verse_id ROWS UNBOUNDED PRECEDING) AS reach FROM c WHERE verse_id IS NOT NULL)
SELECT n.primary_surah, n_rows, n_values, n_distinct, m.verse_id AS mode, m.w AS mode_rows, low, high,
  (SELECT min(verse_id) FROM u WHERE u.primary_surah IS NOT DISTINCT FROM n.primary_surah AND reach >= greatest(1, ceil(n_values * 0.5))) AS quantile
FROM n LEFT JOIN m ON m.primary_surah IS NOT DISTINCT FROM n.primary_surah AND m.r = 1
"""

QUERIES: dict[str, Query] = {"p1_found": p1_found, "p4_found": p4_found, "p4_parents": p4_parents, "p4_segment_words": p4_segment_words, "p4_segment_matches": p4_segment_matches, "p4_segments": p4_segments, "p4_matches": p4_matches, "p4_words": p4_words, "p6_found": p6_found, "p6_texts": p6_texts, "p7_found": p7_found, "p7_matches": p7_matches}
ORACLES: dict[str, str] = {"p1_found": P1_SQL, "p4_words": P4_WORDS_SQL, "p4_found": P4_SQL, "p4_segments": _sql_table("seg", SEGMENT_FIELDS), "p4_segment_words": _sql_table("wor", WORD_FIELDS), "p4_matches": _sql_table("mat", MATCH_FIELDS), "p4_segment_matches": _sql_table("sem", MATCH_FIELDS), "p4_parents": f"WITH RECURSIVE {_DOCS_SQL} SELECT record_id, {_sql_fields(DOC_FIELDS, 'd')} FROM docs", "p6_found": P6_SQL, "p7_found": P7_SQL, "p7_matches": P7_MATCHES_SQL}

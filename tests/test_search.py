import duckdb
from pyspark.sql import functions as F

from spanloom.config import Config
from spanloom.operators import align, corpus, words
from spanloom.plans import quotes
from tests.test_quotes import corpus_of, docs_of


def test_a_word_that_every_passage_has_is_not_looked_up(spark):
    """Half of all rows hold one word: queries with a rarer one meet only the passages of that one."""
    from spanloom.operators import search

    p = spark.createDataFrame([(i, ["hot", f"w{i % 500}"] if i % 2 else ["hot"]) for i in range(1000)], "id int, t array<string>")
    q = spark.createDataFrame([(1, ["hot", "w7"]), (2, ["w7", "w9"]), (3, ["absent", "hot"]), (4, ["hot", "hot"]), (5, None)], "q int, w array<string>")
    got = {}
    for r in search.all_terms(p, "id", "t", q, "q", "w").collect():
        got.setdefault(r.q, set()).add(r.id)
    assert got == {1: {7, 507}, 4: set(range(1000))}


def test_one_edit_and_subsequence_in_sql_are_those_of_the_kernels(spark):
    from spanloom.functions import scores

    pairs = [("قلم", "قلمي"), ("قلم", "علم"), ("قلم", "قمل"), ("كتاب", "كتب"), ("نور", "ناور"), ("ab", "ba"), ("a", "b"), ("abcd", "xbcdx"), ("", "a")]
    for a, b in pairs:
        edit, lcs = duckdb.execute(f"SELECT {quotes._sql_one_edit('a', 'b')}, {quotes._sql_lcs('a', 'b')} FROM (SELECT ? AS a, ? AS b)", [a, b]).fetchone()
        assert (edit, lcs) == (scores.one_edit(a, b), scores.lcs(a, b)), (a, b)


def test_one_document_with_most_of_the_rows(spark):
    """A document that is longer than all others together gives the same spans as its parts."""
    verses = corpus_of(spark, ["باب دار قلم كتاب نور", "ليل نهار شمس قمر نجم"])
    part = "قال باب دار قلم كتاب نور ثم ليل نهار شمس قمر نجم ثم "
    docs = docs_of(spark, [part * 400, part, part])
    arrays, p = words.word_arrays(docs, "transcript_id"), corpus.passages(verses)
    got = align.raw_matches(arrays, p, Config(bigram_df_cap=None)).groupBy("doc").agg(F.count("*").alias("n"), F.countDistinct("word_start").alias("k")).collect()
    assert {r.doc: (r.n, r.k) for r in got} == {0: (800, 800), 1: (2, 2), 2: (2, 2)}

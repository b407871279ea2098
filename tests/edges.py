"""Tables for the edge tests: emptied, and with null rows, repeated rows and other columns."""

from pyspark.sql import functions as F

FROM = "/root/testdata/sf0.001"
TABLES = ("verses", "statistics", "transcripts", "verified_matches", "raw_records", "documents", "eval_items", "lang_samples", "events", "customer", "orders")
CLASHING = ("lo", "hi", "kind", "axis", "shard", "value", "weight", "doc", "words", "id", "item", "pos", "node", "ids", "g", "h1", "k0", "line_no", "confidence", "owner", "status_", "_key", "_t", "key", "odd", "wider", "n_words", "word_no")


def emptied(spark, to):
    for t in TABLES:
        spark.read.parquet(f"{FROM}/{t}.parquet").limit(0).write.parquet(f"{to}/{t}.parquet")
    return to


def widened(spark, to):
    """Other columns with names that the operators use inside."""
    for t in TABLES:
        df = spark.read.parquet(f"{FROM}/{t}.parquet")
        df.select("*", *[F.lit("clash").alias(c) for c in CLASHING if c not in df.columns]).write.parquet(f"{to}/{t}.parquet")
    return to


def nulled(spark, to):
    """A row of nulls in every table, twice."""
    for t in TABLES:
        df = spark.read.parquet(f"{FROM}/{t}.parquet")
        df.unionByName(spark.createDataFrame([tuple([None] * len(df.columns))] * 2, df.schema)).write.parquet(f"{to}/{t}.parquet")
    return to


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))

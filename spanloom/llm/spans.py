"""Long exact spans shared between records, by level-wise doubling.

Windows of half the least length are taken from every text; those found in one
owner only are dropped. Two surviving windows side by side make a window of
twice the length, which has to be found in another owner again, and so on.

What "found in another owner" costs: each window is reduced to two 64-bit
hashes, and per hash pair only the smallest and the largest owner are kept,
by partial aggregation before the shuffle. So a passage that a third of all
records hold is one small row, no pairs of records are ever made, and nothing
is collected per passage. The two hashes have 128 bits together: over 10^13
windows, the chance of any false match is below 10^-12.

Defined results: null and empty texts and those under ``min_words`` words
share nothing; repeated rows count once; a text repeated by its own owner only
is not shared; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.sources.tables import cut

TEXT = ["field_name", "owner", "item"]
#: Passages are hot that hold more than one in HOT of all rows; tasks that a hot passage is dealt over.
HOT, SALTS = 1000, 64


def words_of(text: Column) -> Column:
    """The non-empty pieces between plain spaces."""
    return F.filter(F.split(text, " "), lambda w: w != "")


def _in_other_owner(windows: DataFrame) -> DataFrame:
    """The windows (h1, h2, ...) that also occur in another owner.

    A passage that many texts have is one row on one side, but a row of each
    of them on the other. Passages with more than one in ``HOT`` of all rows
    are at most ``HOT`` in number, so their list may be broadcast; their rows
    are dealt over ``SALTS`` tasks by text, and so are copies of their one row.
    """
    both = cut(windows.groupBy("h1", "h2").agg(F.min("owner").alias("a"), F.max("owner").alias("b"), F.count("*").alias("n")).where("a < b").select("h1", "h2", "n"))
    all_rows = both.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    hot = F.broadcast(both.where(F.col("n") * HOT > all_rows.scalar()).select(F.col("h1").alias("x1"), F.col("h2").alias("x2")))
    at = (F.col("h1") == F.col("x1")) & (F.col("h2") == F.col("x2"))
    salt = lambda s: F.when(F.col("x1").isNotNull(), s).otherwise(F.lit(0))
    dealt = windows.join(hot, at, "left").withColumn("salt", salt(F.pmod(F.xxhash64(*TEXT), F.lit(SALTS)).cast("int")))
    once = both.select("h1", "h2").join(hot, at, "left").select("h1", "h2", F.explode(F.when(F.col("x1").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    return dealt.join(once, ["h1", "h2", "salt"], "left_semi").drop("salt", "x1", "x2")


def _wider(windows: DataFrame, by: int) -> DataFrame:
    """Windows lengthened by ``by`` words, where the window ``by`` words later survives too."""
    w = Window.partitionBy(*TEXT).orderBy("pos").rangeBetween(by, by)
    n = windows.withColumn("n1", F.first("h1").over(w)).withColumn("n2", F.first("h2").over(w)).where("n1 IS NOT NULL")
    return n.select(*TEXT, "pos", F.xxhash64("h1", "n1").alias("h1"), F.xxhash64(F.lit(1), "h2", "n2").alias("h2"))


def repeated_windows(texts: DataFrame, owner: str, min_words: int = 16) -> DataFrame:
    """Starts of the windows of ``min_words`` words that occur in another owner: TEXT, pos, h1, h2.

    ``texts`` has field_name, the owner, item_id and text. Written once to the
    checkpoint folder.
    """
    half = (min_words + 1) // 2
    t = texts.select(F.col("field_name"), F.col(owner).alias("owner"), F.col("item_id").alias("item"), words_of(F.col("text")).alias("w")).where(F.size("w") >= min_words)
    hashes = F.transform(
        F.sequence(F.lit(1), F.size("w") - half + 1),
        lambda i: F.struct(F.xxhash64(F.slice("w", i, half)).alias("h1"), F.xxhash64(F.lit(1), F.slice("w", i, half)).alias("h2")),
    )
    windows = t.select(*TEXT, F.posexplode(hashes).alias("pos", "h")).select(*TEXT, "pos", "h.h1", "h.h2")
    return cut(_in_other_owner(cut(_wider(_in_other_owner(windows), min_words - half))))


def runs(windows: DataFrame, length: int) -> DataFrame:
    """Longest runs of words covered by windows of ``length`` words: TEXT, first_word, last_word."""
    by_pos = Window.partitionBy(*TEXT).orderBy("pos")
    return (
        windows.select(*TEXT, "pos")
        .withColumn("fresh", F.coalesce(F.col("pos") > F.lag("pos").over(by_pos) + length, F.lit(True)).cast("int"))
        .withColumn("run", F.sum("fresh").over(by_pos.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*TEXT, "run")
        .agg(F.min("pos").cast("int").alias("first_word"), (F.max("pos") + length - 1).cast("int").alias("last_word"))
        .drop("run")
    )


def shared_spans(texts: DataFrame, owner: str, min_words: int = 16) -> DataFrame:
    """Columns field_name, the owner, item_id, first_word, last_word."""
    out = runs(repeated_windows(texts, owner, min_words), min_words)
    return out.select("field_name", F.col("owner").alias(owner), F.col("item").alias("item_id"), "first_word", "last_word")


def shared_share(texts: DataFrame, owner: str, min_words: int = 16) -> DataFrame:
    """Per text that is not null: n_words, n_shared of them, their share, and level, the longest doubled length that still occurs elsewhere; 0 where nothing is shared."""
    level, windows = min_words, repeated_windows(texts, owner, min_words)
    covered = runs(windows, min_words).groupBy(*TEXT).agg(F.sum(F.col("last_word") - F.col("first_word") + 1).alias("n_shared"))
    levels = windows.select(*TEXT, F.lit(level).alias("level"))
    while True:
        windows = cut(_in_other_owner(cut(_wider(windows, level))))
        level *= 2
        if windows.isEmpty():
            break
        levels = levels.unionByName(windows.select(*TEXT, F.lit(level).alias("level")))
    top = levels.groupBy(*TEXT).agg(F.max("level").alias("level"))
    same = [F.col(f"c.{n}").eqNullSafe(F.col(f"t.{n}")) for n in TEXT]
    shared = covered.alias("c").join(top.alias("t"), same).select("c.*", "t.level")
    n = texts.where("text IS NOT NULL").select("field_name", F.col(owner).alias("owner"), F.col("item_id").alias("item"), F.size(words_of(F.col("text"))).alias("n"))
    n = n.groupBy(*TEXT).agg(F.max("n").alias("n_words"))  # repeated rows count once
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"c.{c}")) for c in TEXT]
    out = n.alias("n").join(shared.alias("c"), same, "left")
    n_shared, level = F.coalesce("n_shared", F.lit(0).cast("long")).alias("n_shared"), F.coalesce("level", F.lit(0)).alias("level")
    share = F.when(F.col("n_shared") > 0, F.col("n_shared") / F.col("n_words")).otherwise(0.0).alias("share")
    return out.select(F.col("n.field_name"), F.col("n.owner").alias(owner), F.col("n.item").alias("item_id"), "n_words", n_shared, share, level)

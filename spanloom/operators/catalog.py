"""Cataloguing files by their names: ordered patterns, lookups, statistics, paths.

Defined results: a null or unparsable name goes to the unmatched side; a name
without a known order gets order 9999, introductions 0; digits of the Arabic
and Persian rows count as digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# File name extensions, patterns and spellings that results must agree with.
VIDEO = r"(?i)\.(mp4|mkv|avi|mov|webm|flv)$"
INTRO = r"مقدمة\s+رقم\s+(\d+)"
INTRO_NAME = "مقدمة"
L = r"\x{0600}-\x{06FF}"
PATTERNS = (
    rf"تفسير\s+سورة\s+([{L}][{L}\s]*?)\s+رقم\s+(\d+)",
    rf"سورة\s+([{L}][{L}\s]*?)\s+حلقة\s+رقم\s+(\d+)",
    rf"سورة\s+([{L}][{L}\s]*?)\s+الحلقة\s+رقم\s+(\d+)",
    rf"سورة\s+([{L}][{L}]+?)الحلقة\s*رقم\s+(\d+)",
    rf"سورة\s+([{L}][{L}\s]*?)\s+الحلقات\s+رقم\s+(\d+)",
    rf"سورة\s+([{L}][{L}\s]*?)\s+رقم\s+(\d+)",
)
SPELLINGS = {"ابراهيم": "إبراهيم", "الاخلاص": "الإخلاص", "الاعلى": "الأعلى"}
PARTS = (("الأول", "_part1"), ("الثاني", "_part2"), ("الثالث", "_part3"), ("الرابع", "_part4"))
UNKNOWN_ORDER = 9999


def digits(text: Column) -> Column:
    """Digits of the Arabic and Persian rows as ASCII digits."""
    return F.translate(text, "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "01234567890123456789")


def stem(path: Column) -> Column:
    """File name without folders and the last extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def spelling(name: Column) -> Column:
    name = F.trim(F.regexp_replace(name, r"\s+", " "))
    known = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    return F.coalesce(known[name], name)


def parse(df: DataFrame, path: str) -> DataFrame:
    """``df`` with group, number and is_intro; null where no pattern fits."""
    mark = "\u0001"

    def fit(s: Column) -> Column:
        intro = F.when(s.rlike(INTRO), F.concat(F.lit(mark), F.regexp_extract(s, INTRO, 1)))
        return F.split(F.coalesce(intro, *[F.when(s.rlike(p), F.concat(F.regexp_extract(s, p, 1), F.lit(mark), F.regexp_extract(s, p, 2))) for p in PATTERNS]), mark)

    # As the parameter of a function the stem is made once, not once in every place that it stands.
    out = df.withColumn("_h", F.explode_outer(F.transform(F.array(digits(stem(F.col(path)))), fit)))
    intro = F.get("_h", F.lit(0)) == ""
    return out.select(
        *df.columns,
        F.when(intro, F.lit(INTRO_NAME)).otherwise(spelling(F.get("_h", F.lit(0)))).alias("group"),
        F.get("_h", F.lit(1)).try_cast("int").alias("number"),
        F.coalesce(intro, F.lit(False)).alias("is_intro"),
    )


def route(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with a name and number, and the others."""
    good = F.col("group").isNotNull() & F.col("number").isNotNull()
    return parsed.where(good), parsed.where(~good)


def with_order(df: DataFrame, name: str, orders: DataFrame, order_name: str, order: str, intro: Column | None = None) -> DataFrame:
    """``df`` with group_order: looked up by the name, then by its lighter spelling, then the default.

    ``orders`` has unique names. Joined, not broadcast by hint: Spark
    broadcasts it if its size allows.
    """
    light = F.trim(F.replace(F.col(name), F.lit("ال "), F.lit("ال")))
    a = orders.select(F.col(order_name).alias("_n1"), F.col(order).alias("_o1"))
    b = orders.select(F.col(order_name).alias("_n2"), F.col(order).alias("_o2"))
    out = df.join(a, F.col(name) == F.col("_n1"), "left").join(b, light == F.col("_n2"), "left")
    found = F.coalesce(F.nullif(F.col("_o1"), F.lit(0)), F.col("_o2"), F.lit(UNKNOWN_ORDER))
    return out.withColumn("group_order", F.when(intro, 0).otherwise(found) if intro is not None else found).drop("_n1", "_n2", "_o1", "_o2")


def without_order(ordered: DataFrame) -> DataFrame:
    """Of :func:`with_order`, the rows whose name has no known order; they are reported with the unmatched."""
    return ordered.where((F.col("group_order") == UNKNOWN_ORDER) & ~F.col("is_intro"))


def statistics(df: DataFrame, name: str, order: str) -> DataFrame:
    """Per group: its order and number of rows."""
    return df.groupBy(name).agg(F.min(order).alias("group_order"), F.count("*").alias("n_rows"))


def output_path(root: str, group: Column, number: Column, file_stem: Column, extension: str) -> Column:
    """root/group/ep_NNN[_partK].extension; numbers over 999 keep all their digits."""
    part = F.lit("")
    for word, suffix in reversed(PARTS):
        part = F.when(file_stem.contains("الجزء " + word) | file_stem.contains("الجزء_" + word), suffix).otherwise(part)
    return F.concat(F.lit(root + "/"), group, F.lit("/ep_"), F.format_string("%03d", number), part, F.lit("." + extension))

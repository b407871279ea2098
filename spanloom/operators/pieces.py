"""Cutting oversized items at natural boundaries, with overlap.

Two forms of the same operator:

* :func:`split_sequence` for items made of measured parts (segments with start
  and end). A fold over the ordered parts in SQL array functions; a pattern
  cannot express it, because where a piece ends depends on differences of
  arbitrary numbers.
* :func:`split_text` for texts. A regular expression with bounded quantifiers
  whose alternatives are ordered by boundary strength takes as much as fits,
  falling back to single characters; the overlap looks back over the end of
  the piece before. All in SQL array functions, without a Python worker.

Defined results: null or empty items have no pieces; parts with a null bound
or an end before their start are left out; ties are ordered by part id;
repeated rows give the same pieces again; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Pieces of one block of the fold's result.
_BLOCK = 256


def split_sequence(df: DataFrame, key: str, parts: Column, limit: int) -> DataFrame:
    """Pieces of the items longer than ``limit``.

    ``parts`` is ARRAY<STRUCT<lo LONG, id INT, hi LONG>>, each valid. Columns:
    the key, piece_no from 1, first_part, last_part. A piece takes parts while
    its latest hi minus its first lo is within the limit; the next one begins
    with the last part again if that part and its follower fit together.
    """
    a = F.array_sort(parts)
    piece = "struct<first:int,last:int>"
    state = f"struct<n:int, lo:bigint, hi:bigint, first:int, last:struct<lo:bigint,id:int,hi:bigint>, out:array<{piece}>, full:array<array<{piece}>>>"
    zero = F.from_json(F.lit('{"n":0,"out":[],"full":[]}'), state)

    def close(s: Column) -> Column:
        """The pieces with the one in hand; every array is copied when it grows, so they are kept in blocks."""
        one = F.struct(s["first"].alias("first"), s["last"]["id"].alias("last"))
        return F.when(s["n"] == 0, F.struct(s["out"].alias("out"), s["full"].alias("full"))).when(
            F.size(s["out"]) >= _BLOCK, F.struct(F.array(one).alias("out"), F.array_append(s["full"], s["out"]).alias("full"))
        ).otherwise(F.struct(F.array_append(s["out"], one).alias("out"), s["full"].alias("full")))

    def step(s: Column, p: Column) -> Column:
        top = F.greatest(s["hi"], p["hi"])
        fits = (s["n"] > 0) & (top - s["lo"] <= limit)
        back = (s["n"] > 1) & (F.greatest(s["last"]["hi"], p["hi"]) - s["last"]["lo"] <= limit)

        def be(n: Column, lo: Column, hi: Column, first: Column, kept: Column) -> Column:
            return F.struct(n.cast("int").alias("n"), lo.alias("lo"), hi.alias("hi"), first.alias("first"), p.alias("last"), kept["out"].alias("out"), kept["full"].alias("full"))

        def cut(kept: Column) -> Column:
            return F.when(back, be(F.lit(2), s["last"]["lo"], F.greatest(s["last"]["hi"], p["hi"]), s["last"]["id"], kept)).otherwise(be(F.lit(1), p["lo"], p["hi"], p["id"], kept))

        return F.when(fits, be(s["n"] + 1, s["lo"], top, s["first"], s)).otherwise(F.get(F.transform(F.array(close(s)), cut), F.lit(0)))

    end = lambda s: F.flatten(F.transform(F.array(close(s)), lambda x: F.concat(F.flatten(x["full"]), x["out"])))
    long_ones = df.select(F.col(key).alias("_key"), a.alias("_a")).where(F.size("_a") > 0).where(F.array_max(F.transform("_a", lambda p: p["hi"])) - F.col("_a")[0]["lo"] > limit)
    pieces = long_ones.select("_key", F.posexplode(F.aggregate("_a", zero, step, end)).alias("_p", "_x"))
    return pieces.select(F.col("_key").alias(key), (F.col("_p") + 1).alias("piece_no"), F.col("_x.first").alias("first_part"), F.col("_x.last").alias("last_part"))


#: Boundaries from the strongest to the weakest.
BOUNDARIES = (r"\n\s{0,8}\n", r"\n", r"[.!?؟۔]\s{1,8}", r"[,;:،؛]\s{1,8}", r"\s")


def piece_pattern(limit: int, least: float = 0.5) -> str:
    """Alternatives, strongest boundary first, that take up to ``limit`` characters; then any characters.

    A boundary counts first only in the part of the piece beyond ``least`` of the
    limit, so that a strong one near the start does not make tiny pieces. Where
    there is none, the last white space before that is taken. The
    rest of the text, if it fits, is a piece.
    """
    low = max(1, int(limit * least))
    tries = [rf".{{1,{limit}}}\z", *[rf".{{{low},{limit}}}(?<={b})" for b in BOUNDARIES], rf".{{1,{limit}}}(?<={BOUNDARIES[-1]})", rf".{{1,{limit}}}"]
    return "(?s)" + "|".join(f"(?:{t})" for t in tries)


def split_text(df: DataFrame, key: str, text: str, limit: int, overlap: int = 0) -> DataFrame:
    """Pieces of at most ``limit`` characters (texts within it are one piece).

    Columns: the key, piece_no from 1, n_back, piece. A piece is ``n_back``
    characters from the end of the piece before (at most ``overlap``, beginning
    with a word where there is one) and its own text; the own texts put
    together are the text.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than limit")
    own = F.regexp_extract_all(F.col("_t"), F.lit(piece_pattern(limit - overlap)), F.lit(0))

    def piece(i: Column, x: Column) -> Column:
        before = F.when(i > 0, F.col("_own")[i - 1]).otherwise("")
        end = F.right(before, F.lit(overlap)) if overlap else F.lit("")
        back = F.when(F.length(before) <= overlap, end).otherwise(F.regexp_replace(end, r"(?s)\A\S*\s+(?=\S)", ""))
        return F.struct(F.length(back).alias("n_back"), F.concat(back, x).alias("piece"))

    base = df.select(F.col(key).alias("_key"), F.col(text).alias("_t")).where("length(_t) > 0").select("_key", own.alias("_own"))
    rows = base.select("_key", F.posexplode(F.transform("_own", lambda x, i: piece(i, x))).alias("_p", "_x"))
    return rows.select(F.col("_key").alias(key), (F.col("_p") + 1).alias("piece_no"), "_x.n_back", "_x.piece")

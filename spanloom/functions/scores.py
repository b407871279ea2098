"""Scores of matches: kernels in Python for Arrow functions, and column expressions."""

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel: a set bit is a column not yet reached."""
    if a == b:
        return len(a)
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & places.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Similarity from 0 to 100 under insertions and deletions; two empty strings are equal."""
    n = len(a) + len(b)
    return 200.0 * lcs(a, b) / n if n else 100.0


def one_edit(a: str, b: str) -> bool:
    """Whether at most one insertion, deletion or substitution parts them."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


@lru_cache(maxsize=500_000)
def _alike(a: str, b: str) -> bool:
    n, m = len(a), len(b)
    if abs(n - m) <= 1 and one_edit(a, b):
        return True
    # the subsequence is at most the shorter word, which settles most pairs
    return min(n, m) >= 4 and 200 * min(n, m) >= 85 * (n + m) and ratio(a, b) >= 85.0


def alike(a: str, b: str) -> bool:
    """Words that count as the same: equal, one edit apart, or both of four letters and 85 % similar."""
    return a == b or _alike(a, b)


def length_factor(n: Column) -> Column:
    """Trust in a match by its number of words (fixed values)."""
    return F.when(n >= 5, 1.0).when(n == 4, 0.96).when(n == 3, 0.85).when(n == 2, 0.66).otherwise(0.40)


#: The same for kernels: words of a match -> trust.
FACTORS = {1: 0.40, 2: 0.66, 3: 0.85, 4: 0.96}


def factor(n: int) -> float:
    return 1.0 if n >= 5 else FACTORS.get(n, 0.40)


def half_even(x: Column, digits: int) -> Column:
    """``x`` to the nearest decimal, ties to the even digit, by the exact value of the double.

    ``bround`` rounds the shortest decimal that prints as ``x``, which calls
    values ties that are not. Here x is split in two parts whose products with
    the power of ten are exact, so the side of the tie is exact too (up to 2^52
    in the last digit).
    """
    s = F.lit(float(10**digits))
    # Each step is the parameter of the next one's function, so it is worked out once and not once a use.
    halves = F.transform(F.array(x.cast("double")), lambda v: F.struct(v.alias("v"), v.cast("float").cast("double").alias("hi")))
    scaled = F.transform(halves, lambda h: F.struct((h["hi"] * s).alias("a"), ((h["v"] - h["hi"]) * s).alias("b")))
    floored = F.transform(scaled, lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b"), F.floor(p["a"] + p["b"]).cast("double").alias("low")))
    sided = F.transform(floored, lambda p: F.struct(p["low"].alias("low"), ((p["a"] - (p["low"] + 0.5)) + p["b"]).alias("side")))
    whole = F.transform(sided, lambda p: F.when(p["side"] > 0, p["low"] + 1).when(p["side"] < 0, p["low"]).otherwise(p["low"] + F.pmod(p["low"], F.lit(2.0))))
    return F.get(whole, F.lit(0)) / s


def confidence(score: Column, n: Column) -> Column:
    return half_even(score / 100.0 * length_factor(n), 4)


def coverage(matched: Column, of: Column) -> Column:
    return F.when(of > 0, half_even(F.least(F.lit(1.0), matched / F.when(of > 0, of)), 4)).otherwise(F.lit(0.0))


def overlap(a_lo: Column, a_hi: Column, b_lo: Column, b_hi: Column) -> Column:
    """Words two inclusive spans share; 0 or less where they are apart."""
    return F.least(a_hi, b_hi) - F.greatest(a_lo, b_lo) + 1


def jaccard(a_lo: Column, a_hi: Column, b_lo: Column, b_hi: Column) -> Column:
    inter = F.greatest(overlap(a_lo, a_hi, b_lo, b_hi), F.lit(0))
    union = (a_hi - a_lo + 1) + (b_hi - b_lo + 1) - inter
    return F.when(union > 0, inter / F.when(union > 0, union)).otherwise(F.lit(0.0))


def status(conf: Column, n: Column, accept: float, review: float, min_standalone: int) -> Column:
    """accepted, review or rejected; a short match is never accepted."""
    return F.when((conf >= accept) & (n >= min_standalone), "accepted").when(conf >= review, "review").otherwise("rejected")


def label(group: Column, item: Column, item_end: Column) -> Column:
    """group:item, or group:item-end for a run."""
    return F.concat(group, F.lit(":"), item.cast("string"), F.when(item_end.isNotNull() & (item_end != item), F.concat(F.lit("-"), item_end.cast("string"))).otherwise(""))

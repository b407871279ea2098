"""Normal forms of text as column expressions, and word arrays.

Null and empty texts normalize to the empty string.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.config import NormRules

# The ranges of combining marks that are dropped.
MARKS = r"[\x{0610}-\x{061A}\x{064B}-\x{065F}\x{0670}\x{06D6}-\x{06DC}\x{06DF}-\x{06E4}\x{06E7}\x{06E8}\x{06EA}-\x{06ED}\x{08D3}-\x{08FF}]"
TATWEEL = "ـ"
NOT_LETTERS = r"[^\x{0621}-\x{064A} ]+"
#: White space besides the plain space.
SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


@F.pandas_udf(T.StringType())
def nfc(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Composed form; needed only where letter rules are off."""
    import unicodedata

    for s in texts:
        yield s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def arabic(text: Column, rules: NormRules = NormRules(), keep: str = "") -> Column:
    """The Arabic profile: marks and tatweel dropped, letter variants unified, anything else a space but for ``keep``."""
    t = F.coalesce(text, F.lit(""))
    if not rules.all_on():
        t = nfc(t)
    if rules.drop_tatweel:
        t = F.replace(t, F.lit(TATWEEL), F.lit(""))
    if rules.drop_marks:
        t = F.regexp_replace(t, MARKS, "")
    swaps: list[tuple[str, str]] = []
    if rules.unify_alef:
        swaps += [("آ", "ا"), ("أ", "ا"), ("إ", "ا"), ("ٱ", "ا")]
    if rules.unify_ya:
        swaps += [("ى", "ي")]
    if rules.unify_ta_marbuta:
        swaps += [("ة", "ه")]
    if rules.unify_hamza:
        swaps += [("ؤ", "و"), ("ئ", "ي"), ("ء", "")]
    if swaps:
        swaps.sort(key=lambda s: s[1] == "")
        t = F.translate(t, "".join(a for a, _ in swaps), "".join(b for _, b in swaps))
    if rules.letters_only:
        t = F.regexp_replace(t, NOT_LETTERS.replace(" ]", f" {keep}]"), " ")
    return F.trim(F.regexp_replace(plain_spaces(t), " {2,}", " "))


def plain_spaces(text: Column) -> Column:
    """Every white-space character as a plain space."""
    return F.translate(text, SPACES, " " * len(SPACES))


def tokens(normal: Column) -> Column:
    """Words of a normalized text."""
    return F.filter(F.split(normal, " "), lambda w: w != "")


def pieces(text: Column) -> Column:
    """White-space pieces of any text."""
    return F.filter(F.split(plain_spaces(F.coalesce(text, F.lit(""))), " "), lambda w: w != "")


def alignment(source: Column, rules: NormRules = NormRules()) -> Column:
    """For each word of the normalized text, the number of the source piece it came from."""
    return F.flatten(F.transform(pieces(source), lambda w, i: F.transform(tokens(arabic(w, rules)), lambda _: i)))


def fragment(source: Column, align: Column, first: Column, last: Column) -> Column:
    """The source pieces behind the normalized words first..last; the whole text where the span is not valid."""
    p = pieces(source)
    a = F.when(F.coalesce(F.size(align), F.lit(0)) > 0, align).otherwise(F.transform(p, lambda _, i: i))
    lo, hi = F.get(a, first), F.get(a, last)
    good = (first >= 0) & (last >= first) & (last < F.size(a)) & lo.isNotNull() & hi.isNotNull()
    return F.when(good, F.array_join(F.slice(p, lo + 1, hi - lo + 1), " ")).otherwise(source)

"""Character forms: look-alikes, invisible characters, and comparable words.

Three levels of sameness, each a pure function of the text:

* :func:`skeleton`: decompose, put the prototype for every character,
  decompose again. Texts that look the same have the same skeleton.
* :func:`ordinary`: the one consistent spelling (the skeleton, composed).
* :class:`BareWords`: words by letters and digits alone, for comparing
  wording: no marks, punctuation, case, invisible characters or look-alikes.

Most of the prototypes come from rules (compatibility decompositions for
full-width and presentation forms, separators for spaces, format characters
for invisible ones), for characters of every plane; the tables below hold what
no rule gives, and a file in the form of the public confusables table may be
given for the rest.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Letters of other scripts that look like a Latin one.
LATIN_LOOKS = {
    "А": "A", "В": "B", "Е": "E", "З": "3", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "к": "k",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ѵ": "v", "Ѵ": "V", "Ӏ": "l", "ӏ": "l", "Ү": "Y", "ү": "y", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W",
    "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʋ": "v", "ᴄ": "c", "ᴏ": "o", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ꜱ": "s", "ʏ": "y", "ǀ": "l", "Ɩ": "l",
    "օ": "o", "Օ": "O", "ս": "u", "Տ": "S", "Ս": "U", "Լ": "L", "հ": "h", "ո": "n", "ռ": "n", "ց": "g", "զ": "q", "գ": "q", "յ": "j", "ա": "w",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j",
}
# Letters of Lisu, Cherokee and Coptic, and signs, that look like a Latin one.
LISU_LOOKS = dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU", strict=True))
CHEROKEE_LOOKS = dict(zip("ᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᎽᏀᏃᏎᏏᏒᏔᏙᏚᏞᏟᏢᏦᏧᏳᏴ", "DRTiYAJEWMHYGZ4bRWVSLCPKdGB", strict=True))
COPTIC_LOOKS = dict(zip("ⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥ", "HIKMNOPCTYXopc", strict=True))
SIGN_LETTERS = {"℮": "e", "ſ": "f", "ℓ": "l", "ɪ": "i", "ɴ": "N", "ʀ": "R", "ʟ": "L", "ʜ": "H", "ɢ": "G", "ʙ": "B", "ᴀ": "A", "ᴅ": "D", "ᴇ": "E", "ᴊ": "J", "ᴋ": "K", "ᴍ": "M", "ᴘ": "P", "ᴛ": "T", "ᴜ": "U"}
# Letters of other Arabic alphabets that look like one of Arabic.
ARABIC_LOOKS = {"ی": "ي", "ے": "ي", "ې": "ي", "ک": "ك", "ڪ": "ك", "ہ": "ه", "ھ": "ه", "ە": "ه", "ۀ": "ه", "ۃ": "ة", "ۇ": "و", "ۆ": "و", "ں": "ن", "ٮ": "ب", "ڡ": "ف", "ٯ": "ق", "ۍ": "ي", "ٲ": "أ", "ٳ": "إ"}
# The Persian digits look like the Arabic ones.
ARABIC_LOOKS |= {chr(0x06F0 + i): chr(0x0660 + i) for i in range(10)}
# Punctuation that looks like an ASCII sign.
SIGN_LOOKS = {"‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "‘": "'", "’": "'", "‛": "'", "′": "'", "ʼ": "'", "“": '"', "”": '"', "‟": '"', "″": '"', "⁄": "/", "∕": "/", "∗": "*", "‚": ",", "․": ".", "꞉": ":", "∶": ":"}
# The usual letters and joiners of Persian and Urdu besides the Arabic ones.
PERSIAN_URDU = "ٹپچڈڑژکگںھہۂۃیےۓۀ۔" + "‌‍" + "۰۱۲۳۴۵۶۷۸۹"
# Characters that count as nothing though their category is not "format".
BLANK = "͏ᅟᅠ឴឵᠋᠌᠍ㅤﾠـ"
# What bare words do not tell apart, beyond marks and look-alikes.
SAME_LETTER = {"ى": "ي", "ة": "ه", "ٱ": "ا", "ı": "i", "æ": "ae", "œ": "oe", "ß": "ss", "ø": "o", "ł": "l", "đ": "d"}

#: Arabic letters, vowel and reading signs, Arabic punctuation and digits, and printable ASCII.
ORDINARY = (
    {chr(c) for c in range(0x20, 0x7F)}
    | {chr(c) for c in range(0x0621, 0x064B) if c not in range(0x063B, 0x0641)}
    | {chr(c) for c in range(0x064B, 0x0660)}
    | {chr(c) for c in range(0x0660, 0x066E)}
    | set("ٱٰ،؛؟٪٫٬٭")
    | {chr(c) for c in (*range(0x0610, 0x061B), *range(0x06D6, 0x06DD), 0x06DE, *range(0x06DF, 0x06E9), *range(0x06EA, 0x06EE))}
    | set("\n\r\t")
)


#: The look-alikes of the tables above.
LOOKS = SIGN_LETTERS | COPTIC_LOOKS | CHEROKEE_LOOKS | LISU_LOOKS | SIGN_LOOKS | LATIN_LOOKS | ARABIC_LOOKS
# The kinds of compatibility decompositions that keep the look of a character.
SAME_LOOK = ("<wide", "<narrow", "<initial", "<medial", "<final", "<isolated", "<font", "<circle", "<compat", "<square", "<small", "<vertical", "<noBreak")


def load_confusables(path: str) -> dict[str, str]:
    """A look-alike table in the form of the Unicode consortium's confusables.txt: source ; prototype ; kind # note."""
    out = {}
    with open(path, encoding="utf-8-sig") as f:
        for line in f:
            parts = line.split("#")[0].split(";")
            if len(parts) >= 2:
                out["".join(chr(int(x, 16)) for x in parts[0].split())] = "".join(chr(int(x, 16)) for x in parts[1].split())
    return {a: b for a, b in out.items() if len(a) == 1}


class Prototypes(dict):
    """Code point -> decomposed prototype, of every plane, filled as characters are met.

    The characters of ``keep`` and the ordinary ones stand for themselves.
    ``more`` are look-alikes besides those of this module; they come first.
    """

    def __init__(self, keep: str, more: dict[str, str] | None = None) -> None:
        super().__init__()
        self.own, self.looks = ORDINARY | set(keep), LOOKS | (more or {})

    def __missing__(self, cp: int) -> int | str:
        ch = chr(cp)
        p = ch if ch in self.own else self._of(ch)
        got = self[cp] = cp if p == ch else unicodedata.normalize("NFD", p)
        return got

    def _of(self, ch: str) -> str:
        """What ``ch`` looks like; itself where it looks like nothing else, '' where it is invisible."""
        kind = unicodedata.category(ch)
        if ch in self.looks:
            return self.looks[ch]
        if kind == "Cf" or ch in BLANK or 0xFE00 <= ord(ch) <= 0xFE0F or 0xE0100 <= ord(ch) <= 0xE01EF or (kind == "Cc" and ch not in "\n\r\t"):
            return ""
        if kind in ("Zs", "Zl", "Zp"):
            return " "
        if unicodedata.decomposition(ch).startswith(SAME_LOOK):
            looks = unicodedata.normalize("NFKC", ch)
            return "".join(c if c in self.own else self._of(c) for c in looks) if looks != ch else ch
        return ch


@lru_cache(maxsize=8)
def _table(keep: str, confusables: str | None = None) -> Prototypes:
    return Prototypes(keep, load_confusables(confusables) if confusables else None)


def skeleton(text: str, keep: str = "", confusables: str | None = None) -> str:
    """Decompose, replace every character by its prototype, decompose again. ``confusables`` is a file for :func:`load_confusables`."""
    return unicodedata.normalize("NFD", unicodedata.normalize("NFD", text).translate(_table(keep, confusables)))


def ordinary(text: str, keep: str = "", confusables: str | None = None) -> str:
    """The text in its consistent form."""
    return unicodedata.normalize("NFC", skeleton(text, keep, confusables))


@lru_cache(maxsize=4)
def _suspect(keep: str) -> re.Pattern:
    """Any character that is not ordinary."""
    return re.compile("[^" + re.escape("".join(sorted(ORDINARY | set(keep)))) + "]")


def is_odd(text: str, keep: str = "", confusables: str | None = None) -> bool:
    """Whether the text differs from its consistent form.

    A text of ordinary characters in composed form is its own consistent form,
    so only the others need their skeleton.
    """
    if not _suspect(keep).search(text):
        return not (text.isascii() or unicodedata.is_normalized("NFC", text))
    return ordinary(text, keep, confusables) != text


_NON_WORD = re.compile(r"[^\w]|_", re.UNICODE)


def _letters(text: str) -> str:
    """Letters and digits alone, folded; anything visible between them is a space."""
    t = unicodedata.normalize("NFKD", text.casefold()).translate(_table(""))
    t = unicodedata.normalize("NFKD", t).casefold()
    out = []
    for ch in t:
        kind = unicodedata.category(ch)
        if kind[0] == "M":
            continue
        if kind[0] in "LN":
            ch = ARABIC_LOOKS.get(ch, ch)
            ch = SAME_LETTER.get(ch, ch)
            out.append(str(unicodedata.decimal(ch)) if kind == "Nd" else ch)
        else:
            out.append(" ")
    return "".join(out)


class BareWords:
    """Comparable forms of white-space pieces, remembered up to a bound.

    ``split`` says whether punctuation inside a piece parts it into several
    words (for wording that may have lost its spaces) or vanishes.
    """

    def __init__(self, split: bool, most: int = 500_000) -> None:
        self.split, self.most, self.known = split, most, {}

    def of(self, piece: str) -> tuple[str, ...]:
        got = self.known.get(piece)
        if got is None:
            parts = _letters(piece).split()
            got = tuple(parts) if self.split else (("".join(parts),) if parts else ())
            if len(self.known) >= self.most:
                self.known.clear()
            if len(piece) < 200:
                self.known[piece] = got
        return got

    def words(self, text: str) -> list[str]:
        of = self.of
        return [w for p in text.split() for w in of(p)]

"""ASCII form of text, character by character (H5).

Most folds come from Unicode itself: the compatibility decomposition without
its marks (Latin of any kind, full-width forms, ligatures, roman numerals,
fractions, superscripts), the character names of kana, and the arithmetic of
Hangul syllables.  What has no rule stands below as plain tables.  Characters
with neither (Chinese, and scripts not named here) stay as they are.

The table is one constant array of strings, indexed by code point, so a fold
costs one array access a character; texts of ASCII alone are not touched.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES ---------------------------------------------------------------
# Latin letters and signs without a decomposition.
LATIN = {"Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "ẞ": "Ss", "Ø": "O", "ø": "o", "Đ": "D", "đ": "d",
         "Ł": "L", "ł": "l", "Þ": "Th", "þ": "th", "Ð": "D", "ð": "d", "ı": "i", "Ħ": "H", "ħ": "h", "Ŋ": "NG", "ŋ": "ng",
         "Ŧ": "T", "ŧ": "t", "ĸ": "k", "Ə": "E", "ə": "e", "ƒ": "f", "Ɓ": "B", "ɓ": "b", "Ɗ": "D", "ɗ": "d", "Ɣ": "G", "ɣ": "g"}
SIGNS = {"‘": "'", "’": "'", "ʼ": "'", "‚": ",", "“": '"', "”": '"', "„": ",,", "«": "<<", "»": ">>", "‹": "<", "›": ">",
         "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--", "−": "-", "…": "...", "•": "*", "·": "*", "×": "x", "÷": "/",
         "⁄": "/", "°": "deg", "©": "(c)", "®": "(r)", "€": "EUR", "¡": "!", "¿": "?", "、": ", ", "。": ". ", "・": "*"}
# Small letters of Greek and Cyrillic; capitals follow from them.
GREEK = {"α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m",
         "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "ς": "s", "σ": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps",
         "ω": "o"}
CYRILLIC = {"а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "io", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k",
            "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts",
            "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "'", "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia", "є": "ie", "і": "i",
            "ї": "yi", "ґ": "g'", "ў": "u", "ђ": "dj", "ѓ": "gj", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "c", "ќ": "kj", "џ": "dzh",
            "ѕ": "dz"}
# The parts of a Hangul syllable.
HANGUL_FIRST = ("g", "gg", "n", "d", "dd", "r", "m", "b", "bb", "s", "ss", "", "j", "jj", "c", "k", "t", "p", "h")
HANGUL_VOWEL = ("a", "ae", "ya", "yae", "eo", "e", "yeo", "ye", "o", "wa", "wae", "oe", "yo", "u", "weo", "we", "wi", "yu", "eu", "yi",
                "i")
HANGUL_LAST = ("", "g", "gg", "gs", "n", "nj", "nh", "d", "l", "lg", "lm", "lb", "ls", "lt", "lp", "lh", "m", "b", "bs", "s", "ss",
               "ng", "j", "c", "k", "t", "p", "h")
# Code points of the table: Latin to Cyrillic, Latin Additional to CJK signs and kana, full-width forms.
RANGES = ((0x80, 0x530), (0x1D00, 0x3100), (0xFB00, 0xFB07), (0xFF00, 0xFFF0))
# -----------------------------------------------------------------------------

_HANGUL, _HANGUL_END = 0xAC00, 0xAC00 + 19 * 21 * 28
#: Separates the entries of the table's literal; no fold has it.
_SEP = "\x01"


def _capitals(table: dict[str, str]) -> dict[str, str]:
    return {c.upper(): x[:1].upper() + x[1:] for c, x in table.items() if len(c.upper()) == 1 and c.upper() != c and c != "ς"} | table


@cache
def _fixed() -> dict[str, str]:
    return LATIN | SIGNS | _capitals(GREEK) | _capitals(CYRILLIC)


def _kana(ch: str) -> str | None:
    """The syllable that a kana letter's name ends with."""
    name = unicodedata.name(ch, "")
    for kind in ("HIRAGANA LETTER ", "KATAKANA LETTER "):
        if name.startswith(kind):
            return name[len(kind):].removeprefix("SMALL ").lower() if " " not in name[len(kind):].removeprefix("SMALL ") else None
    return None


def fold_char(ch: str) -> str:
    """ASCII form of one character, or the character itself."""
    fixed = _fixed()
    if ch.isascii():
        return ch
    if ch in fixed:
        return fixed[ch]
    if _HANGUL <= ord(ch) < _HANGUL_END:
        k = ord(ch) - _HANGUL
        return HANGUL_FIRST[k // 588] + HANGUL_VOWEL[k % 588 // 28] + HANGUL_LAST[k % 28]
    kana = _kana(ch)
    if kana is not None:
        return kana
    if unicodedata.category(ch) in ("Mn", "Cf"):
        return ""
    # first the canonical form (its base may stand in a table), then the compatible one
    for form in ("NFD", "NFKD"):
        base = [c for c in unicodedata.normalize(form, ch) if not unicodedata.combining(c)]
        out = "".join(c if c.isascii() else fixed.get(c, "\0") for c in base)
        if base and "\0" not in out and base != [ch]:
            return out
    return ch


@cache
def _table() -> tuple[str, ...]:
    return tuple(fold_char(chr(cp)) for a, b in RANGES for cp in range(a, b))


def _array(items) -> str:
    text = _SEP.join(items).replace("\\", "\\\\").replace("'", "\\'")
    return f"split('{text}', '{_SEP}')"


def to_ascii(text: Column) -> Column:
    """The text with every character that has an ASCII form replaced by it."""
    return F.when(text.rlike(r"[^\x00-\x7f]"), F.array_join(F.transform(F.split(text, ""), _fold_one), "")).otherwise(text)


def _fold_one(ch: Column) -> Column:
    table, cp, at = F.expr(_array(_table())), F.ascii(ch), 0
    out = F.when(cp < 128, ch)
    for a, b in RANGES:
        out = out.when((cp >= a) & (cp < b), F.element_at(table, (cp - a + at + 1).cast("int")))
        at += b - a
    k = cp - _HANGUL
    part = lambda names, i: F.element_at(F.expr(_array(names)), (i + 1).cast("int"))
    hangul = F.concat(part(HANGUL_FIRST, F.floor(k / 588)), part(HANGUL_VOWEL, F.floor((k % 588) / 28)), part(HANGUL_LAST, k % 28))
    return out.when((cp >= _HANGUL) & (cp < _HANGUL_END), hangul).otherwise(ch)

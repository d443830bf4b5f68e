"""Text rules shared by every operator: Unicode words, spaces and digits.

The catalogue is written in the Python regular-expression dialect, where
letters, digits and spaces are Unicode ones.  Spark runs Java expressions,
whose short-hand classes are ASCII by default and differ in detail even in
Unicode mode, so the classes are spelled out here.
"""

from __future__ import annotations

import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
# The Unicode spaces, and the four separators counted among them.
_WIDE_SPACES = r"\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_SPACES = r"\t-\r\x1C-\x20" + _WIDE_SPACES
SPACE = f"[{_SPACES}]"
# A run of spaces that is not a single plain one.
UNEVEN_SPACES = rf" *[\t-\r\x1C-\x1F{_WIDE_SPACES}]{SPACE}*| {{2,}}"
NOT_SPACE = f"[^{_SPACES}]"
_BOUNDARY = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

_CODEPOINTS = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
# Characters trimmed from the ends of lines and bodies.
SPACE_CHARS = "".join(c for c in _CODEPOINTS if c.isspace())
# Every decimal digit but the ASCII ones, and the ASCII digit of equal value.
_OTHER_DIGITS = [c for c in _CODEPOINTS if c > "\x7f" and unicodedata.category(c) == "Nd"]
_DIGITS_FROM = "".join(_OTHER_DIGITS)
_DIGITS_TO = "".join(str(unicodedata.decimal(c)) for c in _OTHER_DIGITS)


def java_regex(pattern: str, *, ignore_case: bool = True) -> str:
    """A catalogue pattern in the Java dialect, with Unicode classes."""
    translated = (
        pattern.replace(r"[^\s]", NOT_SPACE)
        .replace(r"[-.\s]", rf"[-.{_SPACES}]")
        .replace(r"\s", SPACE)
        .replace(r"\d", r"\p{Nd}")
        .replace(r"\b", _BOUNDARY)
    )
    return ("(?isu)" if ignore_case else "(?s)") + translated


def term_regex(*terms: str) -> str:
    """Whole-word, case-insensitive match of any of `terms`."""
    quoted = "|".join(rf"\Q{term}\E" for term in terms)
    return f"(?iu)(?<!{WORD})(?:{quoted})(?!{WORD})"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def fold(text: Column) -> Column:
    """Lower case such that any case-insensitive match of an ASCII literal is
    a plain substring: four non-ASCII letters fold to an ASCII one."""
    pairs = (("İ", "i"), ("ı", "i"), ("ſ", "s"), ("K", "k"))
    for letter, ascii_letter in pairs:
        text = F.replace(text, F.lit(letter), F.lit(ascii_letter))
    return F.lower(text)


def folded_words(folded: Column) -> Column:
    """Runs of ASCII letters and digits of a folded text.  A whole-word match of
    an ASCII word, case ignored, shows up here as that word."""
    return F.split(folded, "[^a-z0-9]+")


def key_word(term: str) -> str:
    """The longest word of a term: in a text with the term, a folded word."""
    return max(re.findall("[a-z0-9]+", term), key=len)


def literal(text: str | None) -> str:
    """A SQL string literal."""
    if text is None:
        return "cast(null AS string)"
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def array_literal(texts) -> str:
    return f"array({', '.join(literal(t) for t in dict.fromkeys(texts))})"


def luhn_valid(number: Column) -> Column:
    """Luhn check of a number written with separators and any decimal digits."""
    digits = F.regexp_replace(number, r"\P{Nd}", "")
    return F.call_function("luhn_check", F.translate(digits, _DIGITS_FROM, _DIGITS_TO))

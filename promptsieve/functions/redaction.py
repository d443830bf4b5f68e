"""Column functions that clean text for storage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptsieve.functions.catalogue import EXCERPT_CHARS
from promptsieve.functions.dialect import java_regex
from promptsieve.functions.jsontext import sorted_json
from promptsieve.functions.spans import collapse_spaces

# What is replaced, in this order, by what, and whether letter
# case is ignored.
REDACTIONS = (
    (r"\b\d{3}-\d{2}-\d{4}\b", "[SSN]", False),
    (r"\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b", "[EMAIL]", True),
    (r"\b(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]\d{3}[-.\s]\d{4}\b", "[PHONE]", False),
    (r"\b(?:\d[ -]*?){13,19}\b", "[CARD_OR_LONG_NUMBER]", False),
)
# Every pattern asks for a digit or for this sign; most texts have neither.
REDACTABLE = r"[@\p{Nd}]"
CONTROL_CHARS = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"


def redact(text: Column) -> Column:
    redacted = text
    for pattern, label, ignore_case in REDACTIONS:
        redacted = F.regexp_replace(redacted, java_regex(pattern, ignore_case=ignore_case), label)
    return F.when(text.rlike(REDACTABLE), redacted).otherwise(text)


def shorten(text: Column, max_chars: int) -> Column:
    cut = F.rtrim(F.substring(text, 1, max(0, max_chars - 3)))
    return F.when(F.length(text) <= max_chars, text).otherwise(F.concat(cut, F.lit("...")))


def excerpt(text: Column, max_chars: int = EXCERPT_CHARS) -> Column:
    """Redacted text on one line, at most `max_chars` long (never under 3)."""
    # One-element array: the line is computed once, then looked at three times.
    line = F.array(collapse_spaces(redact(text)))
    return F.get(F.transform(line, lambda t: shorten(t, max_chars)), F.lit(0))


def clean_cell(value: Column, kind: T.DataType | None = None) -> Column:
    """Text fit for a tabular cell: no control characters, never null.  With its
    type given, a list, struct or map becomes JSON with sorted keys."""
    nested = isinstance(kind, (T.ArrayType, T.StructType, T.MapType))
    text = F.when(value.isNotNull(), sorted_json(value, kind)) if nested else value.cast("string")
    return F.coalesce(F.regexp_replace(text, CONTROL_CHARS, ""), F.lit(""))

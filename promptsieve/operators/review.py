"""From findings to reviewed and flagged prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptsieve.functions import catalogue as C
from promptsieve.functions import scoring
from promptsieve.functions.redaction import excerpt
from promptsieve.functions.rows import settle
from promptsieve.operators.detect import detect, verdicts

REVIEWED_COLUMNS = (
    "risk_level", "risk_score", "confidence", "needs_human_review", "categories", "reasons",
    "matched_evidence", "line_number", "event_id", "conversation_id", "message_id", "user_id",
    "user_email", "created_at", "prompt",
)
LEVEL_VALUES = (
    "risk_level", "risk_score", "confidence", "needs_human_review", "categories", "user_id", "user_email",
)
# Place of a prompt in the input.
REVIEW_ORDER = ("file", "line_number", "prompt_no")
_TYPES = {"risk_score": "int", "needs_human_review": "boolean", "line_number": "bigint"}


def _typed(df: DataFrame, name: str) -> Column:
    value = F.col(name) if name in df.columns else F.lit(None)
    return value.cast(_TYPES.get(name, "string")).alias(name)


def _judged(detected: DataFrame) -> DataFrame:
    findings = F.col("findings")
    return detected.withColumn("risk_score", scoring.risk_score(findings)).withColumns(
        {
            "risk_level": scoring.risk_level(F.col("risk_score")),
            "confidence": scoring.confidence(findings),
            "needs_human_review": scoring.needs_review(findings),
            "categories": scoring.categories(findings),
        }
    )


def assess(detected: DataFrame) -> DataFrame:
    """Add the score, level, confidence and texts that follow from `findings`."""
    findings = F.col("findings")
    return _judged(detected).withColumns(
        {"reasons": scoring.reasons(findings), "matched_evidence": scoring.matched_evidence(findings)}
    )


def risk_levels(prompts: DataFrame, rules: C.Catalogue = C.DEFAULT, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """`LEVEL_VALUES` of every prompt as `classify` gives them, then the `keep`
    columns; reasons and evidence are not worked out.  All that summaries need."""
    judged = _judged(verdicts(prompts, "prompt", rules))
    return settle(judged.select(*(_typed(judged, c) for c in LEVEL_VALUES), *keep), "risk_level", "risk_score")


def classify(
    prompts: DataFrame,
    rules: C.Catalogue = C.DEFAULT,
    *,
    redact_prompt: bool = False,
    redact_evidence: bool = False,
    excerpt_chars: int = C.EXCERPT_CHARS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Reviewed prompts: `REVIEWED_COLUMNS`, then `findings` and the `keep` columns.

    `prompts` has a `prompt` text; id columns it lacks become null.  With
    `redact_prompt` the prompt is stored as a redacted excerpt.  Evidence is
    left as it is unless `redact_evidence` is set too.
    """
    assessed = assess(detect(prompts, "prompt", rules))
    if redact_evidence:
        hidden = F.transform(
            "findings",
            lambda f: f.withField("evidence", F.transform(f["evidence"], lambda e: excerpt(e, excerpt_chars))),
        )
        assessed = assessed.withColumn("matched_evidence", scoring.matched_evidence(hidden))
    if redact_prompt:
        assessed = assessed.withColumn("prompt", excerpt(F.col("prompt"), excerpt_chars))
    reviewed = assessed.select(*(_typed(assessed, c) for c in REVIEWED_COLUMNS), "findings", *keep)
    return settle(reviewed, "risk_level", "risk_score")


def invalid_line_values(line: Column) -> dict[str, Column]:
    """Reviewed values of an input line that is not JSON.  The line is kept
    whole, never redacted."""
    category, score, level, confidence = C.INVALID_LINE
    return {
        "risk_level": F.lit(level),
        "risk_score": F.lit(score),
        "confidence": F.lit(confidence),
        "needs_human_review": F.lit(True),
        "categories": F.lit(category),
        "reasons": F.lit(C.INVALID_LINE_REASON),
        "matched_evidence": F.substring(line, 1, C.EXCERPT_CHARS),
        "prompt": line,
    }


def invalid_lines(lines: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Reviewed rows for lines (line_number, line) that are not JSON."""
    values = invalid_line_values(F.col("line"))
    with_values = lines.select("line_number", *(v.alias(c) for c, v in values.items()), *keep)
    return with_values.select(*(_typed(with_values, c) for c in REVIEWED_COLUMNS), *keep)


def flagged(reviewed: DataFrame) -> DataFrame:
    return reviewed.where(F.col("risk_level") != "none")

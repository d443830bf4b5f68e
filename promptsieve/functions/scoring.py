"""From findings to a risk score, level and confidence.

All functions take the `findings` array that `operators.detect` produces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from promptsieve.functions.catalogue import (
    CONFIDENCES,
    EXTRA_CATEGORY_POINTS,
    LEVEL_FLOORS,
    MAX_EVIDENCE,
    MAX_EXTRA_POINTS,
    MAX_SCORE,
)


def field_values(findings: Column, field: str) -> Column:
    return F.array_distinct(F.transform(findings, lambda f: f[field]))


def risk_score(findings: Column) -> Column:
    categories = F.size(field_values(findings, "category"))
    extra = F.least(F.lit(MAX_EXTRA_POINTS), (categories - 1) * EXTRA_CATEGORY_POINTS)
    best = F.array_max(F.transform(findings, lambda f: f["score"]))
    score = F.least(F.lit(MAX_SCORE), best + extra)
    return F.when(F.size(findings) > 0, score).otherwise(0)


def risk_level(score: Column) -> Column:
    level = F
    for name, floor in LEVEL_FLOORS:
        level = level.when(score >= floor, name)
    return level.otherwise("none")


def confidence(findings: Column) -> Column:
    seen = field_values(findings, "confidence")
    best = F
    for name in CONFIDENCES:
        best = best.when(F.array_contains(seen, name), name)
    return best.otherwise("none")


def needs_review(findings: Column) -> Column:
    return F.size(findings) > 0


def categories(findings: Column) -> Column:
    return F.array_join(F.array_sort(field_values(findings, "category")), "; ")


def reasons(findings: Column) -> Column:
    return F.array_join(field_values(findings, "reason"), " | ")


def matched_evidence(findings: Column) -> Column:
    texts = F.flatten(F.transform(findings, lambda f: f["evidence"]))
    shown = F.array_distinct(F.filter(texts, lambda t: t != ""))
    return F.array_join(F.slice(shown, 1, MAX_EVIDENCE), " | ")

"""Prompt-compliance analytics as Spark DataFrame operators."""

from promptsieve.functions.catalogue import DEFAULT, Catalogue, Pattern, Rule
from promptsieve.functions.redaction import clean_cell, excerpt
from promptsieve.operators.detect import detect, detections, verdicts
from promptsieve.operators.prompts import extract_prompts, prompt_rows, prompt_text
from promptsieve.operators.records import decode_payload, with_record_facts
from promptsieve.operators.review import assess, classify, flagged, invalid_lines, risk_levels
from promptsieve.operators.summary import by_category, by_risk_level, by_user, scan_counters
from promptsieve.plans.export import Export, ExportConfig, export_logs
from promptsieve.plans.review import Review, review_lines, run_review, write_review
from promptsieve.plans.whole_run import WholeRun, export_and_review
from promptsieve.sources.lines import numbered_lines
from promptsieve.streaming.review import start_review, start_user_totals

__all__ = [
    "Catalogue", "DEFAULT", "Export", "ExportConfig", "Pattern", "Review", "Rule", "WholeRun",
    "assess", "by_category", "by_risk_level", "by_user", "classify", "clean_cell",
    "decode_payload", "detect", "detections", "excerpt", "export_and_review", "export_logs", "extract_prompts",
    "flagged", "invalid_lines", "numbered_lines", "prompt_rows", "prompt_text",
    "review_lines", "risk_levels", "run_review", "scan_counters", "start_review", "start_user_totals",
    "verdicts", "with_record_facts", "write_review",
]

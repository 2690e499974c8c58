"""Batch scoring of free-text reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimwise.operators.cleaning import coerce_columns, reject_blank
from claimwise.operators.reports import (
    compare_with_means, display_means, extract_features, format_amount, rule_score, severity_means,
)

from claimwise.schemas import SENTINEL
from claimwise.sources.readers import read_claims_optional


def score_reports(reports: DataFrame, text_column: str = "text") -> DataFrame:
    """Features, rule score and display amount per non-blank report; one narrow stage."""
    kept, _ = reject_blank(reports, text_column)
    return score_texts(kept, text_column)


def score_texts(kept: DataFrame, text_column: str = "text") -> DataFrame:
    """:func:`score_reports` of reports known to hold text."""
    return format_amount(rule_score(extract_features(kept, text_column), text_column=text_column))


def score_with_history(reports: DataFrame, history: DataFrame, text_column: str = "text") -> DataFrame:
    """Scored reports, each with the historical mean of its severity."""
    return compare_with_means(score_reports(reports, text_column), severity_means(history))


def score_with_claims_file(
    spark: SparkSession, reports: DataFrame, claims: str, text_column: str = "text", target: str = "total_claim_amount",
) -> dict[str, DataFrame]:
    """``scored`` reports and ``means`` of all severities, from an optional claims CSV.

    Without the file there are no means, and no report has one.
    """
    history = coerce_columns(read_claims_optional(spark, claims, extra_null_tokens=[SENTINEL]), [target])
    means = severity_means(history, target=target)
    return {"scored": compare_with_means(score_reports(reports, text_column), means), "means": display_means(means)}

"""Features of free-text accident reports, rule score and display columns.

All of it is built-in column functions: one projection, no shuffle, usable on
batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimwise.functions.numbers import as_double, format_thousands
from claimwise.functions.text import contains_any, first_number, quoted
from claimwise.schemas import (
    BASE_AMOUNTS, COUNT_RULES, DEFAULT_SEVERITY, FEATURE_LABELS, PER_EXTRA_VEHICLE, PER_INJURED,
    POLICE_KEYWORD, SEVERITY_GERMAN, SEVERITY_RULES,
)


def severity(lowered: Column, rules: list[tuple[str, list[str]]] = SEVERITY_RULES,
             default: str = DEFAULT_SEVERITY) -> Column:
    """Label of the first rule with a keyword in the lower-cased text."""
    (label, words), *rest = rules
    chain = F.when(contains_any(lowered, words), label)
    for label, words in rest:
        chain = chain.when(contains_any(lowered, words), label)
    return chain.otherwise(default)


def extract_features(df: DataFrame, text_column: str = "text", rules: list[tuple[str, list[str]]] = SEVERITY_RULES,
                     counts: list[tuple[str, str, int, str]] = COUNT_RULES, kind: str = "decimal(38,0)") -> DataFrame:
    """Add ``severity``, one column per count rule (``vehicles, injured, witnesses``) and ``police``.

    A count rule is a column, a pattern whose group 1 is the number, the value without a match, and plain
    text that every match contains. ``kind`` is the type of the counts: as ``string`` they are exact at any length.
    """
    lowered = F.lower(quoted(text_column))
    return df.withColumns({
        "severity": severity(lowered, rules),
        **{name: first_number(lowered, *rule, kind) for name, *rule in counts},
        "police": F.when(F.contains(lowered, F.lit(POLICE_KEYWORD)), "Ja").otherwise("Nein"),
    })


def lookup(key: Column, table: dict, default: Column | None = None) -> Column:
    """Value of a small fixed table; ``default`` (else NULL) for other keys."""
    found = F.try_element_at(F.create_map(*[F.lit(v) for pair in table.items() for v in pair]), key)
    return found if default is None else F.coalesce(found, default)


def rule_score(df: DataFrame, name: str = "predicted_claim", text_column: str | None = None) -> DataFrame:
    """Base amount by severity plus surcharges; no vehicle gives a deduction.

    With the ``text_column`` the counts are taken from the text, so that those too long for their column count too.
    """
    if text_column is None:
        number = {c: F.col(c).cast("double") for c in ("vehicles", "injured")}
    else:
        lowered = F.lower(quoted(text_column))
        number = {c: F.coalesce(F.col(c).cast("double"), first_number(lowered, *rule, "double")) for c, *rule in COUNT_RULES}
    return df.withColumn(
        name,
        lookup(F.col("severity"), BASE_AMOUNTS)
        + (number["vehicles"] - 1.0) * PER_EXTRA_VEHICLE
        + number["injured"] * PER_INJURED)


def german_severity(c: Column) -> Column:
    """Display name; unknown categories show as they are."""
    return lookup(c, SEVERITY_GERMAN, c)


def feature_table(df: DataFrame, id_column: str = "report_id") -> DataFrame:
    """``id, Merkmal, Wert``: one row per report and feature, for display."""
    cells = [F.struct(F.lit(label).alias("Merkmal"),
                      (german_severity(F.col(c)) if c == "severity" else F.col(c).cast("string")).alias("Wert"))
             for c, label in FEATURE_LABELS.items()]
    return df.select(quoted(id_column), F.inline(F.array(*cells)))


def format_amount(df: DataFrame, column: str = "predicted_claim", name: str = "display",
                  unit: str = "EUR") -> DataFrame:
    """Whole amount with thousands dots and a unit."""
    return df.withColumn(name, F.concat(format_thousands(quoted(column)), F.lit(f" {unit}")))


def severity_means(history: DataFrame, by: str = "incident_severity",
                   target: str = "total_claim_amount") -> DataFrame:
    """``category, mean`` in key order; null keys are left out."""
    y = as_double(quoted(target), history.schema[target].dataType)
    return (history.where(quoted(by).isNotNull()).groupBy(quoted(by).alias("category"))
            .agg(F.avg(y).alias("mean")).orderBy("category"))


def compare_with_means(scored: DataFrame, means: DataFrame, by: str = "severity") -> DataFrame:
    """Every report with the historical mean of its own category, and the distance from it.

    One row per report: ``category_mean`` and ``difference`` are NULL where the history has no
    such category. The means of all categories stay a frame of their own, see
    :func:`severity_means`.
    """
    own = means.select(F.col("category").alias(by), F.col("mean").alias("category_mean"))
    return (scored.join(own, by, "left").select(*[quoted(c) for c in scored.columns], "category_mean",
                                                (F.col("predicted_claim") - F.col("category_mean")).alias("difference")))


def display_means(means: DataFrame) -> DataFrame:
    """``category, category_german, mean`` of every historical category."""
    return means.select("category", german_severity(F.col("category")).alias("category_german"), "mean")

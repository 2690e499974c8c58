"""Prepared dataset: strict cleaning, value fixes, derived columns, report text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimwise.functions.text import quoted
from claimwise.operators.cleaning import (
    cleanup_rejects, cleanup_report_lines, cleanup_summary, fix_values, strict_clean,
)
from claimwise.operators.prepare import prepared_columns
from claimwise.operators.ranking import file_row_index
from claimwise.operators.synth import generate_reports
from claimwise.phrases import DEFAULT_BOOK, PhraseBook
from claimwise.session import stage
from claimwise.sources.readers import read_claims_strict, read_csv_text
from claimwise.sources.writers import write_csv, write_report

INDEX = "row_index"


def prepare(df: DataFrame, index: str, seed: int = 42, book: PhraseBook = DEFAULT_BOOK) -> DataFrame:
    """Six prepared columns after ``index``, from a text frame with null tokens applied.

    Make names are fixed after duplicates are dropped, so rows that differ only
    by a misspelt make both stay.
    """
    fixed = fix_values(strict_clean(df, index))
    return generate_reports(prepared_columns(fixed, keep=[index]), index, seed=seed, book=book)


def build_prepared(spark: SparkSession, source: str, report_path: str | None = None,
                   work_path: str | None = None, seed: int = 42) -> DataFrame:
    """From CSV to the prepared dataset, with an optional cleanup report."""
    raw = stage(file_row_index(read_claims_strict(spark, source, positions=True), INDEX, start=0), "raw", work_path)
    if report_path:
        write_report(cleanup_report_lines(cleanup_summary(raw, INDEX), cleanup_rejects(raw, INDEX)), report_path)
    return prepare(raw, INDEX, seed).drop(INDEX)


def add_report_column(spark: SparkSession, source: str, target: str, column: str, key: str | None = None,
                      seed: int = 42, book: PhraseBook = DEFAULT_BOOK) -> int:
    """Copy a CSV with one generated text column added or overwritten; rows written.

    Without ``key`` the choices derive from the row's content and the column's
    old value is not read, so equal rows get equal texts.
    """
    from pyspark.sql import functions as F

    df = read_csv_text(spark, source)
    if key is not None:
        return write_csv(generate_reports(df, key, column, seed, book), target)
    content = F.concat_ws("\u001f", *[quoted(c) for c in df.columns if c != column])
    keyed = df.withColumn("_content", content)
    return write_csv(generate_reports(keyed, "_content", column, seed, book).drop("_content"), target)

"""Columns of the prepared claims dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimwise.functions.numbers import coerce_number, round_cents
from claimwise.functions.text import quoted, strip
from claimwise.operators.cleaning import flag_to_boolean, parse_dates
from claimwise.schemas import ARTEFACT_COLUMN, SENTINEL, TABLES, USD_TO_EUR, spark_type


def make_model(make: Column, model: Column) -> Column:
    """Trimmed make and model with one blank; a missing part reads ``nan``."""
    part = lambda c: F.coalesce(strip(c.cast("string")), F.lit("nan"))
    return F.concat(part(make), F.lit(" "), part(model))


def usable_text(c: Column) -> Column:
    """Trimmed text; empty text and the sentinel count as missing."""
    text = strip(c.cast("string"))
    return F.when(~text.isin("", SENTINEL), text)


def first_usable_text(columns: list[Column], default: str = "Unknown") -> Column:
    return F.coalesce(*[usable_text(c) for c in columns], F.lit(default))


def first_usable_amount(columns: list[Column], rate: float = USD_TO_EUR) -> Column:
    """First numeric amount (else 0) times a rate, to two decimals."""
    amount = F.coalesce(*[coerce_number(c) for c in columns], F.lit(0.0))
    return round_cents(amount * F.lit(rate))


def prepared_columns(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """The five derived columns of the prepared dataset, after ``keep``."""
    return df.select(
        *[quoted(c) for c in keep],
        make_model(F.col("auto_make"), F.col("auto_model")).alias("auto_make_model"),
        "auto_year",
        "incident_severity",
        first_usable_text([F.col("collision_type"), F.col("incident_type")]).alias("collision_type"),
        first_usable_amount([F.col("total_claim_amount"), F.col("vehicle_claim")]).alias("claim_amount_eur"),
    )


def typed_claims(df: DataFrame, date_format: str | list[str] = "yyyy-MM-dd", flags: bool = True) -> DataFrame:
    """The text frame with the types of the claims tables, without the artefact column.

    Numbers and dates of the data model are typed, other columns stay text, and so do flags unless ``flags`` makes them BOOLEAN. Malformed text is an error that names the column and the value.
    """
    kinds = {source: spark_type(kind) for columns in TABLES.values() for source, _, kind in columns}
    plain = {c: k for c, k in kinds.items() if k not in ("STRING", "DATE", "BOOLEAN") and c in df.columns}
    typed = df.drop(ARTEFACT_COLUMN).withColumns({
        c: F.coalesce(quoted(c).try_cast(kind), F.when(quoted(c).isNotNull(), F.raise_error(
            F.concat(F.lit(f"no {kind} in {c}: "), quoted(c))).cast(kind))) for c, kind in plain.items()})
    typed = parse_dates(typed, [c for c, k in kinds.items() if k == "DATE" and c in df.columns], date_format)
    for c in (c for c, k in kinds.items() if flags and k == "BOOLEAN" and c in df.columns):
        typed = flag_to_boolean(typed, c)
    return typed

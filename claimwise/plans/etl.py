"""Load job: CSV -> clean -> five audited tables -> sample join."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from claimwise.operators.audits import audit_flat, require_clean
from claimwise.operators.cleaning import head_ordered
from claimwise.operators.normalise import clean_claims as transform, join_claims, split_claims
from claimwise.operators.ranking import file_row_index
from claimwise.schemas import TABLES
from claimwise.session import stage
from claimwise.sources.readers import read_claims, read_tables
from claimwise.sources.writers import write_tables

ROW_NUMBER = "lfd_id"


@dataclass
class LoadResult:
    rows_read: int
    rows_written: dict[str, int]
    audit: DataFrame
    sample: DataFrame


def extract(spark: SparkSession, path: str) -> DataFrame:
    """Text frame with the running number in file order."""
    return file_row_index(read_claims(spark, path, positions=True), ROW_NUMBER)


def load_tables(df: DataFrame, location: str, id_column: str = ROW_NUMBER) -> tuple[dict[str, int], DataFrame]:
    """Audit all five tables, then write them; nothing is written if a rule is broken.

    ``df`` is read several times (audits, five writes): pass a staged frame.
    """
    audit = audit_flat(df, id_column)
    require_clean(audit)
    return write_tables(split_claims(df, id_column), location), audit


def run_load(spark: SparkSession, source: str, location: str, date_format: str = "yyyy-MM-dd",
             sample_rows: int = 3, work_path: str | None = None) -> LoadResult:
    """The whole job. The transformed frame is written once and read by all later steps."""
    flat = stage(transform(extract(spark, source), date_format), "claims", work_path)
    rows, audit = load_tables(flat, location)
    tables = read_tables(spark, location, list(TABLES))
    # only the rows of the sample are joined
    keys = head_ordered(tables["schaeden"].select("schaden_id"), ["schaden_id"], sample_rows)
    tables["schaeden"] = tables["schaeden"].join(keys, "schaden_id", "left_semi")
    joined = join_claims(tables, ["schaeden.schaden_id", "kunden.alter_jahre", "fahrzeuge.marke",
                                  "unfaelle.schadensschwere", "schaeden.gesamtschaden"])
    sample = head_ordered(joined, ["schaden_id"], sample_rows).drop("schaden_id")
    return LoadResult(rows["kunden"], rows, audit, sample)

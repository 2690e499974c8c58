"""Flat claims table to five keyed tables, and back by a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimwise.functions.text import quoted
from claimwise.operators.cleaning import drop_column, flag_to_boolean, nullify_tokens, parse_dates
from claimwise.schemas import ARTEFACT_COLUMN, PRIMARY_KEYS, ROW_ID, TABLES, spark_type


def clean_claims(df: DataFrame, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Artefact column gone, sentinel to NULL, dates parsed, fraud flag as BOOLEAN."""
    df = nullify_tokens(drop_column(df, ARTEFACT_COLUMN))
    df = parse_dates(df, ["policy_bind_date", "incident_date"], date_format)
    return flag_to_boolean(df, "fraud_reported")


def split_table(df: DataFrame, table: str, id_column: str, typed: bool = True) -> DataFrame:
    """Project and rename one target table; all keys derive from ``id_column``."""
    def source(name: str) -> Column:
        return quoted(id_column if name == ROW_ID else name)
    return df.select(*[
        (source(name).cast(spark_type(kind)) if typed else source(name)).alias(target)
        for name, target, kind in TABLES[table]
    ])


def split_claims(df: DataFrame, id_column: str, typed: bool = True) -> dict[str, DataFrame]:
    """All five tables, parents before children."""
    return {name: split_table(df, name, id_column, typed) for name in TABLES}


def join_claims(tables: dict[str, DataFrame], columns: list[str] | None = None) -> DataFrame:
    """Damage -> incident -> policy -> (vehicle, customer), inner joins along the keys.

    Correct for 1:n relations: a policy with two vehicles gives two rows. Every
    join is a plain equi join, so adaptive execution broadcasts what is
    measured to be small and splits skewed partitions of what is not.
    """
    damage, incident, policy, vehicle, customer = (
        tables[n].alias(n) for n in ("schaeden", "unfaelle", "policen", "fahrzeuge", "kunden"))
    joined = (
        damage
        .join(incident, F.col("schaeden.unfall_id") == F.col("unfaelle.unfall_id"))
        .join(policy, F.col("unfaelle.police_id") == F.col("policen.police_id"))
        .join(vehicle, F.col("fahrzeuge.police_id") == F.col("policen.police_id"))
        .join(customer, F.col("policen.kunde_id") == F.col("kunden.kunde_id"))
    )
    return joined.select(*(columns or [
        "kunden.alter_jahre", "fahrzeuge.marke", "unfaelle.schadensschwere", "schaeden.gesamtschaden"]))


def orphan_rows(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    parent_key = parent_key or PRIMARY_KEYS.get(key, key)
    keys = parent.select(quoted(parent_key).alias("_parent_key"))
    return child.where(quoted(key).isNotNull()).join(keys, quoted(key) == keys["_parent_key"], "left_anti")

"""Claims-shaped views over the shared test tables.

The test tables are clean, so the dirt that cleaning and audit operators work
on is written here by key arithmetic. Every view is one SQL text valid in Spark
and DuckDB, and covers the whole ``orders`` table: ``WHERE`` appears only on the
*extra* copies that are added to it as duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwise.schemas import CLAIM_COLUMNS
from claimwise.session import scratch_path, stage


def pick(expr: str, *values: str) -> str:
    """Text chosen by ``expr`` modulo the number of values."""
    branches = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values[:-1]))
    return f"CASE {expr} % {len(values)} {branches} ELSE '{values[-1]}' END"


def money(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(12,2)) AS STRING)"


K = "o_orderkey"

_COLUMNS = {
    "months_as_customer": f"CAST({K} % 480 AS STRING)",
    "age": "CAST(19 + o_custkey % 46 AS STRING)",
    "policy_number": f"CAST(100000 + {K} AS STRING)",
    "policy_bind_date": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "policy_state": pick("c_nationkey", "OH", "IN", "IL"),
    "policy_csl": pick(K, "100/300", "250/500", "500/1000"),
    "policy_deductable": pick("o_custkey", "500", "1000", "2000"),
    "policy_annual_premium": money("o_totalprice"),
    "umbrella_limit": pick(K, "0", "0", "4000000", "-1000000", "10000000"),
    "insured_zip": "lpad(CAST(o_custkey AS STRING), 6, '0')",
    "insured_sex": pick("o_custkey", "MALE", "FEMALE"),
    "insured_education_level": pick("c_nationkey", "MD", "PhD", "JD", "College", "High School"),
    "insured_occupation": "lower(c_mktsegment)",
    "insured_hobbies": "o_orderpriority",
    "insured_relationship": pick("o_custkey", "husband", "wife", "own-child", "not-in-family"),
    "capital-gains": f"CASE WHEN {K} % 3 = 0 THEN '0' ELSE CAST({K} % 700 * 100 AS STRING) END",
    "capital-loss": f"CASE WHEN {K} % 2 = 0 THEN '0' ELSE CAST(-({K} % 500) * 100 AS STRING) END",
    "incident_date": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "incident_type": f"CASE WHEN {K} % 17 = 0 THEN ' Parked Car ' ELSE "
                     + pick(K, "Single Vehicle Collision", "Multi-vehicle Collision", "Vehicle Theft", "Parked Car") + " END",
    "collision_type": f"CASE WHEN {K} % 7 = 0 THEN '?' ELSE "
                      + pick(f"({K} + o_custkey)", "Side Collision", "Rear Collision", "Front Collision") + " END",
    "incident_severity": pick(f"({K} + c_nationkey)", "Minor Damage", "Total Loss", "Major Damage", "Trivial Damage"),
    "authorities_contacted": pick(K, "Police", "Fire", "Ambulance", "Other", "None"),
    "incident_state": pick("o_custkey", "NY", "SC", "WV", "VA", "NC", "PA", "OH"),
    "incident_city": pick(K, "Columbus", "Riverwood", "Arlington", "Springfield", "Hillsdale", "Northbend", "Northbrook"),
    "incident_location": f"CAST({K} AS STRING) || ' Oak Street'",
    "incident_hour_of_the_day": f"CASE WHEN {K} % 97 = 0 THEN '24' ELSE CAST({K} % 24 AS STRING) END",
    "number_of_vehicles_involved": f"CAST(1 + {K} % 4 AS STRING)",
    "property_damage": f"CASE WHEN {K} % 9 = 4 THEN '?' ELSE " + pick(K, "YES", "NO") + " END",
    "bodily_injuries": "CAST(o_custkey % 3 AS STRING)",
    "witnesses": "CAST(o_custkey % 4 AS STRING)",
    "police_report_available": f"CASE WHEN {K} % 8 = 5 THEN '?' ELSE " + pick("o_custkey", "YES", "NO") + " END",
    "total_claim_amount": f"CASE WHEN {K} % 11 = 0 THEN '' ELSE " + money("o_totalprice") + " END",
    "injury_claim": money(f"{K} % 9000"),
    "property_claim": money(f"{K} % 7000 * 2"),
    "vehicle_claim": f"CASE WHEN {K} % 23 = 0 THEN 'n/a' ELSE " + money(f"o_totalprice - {K} % 900") + " END",
    "auto_make": f"CASE WHEN {K} % 13 = 0 THEN 'Suburu' WHEN {K} % 13 = 1 THEN 'Accura' ELSE "
                 + pick(K, "Saab", "Subaru", "Acura", "Audi", "BMW") + " END",
    "auto_model": pick(K, "92x", " A 3 ", "Legacy", "TL", "X5 "),
    "auto_year": f"CAST(1995 + {K} % 21 AS STRING)",
    "fraud_reported": f"CASE WHEN {K} % 31 = 0 THEN 'X' ELSE " + pick(K, "Y", "N", "N", "N") + " END",
    "_c39": "''",
}

_CLEAN = {
    "incident_hour_of_the_day": f"CAST({K} % 24 AS STRING)",
    "vehicle_claim": money(f"o_totalprice - {K} % 900"),
}


def flat_sql(copies: bool = True, clean: bool = False) -> str:
    """Flat claims as text columns plus ``src_pos``, the unique source position.

    ``copies`` adds duplicates of some rows; ``clean`` keeps values inside the
    table constraints.
    """
    base = f"SELECT {K} * 2 AS src_pos, {_body(clean)} FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey"
    if not copies:
        return base
    extra = base.replace(f"{K} * 2 AS", f"{K} * 2 + 1 AS", 1)
    return f"{base} UNION ALL {extra} WHERE {K} % 50 = 3"


def _body(clean: bool) -> str:
    columns = {**_COLUMNS, **(_CLEAN if clean else {})}
    return ", ".join(f'{columns[c]} AS {_name(c)}' for c in CLAIM_COLUMNS)


def _name(column: str) -> str:
    # hyphens need quoting, and the two engines quote differently
    return column.replace("-", "_")


REPORT_TEXT = (
    f"CASE {K} % 6 WHEN 0 THEN 'Unfall mit ' || CAST({K} % 5 AS STRING) || ' Fahrzeugen, Auto erheblich beschädigt' "
    f"WHEN 1 THEN 'TOTALSCHADEN nach Kollision, ' || CAST({K} % 4 AS STRING) || ' Personen verletzt' "
    f"WHEN 2 THEN 'Nur Kratzer am Lack, ' || CAST({K} % 3 AS STRING) || ' Zeugen' "
    f"WHEN 3 THEN 'Großer Schaden, 1 Person wurde verletzt' "
    f"WHEN 4 THEN 'Kratzer, aber abgeschleppt; ' || CAST({K} % 7 AS STRING) || ' verletzt' "
    f"ELSE CASE WHEN {K} % 12 = 5 THEN '   ' ELSE 'Parkrempler' END END"
    f" || CASE WHEN {K} % 12 = 5 THEN '' WHEN o_custkey % 3 = 0 THEN '. Die Polizei kam, es gibt 2 Zeugen.' ELSE '.' END"
)
REPORTS_SQL = f"SELECT {K} AS report_id, {REPORT_TEXT} AS text FROM {{orders}}"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_WRITTEN: dict[tuple, str] = {}


def written(spark: SparkSession, sf: str, label: str, build) -> DataFrame:
    """A frame written once per application, like the source file it stands for."""
    key = (spark.sparkContext.applicationId, sf, label)
    if key not in _WRITTEN:
        path = scratch_path(spark, "view")
        stage(build(), label, path)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])


def flat(spark: SparkSession, sf: str, **options) -> DataFrame:
    """The flat claims view in Spark, with the true column names.

    Queries start from its plain columns and not from the arithmetic above.
    """
    return written(spark, sf, f"flat {sorted(options.items())}", lambda: _flat(spark, sf, **options))


def _flat(spark: SparkSession, sf: str, in_order: bool = False, **options) -> DataFrame:
    """The view computed piece by piece from its few source columns, ``in_order`` sorted by ``src_pos``.

    A row of the view is ten times as wide as its source: only source rows are dealt out or sorted.
    """
    source = _source(spark, sf, options.get("copies", True))
    if in_order:
        dealt = source.repartitionByRange(_pieces(spark, sf), "src_pos").sortWithinPartitions("src_pos")
    else:
        dealt = source.repartition(_pieces(spark, sf))
    df = spark.sql(f"SELECT src_pos, {_body(options.get('clean', False))} FROM {{source}}", source=dealt)
    return df.withColumnsRenamed({_name(c): c for c in CLAIM_COLUMNS if "-" in c})


#: Rows of the view in one task and file, about 50 MB of text.
PIECE_ROWS = 100_000


def _pieces(spark: SparkSession, sf: str) -> int:
    """Pieces of the view: they grow in number with the orders, not in size."""
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, sf, "orders").count() // PIECE_ROWS))


def _source(spark: SparkSession, sf: str, copies: bool) -> DataFrame:
    """``src_pos`` and the columns that the view is computed from, copies included; as in :func:`flat_sql`, by one join."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    places = f"CASE WHEN {K} % 50 = 3 THEN array({K} * 2, {K} * 2 + 1) ELSE array({K} * 2) END" if copies else f"array({K} * 2)"
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        F.expr(f"explode({places})").alias("src_pos"), K, "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "c_nationkey", "c_mktsegment")


def flat_in_order(spark: SparkSession, sf: str, **options) -> DataFrame:
    """The flat view sorted by ``src_pos``, for files in source order."""
    return _flat(spark, sf, in_order=True, **options)


def flat_duck(**options) -> str:
    """The flat claims view as a DuckDB subquery, with the true column names."""
    inner = flat_sql(**options).format(orders="orders", customer="customer")
    names = ", ".join(f'{_name(c)} AS "{c}"' for c in CLAIM_COLUMNS)
    return f"(SELECT src_pos, {names} FROM ({inner}) raw)"


def reports(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(REPORTS_SQL, orders=table(spark, sf, "orders"))


def reports_duck() -> str:
    return f"({REPORTS_SQL.format(orders='orders')})"

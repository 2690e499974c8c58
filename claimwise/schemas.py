"""Schemas, column mappings and rule constants of the claims data model.

The values below are fixed by the data model: changing one changes results.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: flat claims table, in file order --------------------------
CLAIM_COLUMNS = [
    "months_as_customer", "age", "policy_number", "policy_bind_date", "policy_state",
    "policy_csl", "policy_deductable", "policy_annual_premium", "umbrella_limit",
    "insured_zip", "insured_sex", "insured_education_level", "insured_occupation",
    "insured_hobbies", "insured_relationship", "capital-gains", "capital-loss",
    "incident_date", "incident_type", "collision_type", "incident_severity",
    "authorities_contacted", "incident_state", "incident_city", "incident_location",
    "incident_hour_of_the_day", "number_of_vehicles_involved", "property_damage",
    "bodily_injuries", "witnesses", "police_report_available", "total_claim_amount",
    "injury_claim", "property_claim", "vehicle_claim", "auto_make", "auto_model",
    "auto_year", "fraud_reported", "_c39",
]
ARTEFACT_COLUMN = "_c39"

CLAIMS_RAW = T.StructType([T.StructField(c, T.StringType()) for c in CLAIM_COLUMNS])

# --- fixed values: cell texts read as missing --------------------------------
DEFAULT_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
SENTINEL = "?"

# --- fixed values: five target tables; (source column, target column, SQL type)
# Parents come before children. "@id" is the shared running number.
ROW_ID = "@id"
TABLES = {
    "kunden": [
        (ROW_ID, "kunde_id", "BIGINT"),
        ("age", "alter_jahre", "INT"),
        ("insured_sex", "geschlecht", "VARCHAR(10)"),
        ("insured_education_level", "bildungsniveau", "VARCHAR(20)"),
        ("insured_occupation", "beruf", "VARCHAR(50)"),
        ("insured_hobbies", "hobbys", "VARCHAR(50)"),
        ("insured_relationship", "familienverhaeltnis", "VARCHAR(30)"),
        ("insured_zip", "plz", "VARCHAR(10)"),
        ("capital-gains", "kapitalgewinne", "INT"),
        ("capital-loss", "kapitalverluste", "INT"),
        ("months_as_customer", "kunde_seit_monaten", "INT"),
    ],
    "policen": [
        (ROW_ID, "police_id", "BIGINT"),
        (ROW_ID, "kunde_id", "BIGINT"),
        ("policy_number", "policen_nummer", "INT"),
        ("policy_bind_date", "vertragsbeginn", "DATE"),
        ("policy_state", "bundesstaat", "VARCHAR(5)"),
        ("policy_csl", "deckungsgrenze", "VARCHAR(20)"),
        ("policy_deductable", "selbstbeteiligung", "INT"),
        ("policy_annual_premium", "jahrespraemie", "DECIMAL(10,2)"),
        ("umbrella_limit", "umbrella_limit", "BIGINT"),
    ],
    "fahrzeuge": [
        (ROW_ID, "fahrzeug_id", "BIGINT"),
        (ROW_ID, "police_id", "BIGINT"),
        ("auto_make", "marke", "VARCHAR(30)"),
        ("auto_model", "modell", "VARCHAR(30)"),
        ("auto_year", "baujahr", "INT"),
    ],
    "unfaelle": [
        (ROW_ID, "unfall_id", "BIGINT"),
        (ROW_ID, "police_id", "BIGINT"),
        ("incident_date", "unfall_datum", "DATE"),
        ("incident_type", "unfall_typ", "VARCHAR(40)"),
        ("collision_type", "kollisions_typ", "VARCHAR(30)"),
        ("incident_severity", "schadensschwere", "VARCHAR(20)"),
        ("authorities_contacted", "behoerde", "VARCHAR(20)"),
        ("incident_state", "bundesstaat", "VARCHAR(5)"),
        ("incident_city", "stadt", "VARCHAR(40)"),
        ("incident_location", "adresse", "VARCHAR(80)"),
        ("incident_hour_of_the_day", "uhrzeit_stunde", "INT"),
        ("number_of_vehicles_involved", "anzahl_fahrzeuge", "INT"),
        ("property_damage", "sachschaden_dritter", "VARCHAR(5)"),
        ("bodily_injuries", "anzahl_verletzte", "INT"),
        ("witnesses", "anzahl_zeugen", "INT"),
        ("police_report_available", "polizeibericht", "VARCHAR(5)"),
    ],
    "schaeden": [
        (ROW_ID, "schaden_id", "BIGINT"),
        (ROW_ID, "unfall_id", "BIGINT"),
        ("total_claim_amount", "gesamtschaden", "DECIMAL(12,2)"),
        ("injury_claim", "personenschaden", "DECIMAL(12,2)"),
        ("property_claim", "sachschaden", "DECIMAL(12,2)"),
        ("vehicle_claim", "fahrzeugschaden", "DECIMAL(12,2)"),
        ("fraud_reported", "betrug_gemeldet", "BOOLEAN"),
    ],
}
PRIMARY_KEYS = {
    "kunden": "kunde_id", "policen": "police_id", "fahrzeuge": "fahrzeug_id",
    "unfaelle": "unfall_id", "schaeden": "schaden_id",
}
UNIQUE_KEYS = [("policen", "policen_nummer")]
FOREIGN_KEYS = [
    ("policen", "kunde_id", "kunden", "kunde_id"),
    ("fahrzeuge", "police_id", "policen", "police_id"),
    ("unfaelle", "police_id", "policen", "police_id"),
    ("schaeden", "unfall_id", "unfaelle", "unfall_id"),
]
NOT_NULL = [
    ("kunden", "alter_jahre"), ("policen", "kunde_id"), ("policen", "policen_nummer"),
    ("fahrzeuge", "police_id"), ("unfaelle", "police_id"), ("schaeden", "unfall_id"),
]
RANGES = [("unfaelle", "uhrzeit_stunde", 0, 23)]

# --- fixed values: cleaning --------------------------------------------------
MAKE_FIXES = {"Accura": "Acura", "Suburu": "Subaru"}
USD_TO_EUR = 0.92

# --- fixed values: report features and scoring -------------------------------
# First matching rule wins; the text is lower-cased before the search, so a
# keyword with a capital letter can never match and is therefore not listed.
SEVERITY_RULES = [
    ("Total Loss", ["totalschaden", "total zerstört", "abgeschleppt"]),
    ("Major Damage", ["erheblich", "schwer beschädigt"]),
    ("Trivial Damage", ["kratzer", "bagatelle", "geringfügig"]),
]
DEFAULT_SEVERITY = "Minor Damage"
# (output column, pattern over the lower-cased text, value without a match, text in every match)
COUNT_RULES = [
    ("vehicles", r"(\d+)\s*fahrzeug", 1, "fahrzeug"),
    ("injured", r"(\d+)\s*(personen?\s*)?verletzt", 0, "verletzt"),
    ("witnesses", r"(\d+)\s*zeug", 0, "zeug"),
]
POLICE_KEYWORD = "polizei"
BASE_AMOUNTS = {
    "Trivial Damage": 5000.0,
    "Minor Damage": 35000.0,
    "Major Damage": 62000.0,
    "Total Loss": 65000.0,
}
PER_EXTRA_VEHICLE = 4000.0
PER_INJURED = 3000.0
SEVERITY_GERMAN = {
    "Trivial Damage": "Bagatellschaden",
    "Minor Damage": "Leichter Schaden",
    "Major Damage": "Erheblicher Schaden",
    "Total Loss": "Totalschaden",
}
FEATURE_LABELS = {
    "severity": "Schadensschwere",
    "vehicles": "Beteiligte Fahrzeuge",
    "injured": "Verletzte Personen",
    "witnesses": "Zeugen",
    "police": "Polizei informiert",
}

# --- fixed values: report generation -----------------------------------------
CASE_TYPES = ["Front Collision", "Parked Car", "Rear Collision", "Side Collision", "Vehicle Theft"]
DEFAULT_CASE = "Side Collision"
MAJOR_SEVERITIES = ["Major Damage", "Total Loss"]


def varchar_limit(sql_type: str) -> int | None:
    """Length limit of a ``VARCHAR(n)`` type text, else ``None``."""
    return int(sql_type[8:-1]) if sql_type.startswith("VARCHAR(") else None


def spark_type(sql_type: str) -> str:
    """Type to cast to; character limits are audited, not cast."""
    return "STRING" if sql_type.startswith("VARCHAR(") else sql_type


def table_schema(name: str) -> T.StructType:
    """Typed target schema of one of the five tables."""
    ddl = ", ".join(f"{target} {spark_type(kind)}" for _, target, kind in TABLES[name])
    return T.StructType.fromDDL(ddl)

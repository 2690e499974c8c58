"""Registered queries, and for each the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import synth_sql, views as V
from claimwise.operators import audits, cleaning, cube, encode, model, normalise, prepare, ranking, reports, stats, synth
from claimwise.plans import analysis, etl, prepared, scoring
from claimwise.schemas import (
    CLAIM_COLUMNS, CLAIMS_RAW, DEFAULT_NULL_TOKENS, FEATURE_LABELS, SENTINEL, PRIMARY_KEYS, SEVERITY_GERMAN, TABLES, spark_type,
)
from claimwise.session import scratch_path, shared_dir, stage
from claimwise.sources.readers import (
    read_claims, read_claims_optional, read_claims_strict, read_csv_text, read_tables,
)
from claimwise.sources.writers import write_csv
from claimwise.streaming.scores import report_stream, run_scores, run_scores_and_rejects, scored_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(sql: str | None = None, name: str | None = None):
    def add(query: Query) -> Query:
        key = name or query.__name__
        QUERIES[key] = query
        if sql is not None:
            SQL[key] = sql
        return query
    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """DOUBLE columns rounded, so that summation order does not show."""
    return df.select(*[
        F.round(F.col(f"`{n}`"), digits).alias(n) if kind == "double" else F.col(f"`{n}`") for n, kind in df.dtypes])


def r(expr: str, digits: int = 6) -> str:
    """Rounded expression for the SQL side; NaN counts as missing."""
    return f"CASE WHEN isnan({expr}) THEN NULL ELSE round({expr}, {digits}) END"


def quoted_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


COLUMNS = [c for c in CLAIM_COLUMNS if c != "_c39"]
NULL_TEXTS = quoted_list([*DEFAULT_NULL_TOKENS, SENTINEL])


def nulled(columns, tokens: str, source: str, extra: str = "src_pos") -> str:
    cells = ", ".join(f'CASE WHEN "{c}" IN ({tokens}) THEN NULL ELSE "{c}" END AS "{c}"' for c in columns)
    return f"(SELECT {extra + ', ' if extra else ''}{cells} FROM {source} f)"


FLAT = V.flat_duck()
STRICT = nulled(CLAIM_COLUMNS, NULL_TEXTS, FLAT)
COMPLETE = " AND ".join(f'"{c}" IS NOT NULL' for c in COLUMNS)
NAMES = ", ".join(f'"{c}"' for c in COLUMNS)


def strict(spark: SparkSession, sf: str) -> DataFrame:
    """The flat view with null tokens applied, written once, as the prepared-data job does."""
    return V.written(spark, sf, "strict", lambda: cleaning.nullify_file_tokens(V._flat(spark, sf), [SENTINEL]))


def flat_csv(spark: SparkSession, sf: str, **options) -> str:
    """Write the flat view as CSV files whose file order is the source order."""
    path = scratch_path(spark, "flat-csv")
    write_csv(V.flat_in_order(spark, sf, **options), path)
    return path


# --- sources and sinks --------------------------------------------------------

@register(f"SELECT * FROM {nulled([*CLAIM_COLUMNS], quoted_list(DEFAULT_NULL_TOKENS), FLAT, 'CAST(src_pos AS STRING) AS src_pos')}")
def csv_claims(spark, sf):
    return read_claims(spark, flat_csv(spark, sf))


@register(f"SELECT * FROM {nulled([*CLAIM_COLUMNS], NULL_TEXTS, FLAT, 'CAST(src_pos AS STRING) AS src_pos')}")
def csv_claims_strict(spark, sf):
    return read_claims_strict(spark, flat_csv(spark, sf))


@register(f"SELECT * REPLACE (CAST(src_pos AS STRING) AS src_pos) FROM {FLAT} f")
def csv_text(spark, sf):
    return read_csv_text(spark, flat_csv(spark, sf))


@register(f"SELECT 'present' AS source, count(*) AS rows FROM {FLAT} f UNION ALL SELECT 'absent', 0")
def csv_optional(spark, sf):
    path = flat_csv(spark, sf)
    count = lambda label, df: df.agg(F.count("*").alias("rows")).select(F.lit(label).alias("source"), "rows")
    schema = CLAIMS_RAW.__class__([CLAIMS_RAW.__class__().add("src_pos", "string").fields[0], *CLAIMS_RAW.fields])
    return count("present", read_claims_optional(spark, path, schema)).unionByName(
        count("absent", read_claims_optional(spark, path + "-none", schema)))


@register("SELECT CAST(o_orderkey AS STRING) AS o_orderkey, o_orderpriority || chr(10) || '\"' || o_orderstatus || '\", ' AS note FROM orders")
def csv_quoted_lines(spark, sf):
    """Line breaks, quotes and commas inside quoted fields, written and read again."""
    path = scratch_path(spark, "quoted-csv")
    note = F.concat("o_orderpriority", F.lit('\n"'), "o_orderstatus", F.lit('", '))
    write_csv(V.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string"), note.alias("note")), path)
    return read_csv_text(spark, path)


@register("SELECT 'surplus field' AS fault, count(*) > 0 AS refused FROM orders UNION ALL SELECT 'line break in quotes', count(*) > 0 FROM orders")
def csv_bad_rows(spark, sf):
    """A record with a field too many, and a broken line read as whole lines, are errors."""
    rows, found = V.table(spark, sf, "orders"), []
    key = F.col("o_orderkey").cast("string")
    for fault, lines in (("surplus field", [F.concat(key, F.lit(",b,c"))]),
                         ("line break in quotes", [F.concat(key, F.lit(',"b')), F.lit('b"')])):
        path = scratch_path(spark, "bad-csv")
        # other separators than the reader's, so that the lines are written as they are
        (rows.select(F.explode(F.array(*lines)).alias("a,b")).write.option("header", True)
         .option("sep", "\u0001").option("quote", "\u0002").csv(path))
        try:
            read_csv_text(spark, path, multiline=False).write.format("noop").mode("overwrite").save()
            found.append((fault, False))
        except Exception as error:  # noqa: BLE001 - the kind of error depends on where it is found
            found.append((fault, "more fields than columns" in str(error) or "unbalanced quotes" in str(error)))
    return spark.createDataFrame(found, "fault string, refused boolean")


CLEAN = V.flat_duck(copies=False, clean=True)
CLEAN_NULLED = nulled(CLAIM_COLUMNS, NULL_TEXTS, CLEAN)
NUMBERED = f"(SELECT *, row_number() OVER (ORDER BY src_pos) AS lfd_id FROM {CLEAN_NULLED} n)"


@register(f"""SELECT lfd_id AS schaden_id, CAST(age AS INT) AS alter_jahre, auto_make AS marke,
    incident_severity AS schadensschwere, CAST(total_claim_amount AS DECIMAL(12,2)) AS gesamtschaden
    FROM {NUMBERED} n""")
def load_job(spark, sf):
    """CSV -> row numbers in file order -> audits -> five tables -> read back -> five-way join."""
    location = scratch_path(spark, "tables")
    etl.run_load(spark, flat_csv(spark, sf, copies=False, clean=True), location)
    return normalise.join_claims(read_tables(spark, location, list(TABLES)), [
        "schaeden.schaden_id", "kunden.alter_jahre", "fahrzeuge.marke",
        "unfaelle.schadensschwere", "schaeden.gesamtschaden"])


@register(f"""WITH f AS {FLAT}, s AS (SELECT * FROM {STRICT} x), n AS (SELECT * FROM s WHERE NOT ({COMPLETE})),
    d AS (SELECT src_pos FROM (SELECT src_pos, row_number() OVER (PARTITION BY {NAMES} ORDER BY src_pos) AS pos_
          FROM s WHERE {COMPLETE}) q WHERE pos_ > 1),
    c AS (SELECT (SELECT count(*) FROM s) AS o, (SELECT count(*) FROM n) AS n, (SELECT count(*) FROM d) AS d)
    SELECT 0 AS section, CAST(0 AS BIGINT) AS position, 'Original rows: ' || o AS line FROM c
    UNION ALL SELECT 0, 1, 'Removed fully empty columns (1): _c39'
    UNION ALL SELECT 0, 2, 'Removed rows with null values: ' || n FROM c
    UNION ALL SELECT 0, 3, 'Removed duplicate rows: ' || d FROM c
    UNION ALL SELECT 0, 4, 'Final rows: ' || (o - n - d) FROM c
    UNION ALL SELECT 1, -2, '' UNION ALL SELECT 1, -1, 'Rows removed because of null values:'
    UNION ALL SELECT 2, -2, '' UNION ALL SELECT 2, -1, 'Duplicate rows removed:'
    UNION ALL SELECT 1, src_pos, '- row_index=' || src_pos FROM n
    UNION ALL SELECT 2, src_pos, '- row_index=' || src_pos FROM d""")
def cleanup_report_lines(spark, sf):
    df = strict(spark, sf)
    return cleaning.cleanup_report_lines(
        cleaning.cleanup_summary(df, "src_pos"), cleaning.cleanup_rejects(df, "src_pos"))


# --- cleaning -----------------------------------------------------------------

@register(f"SELECT * FROM {nulled(COLUMNS, quoted_list([SENTINEL]), FLAT)} n")
def null_tokens(spark, sf):
    return cleaning.nullify_tokens(cleaning.drop_column(V.flat(spark, sf), "_c39"))


@register(f"SELECT src_pos, {NAMES} FROM {STRICT} s")
def drop_empty_columns(spark, sf):
    return cleaning.drop_empty_columns(strict(spark, sf))


@register(f"SELECT src_pos, {NAMES} FROM {STRICT} s WHERE {COMPLETE}")
def drop_null_rows(spark, sf):
    return cleaning.drop_null_rows(cleaning.drop_empty_columns(strict(spark, sf)))


@register(f"SELECT src_pos, {NAMES} FROM {STRICT} s WHERE NOT ({COMPLETE})")
def null_rows(spark, sf):
    return cleaning.null_rows(cleaning.drop_empty_columns(strict(spark, sf)))


@register(f"SELECT min(src_pos) AS src_pos, {NAMES} FROM {STRICT} s GROUP BY ALL")
def drop_duplicate_rows(spark, sf):
    return cleaning.drop_duplicate_rows(strict(spark, sf).drop("_c39"), "src_pos")


@register(f"""SELECT src_pos FROM (SELECT src_pos, row_number() OVER (PARTITION BY {NAMES} ORDER BY src_pos) AS pos_
    FROM {STRICT} s) q WHERE pos_ > 1""")
def duplicate_rows(spark, sf):
    return cleaning.duplicate_rows(strict(spark, sf).drop("_c39"), "src_pos")


@register("SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def distinct_documents(spark, sf):
    return cleaning.drop_duplicate_rows(V.table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


@register(f"""WITH s AS (SELECT * FROM {STRICT} x)
    SELECT count(*) AS original_rows, CAST(1 AS BIGINT) AS emptied_columns, '_c39' AS emptied_names,
    count(*) FILTER (WHERE NOT ({COMPLETE})) AS null_rows,
    count(*) FILTER (WHERE {COMPLETE}) - (SELECT count(*) FROM (SELECT DISTINCT {NAMES} FROM s WHERE {COMPLETE}) d) AS duplicate_rows,
    (SELECT count(*) FROM (SELECT DISTINCT {NAMES} FROM s WHERE {COMPLETE}) d) AS final_rows FROM s""")
def cleanup_report(spark, sf):
    return cleaning.cleanup_summary(strict(spark, sf), "src_pos")


@register(f"""WITH s AS (SELECT * FROM {STRICT} x)
    SELECT src_pos AS row_index, 'null' AS reason FROM s WHERE NOT ({COMPLETE})
    UNION ALL SELECT src_pos, 'duplicate' FROM (SELECT src_pos, row_number() OVER (PARTITION BY {NAMES} ORDER BY src_pos) AS pos_
    FROM s WHERE {COMPLETE}) q WHERE pos_ > 1""")
def cleanup_rejects(spark, sf):
    return cleaning.cleanup_rejects(strict(spark, sf), "src_pos")


@register(f"""SELECT src_pos, CAST(policy_bind_date AS DATE) AS policy_bind_date,
    CAST(incident_date AS DATE) AS incident_date FROM {FLAT} f""")
def parse_dates(spark, sf):
    df = V.flat(spark, sf).select("src_pos", "policy_bind_date", "incident_date")
    return cleaning.parse_dates(df, ["policy_bind_date", "incident_date"])


@register(f"""SELECT src_pos, CASE fraud_reported WHEN 'Y' THEN true WHEN 'N' THEN false END AS fraud_reported FROM {FLAT} f""")
def flag_to_boolean(spark, sf):
    return cleaning.flag_to_boolean(V.flat(spark, sf).select("src_pos", "fraud_reported"), "fraud_reported")


@register("SELECT event_id, user_id, value, row_number() OVER (ORDER BY event_id) AS row_index FROM events")
def row_index(spark, sf):
    return ranking.row_index(V.table(spark, sf, "events").select("event_id", "user_id", "value"), "event_id")


@register(f"""SELECT src_pos, TRY_CAST(total_claim_amount AS DOUBLE) AS total_claim_amount,
    TRY_CAST(vehicle_claim AS DOUBLE) AS vehicle_claim, CAST(NULL AS DOUBLE) AS incident_location FROM {FLAT} f""")
def coerce_numbers(spark, sf):
    df = V.flat(spark, sf).select("src_pos", "total_claim_amount", "vehicle_claim", "incident_location")
    return cleaning.coerce_columns(df, ["total_claim_amount", "vehicle_claim", "incident_location"])


GAPS = """(SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
    CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice, l_discount,
    CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag, l_linestatus,
    CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE CAST(l_partkey AS STRING) END AS part FROM {lineitem})"""
GAPS_DUCK = GAPS.format(lineitem="lineitem")


def gaps(spark, sf) -> DataFrame:
    return spark.sql(f"SELECT * FROM {GAPS} g", lineitem=V.table(spark, sf, "lineitem"))


@register(f"""SELECT l_orderkey, l_linenumber, l_partkey,
    coalesce(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM {GAPS_DUCK} a)) AS l_quantity,
    coalesce(l_extendedprice, (SELECT quantile_cont(l_extendedprice, 0.5) FROM {GAPS_DUCK} a)) AS l_extendedprice
    FROM {GAPS_DUCK} g""")
def impute_median(spark, sf):
    return cleaning.impute_median(gaps(spark, sf), ["l_quantity", "l_extendedprice"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


def mode_sql(c: str) -> str:
    return (f"coalesce({c}, (SELECT {c} FROM {GAPS_DUCK} a WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}")


@register(f"SELECT l_orderkey, l_linenumber, l_partkey, {mode_sql('l_returnflag')}, {mode_sql('part')} FROM {GAPS_DUCK} g")
def impute_mode(spark, sf):
    return cleaning.impute_mode(gaps(spark, sf), ["l_returnflag", "part"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "part")


@register(f"""SELECT src_pos, CASE auto_make WHEN 'Accura' THEN 'Acura' WHEN 'Suburu' THEN 'Subaru' ELSE auto_make END AS auto_make
    FROM {FLAT} f""")
def fix_values(spark, sf):
    return cleaning.fix_values(V.flat(spark, sf).select("src_pos", "auto_make"))


PREPARED = """trim(auto_make) || ' ' || trim(auto_model) AS auto_make_model, auto_year, incident_severity,
    coalesce(CASE WHEN trim(collision_type) NOT IN ('', '?') THEN trim(collision_type) END,
             CASE WHEN trim(incident_type) NOT IN ('', '?') THEN trim(incident_type) END, 'Unknown') AS collision_type,
    round_even(coalesce(TRY_CAST(total_claim_amount AS DOUBLE), TRY_CAST(vehicle_claim AS DOUBLE), 0.0::DOUBLE) * 0.92::DOUBLE * 100, 0) / 100
      AS claim_amount_eur"""


@register(f"SELECT src_pos, {PREPARED} FROM {FLAT} f")
def prepared_columns(spark, sf):
    return prepare.prepared_columns(V.flat(spark, sf), keep=["src_pos"])


FIXED = f"""(SELECT * REPLACE (CASE auto_make WHEN 'Accura' THEN 'Acura' WHEN 'Suburu' THEN 'Subaru' ELSE auto_make END AS auto_make)
    FROM (SELECT min(src_pos) AS src_pos, {NAMES} FROM {STRICT} s WHERE {COMPLETE} GROUP BY ALL) d)"""


@register(synth_sql.report_sql(f"(SELECT src_pos, {PREPARED} FROM {FIXED} x)", "src_pos", 42,
                               ["src_pos", "auto_make_model", "auto_year", "incident_severity", "collision_type", "claim_amount_eur"],
                               candidates=["collision_type"]))
def prepared_dataset(spark, sf):
    return prepared.prepare(strict(spark, sf), "src_pos")


@register("SELECT l_orderkey, l_linenumber, l_extendedprice AS price_claim FROM lineitem")
def drop_leakage(spark, sf):
    df = V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price_claim"),
        F.col("l_tax").alias("tax_CLAIM"), F.col("l_discount").alias("claim_discount"))
    return cleaning.drop_leakage(df, "price_claim")


def per_column(columns, template: str, source: str) -> str:
    return " UNION ALL ".join(template.format(c=c) + f" FROM {source} s" for c in columns)


@register(per_column([*COLUMNS, "_c39", "src_pos"], "SELECT '{c}' AS \"column\", count(*) - count(\"{c}\") AS nulls", STRICT))
def null_profile(spark, sf):
    return cleaning.null_profile(strict(spark, sf))


@register("SELECT CAST(sum(nulls) AS BIGINT) AS nulls FROM (" + SQL["null_profile"] + ") p")
def total_nulls(spark, sf):
    return cleaning.total_nulls(strict(spark, sf))


@register(per_column([*COLUMNS, "_c39"], "SELECT '{c}' AS \"column\", 'string' AS dtype, count(\"{c}\") AS non_null, count(*) AS rows", STRICT)
          + f" UNION ALL SELECT 'src_pos', 'bigint', count(src_pos), count(*) FROM {STRICT} s")
def table_profile(spark, sf):
    return cleaning.table_profile(strict(spark, sf))


@register("SELECT o_totalprice, o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5")
def head_ordered(spark, sf):
    return cleaning.head_ordered(V.table(spark, sf, "orders").select("o_totalprice", "o_orderkey"), ["o_totalprice", "o_orderkey"], 5)


@register(f"SELECT 'kept' AS part, report_id, text FROM {V.reports_duck()} x WHERE trim(text) <> '' "
          f"UNION ALL SELECT 'rejected', report_id, text FROM {V.reports_duck()} x WHERE trim(text) = ''")
def reject_blank(spark, sf):
    kept, rejected = cleaning.reject_blank(V.reports(spark, sf), "text")
    return kept.select(F.lit("kept").alias("part"), "*").unionByName(rejected.select(F.lit("rejected").alias("part"), "*"))


# --- normalised tables and joins ----------------------------------------------

def table_sql(name: str, source: str = "n") -> str:
    date = ("policy_bind_date", "incident_date")
    def cell(src, kind):
        if src == "@id":
            return "src_pos + 1"
        c = f'CASE WHEN "{src}" = \'?\' THEN NULL ELSE "{src}" END'
        if src == "fraud_reported":
            return "CASE fraud_reported WHEN 'Y' THEN true WHEN 'N' THEN false END"
        if src in date or kind.startswith(("INT", "BIGINT", "DECIMAL")):
            return f"CAST(nullif({c}, '') AS {kind})"
        return c
    return ", ".join(f"{cell(s, k)} AS {t}" for s, t, k in TABLES[name])


def claims_for_split(spark, sf) -> DataFrame:
    df = V.flat(spark, sf, copies=False, clean=True).withColumn("lfd_id", F.col("src_pos") + 1)
    return etl.transform(cleaning.nullify_tokens(df, ["", SENTINEL]))


def _split(name: str) -> Query:
    def query(spark, sf):
        return normalise.split_table(claims_for_split(spark, sf), name, "lfd_id")
    return query


for _name in TABLES:
    register(f"SELECT {table_sql(_name)} FROM {CLEAN} n", name=f"split_{_name}")(_split(_name))


@register(f"""SELECT CAST(age AS INT) AS alter_jahre, auto_make AS marke, incident_severity AS schadensschwere,
    CAST(nullif(total_claim_amount, '') AS DECIMAL(12,2)) AS gesamtschaden, v AS fahrzeug
    FROM {CLEAN} n JOIN (SELECT 1 AS v UNION ALL SELECT 2) w ON v <= 1 + src_pos % 4 // 2""")
def five_way_join(spark, sf):
    """Every second policy has two vehicles, so relations are 1:n."""
    tables = normalise.split_claims(claims_for_split(spark, sf), "lfd_id")
    copies = F.sequence(F.lit(1), F.when((F.col("police_id") - 1) % 4 == 2, 2).otherwise(1))
    tables["fahrzeuge"] = tables["fahrzeuge"].withColumn("fahrzeug", F.explode(copies))
    return normalise.join_claims(tables, ["kunden.alter_jahre", "fahrzeuge.marke", "unfaelle.schadensschwere",
                                          "schaeden.gesamtschaden", "fahrzeuge.fahrzeug"])


@register(f"""SELECT n_name AS nation, {r('avg(l_extendedprice)', 4)} AS mean FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def joined_group_mean(spark, sf):
    t = lambda n: V.table(spark, sf, n)
    joined = (
        t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("nation"), "l_extendedprice"))
    return rounded(stats.group_mean(joined, "nation", "l_extendedprice"), 4)


@register("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 10 = 3""")
def orphan_rows(spark, sf):
    orders = V.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    known = V.table(spark, sf, "customer").where("c_custkey % 10 <> 3")
    return normalise.orphan_rows(orders, "o_custkey", known, "c_custkey")


# --- audits -------------------------------------------------------------------

def dirty_tables(spark, sf) -> dict[str, DataFrame]:
    """Five text-typed tables with broken rows: copies, orphans, long texts, bad numbers."""
    df = cleaning.nullify_tokens(V.flat(spark, sf), [""])
    df = df.withColumn("lfd_id", F.floor(F.col("src_pos") / 2) + 1).withColumns({
        "age": F.when(F.col("lfd_id") % 19 == 0, None).otherwise(F.col("age")),
        "incident_city": F.when(F.col("lfd_id") % 37 == 0, F.repeat("incident_city", F.lit(6))).otherwise(F.col("incident_city")),
        "policy_annual_premium": F.when(F.col("lfd_id") % 41 == 0, F.concat(F.lit("12345"), "policy_annual_premium"))
        .otherwise(F.col("policy_annual_premium")),
    })
    tables = normalise.split_claims(df, "lfd_id", typed=False)
    tables["unfaelle"] = tables["unfaelle"].withColumn(
        "police_id", F.when(F.col("police_id") % 101 == 0, -F.col("police_id")).otherwise(F.col("police_id")))
    return tables


DIRTY = f"""(SELECT * REPLACE (CASE WHEN id % 19 = 0 THEN NULL ELSE age END AS age,
    CASE WHEN id % 37 = 0 THEN repeat(incident_city, 6) ELSE incident_city END AS incident_city,
    CASE WHEN id % 41 = 0 THEN '12345' || policy_annual_premium ELSE policy_annual_premium END AS policy_annual_premium)
    FROM (SELECT *, src_pos // 2 + 1 AS id FROM {nulled(CLAIM_COLUMNS, "''", FLAT)} f) g)"""


def rule_sql(rule: str, condition: str) -> str:
    return f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {condition}) AS violations FROM {DIRTY} d"


def _local_audit(make_rules, conditions: dict[str, str]):
    def query(spark, sf):
        result = None
        for name, df in dirty_tables(spark, sf).items():
            rules = make_rules(name)
            if rules:
                part = audits.count_violations(df, rules)
                result = part if result is None else result.unionByName(part)
        return result
    return query, " UNION ALL ".join(rule_sql(rule, c) for rule, c in conditions.items())


_q, _s = _local_audit(audits.not_null_rules, {
    "not_null kunden.alter_jahre": "age IS NULL", "not_null kunden.kunde_id": "id IS NULL",
    "not_null policen.kunde_id": "id IS NULL", "not_null policen.policen_nummer": "policy_number IS NULL",
    "not_null policen.police_id": "id IS NULL", "not_null fahrzeuge.police_id": "id IS NULL",
    "not_null fahrzeuge.fahrzeug_id": "id IS NULL", "not_null unfaelle.police_id": "id IS NULL",
    "not_null unfaelle.unfall_id": "id IS NULL", "not_null schaeden.unfall_id": "id IS NULL",
    "not_null schaeden.schaden_id": "id IS NULL"})
register(_s, name="audit_not_null")(_q)
_q, _s = _local_audit(audits.range_rules, {
    "check unfaelle.uhrzeit_stunde": "CAST(incident_hour_of_the_day AS INT) NOT BETWEEN 0 AND 23"})
register(_s, name="audit_check")(_q)
_q, _s = _local_audit(audits.length_rules, {
    f"length {t}.{target}": f'length("{source}") > {kind[8:-1]}'
    for t, cells in TABLES.items() for source, target, kind in cells if kind.startswith("VARCHAR")})
register(_s, name="audit_length")(_q)
_q, _s = _local_audit(audits.numeric_rules, {
    f"numeric {t}.{target}": f'"{source}" IS NOT NULL AND TRY_CAST("{source}" AS {kind}) IS NULL'
    for t, cells in TABLES.items() for source, target, kind in cells if kind.startswith("DECIMAL")})
register(_s, name="audit_numeric")(_q)


@register(" UNION ALL ".join(
    f"SELECT 'unique {t}.{c}' AS rule, count({s}) - count(DISTINCT {s}) AS violations FROM {DIRTY} d"
    for t, c, s in [("kunden", "kunde_id", "id"), ("policen", "police_id", "id"), ("fahrzeuge", "fahrzeug_id", "id"),
                    ("unfaelle", "unfall_id", "id"), ("schaeden", "schaden_id", "id"),
                    ("policen", "policen_nummer", "policy_number")]))
def audit_unique(spark, sf):
    return audits.unique_summary(dirty_tables(spark, sf))


AUDITED = f"(SELECT *, lfd_id AS id FROM {NUMBERED} n)"
LIMITS = [(t, c, s, kind) for t, columns in TABLES.items() for s, c, kind in columns]


def audit_rules() -> list[tuple[str, str]]:
    """Rule and the condition that breaks it, over the flat rows."""
    cell = lambda s: "id" if s == "@id" else f'"{s}"'
    at = {(t, c): cell(s) for t, c, s, _ in LIMITS}
    required = [("kunden", "alter_jahre"), ("policen", "kunde_id"), ("policen", "policen_nummer"), ("fahrzeuge", "police_id"),
                ("unfaelle", "police_id"), ("schaeden", "unfall_id"), *PRIMARY_KEYS.items()]
    out = [(f"not_null {t}.{c}", f"{at[t, c]} IS NULL") for t, c in required]
    out.append(("check unfaelle.uhrzeit_stunde", "coalesce(TRY_CAST(incident_hour_of_the_day AS BIGINT) NOT BETWEEN 0 AND 23, false)"))
    for t, c, s, kind in LIMITS:
        if kind.startswith("VARCHAR("):
            out.append((f"length {t}.{c}", f"coalesce(length({cell(s)}) > {kind[8:-1]}, false)"))
        elif kind not in ("DATE", "BOOLEAN"):
            label = "numeric" if kind.startswith("DECIMAL") else "type"
            out.append((f"{label} {t}.{c}", f"{cell(s)} IS NOT NULL AND TRY_CAST({cell(s)} AS {kind}) IS NULL"))
    return out


@register(" UNION ALL ".join(
    [f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {broken}) AS violations FROM {AUDITED} a" for rule, broken in audit_rules()]
    + [f"SELECT 'unique {t}.{c}', count({s}) - count(DISTINCT {s}) FROM {AUDITED} a" for t, c, s in
       [*((t, c, "id") for t, c in PRIMARY_KEYS.items()), ("policen", "policen_nummer", "policy_number")]]
    + [f"SELECT 'foreign_key {k}', 0" for k in ("policen.kunde_id", "fahrzeuge.police_id", "unfaelle.police_id", "schaeden.unfall_id")]))
def audit_all(spark, sf):
    """Every rule of the five tables, from the flat frame."""
    return audits.audit_flat(etl.transform(etl.extract(spark, flat_csv(spark, sf, copies=False, clean=True))), etl.ROW_NUMBER)


@register(f"""SELECT 'foreign_key ' || r AS rule, CASE WHEN r = 'unfaelle.police_id' THEN n ELSE 0 END AS violations
    FROM (SELECT count(*) FILTER (WHERE id % 101 = 0) AS n FROM {DIRTY} d) c,
    (SELECT unnest(['policen.kunde_id', 'fahrzeuge.police_id', 'unfaelle.police_id', 'schaeden.unfall_id']) AS r) k""")
def audit_foreign_key(spark, sf):
    return audits.foreign_key_summary(dirty_tables(spark, sf))


@register("SELECT o_custkey AS key, count(*) AS copies FROM orders GROUP BY 1 HAVING count(*) > 1")
def repeated_keys(spark, sf):
    return audits.repeated_keys(V.table(spark, sf, "orders"), "o_custkey")


@register("SELECT o_custkey AS key, count(*) AS children FROM orders WHERE o_custkey % 10 = 3 GROUP BY 1")
def orphan_keys(spark, sf):
    known = V.table(spark, sf, "customer").where("c_custkey % 10 <> 3")
    return audits.orphan_keys(V.table(spark, sf, "orders"), "o_custkey", known, "c_custkey")


@register(f"""SELECT -id AS police_id, id AS unfall_id, 'check unfaelle.uhrzeit_stunde' AS broken FROM {DIRTY} d
    WHERE incident_hour_of_the_day = '24' AND id % 101 = 0 UNION ALL
    SELECT id, id, 'check unfaelle.uhrzeit_stunde' FROM {DIRTY} d WHERE incident_hour_of_the_day = '24' AND id % 101 <> 0""")
def violating_rows(spark, sf):
    broken = audits.violating_rows(dirty_tables(spark, sf)["unfaelle"], audits.range_rules("unfaelle"))
    return broken.select("police_id", "unfall_id", F.array_join("broken_rules", "; ").alias("broken"))


# --- statistics ---------------------------------------------------------------

@register(f"""SELECT collision_type, {r("avg(TRY_CAST(vehicle_claim AS DOUBLE))", 4)} AS mean FROM {STRICT} s
    WHERE collision_type IS NOT NULL GROUP BY 1""")
def group_mean(spark, sf):
    df = cleaning.coerce_columns(strict(spark, sf), ["vehicle_claim"])
    return rounded(stats.group_mean(df, "collision_type", "vehicle_claim"), 4)


@register(f"""SELECT l_returnflag, {r('avg(l_extendedprice)', 4)} AS mean, {r('quantile_cont(l_extendedprice, 0.5)', 4)} AS median,
    count(l_extendedprice) AS count FROM {GAPS_DUCK} g WHERE l_returnflag IS NOT NULL GROUP BY 1""")
def group_mean_median_count(spark, sf):
    return rounded(stats.group_summary(gaps(spark, sf), "l_returnflag", "l_extendedprice"), 4)


def describe_sql(c: str, source: str) -> str:
    return f"""SELECT '{c}' AS feature, count({c}) AS count, {r(f'avg({c})', 4)} AS mean, {r(f'stddev_samp({c})', 4)} AS std,
    min({c}) AS min, {r(f'quantile_cont({c}, 0.25)', 4)} AS p25, {r(f'quantile_cont({c}, 0.5)', 4)} AS p50,
    {r(f'quantile_cont({c}, 0.75)', 4)} AS p75, max({c}) AS max FROM {source} s"""


@register(" UNION ALL ".join(describe_sql(c, GAPS_DUCK) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def describe_columns(spark, sf):
    return rounded(stats.describe(gaps(spark, sf), ["l_quantity", "l_extendedprice", "l_discount"]), 4)


@register(f"""WITH v AS (SELECT l_extendedprice AS v FROM {GAPS_DUCK} g WHERE l_extendedprice IS NOT NULL),
    e AS (SELECT min(v) AS low, max(v) AS high, (max(v) - min(v)) / 30.0::DOUBLE AS w FROM v),
    i AS (SELECT v, low, high, w, least(29, CAST(floor((v - low) / w) AS INT)) AS i FROM v, e),
    b AS (SELECT CASE WHEN v < low + i * w THEN i - 1 WHEN i < 29 AND v >= low + (i + 1) * w THEN i + 1 ELSE i END AS b FROM i)
    SELECT CAST(k + 1 AS INT) AS bin, {r('low + k * w', 4)} AS low, {r('CASE WHEN k = 29 THEN high ELSE low + (k + 1) * w END', 4)} AS high,
    (SELECT count(*) FROM b WHERE b = k) AS count FROM e, range(30) AS g(k)""")
def histogram30(spark, sf):
    return rounded(stats.histogram(gaps(spark, sf), "l_extendedprice"), 4)


@register(f"""SELECT incident_type, collision_type, count(*) AS count FROM {STRICT} s
    WHERE incident_type IS NOT NULL AND collision_type IS NOT NULL GROUP BY 1, 2""")
def contingency(spark, sf):
    return stats.contingency(strict(spark, sf), "incident_type", "collision_type")


@register("SELECT o_orderpriority, " + ", ".join(
    f"count(*) FILTER (WHERE o_orderstatus = '{s}' AND o_custkey % 9 <> 0) AS \"{s}\"" for s in "FOP") +
    " FROM orders WHERE o_custkey % 9 <> 0 GROUP BY 1")
def crosstab(spark, sf):
    """Null keys (here: some statuses set to NULL) stay out of the table."""
    df = V.table(spark, sf, "orders").withColumn(
        "o_orderstatus", F.when(F.col("o_custkey") % 9 != 0, F.col("o_orderstatus")))
    return stats.crosstab(df, "o_orderpriority", "o_orderstatus")


PEARSON = ["l_quantity", "l_extendedprice", "l_discount", "flat"]


@register(" UNION ALL ".join(
    f"""SELECT '{a}' AS col_a, '{b}' AS col_b, {r(f'corr({a}, {b})')} AS r FROM (SELECT *, 1.5::DOUBLE AS flat FROM {GAPS_DUCK} g) s"""
    if "flat" not in (a, b) else f"SELECT '{a}' AS col_a, '{b}' AS col_b, CAST(NULL AS DOUBLE) AS r"
    for a in PEARSON for b in PEARSON))
def pearson_matrix(spark, sf):
    return rounded(stats.pearson_matrix(gaps(spark, sf).withColumn("flat", F.lit(1.5)), PEARSON))


WIDE = {**{c: c for c in PEARSON[:3]}, **{f"w{i}": f"l_extendedprice * {i} + l_quantity * l_quantity * {10 - i}" for i in range(1, 7)},
        **{f"d{i}": f"CASE WHEN l_quantity > {5 * i} THEN l_discount * l_quantity END" for i in range(1, 5)}}


@register(" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r(f'corr({x}, {y})')} AS r FROM {GAPS_DUCK} g" for a, x in WIDE.items() for b, y in WIDE.items()))
def pearson_wide(spark, sf):
    """More pairs than one aggregate holds, with gaps: merged moment matrices."""
    return rounded(stats.pearson_matrix(gaps(spark, sf).select(*[F.expr(x).alias(c) for c, x in WIDE.items()]), list(WIDE)))


@register(SQL["describe_columns"])
def cube_describe(spark, sf):
    """Describe, read from the counts of all values."""
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    return rounded(cube.describe(cube.value_cube(gaps(spark, sf), columns=columns), columns), 4)


@register(SQL["null_profile"])
def cube_nulls(spark, sf):
    """Gaps of every column, read from the counts of all values."""
    df = strict(spark, sf)
    return cube.nulls(cube.value_cube(df), df.columns)


def spearman_sql(feature: str, target: str, source: str, digits: int = 6) -> str:
    return f"""SELECT '{feature}' AS feature, count(*) AS n, {r('corr(rx, ry)', digits)} AS effect FROM (
    SELECT rank() OVER (ORDER BY {feature}) + (count(*) OVER (PARTITION BY {feature}) - 1) / 2.0::DOUBLE AS rx,
           rank() OVER (ORDER BY {target}) + (count(*) OVER (PARTITION BY {target}) - 1) / 2.0::DOUBLE AS ry
    FROM {source} s WHERE {feature} IS NOT NULL AND {target} IS NOT NULL) q"""


SPEARMAN = ["l_quantity", "l_discount", "l_partkey"]


@register(" UNION ALL ".join(spearman_sql(c, "l_extendedprice", GAPS_DUCK) for c in SPEARMAN))
def spearman(spark, sf):
    df = gaps(spark, sf).withColumn("flat", F.lit(3))
    return rounded(stats.spearman(df, [*SPEARMAN, "flat"], "l_extendedprice"))


@register(" UNION ALL ".join(spearman_sql(c, "l_quantity", GAPS_DUCK) for c in ("l_extendedprice", "l_discount")))
def spearman_tied_target(spark, sf):
    """A target with 50 values, each held by 2 % of the rows: the salted path."""
    return rounded(stats.spearman(gaps(spark, sf), ["l_extendedprice", "l_discount"], "l_quantity"))


def anova_sql(feature: str, target: str, source: str, digits: int = 6) -> str:
    return f"""SELECT '{feature}' AS feature, count(*) AS k, CAST(sum(n) AS BIGINT) AS n,
    {r('(sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(w) / (sum(n) - count(*)))', digits)} AS f_stat,
    {r('sum(n * (m - g) * (m - g)) / (sum(n * (m - g) * (m - g)) + sum(w))', 9)} AS effect
    FROM (SELECT {feature}, count(*)::DOUBLE AS n, avg({target}) AS m, var_pop({target}) * count(*) AS w,
          (SELECT avg({target}) FROM {source} a WHERE {feature} IS NOT NULL AND {target} IS NOT NULL) AS g
          FROM {source} b WHERE {feature} IS NOT NULL AND {target} IS NOT NULL GROUP BY 1) q"""


ANOVA = ["l_returnflag", "l_linestatus", "part"]


@register(" UNION ALL ".join(anova_sql(c, "l_extendedprice", GAPS_DUCK) for c in ANOVA))
def anova_eta2(spark, sf):
    found = stats.anova(gaps(spark, sf).withColumn("flat", F.lit("same")), [*ANOVA, "flat"], "l_extendedprice")
    return found.withColumns({"f_stat": F.round("f_stat", 6), "effect": F.round("effect", 9)})


@register(" UNION ALL ".join(
    f"""SELECT feature, 'anova' AS test, round(effect, 9) AS effect,
    round(pow(1 + 2 * f_stat / (n - 3), -(n - 3) / 2.0::DOUBLE), 4) AS p_value
    FROM ({anova_sql(c, 'o_totalprice', 'orders')}) a""" for c in ("o_orderstatus",)))
def anova_p_three_levels(spark, sf):
    """With three levels the p-value has a closed form."""
    found = stats.anova_table(V.table(spark, sf, "orders"), ["o_orderstatus"], "o_totalprice")
    return found.withColumns({"effect": F.round("effect", 9), "p_value": F.round("p_value", 4)})


@register("SELECT feature, 'spearman' AS test, effect FROM (" + SQL["spearman"] + ") s UNION ALL "
          "SELECT feature, 'anova', round(effect, 6) FROM (" + SQL["anova_eta2"] + ") a")
def effect_ranking(spark, sf):
    ranked = stats.effect_ranking(gaps(spark, sf), SPEARMAN, ANOVA, "l_extendedprice")
    return ranked.select("feature", "test", F.round("effect", 6).alias("effect"))


def f_tail_sql(source: str) -> str:
    """``feature, test, effect, p_value`` from rows with ``f, d1, d2``, by the midpoint rule over log x."""
    steps = 40000
    return f"""SELECT feature, test, round(effect, 6) AS effect, round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, p)), 6) AS p_value FROM (
    SELECT feature, test, any_value(effect) AS effect, sum(exp(b * v + (a - 1) * ln(1 - exp(v)) + lgamma(a + b) - lgamma(a) - lgamma(b)) * step) AS p FROM (
      SELECT *, low + (i + 0.5) * step AS v FROM (
        SELECT *, (least(-1e-12::DOUBLE, greatest(low + 1e-9, ln((d1 / 2 + 60 + 12 * sqrt(d1)) / (d2 / 2)))) - low) / {steps} AS step, d2 / 2 AS a, d1 / 2 AS b
        FROM (SELECT *, ln(d1 * f / d2 / (1 + d1 * f / d2)) AS low FROM {source} s0) s1) s2, range({steps}) t(i)) s3 GROUP BY feature, test) s4"""


EFFECT_TESTS = f"""(SELECT feature, 'spearman' AS test, effect, effect * effect * (n - 2) / (1 - effect * effect) AS f, 1.0::DOUBLE AS d1, (n - 2)::DOUBLE AS d2
    FROM (SELECT feature, effect, CASE feature WHEN 'l_quantity' THEN (SELECT count(*) FROM {GAPS_DUCK} g WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL)
          ELSE (SELECT count(*) FROM {GAPS_DUCK} g WHERE l_extendedprice IS NOT NULL) END AS n FROM (SPEARMAN_SQL) s) q
    UNION ALL SELECT feature, 'anova', effect, f_stat, (k - 1)::DOUBLE, (n - k)::DOUBLE FROM (ANOVA_SQL) a)"""
EFFECT_P = f_tail_sql(EFFECT_TESTS.replace(
    "SPEARMAN_SQL", " UNION ALL ".join(spearman_sql(c, "l_extendedprice", GAPS_DUCK, 15) for c in SPEARMAN)).replace(
    "ANOVA_SQL", " UNION ALL ".join(anova_sql(c, "l_extendedprice", GAPS_DUCK, 12) for c in ANOVA)))


@register(f"SELECT feature, test, effect FROM ({EFFECT_P}) p WHERE p_value < 0.05")
def significant_effects(spark, sf):
    ranked = stats.effect_ranking(gaps(spark, sf), SPEARMAN, ANOVA, "l_extendedprice")
    return rounded(stats.significant(ranked, 0.05).select("feature", "test", "effect"))


@register(f"SELECT feature, p_value FROM ({EFFECT_P}) p")
def effect_p_values(spark, sf):
    ranked = stats.effect_ranking(gaps(spark, sf), SPEARMAN, ANOVA, "l_extendedprice")
    return rounded(ranked.select("feature", "p_value"))


@register(f"""SELECT DISTINCT 'l_quantity' AS feature, l_quantity AS value, count(*) OVER (PARTITION BY l_quantity) AS n,
    rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0::DOUBLE AS avg_rank
    FROM {GAPS_DUCK} g WHERE l_quantity IS NOT NULL UNION ALL
    SELECT DISTINCT 'l_extendedprice', l_extendedprice, count(*) OVER (PARTITION BY l_extendedprice),
    rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0::DOUBLE
    FROM {GAPS_DUCK} g WHERE l_extendedprice IS NOT NULL""")
def average_rank(spark, sf):
    return ranking.average_rank(gaps(spark, sf), ["l_quantity", "l_extendedprice"])


@register("SELECT event_type, " + ", ".join(
    f"{r(f'quantile_cont(value, {p})')} AS q{int(p * 100)}" for p in (0.1, 0.5, 0.9)) + " FROM events GROUP BY 1")
def exact_quantiles(spark, sf):
    found = ranking.exact_quantiles(V.table(spark, sf, "events"), ["value"], [0.1, 0.5, 0.9], by=["event_type"])
    at = lambda p: F.round(F.max(F.when(F.col("prob") == p, F.col("quantile"))), 6).alias(f"q{int(p * 100)}")
    return found.groupBy("event_type").agg(at(0.1), at(0.5), at(0.9))


# --- reports ------------------------------------------------------------------

def first_number(pattern: str, default: int) -> str:
    digits = f"nullif(regexp_extract(low, '{pattern}', 1), '')"
    return f"CASE WHEN {digits} IS NULL THEN {default}::DECIMAL(38,0) ELSE TRY_CAST({digits} AS DECIMAL(38,0)) END"


FEATURES = f"""(SELECT report_id, text,
    CASE WHEN contains(low, 'totalschaden') OR contains(low, 'total zerstört') OR contains(low, 'abgeschleppt') THEN 'Total Loss'
         WHEN contains(low, 'erheblich') OR contains(low, 'schwer beschädigt') THEN 'Major Damage'
         WHEN contains(low, 'kratzer') OR contains(low, 'bagatelle') OR contains(low, 'geringfügig') THEN 'Trivial Damage'
         ELSE 'Minor Damage' END AS severity,
    {first_number('(\\d+)\\s*fahrzeug', 1)} AS vehicles,
    {first_number('(\\d+)\\s*(personen?\\s*)?verletzt', 0)} AS injured,
    {first_number('(\\d+)\\s*zeug', 0)} AS witnesses,
    CASE WHEN contains(low, 'polizei') THEN 'Ja' ELSE 'Nein' END AS police
    FROM (SELECT *, lower(text) AS low FROM SOURCE t WHERE trim(text) <> '') l)"""
REPORT_FEATURES = FEATURES.replace("SOURCE", V.reports_duck())
SCORED = f"""(SELECT *, CASE severity WHEN 'Trivial Damage' THEN 5000 WHEN 'Minor Damage' THEN 35000 WHEN 'Major Damage' THEN 62000
    ELSE 65000 END + (CAST(vehicles AS DOUBLE) - 1) * 4000.0::DOUBLE + CAST(injured AS DOUBLE) * 3000.0::DOUBLE AS predicted_claim FROM {REPORT_FEATURES} f)"""
GERMAN = "CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SEVERITY_GERMAN.items()) + " ELSE {c} END"
DISPLAY = "replace(format('{:,}', CAST(round_even(predicted_claim, 0) AS BIGINT)), ',', '.') || ' EUR'"


@register(f"SELECT * FROM {REPORT_FEATURES} f")
def report_features(spark, sf):
    kept, _ = cleaning.reject_blank(V.reports(spark, sf), "text")
    return reports.extract_features(kept)


DOC_FEATURES = FEATURES.replace("SOURCE", "(SELECT doc_id AS report_id, text FROM documents)")


@register(f"SELECT report_id, severity, vehicles, injured, witnesses, police FROM {DOC_FEATURES} f")
def document_features(spark, sf):
    """The same rules over whole texts in four languages."""
    docs = V.table(spark, sf, "documents").select(F.col("doc_id").alias("report_id"), "text")
    kept, _ = cleaning.reject_blank(docs, "text")
    return reports.extract_features(kept).drop("text")


@register(f"SELECT report_id, severity, predicted_claim FROM {SCORED} s")
def rule_score(spark, sf):
    return scoring.score_reports(V.reports(spark, sf)).select("report_id", "severity", "predicted_claim")


@register(f"SELECT report_id, predicted_claim, {DISPLAY} AS display FROM {SCORED} s")
def format_amount(spark, sf):
    return scoring.score_reports(V.reports(spark, sf)).select("report_id", "predicted_claim", "display")


@register(f"SELECT report_id, severity, {GERMAN.format(c='severity')} AS severity_german FROM {REPORT_FEATURES} f")
def severity_german(spark, sf):
    kept, _ = cleaning.reject_blank(V.reports(spark, sf), "text")
    return reports.extract_features(kept).select(
        "report_id", "severity", reports.german_severity(F.col("severity")).alias("severity_german"))


@register(" UNION ALL ".join(
    f"""SELECT report_id, '{label}' AS "Merkmal", {GERMAN.format(c='severity') if c == 'severity' else f'CAST({c} AS STRING)'} AS "Wert"
    FROM {REPORT_FEATURES} f""" for c, label in FEATURE_LABELS.items()))
def feature_table(spark, sf):
    kept, _ = cleaning.reject_blank(V.reports(spark, sf), "text")
    return reports.feature_table(reports.extract_features(kept))


MEANS = f"""(SELECT incident_severity AS category, avg(TRY_CAST(total_claim_amount AS DOUBLE)) AS mean FROM {STRICT} s
    WHERE incident_severity IS NOT NULL GROUP BY 1)"""
COMPARED = f"""SELECT report_id, severity, predicted_claim, {r('mean', 4)} AS category_mean,
    {r('predicted_claim - mean', 4)} AS difference FROM {SCORED} s LEFT JOIN {MEANS} m ON severity = category"""
COMPARED_COLUMNS = ["report_id", "severity", "predicted_claim", "category_mean", "difference"]


def history(spark, sf) -> DataFrame:
    return cleaning.coerce_columns(strict(spark, sf), ["total_claim_amount"])


@register(COMPARED)
def score_vs_mean(spark, sf):
    compared = scoring.score_with_history(V.reports(spark, sf), history(spark, sf))
    return rounded(compared.select(*COMPARED_COLUMNS), 4)


@register(f"SELECT category, {GERMAN.format(c='category')} AS category_german, {r('mean', 4)} AS mean FROM {MEANS} m")
def display_means(spark, sf):
    return rounded(reports.display_means(reports.severity_means(history(spark, sf))), 4)


@register(COMPARED)
def score_with_claims_file(spark, sf):
    """Reports next to the means of an optional claims CSV."""
    path = scratch_path(spark, "history-csv")
    write_csv(V.flat(spark, sf).drop("src_pos"), path)
    found = scoring.score_with_claims_file(spark, V.reports(spark, sf), path)
    return rounded(found["scored"].select(*COMPARED_COLUMNS), 4)


@register(COMPARED)
def stream_scores(spark, sf):
    """The orders file arrives as a stream; reports are scored as it does."""
    orders = report_stream(spark, sf, V.table(spark, sf, "orders").schema, pathGlobFilter="orders.parquet")
    arriving = orders.selectExpr(f"{V.K} AS report_id", f"{V.REPORT_TEXT} AS text")
    output, checkpoint = scratch_path(spark, "scores"), scratch_path(spark, "scores-progress")
    means = stage(reports.severity_means(history(spark, sf)), "means")
    run_scores(scored_stream(arriving, means), output, checkpoint).awaitTermination()
    return rounded(spark.read.parquet(output).select(*COMPARED_COLUMNS), 4)


@register(f"""SELECT 'scored' AS sink, report_id, predicted_claim FROM {SCORED} s
    UNION ALL SELECT 'rejected', report_id, NULL FROM {V.reports_duck()} t WHERE trim(text) = ''""")
def stream_rejects(spark, sf):
    """Both outputs of the stream: scores and blank messages, after its last batch was run a second time."""
    arriving = report_stream(spark, sf, V.table(spark, sf, "orders").schema, pathGlobFilter="orders.parquet").selectExpr(
        f"{V.K} AS report_id", f"{V.REPORT_TEXT} AS text")
    scores, rejects, progress = (scratch_path(spark, n) for n in ("sink-scores", "sink-rejects", "sink-progress"))
    for again in (True, False):
        run_scores_and_rejects(arriving, scores, rejects, progress).awaitTermination()
        if again:
            # the batch is forgotten as done, as after a failure just before that is noted
            done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{progress}/commits")
            done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(done, True)
    return spark.read.parquet(scores).select(F.lit("scored").alias("sink"), "report_id", "predicted_claim").unionByName(
        spark.read.parquet(rejects).select(F.lit("rejected").alias("sink"), "report_id", F.lit(None).cast("double").alias("predicted_claim")))


# --- generated reports --------------------------------------------------------

SYNTH_IN = f"""(SELECT src_pos, auto_make, auto_model, auto_year, incident_severity, collision_type, incident_type FROM {FLAT} f)"""


@register(synth_sql.report_sql(SYNTH_IN, "src_pos", 7, ["src_pos"], candidates=["collision_type", "incident_type"], combined=False))
def synthetic_reports(spark, sf):
    df = V.flat(spark, sf).select(
        "src_pos", "auto_make", "auto_model", "auto_year", "incident_severity", "collision_type", "incident_type")
    return synth.generate_reports(df, "src_pos", seed=7).select("src_pos", "generated_description")


@register(f"""SELECT src_pos, {synth_sql.case_sql(['collision_type', 'incident_type'])} AS case_type,
    CASE WHEN incident_severity IN ('Major Damage', 'Total Loss') THEN 'major' ELSE 'minor' END AS bucket FROM {FLAT} f""")
def case_types(spark, sf):
    return V.flat(spark, sf).select(
        "src_pos", synth.case_type([F.col("collision_type"), F.col("incident_type")]).alias("case_type"),
        synth.severity_bucket(F.col("incident_severity")).alias("bucket"))


GENERATED = "(" + synth_sql.report_sql(SYNTH_IN, "src_pos", 7, ["src_pos"], candidates=["collision_type", "incident_type"], combined=False) + ")"


@register("SELECT report_id, severity, vehicles, injured, witnesses, police FROM " + FEATURES.replace(
    "SOURCE", f"(SELECT src_pos AS report_id, generated_description AS text FROM {GENERATED} g)") + " f")
def synthetic_report_features(spark, sf):
    """Generated text fed back through feature extraction."""
    text = synthetic_reports(spark, sf).select(F.col("src_pos").alias("report_id"), F.col("generated_description").alias("text"))
    return reports.extract_features(text).drop("text")


@register(synth_sql.report_sql(f"(SELECT * REPLACE (CAST(src_pos AS STRING) AS src_pos) FROM {FLAT} f)", "src_pos", 42,
                               ["src_pos", *[f'"{c}"' for c in CLAIM_COLUMNS]],
                               candidates=["collision_type", "incident_type"], combined=False, name="bericht"))
def csv_with_reports(spark, sf):
    """CSV -> CSV with one generated column -> read back."""
    target = scratch_path(spark, "reports-csv")
    prepared.add_report_column(spark, flat_csv(spark, sf), target, "bericht", key="src_pos")
    return read_csv_text(spark, target)


# --- regression baseline ------------------------------------------------------

@register("SELECT o_orderkey, o_totalprice, " + ", ".join(
    f"CASE WHEN o_orderstatus = '{s}' THEN 1 ELSE 0 END AS \"o_orderstatus_{s}\"" for s in "OP") + ", " + ", ".join(
    f"CASE WHEN o_orderpriority = '{s}' THEN 1 ELSE 0 END AS \"o_orderpriority_{s}\""
    for s in ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")) + " FROM orders")
def one_hot(spark, sf):
    df = V.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    return model.one_hot(df, ["o_orderstatus", "o_orderpriority"])


def seeded(key: str, seed: int) -> str:
    return f"md5(CAST({key} AS STRING) || '|{seed}|') || ':' || CAST({key} AS STRING)"


@register(f"""SELECT o_orderkey, row_number() OVER (ORDER BY {seeded('o_orderkey', 42)})
    <= ceil(0.2 * (SELECT count(*) FROM orders)) AS is_test FROM orders""")
def holdout_split(spark, sf):
    return ranking.holdout_split(V.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@register(f"""WITH n AS (SELECT count(*) AS n FROM orders),
    s AS (SELECT o_orderkey, row_number() OVER (ORDER BY {seeded('o_orderkey', 42)}) - 1 AS i FROM orders)
    SELECT o_orderkey, CAST(CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1)
    ELSE n % 5 + (i - (n % 5) * (n // 5 + 1)) // (n // 5) END AS INT) AS fold FROM s, n""")
def cv_folds(spark, sf):
    return ranking.fold_index(V.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@register(f"""SELECT count(*) AS n, {r('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))')} AS r2, {r('avg(abs(y - p))', 4)} AS mae
    FROM (SELECT l_extendedprice AS y, 1500.0::DOUBLE * l_quantity + 10000 * l_discount AS p FROM lineitem) q""")
def regression_metrics(spark, sf):
    df = V.table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("label"),
        (1500.0 * F.col("l_quantity") + 10000 * F.col("l_discount")).alias("prediction"))
    found = model.regression_metrics(df)
    return found.select("n", F.round("r2", 6).alias("r2"), F.round("mae", 4).alias("mae"))


TYPES = {source: spark_type(kind) for columns in TABLES.values() for source, _, kind in columns}
NUMBERS = [c for c in COLUMNS if TYPES[c] not in ("STRING", "DATE", "BOOLEAN")]
TEXTS = [c for c in COLUMNS if TYPES[c] == "STRING"]


def typed_cell(c: str) -> str:
    if TYPES[c] == "BOOLEAN":
        return f"CASE \"{c}\" WHEN 'Y' THEN true WHEN 'N' THEN false END AS \"{c}\""
    return f'CAST("{c}" AS {TYPES[c]}) AS "{c}"'


TYPED = f"(SELECT CAST(src_pos AS STRING) AS src_pos, {', '.join(map(typed_cell, COLUMNS))} FROM {CLEAN_NULLED} n)"


@register(f"SELECT * FROM {TYPED} t")
def typed_claims(spark, sf):
    return prepare.typed_claims(read_claims_strict(spark, flat_csv(spark, sf, copies=False, clean=True)))


@register(" UNION ALL ".join(
    f"SELECT '{role}' AS role, '{c}' AS \"column\" WHERE (SELECT count(*) FROM orders) > 0"
    for role, names in (("numeric", [c for c in NUMBERS if c != "vehicle_claim"]), ("categorical", ["src_pos", *TEXTS])) for c in names))
def column_roles(spark, sf):
    typed = typed_claims(spark, sf)
    numeric, categorical = cleaning.column_roles(typed, "vehicle_claim")
    # the roles come from the schema; the count shows that the typed rows can be read
    rows = typed.agg(F.count("*").alias("n")).where("n > 0")
    return rows.select(F.inline(F.array(*[F.struct(F.lit(role).alias("role"), F.lit(c).alias("column"))
                                          for role, names in (("numeric", numeric), ("categorical", categorical)) for c in names])))


FLAG = "fraud_reported"
PLAIN = f"(SELECT CAST(src_pos AS STRING) AS src_pos, {', '.join(FLAG if c == FLAG else typed_cell(c) for c in COLUMNS)} FROM {CLEAN_NULLED} n)"


def filled(c: str) -> str:
    if c in NUMBERS:
        return (f'CASE WHEN (SELECT count(*) - count("{c}") FROM {PLAIN} a) = 0 THEN CAST("{c}" AS DOUBLE) '
                f'ELSE coalesce(CAST("{c}" AS DOUBLE), (SELECT quantile_cont(CAST("{c}" AS DOUBLE), 0.5) FROM {PLAIN} a)) END AS "{c}"')
    if c in TEXTS or c == FLAG:
        return (f'coalesce("{c}", (SELECT "{c}" FROM {PLAIN} a WHERE "{c}" IS NOT NULL GROUP BY "{c}" ORDER BY count(*) DESC, "{c}" LIMIT 1)) AS "{c}"')
    return f'"{c}"'


def plain_claims(spark, sf) -> DataFrame:
    """Typed claims with the flag as text, as the analysis reads them; written once."""
    source = read_claims_strict(spark, flat_csv(spark, sf, copies=False, clean=True))
    return stage(prepare.typed_claims(source, flags=False), "typed")


@register(f"SELECT CAST(src_pos AS STRING) AS src_pos, {', '.join(filled(c) for c in COLUMNS)} FROM {PLAIN} t")
def analysis_clean(spark, sf):
    """Sentinel to NULL, medians, modes, copies dropped, from the CSV."""
    found = analysis.impute_and_deduplicate(plain_claims(spark, sf))
    return found.select("src_pos", *[F.col(f"`{c}`").cast("double").alias(c) if c in NUMBERS else F.col(f"`{c}`") for c in COLUMNS])


IDENTIFYING = ["policy_number", "policy_bind_date", "incident_date", "incident_location", "insured_zip"]


def model_frame(spark, sf) -> DataFrame:
    """Typed and imputed claims with every column that does not identify a row, one row per claim."""
    df = analysis.impute_and_deduplicate(plain_claims(spark, sf))
    return stage(df.drop(*IDENTIFYING), "model")


def level_count(c: str) -> str:
    return f'(SELECT greatest(count(DISTINCT "{c}") - 1, 0) FROM {PLAIN} t)'


LEVEL_COLUMNS = [c for c in COLUMNS if c in TEXTS or c in ("policy_bind_date", "incident_date", FLAG)]


@register(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CAST("{c}" AS STRING) AS level, count(*) AS rows FROM {PLAIN} t WHERE "{c}" IS NOT NULL
    AND CAST("{c}" AS STRING) > (SELECT min(CAST("{c}" AS STRING)) FROM {PLAIN} u) GROUP BY 1, 2""" for c in LEVEL_COLUMNS))
def encoded_levels(spark, sf):
    """Every text column and date as sparse vectors, zip codes and addresses too: rows per place, read back from the vectors."""
    claims = plain_claims(spark, sf)
    dated = claims.withColumns({c: F.col(c).cast("string") for c in ("policy_bind_date", "incident_date")})
    found = encode.slot_totals(encode.encode(dated, "vehicle_claim", keep=["src_pos"]))
    return found.where("level IS NOT NULL").select("feature", "level", "rows")


FEATURE_COLUMNS = [c for c in COLUMNS if c not in IDENTIFYING and ("claim" not in c or c == "vehicle_claim")]


@register("SELECT CAST(" + " + ".join(
    [str(sum(c in NUMBERS for c in FEATURE_COLUMNS) - 1),
     *[level_count(c) for c in FEATURE_COLUMNS if c in TEXTS or c == FLAG]]) + " AS BIGINT) AS features, 1.0::DOUBLE AS total, CAST(15 AS BIGINT) AS top")
def rf_importance(spark, sf):
    """Random forest of 200 trees of depth 10 over all columns: facts of its importances."""
    found = analysis.baseline(model_frame(spark, sf), "src_pos", cross_validation=False)
    top = found["top importances"].agg(F.count("*").alias("top"))
    return found["importances"].agg(F.count("*").alias("features"), F.round(F.sum("importance"), 6).alias("total")).join(top)


N = "(SELECT count(*) FROM orders)"


@register(f"SELECT CAST(ceil(0.2 * {N}) AS BIGINT) AS n, true AS explains, true AS close FROM orders LIMIT 1")
def rf_holdout(spark, sf):
    """Rows of the holdout, whether the forest explains 95 % of its variance, and whether its mean error is a tenth of the spread at most."""
    frame = model_frame(spark, sf)
    spread = frame.agg(F.stddev_pop("vehicle_claim").cast("double").alias("spread"))
    found = analysis.baseline(frame, "src_pos", cross_validation=False)["holdout"].join(spread)
    return found.select("n", (F.col("r2") > 0.95).alias("explains"), (F.col("mae") < F.col("spread") / 10).alias("close"))


@register(f"SELECT f AS fold, {N} // 5 + CASE WHEN f < {N} % 5 THEN 1 ELSE 0 END AS n, true AS explains, true AS steady FROM range(5) r(f)")
def rf_folds(spark, sf):
    """Rows of five folds, whether each forest explains 95 % of the variance, and whether folds differ by under 0.02 in that."""
    found = analysis.baseline(model_frame(spark, sf), "src_pos", holdout=False)
    steady = found["cross validation"].select((F.col("r2_std") < 0.02).alias("steady"))
    return found["folds"].join(steady).select(F.col("fold").cast("bigint").alias("fold"), "n", (F.col("r2") > 0.95).alias("explains"), "steady")

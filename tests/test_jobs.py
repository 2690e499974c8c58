import os

import pytest
from pyspark.sql import functions as F, types as T

from claimwise import session
from claimwise.operators import audits, cleaning, model
from claimwise.operators.normalise import join_claims, split_claims
from claimwise.operators.ranking import file_row_index
from claimwise.plans import analysis, etl, prepared
from claimwise.schemas import CLAIM_COLUMNS, PRIMARY_KEYS, TABLES, table_schema
from claimwise.sources.readers import read_claims, read_claims_optional, read_csv_text, read_tables
from claimwise.sources.writers import save_bucketed_tables, write_csv, write_tables

BASE = {
    "months_as_customer": "10", "age": "40", "policy_bind_date": "2014-10-17", "policy_state": "OH", "policy_csl": "250/500",
    "policy_deductable": "1000", "policy_annual_premium": "1406.915", "umbrella_limit": "0", "insured_zip": "046613",
    "insured_sex": "MALE", "insured_education_level": "MD", "insured_occupation": "craft-repair", "insured_hobbies": "chess",
    "insured_relationship": "husband", "capital-gains": "5", "capital-loss": "-5", "incident_date": "2015-01-25",
    "incident_type": "Parked Car", "collision_type": "?", "incident_severity": "Minor Damage",
    "authorities_contacted": "None", "incident_state": "SC", "incident_city": "Columbus", "incident_location": "1 Main, \"A\"",
    "incident_hour_of_the_day": "5", "number_of_vehicles_involved": "1", "property_damage": "?", "bodily_injuries": "1",
    "witnesses": "2", "police_report_available": "YES", "total_claim_amount": "71610", "injury_claim": "6510",
    "property_claim": "13020", "vehicle_claim": "52080", "auto_make": "Saab", "auto_model": "92x", "auto_year": "2004",
    "fraud_reported": "Y", "_c39": "",
}


def write_source(path, rows):
    import csv

    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.DictWriter(f, CLAIM_COLUMNS)
        out.writeheader()
        for i, change in enumerate(rows):
            out.writerow({**BASE, "policy_number": str(1000 + i), **change})
    return str(path)


def test_load_job(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        source = write_source(tmp_path / "claims.csv", [{"age": str(20 + i % 50)} for i in range(200)])
        result = etl.run_load(spark, source, str(tmp_path / "db"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert result.rows_read == 200 and set(result.rows_written.values()) == {200}
    tables = read_tables(spark, str(tmp_path / "db"), list(TABLES))
    # the running number follows the file order over many file blocks
    numbered = tables["policen"].select("police_id", "policen_nummer").collect()
    assert all(r["policen_nummer"] == 999 + r["police_id"] for r in numbered)
    customer, incident = tables["kunden"].first(), tables["unfaelle"].first()
    assert customer["plz"] == "046613" and incident["kollisions_typ"] is None and incident["behoerde"] is None
    assert str(tables["policen"].first()["jahrespraemie"]) == "1406.92"
    assert tables["schaeden"].first()["betrug_gemeldet"] is True
    assert result.sample.columns == ["alter_jahre", "marke", "schadensschwere", "gesamtschaden"] and result.sample.count() == 3
    for name, df in tables.items():
        assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in table_schema(name).fields]


def test_load_refuses_broken_rules(spark, tmp_path):
    source = write_source(tmp_path / "claims.csv", [{"policy_number": "7"}, {"policy_number": "7"}, {"age": ""},
                                                    {"incident_hour_of_the_day": "24"}, {"policy_state": "TOOLONG"}])
    with pytest.raises(audits.AuditError) as error:
        etl.run_load(spark, source, str(tmp_path / "db"))
    for rule in ("unique policen.policen_nummer: 1", "not_null kunden.alter_jahre: 1",
                 "check unfaelle.uhrzeit_stunde: 1", "length policen.bundesstaat: 1"):
        assert rule in str(error.value)
    assert not os.path.exists(tmp_path / "db")


def test_failed_refresh_leaves_the_old_tables(spark, tmp_path):
    """A failure in the third write leaves all five old tables readable, and a later load replaces all of them."""
    location = str(tmp_path / "db")
    flats = [session.stage(etl.transform(etl.extract(spark, write_source(tmp_path / f"{n}.csv", [{}] * n))), "flat") for n in (2, 3, 4)]
    assert set(write_tables(split_claims(flats[0].withColumn("policy_number", F.col("lfd_id")), etl.ROW_NUMBER), location).values()) == {2}
    broken = split_claims(flats[1], etl.ROW_NUMBER)
    third = list(TABLES)[2]
    broken[third] = broken[third].withColumn("marke", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        write_tables(broken, location)
    assert {name: df.count() for name, df in read_tables(spark, location, list(TABLES)).items()} == dict.fromkeys(TABLES, 2)
    at_work = read_tables(spark, location, list(TABLES))
    write_tables(split_claims(flats[2], etl.ROW_NUMBER), location)
    assert {name: df.count() for name, df in read_tables(spark, location, list(TABLES)).items()} == dict.fromkeys(TABLES, 4)
    assert at_work["kunden"].count() == 2
    # the unfinished generation went with the next load
    assert len([n for n in os.listdir(location) if n.startswith("generation-")]) == 2


def test_join_is_correct_for_several_vehicles(spark, tmp_path):
    source = write_source(tmp_path / "claims.csv", [{}, {}])
    flat = etl.transform(etl.extract(spark, source))
    tables = split_claims(flat, etl.ROW_NUMBER)
    tables["fahrzeuge"] = tables["fahrzeuge"].unionByName(tables["fahrzeuge"].where("police_id = 1"))
    assert join_claims(tables).count() == 3


def test_audit_messages_and_types(spark):
    df = spark.createDataFrame([(1, "9" * 11), (None, "x"), (2, None)], "k int, a string")
    rules = {"n": audits.not_null_rule("k"), "t": audits.type_rule("a", "DECIMAL(10,2)")}
    assert dict(audits.count_violations(df, rules).collect()) == {"n": 1, "t": 2}
    assert sorted(r["broken_rules"] for r in audits.violating_rows(df, rules).collect()) == [["n", "t"], ["t"]]
    assert audits.repeated_keys(spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int"), "k").collect() == [(1, 2)]


def test_optional_source(spark, tmp_path):
    assert read_claims_optional(spark, str(tmp_path / "none.csv")).count() == 0
    source = write_source(tmp_path / "some.csv", [{}])
    assert read_claims_optional(spark, source).count() == 1


def test_csv_text_keeps_every_field(spark, tmp_path):
    source = write_source(tmp_path / "some.csv", [{"age": "NA"}])
    row = read_csv_text(spark, source).first()
    assert (row["age"], row["_c39"], row["incident_location"]) == ("NA", "", '1 Main, "A"')
    assert read_claims(spark, source).first()["age"] is None


def test_prepared_job_and_report(spark, tmp_path):
    full = {"collision_type": "Rear Collision", "property_damage": "NO", "authorities_contacted": "Fire"}
    source = write_source(tmp_path / "c.csv", [
        {**full, "policy_number": "1"}, {**full, "policy_number": "1"}, {},
        {**full, "auto_make": "Accura", "policy_number": "2"}, {**full, "auto_make": "Acura", "policy_number": "2"}])
    df = prepared.build_prepared(spark, source, str(tmp_path / "report"))
    assert df.columns == ["auto_make_model", "auto_year", "incident_severity", "collision_type",
                          "claim_amount_eur", "generated_description"]
    assert sorted(r["auto_make_model"] for r in df.collect()) == ["Acura 92x", "Acura 92x", "Saab 92x"]
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert lines[:5] == ["Original rows: 5", "Removed fully empty columns (1): _c39", "Removed rows with null values: 1",
                         "Removed duplicate rows: 1", "Final rows: 3"]
    assert lines[-1] == "- row_index=1"


def test_csv_with_generated_column(spark, tmp_path):
    source = write_source(tmp_path / "c.csv", [{}, {"auto_make": "BMW"}])
    assert prepared.add_report_column(spark, source, str(tmp_path / "out"), "bericht") == 2
    back = read_csv_text(spark, str(tmp_path / "out"))
    assert back.columns == [*CLAIM_COLUMNS, "bericht"] and back.where("bericht LIKE '%BMW 92x%'").count() == 1
    assert prepared.add_report_column(spark, str(tmp_path / "out"), str(tmp_path / "o2"), "bericht", key="policy_number") == 2


def test_bucketed_tables_join_without_shuffle(spark):
    left = spark.range(100).withColumn("v", F.lit(1))
    rows = save_bucketed_tables({"b_left": left, "b_right": left}, {"b_left": "id", "b_right": "id"}, 4)
    assert rows == {"b_left": 100, "b_right": 100}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark.table("b_left").join(spark.table("b_right"), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE b_left")
        spark.sql("DROP TABLE b_right")
    assert "Exchange" not in plan


def test_one_hot_drops_first_level(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3), (None, 4)], "c string, n int")
    assert sorted(tuple(r) for r in model.one_hot(df, ["c"]).collect()) == [(1, 1, 0), (2, 0, 0), (3, 0, 1), (4, 0, 0)]


def test_vectors_equal_one_hot(spark):
    df = spark.createDataFrame([("b", "x", 1.0, 5.0), ("a", "y", 2.0, 6.0), ("c", "x", 3.0, 7.0)],
                               "c string, e string, n double, t double")
    vectors, names = model.feature_vectors(df, "t")
    assert names == ["n", "c_c", "c_b", "e_y"]
    assert sorted(r["features"].toArray().tolist() for r in vectors.collect()) == [
        [1.0, 0.0, 1.0, 0.0], [2.0, 0.0, 0.0, 1.0], [3.0, 1.0, 0.0, 0.0]]


def test_baseline(spark):
    df = spark.range(400).select(
        "id", (F.col("id") % 17).cast("double").alias("x"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("c"),
        (F.rand(1)).alias("injury_claim")).withColumn("vehicle_claim", F.col("x") * 10 + (F.col("c") == "a").cast("int") * 50)
    found = analysis.baseline(df, "id", trees=10, depth=5, folds=2)
    holdout = found["holdout"].first()
    assert holdout["n"] == 80 and holdout["r2"] > 0.9
    assert [r["feature"] for r in found["top importances"].collect()] == ["x", "c_b"]
    assert sum(r["n"] for r in found["folds"].collect()) == 400 and found["cross validation"].first()["r2_mean"] > 0.9


def test_analysis_frames(spark):
    df = spark.createDataFrame(
        [(float(i % 7), None if i % 5 == 0 else "?" if i % 4 == 0 else "k", "t", float(i)) for i in range(60)],
        "x double, incident_type string, collision_type string, vehicle_claim double")
    clean = analysis.impute_and_deduplicate(df)
    assert clean.where("incident_type IS NULL OR incident_type = '?'").count() == 0
    frames = analysis.explore(clean)
    assert {"describe", "histogram", "effects", "crosstab", "mean by incident_type"} <= set(frames)
    assert all(frame.count() >= 0 for frame in frames.values())


def test_forest_does_not_depend_on_input_partitions(spark):
    df = spark.range(300).select("id", (F.col("id") % 17).cast("double").alias("x"), (F.col("id") * 7 % 23).cast("double").alias("z")).withColumn(
        "vehicle_claim", F.col("x") * 10 + F.col("z"))
    runs = [{r["feature"]: r["importance"] for r in analysis.baseline(df.repartition(n), "id", trees=5, depth=4, partitions=4, cross_validation=False)["importances"].collect()}
            for n in (1, 3, 8)]
    assert runs[0] == runs[1] == runs[2]


def test_csv_faults_are_errors(spark, tmp_path):
    surplus, broken = tmp_path / "s.csv", tmp_path / "b.csv"
    surplus.write_text("a,b\n1,2\n3,4,5\n")
    broken.write_text('a,b\n"x\ny",7\n1\n')
    with pytest.raises(Exception, match="more fields than columns"):
        read_csv_text(spark, str(surplus)).collect()
    with pytest.raises(ValueError, match="unbalanced quotes"):
        read_csv_text(spark, str(broken), multiline=False)
    assert sorted(tuple(r) for r in read_csv_text(spark, str(broken)).collect()) == [("1", ""), ("x\ny", "7")]
    broken.write_text('a,b\n"x\ny",7\n1,"2\n')
    with pytest.raises(ValueError, match="never closed"):
        read_csv_text(spark, str(broken))
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "1.csv").write_text('a,b\n"x\ny",7\n')
    (tmp_path / "two" / "2.csv").write_text('b,a\n1,2\n')
    with pytest.raises(Exception, match="differs from the columns"):
        read_csv_text(spark, str(tmp_path / "two"), T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])).collect()


@pytest.mark.parametrize("block", [40, 150, 4000])
def test_records_over_several_lines_and_blocks(spark, tmp_path, block):
    """Random quotes, commas, line breaks and blank lines in files cut into small blocks, against the csv module."""
    import csv
    import random

    rng, want = random.Random(block), []
    for name in ("b.csv", "a.csv", "c.csv"):
        ending = "\r\n" if name == "c.csv" else "\n"
        with open(tmp_path / name, "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, lineterminator=ending)
            out.writerow(["id", "note", "end"])
            for i in range(60):
                text = "".join(rng.choice(["x", "é", '"', ",", "\n", "\n\n", "\r\n", " word "]) for _ in range(rng.choice([0, 1, 3, 40])))
                out.writerow([f"{name}{i}", text, rng.choice(["", "z", "a\nb" * 20])])
                if rng.random() < 0.2:
                    f.write(ending)
    for name in sorted(["a.csv", "b.csv", "c.csv"]):
        with open(tmp_path / name, newline="", encoding="utf-8") as f:
            want += [tuple(r) for r in list(csv.reader(f))[1:] if r]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = read_csv_text(spark, str(tmp_path), positions=True)
        assert block == 4000 or df.rdd.getNumPartitions() > 10
        got = file_row_index(df, "n").orderBy("n").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r["id"], r["note"], r["end"]) for r in got] == want
    assert [r["n"] for r in got] == list(range(1, len(want) + 1))


def test_staged_data_go_with_the_job(spark, tmp_path):
    df = spark.range(5)
    with session.scratch(spark):
        path = session.scratch_path(spark, "x")
        assert session.stage(df, "x", path).count() == 5 and os.path.exists(path)
    assert not os.path.exists(path)


def test_several_date_formats(spark):
    df = spark.createDataFrame([("2014-10-17",), ("10/17/2014",), (None,)], "d string")
    assert [str(r[0]) for r in cleaning.parse_dates(df, ["d"], ["yyyy-MM-dd", "MM/dd/yyyy"]).collect()] == ["2014-10-17", "2014-10-17", "None"]
    with pytest.raises(Exception, match="no date in"):
        cleaning.parse_dates(df, ["d"]).collect()


def test_audit_plan_is_small(spark, tmp_path):
    source = write_source(tmp_path / "claims.csv", [{}, {}])
    flat = session.stage(etl.transform(etl.extract(spark, source)), "flat")
    plan = audits.audit_flat(flat, etl.ROW_NUMBER)._jdf.queryExecution().executedPlan().toString()
    # one scan; the keys are shuffled once, and then one row a rule and task
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange") == 2


def test_audit_of_tables_counts_keys_of_all_places(spark, tmp_path):
    source = write_source(tmp_path / "claims.csv", [{"policy_number": str(1000 + i % 3)} for i in range(6)] + [{"age": "", "policy_number": ""}])
    tables = split_claims(etl.transform(etl.extract(spark, source)), etl.ROW_NUMBER, typed=False)
    tables["unfaelle"] = tables["unfaelle"].withColumn("police_id", F.expr("CASE police_id WHEN 1 THEN 99 WHEN 2 THEN 99 WHEN 3 THEN NULL ELSE police_id END"))
    tables["schaeden"] = tables["schaeden"].unionByName(tables["schaeden"].where("schaden_id < 3"))
    tables["kunden"] = tables["kunden"].where("kunde_id <> 4")
    found = {r["rule"]: r["violations"] for r in audits.audit_tables(tables).collect()}
    want = {"unique policen.policen_nummer": 3, "unique schaeden.schaden_id": 2, "foreign_key unfaelle.police_id": 2, "foreign_key policen.kunde_id": 1,
            "not_null unfaelle.police_id": 1, "not_null kunden.alter_jahre": 1, "not_null policen.policen_nummer": 1}
    assert {r: n for r, n in found.items() if n} == want
    assert len(found) == 67
    assert {r["rule"]: r["violations"] for r in audits.unique_summary(tables).collect()} == {r: n for r, n in found.items() if r.startswith("unique")}
    assert {r["rule"]: r["violations"] for r in audits.foreign_key_summary(tables).collect()} == {r: n for r, n in found.items() if r.startswith("foreign")}


def test_mapping_of_the_tables():
    """Literal names of every target column, beside the table that the code reads."""
    assert {t: ",".join(c for _, c, _ in columns) for t, columns in TABLES.items()} == {
        "kunden": "kunde_id,alter_jahre,geschlecht,bildungsniveau,beruf,hobbys,familienverhaeltnis,plz,kapitalgewinne,kapitalverluste,kunde_seit_monaten",
        "policen": "police_id,kunde_id,policen_nummer,vertragsbeginn,bundesstaat,deckungsgrenze,selbstbeteiligung,jahrespraemie,umbrella_limit",
        "fahrzeuge": "fahrzeug_id,police_id,marke,modell,baujahr",
        "unfaelle": "unfall_id,police_id,unfall_datum,unfall_typ,kollisions_typ,schadensschwere,behoerde,bundesstaat,stadt,adresse,"
                    "uhrzeit_stunde,anzahl_fahrzeuge,sachschaden_dritter,anzahl_verletzte,anzahl_zeugen,polizeibericht",
        "schaeden": "schaden_id,unfall_id,gesamtschaden,personenschaden,sachschaden,fahrzeugschaden,betrug_gemeldet"}

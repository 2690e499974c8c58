import datetime

import pytest
from pyspark.sql import functions as F

from claimwise.operators import cleaning as C
from claimwise.operators.prepare import first_usable_amount, make_model, prepared_columns


def values(df, column):
    return [r[column] for r in df.collect()]


def test_tokens_match_whole_cells_only(spark):
    df = spark.createDataFrame([("?", "a?b"), ("x", "?")], "a string, b string")
    assert {tuple(r) for r in C.nullify_tokens(df).collect()} == {(None, "a?b"), ("x", None)}


def test_default_tokens_include_none_and_na(spark):
    df = spark.createDataFrame([("None",), ("NA",), ("",), ("?",), ("none",)], "a string")
    assert values(C.nullify_file_tokens(df), "a") == [None, None, None, "?", "none"]
    assert values(C.nullify_file_tokens(df, ["?"]), "a") == [None] * 4 + ["none"]


def test_drop_column_is_tolerant(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert C.drop_column(df, "_c39").columns == ["a"]


def test_strict_clean_order_and_report(spark):
    df = spark.createDataFrame(
        [(0, "a", "x", None), (1, None, "x", None), (2, "a", "x", None), (3, "b", "y", None), (4, "a", "x", None)],
        "i bigint, a string, b string, _c39 string")
    assert C.empty_columns(df) == ["_c39"]
    assert sorted(values(C.strict_clean(df, "i"), "i")) == [0, 3]
    assert C.cleanup_summary(df, "i").first() == (5, 1, "_c39", 1, 2, 2)
    rejects = {(r["row_index"], r["reason"]) for r in C.cleanup_rejects(df, "i").collect()}
    assert rejects == {(1, "null"), (2, "duplicate"), (4, "duplicate")}
    lines = C.cleanup_report_lines(C.cleanup_summary(df, "i"), C.cleanup_rejects(df, "i"))
    text = [r["line"] for r in lines.orderBy("section", "position").collect()]
    assert text == [
        "Original rows: 5", "Removed fully empty columns (1): _c39", "Removed rows with null values: 1",
        "Removed duplicate rows: 2", "Final rows: 2", "", "Rows removed because of null values:", "- row_index=1",
        "", "Duplicate rows removed:", "- row_index=2", "- row_index=4"]


def test_report_of_clean_frame_has_no_row_sections(spark):
    df = spark.createDataFrame([(0, "a")], "i bigint, a string")
    lines = C.cleanup_report_lines(C.cleanup_summary(df, "i"), C.cleanup_rejects(df, "i"))
    text = [r["line"] for r in lines.orderBy("section", "position").collect()]
    assert text[1] == "Removed fully empty columns (0): none" and len(text) == 5


def test_nulls_are_equal_for_duplicates(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", None)], "a string, b int")
    assert C.drop_duplicate_rows(df).count() == 2


def test_coerce_numbers(spark):
    df = spark.createDataFrame([(" 12.5 ",), ("1e3",), ("12d",), ("abc",), ("nan",), ("",), ("-.5",)], "a string")
    assert values(C.coerce_columns(df, ["a"]), "a") == [12.5, 1000.0, None, None, None, None, -0.5]


def test_dates_raise_or_null(spark):
    df = spark.createDataFrame([("2015-01-31",), ("31.01.2015",)], "a string")
    assert values(C.parse_dates(df, ["a"], on_error="null"), "a") == [datetime.date(2015, 1, 31), None]
    with pytest.raises(Exception):
        C.parse_dates(df, ["a"]).collect()


def test_flag(spark):
    df = spark.createDataFrame([("Y",), ("N",), ("y",), (None,)], "a string")
    assert values(C.flag_to_boolean(df, "a"), "a") == [True, False, None, None]


def test_median_interpolates_and_mode_takes_smallest_tie(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (4.0, None), (None, "b"), (9.0, "a")], "x double, c string")
    assert sorted(values(C.impute_median(df), "x")) == [1.0, 2.0, 3.0, 4.0, 9.0]
    assert sorted(values(C.impute_mode(df), "c")) == ["a", "a", "a", "b", "b"]


def test_all_null_columns_stay_null(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "x double, c string")
    assert C.impute_mode(C.impute_median(df)).collect() == [(None, None)] * 2


def test_name_fixes_and_roles(spark):
    df = spark.createDataFrame([("Accura", 1, True), ("Suburu", 2, False)], "auto_make string, n int, f boolean")
    assert values(C.fix_values(df), "auto_make") == ["Acura", "Subaru"]
    assert C.column_roles(df) == (["n"], ["auto_make"])
    assert C.column_roles(df, "n") == ([], ["auto_make"])


def test_misspelt_makes_are_fixed_after_deduplication(spark):
    df = spark.createDataFrame([(0, "Accura"), (1, "Acura")], "i bigint, auto_make string")
    assert C.fix_values(C.strict_clean(df, "i")).count() == 2


def test_leakage_and_blank(spark):
    df = spark.createDataFrame([(1, 2, 3)], "vehicle_claim int, Injury_CLAIM int, age int")
    assert C.drop_leakage(df, "vehicle_claim").columns == ["vehicle_claim", "age"]
    texts = spark.createDataFrame([("a",), ("  \t",), (None,)], "text string")
    kept, rejected = C.reject_blank(texts, "text")
    assert (kept.count(), rejected.count()) == (1, 2)


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in C.null_profile(df).collect()] == [("b", 1), ("a", 0)]
    assert C.total_nulls(df).first()["nulls"] == 1
    assert ("b", "string", 1, 2) in [tuple(r) for r in C.table_profile(df).collect()]


def test_prepared_columns(spark):
    df = spark.createDataFrame(
        [("Audi ", " A 3 ", "2001", "Total Loss", " ? ", " Parked Car", "", "100.5"),
         ("BMW", "X5", "1999", "Minor Damage", "", "?", "x", None)],
        "auto_make string, auto_model string, auto_year string, incident_severity string, collision_type string, "
        "incident_type string, total_claim_amount string, vehicle_claim string")
    first, second = prepared_columns(df).collect()
    assert tuple(first) == ("Audi A 3", "2001", "Total Loss", "Parked Car", 92.46)
    assert (second["collision_type"], second["claim_amount_eur"]) == ("Unknown", 0.0)


def test_cents_round_half_even(spark):
    df = spark.createDataFrame([("0.125",), ("0.375",)], "a string")
    assert values(df.select(first_usable_amount([F.col("a")], 1.0).alias("a")), "a") == [0.12, 0.38]


def test_make_model_of_missing_part(spark):
    df = spark.createDataFrame([(None, "X")], "a string, b string")
    assert values(df.select(make_model(F.col("a"), F.col("b")).alias("m")), "m") == ["nan X"]


@pytest.mark.parametrize("same_hash", [False, True])
def test_copies_are_told_by_content_not_by_hash(spark, monkeypatch, same_hash):
    """Also where all rows have one hash; indices may repeat or be missing."""
    if same_hash:
        monkeypatch.setattr(C, "content_hash", lambda columns: F.lit(1).cast("bigint"))
    df = spark.createDataFrame(
        [(0, "a", "x"), (1, "a", "x"), (2, "a", None), (3, None, "a"), (4, None, "a"), (4, "b", "y"), (5, "b", "y"), (None, "c", "z"), (None, "a", "x")],
        "i bigint, a string, b string")
    assert sorted(values(C.duplicate_rows(df, "i"), "i"), key=str) == [1, 5, None, None]
    assert C.cleanup_summary(df, "i").first() == (9, 0, "none", 3, 3, 3)
    rejects = sorted((tuple(r) for r in C.cleanup_rejects(df, "i").collect()), key=str)
    assert rejects == sorted([(2, "null"), (3, "null"), (4, "null"), (1, "duplicate"), (5, "duplicate"), (None, "duplicate"), (None, "duplicate")], key=str)
    assert C.cleanup_summary(df.limit(0), "i").first() == (0, 2, "a, b", 0, 0, 0)
    assert C.cleanup_summary(df.select("i", F.lit(None).cast("string").alias("a")), "i").first() == (9, 1, "a", 0, 8, 1)


def test_only_repeated_rows_are_compared(spark):
    """Rows whose hash stands alone are not grouped by content: those of the group are few."""
    df = spark.range(1000).select(F.col("id").alias("i"), (F.col("id") % 990).cast("string").alias("a"))
    found = C.duplicate_rows(df, "i")
    assert sorted(values(found, "i")) == list(range(990, 1000)) and "_hash" in found._jdf.queryExecution().optimizedPlan().toString()


def test_modes_are_counted_of_columns_with_gaps_only(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x")], "full string, gaps string")
    filled = C.impute_mode(df)
    assert sorted(tuple(r) for r in filled.collect()) == [("a", "x"), ("a", "x"), ("b", "x")]
    assert "_fill" not in C.impute_mode(df.select("full"))._jdf.queryExecution().analyzed().toString()
    assert "full AS feature" not in filled._jdf.queryExecution().analyzed().toString()

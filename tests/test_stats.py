import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimwise.functions.pvalues import f_tail
from claimwise.operators import stats as S


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(5)
    n = 1200
    pdf = pd.DataFrame({
        "a": rng.normal(size=n), "b": np.where(rng.random(n) < 0.4, 0.0, rng.integers(0, 30, n)).astype(float),
        "flat": 2.0, "c": rng.choice(["u", "v", "w"], n), "d": rng.choice(["p", None], n)})
    pdf["y"] = np.where(rng.random(n) < 0.35, 0.0, pdf["a"] * 2 + (pdf["c"] == "u") + rng.normal(size=n))
    pdf.loc[rng.choice(n, 80, replace=False), "a"] = np.nan
    pdf.loc[rng.choice(n, 50, replace=False), "y"] = np.nan
    return pdf


@pytest.fixture(scope="module")
def frame(spark, sample):
    from claimwise.operators.cleaning import nan_to_null_columns

    return nan_to_null_columns(spark.createDataFrame(sample))


def test_spearman_equals_pandas_with_gaps_and_hot_values(frame, sample):
    got = {r["feature"]: r for r in S.spearman(frame, ["a", "b", "flat"], "y").collect()}
    assert set(got) == {"a", "b"}
    for c in ("a", "b"):
        part = sample[[c, "y"]].dropna()
        assert got[c]["n"] == len(part)
        assert got[c]["effect"] == pytest.approx(part[c].rank().corr(part["y"].rank()), abs=1e-12)


def test_spearman_of_constant_target_is_null(frame):
    assert S.spearman(frame, ["b"], "flat").first()["effect"] is None


def test_anova_of_a_small_table_by_hand(spark):
    # a: 1, 3 (mean 2); b: 5, 7 (mean 6); c: 9, 11 (mean 10); overall 6. Between 2 * (16 + 0 + 16) = 64, within 3 * 2 = 6.
    rows = [("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", 7.0), ("c", 9.0), ("c", 11.0), (None, 5.0), ("a", None)]
    row = S.anova(spark.createDataFrame(rows, "c string, y double").selectExpr("*", "'same' AS d"), ["c", "d"], "y").collect()
    assert [(r["feature"], r["k"], r["n"]) for r in row] == [("c", 3, 6)]
    assert row[0]["f_stat"] == pytest.approx(16.0) and row[0]["effect"] == pytest.approx(64 / 70)


def test_no_features_give_empty_tables(spark):
    df = spark.createDataFrame([("a",)], "y string")
    assert S.effect_ranking(df, [], [], "y").count() == 0 and S.pearson_matrix(df).count() == 0


def test_tail_of_very_many_rows():
    for n in (1e7, 1e9, 1e12):
        for z in (0.3, 1.0, 1.74, 3.0, 6.0):
            # the t tail is the normal tail but for a term of order z^4 / n
            assert f_tail(z * z, 1, n) == pytest.approx(math.erfc(z / math.sqrt(2)), rel=max(1e-9, 40 * (1 + z ** 4) / n))
        assert f_tail(2.5, 2, n) == pytest.approx(math.exp(-n / 2 * math.log1p(5 / n)), rel=1e-9)


def test_anova_extremes(spark):
    exact = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0)], "c string, y double")
    row = S.anova_table(exact, ["c"], "y").first()
    assert row["effect"] == 1.0 and row["p_value"] == 0.0
    flat = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0)], "c string, y double")
    row = S.anova_table(flat, ["c"], "y").first()
    assert row["effect"] is None and row["p_value"] is None


def test_tail_probability():
    assert f_tail(3.0, 2, 20) == pytest.approx((1 + 2 * 3.0 / 20) ** -10, rel=1e-12)
    assert f_tail(500.0, 2, 200) == pytest.approx((1 + 5.0) ** -100, rel=1e-10)
    assert f_tail(0.0, 3, 7) == 1.0 and f_tail(math.inf, 3, 7) == 0.0 and f_tail(1.0, 1, 0) is None
    # one degree of freedom, many rows: the normal two-sided tail
    assert f_tail(1.96 ** 2, 1, 1e9) == pytest.approx(math.erfc(1.96 / math.sqrt(2)), rel=1e-6)
    assert f_tail(1.0, 1, 1) == pytest.approx(0.5, rel=1e-12)


def test_ranking_order_and_filter(frame):
    rows = S.effect_ranking(frame, ["a", "b"], ["c"], "y").collect()
    assert [r["effect"] for r in rows] == sorted((r["effect"] for r in rows), reverse=True)
    assert {r["feature"] for r in S.significant(S.effect_ranking(frame, ["a"], ["c"], "y")).collect()} <= {"a", "c"}


def test_pearson_equals_pandas(frame, sample):
    want = sample[["a", "b", "y", "flat"]].corr()
    for r in S.pearson_matrix(frame, ["a", "b", "y", "flat"]).collect():
        expected = want.loc[r["col_a"], r["col_b"]]
        if "flat" in (r["col_a"], r["col_b"]):
            assert r["r"] is None
        else:
            assert r["r"] == pytest.approx(expected, abs=1e-12)


def test_pearson_in_several_passes(frame):
    assert S.pearson_matrix(frame, ["a", "b", "y"], pairs_per_pass=2).count() == 9


def test_describe_equals_pandas(frame, sample):
    row, want = S.describe(frame, ["y"]).first(), sample["y"].describe()
    for ours, theirs in [("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
        assert row[ours] == pytest.approx(want[theirs], abs=1e-12)


def test_group_operators(frame, sample):
    got = {r["c"]: r for r in S.group_summary(frame, "c", "y").collect()}
    want = sample.groupby("c")["y"].agg(["mean", "median", "count"])
    for level in "uvw":
        assert got[level]["median"] == pytest.approx(want.loc[level, "median"])
        assert got[level]["count"] == want.loc[level, "count"]
    assert [r["d"] for r in S.group_mean(frame, "d", "y").collect()] == ["p"]


@pytest.mark.parametrize("values", [[0.0, 0.1, 0.3, 0.7, 1.0, 1.0], [5.0, 5.0], list(np.arange(301) / 10)])
def test_histogram_equals_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = S.histogram(df, "v").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=30)
    assert [r["count"] for r in rows] == counts.tolist()
    assert [r["low"] for r in rows] == pytest.approx(edges[:-1].tolist())


def test_crosstab_drops_null_keys_and_fills_zero(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "x"), ("a", None)], "r string, k string")
    assert sorted(tuple(r) for r in S.crosstab(df, "r", "k").collect()) == [("a", 1, 0), ("b", 0, 1)]


def test_spearman_in_small_windows(frame, sample):
    """At most 20 rows a window give the same effects."""
    want = {r["feature"]: r["effect"] for r in S.spearman(frame, ["a", "b"], "y").collect()}
    got = {r["feature"]: r["effect"] for r in S.spearman(frame, ["a", "b"], "y", buckets=2, most=20).collect()}
    assert got == pytest.approx(want, abs=1e-12)


def test_crosstab_refuses_too_many_levels(spark):
    df = spark.range(50).selectExpr("'a' as a", "id as b")
    with pytest.raises(ValueError, match="over 20 levels"):
        S.crosstab(df, "a", "b", most_levels=20)

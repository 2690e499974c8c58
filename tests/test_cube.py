"""Value-count cube and moment matrices against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimwise.operators import cleaning, cube, moments, stats
from claimwise.operators.cleaning import nan_to_null_columns


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(21)
    n = 900
    pdf = pd.DataFrame({
        "x": np.round(rng.normal(size=n), 2), "whole": rng.integers(0, 9, n), "y": rng.gamma(2.0, 50.0, n), "flag": rng.random(n) < 0.3,
        "c": rng.choice(["u", "v", "w"], n), "gone": None, "d": rng.choice(["p", "q", None], n, p=[0.4, 0.4, 0.2])})
    pdf.loc[rng.choice(n, 70, replace=False), "x"] = np.nan
    pdf.loc[rng.choice(n, 40, replace=False), "y"] = np.nan
    return pdf


@pytest.fixture(scope="module")
def frame(spark, sample):
    schema = "x double, whole bigint, y double, flag boolean, c string, gone string, d string"
    return nan_to_null_columns(spark.createDataFrame(sample.astype(object).where(sample.notna(), None), schema)).repartition(3)


@pytest.fixture(scope="module")
def counts(frame):
    return cube.value_cube(frame, "y")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_cube_equals_the_operators_that_read_rows(frame, counts):
    assert rows(cube.nulls(counts, frame.columns)) == rows(cleaning.null_profile(frame))
    assert rows(cube.profile(counts, frame)) == rows(cleaning.table_profile(frame))
    assert rows(cube.medians(counts, ["x", "whole", "y"])) == rows(cleaning.medians(frame, ["x", "whole", "y"]))
    assert rows(cube.modes(counts, ["c", "d", "gone"])) == rows(cleaning.modes(frame, ["c", "d"]))
    assert rows(cube.histogram(counts, "y")) == rows(stats.histogram(frame, "y"))
    for got, want in ((cube.describe(counts, ["x", "whole", "y"]), stats.describe(frame, ["x", "whole", "y"])),
                      (cube.anova(counts, ["c", "d", "gone"], "y"), stats.anova(frame, ["c", "d", "gone"], "y")),
                      (cube.group_mean(counts, "d"), stats.group_mean(frame, "d", "y"))):
        got, want = rows(got), rows(want)
        assert len(got) == len(want)
        for a, b in zip(got, want):
            assert a[0] == b[0] and list(a[1:]) == pytest.approx(list(b[1:]), rel=1e-9)


def test_cube_describes_like_pandas_in_small_windows(counts, sample):
    got = {r["feature"]: r for r in cube.describe(counts, ["x", "y"], most=25).collect()}
    for c in ("x", "y"):
        want = sample[c].describe()
        assert [got[c][k] for k in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")] == pytest.approx(want.tolist(), rel=1e-9)


def test_filled_equals_the_two_imputations(frame, counts):
    numeric, categorical = cleaning.column_roles(frame)
    want = cleaning.impute_mode(cleaning.impute_median(frame))
    assert rows(cube.filled(frame, counts, numeric, categorical)) == rows(want)


def test_cube_of_an_empty_table(frame):
    none = frame.limit(0)
    empty = cube.value_cube(none, "y")
    assert {r["nulls"] for r in cube.nulls(empty, frame.columns).collect()} == {0}
    assert {r["rows"] for r in cube.profile(empty, none).collect()} == {0}
    assert cube.describe(empty, ["y"]).first()["count"] == 0 and cube.histogram(empty, "y").count() == 0
    assert cube.filled(none, empty, ["x"], ["c"]).count() == 0


def test_moments_of_a_hundred_columns_with_gaps(spark):
    rng = np.random.default_rng(22)
    base = rng.normal(size=(400, 5))
    values = base @ rng.normal(size=(5, 100)) + rng.normal(size=(400, 100)) * 3 + 1e7
    values[rng.random(values.shape) < 0.15] = np.nan
    values[:, 7], values[:, 8] = 3.5, np.nan
    pdf = pd.DataFrame(values, columns=[f"c{i}" for i in range(100)])
    df = nan_to_null_columns(spark.createDataFrame(pdf)).repartition(7)
    plan = stats.pearson_matrix(df)
    got = {(r["col_a"], r["col_b"]): r["r"] for r in plan.collect()}
    want = pdf.corr()
    assert len(got) == 10_000
    for a in want:
        for b in want:
            if want.loc[a, b] == want.loc[a, b]:
                assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-9)
            else:
                assert got[a, b] is None
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 1


def test_moments_merge_like_one_block():
    rng = np.random.default_rng(23)
    values = rng.normal(size=(300, 4)) * [1, 10, 1e-3, 1] + [0, 5, 1e6, 2]
    values[rng.random(values.shape) < 0.3] = np.nan
    merged = np.zeros((6, 4, 4))
    for part in np.array_split(values, 11):
        merged = moments.merge(merged, moments.of_block(part))
    assert merged == pytest.approx(moments.of_block(values), rel=1e-6)


def test_correlation_of_few_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, None)], "a double, b double, c double").withColumns({f"k{i}": F.lit(float(i)) for i in range(10)})
    assert {r["r"] for r in stats.pearson_matrix(df).collect()} == {None}
    assert {r["r"] for r in stats.pearson_matrix(df.limit(0)).collect()} == {None}

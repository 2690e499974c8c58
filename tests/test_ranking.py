import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimwise.operators import ranking as R


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({
        "id": rng.permutation(1500),
        "g": rng.choice(["a", "b", "c"], 1500, p=[0.7, 0.2, 0.1]),
        "x": np.round(rng.normal(size=1500), 1),
        "y": np.where(rng.random(1500) < 0.4, 0.0, rng.random(1500)),
    })
    pdf.loc[rng.choice(1500, 100, replace=False), "x"] = np.nan
    return pdf


@pytest.mark.parametrize("partitions,buckets", [(1, 2), (4, 7), (50, 40)])
def test_average_rank_equals_pandas(spark, sample, partitions, buckets):
    df = spark.createDataFrame(sample).repartition(partitions)
    got = {(r["feature"], r["value"]): r["avg_rank"] for r in R.average_rank(df, ["x", "y"], buckets).collect()}
    for c in ("x", "y"):
        ranks = sample[c].rank()
        for v, rank in zip(sample[c], ranks):
            if v == v:
                assert got[(c, v)] == rank


@pytest.mark.parametrize("buckets", [2, 16])
def test_quantiles_equal_numpy(spark, sample, buckets):
    df = spark.createDataFrame(sample)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    for r in R.exact_quantiles(df, ["x", "y"], probs, buckets=buckets).collect():
        assert r["quantile"] == pytest.approx(np.nanquantile(sample[r["feature"]], r["prob"]), abs=1e-12)
    rows = R.exact_quantiles(df, ["y"], [0.5], by=["g"], buckets=buckets).collect()
    want = sample.groupby("g")["y"].median()
    assert {r["g"]: r["quantile"] for r in rows} == pytest.approx(want.to_dict())


def test_any_split_points_give_the_same_result(spark, sample):
    df = spark.createDataFrame(sample)
    bad = {"y": [-np.inf, 0.9999, np.inf]}
    assert R.exact_quantiles(df, ["y"], [0.5], splits=bad).first()["quantile"] == pytest.approx(sample["y"].median())


@pytest.mark.parametrize("partitions", [1, 4, 50])
def test_row_index_is_contiguous_in_key_order(spark, sample, partitions):
    df = spark.createDataFrame(sample[["id", "g"]]).repartition(partitions)
    got = R.row_index(df, "id", start=1).collect()
    assert all(r["row_index"] == r["id"] + 1 for r in got) and len(got) == 1500


@pytest.mark.parametrize("partitions,buckets", [(1, 2), (8, 33)])
def test_holdout_and_folds_have_exact_sizes(spark, partitions, buckets):
    df = spark.range(1003).repartition(partitions)
    held = R.holdout_split(df, "id", buckets=buckets)
    assert held.where("is_test").count() == 201
    sizes = sorted(r["count"] for r in R.fold_index(df, "id", buckets=buckets).groupBy("fold").count().collect())
    assert sizes == [200, 200, 201, 201, 201]
    again = R.holdout_split(spark.range(1003).repartition(3), "id", buckets=5)
    assert held.join(again.withColumnRenamed("is_test", "b"), "id").where("is_test <> b").count() == 0


def test_no_unpartitioned_window_over_rows(spark, sample):
    df = spark.createDataFrame(sample[["id", "x", "g"]])
    for frame in (R.average_rank(df, ["x"]), R.exact_quantiles(df, ["x"], [0.5], by=["g"])):
        assert "SinglePartition" not in frame._jdf.queryExecution().executedPlan().toString()


def test_crowded_range_is_split_until_each_window_is_small(spark, monkeypatch):
    """One crowded range, 4 buckets, at most 50 rows a window: every window group is counted."""
    rng = np.random.default_rng(8)
    values = np.unique(np.concatenate([5 + rng.random(3000) * 1e-6, rng.random(200) * 100]))
    rng.shuffle(values)
    pdf = pd.DataFrame({"v": values, "g": rng.choice(["a", "b"], len(values)), "id": np.arange(len(values))})
    df = spark.createDataFrame(pdf).repartition(5)
    groups = []
    plain = R.running_positions
    monkeypatch.setattr(R, "running_positions", lambda counts, by, *a, **k: (groups.append((counts, by)), plain(counts, by, *a, **k))[1])
    got = {r["value"]: r["avg_rank"] for r in R.average_rank(df, ["v"], buckets=4, most=50).collect()}
    assert got == dict(zip(pdf["v"], pdf["v"].rank()))
    counts, by = groups.pop()
    assert counts.groupBy(*by, "bucket").count().agg(F.max("count")).first()[0] <= 50

    # the same for borders of the caller, all of them outside the values
    bad = {"v": [-np.inf, -5.0, 1e9, np.inf]}
    assert {r["value"]: r["avg_rank"] for r in R.average_rank(df, ["v"], splits=bad, most=50).collect()} == got
    rows = R.exact_quantiles(df, ["v"], [0.1, 0.5, 0.93], by=["g"], buckets=4, most=40).collect()
    for r in rows:
        assert r["quantile"] == pytest.approx(np.quantile(pdf[pdf.g == r["g"]]["v"], r["prob"]), abs=1e-12)
    numbered = R.row_index(df.drop("id"), "v", buckets=4, most=50)
    assert numbered.toPandas().sort_values("v")["row_index"].tolist() == list(range(1, len(values) + 1))
    held = R.holdout_split(df, "id", buckets=2).where("is_test").count()
    assert held == -(-len(values) // 5)


def test_refinement_keeps_equal_values_together(spark):
    """A bucket of one value cannot be split, and is not tried for ever."""
    df = spark.createDataFrame([(1.0,)] * 30 + [(2.0,)] * 3, "value double").withColumn("bucket", F.lit(0))
    rounds = R.refinements(df, [], most=2)
    sizes = R.refined(df, [], rounds).groupBy("bucket").agg(F.count_distinct("value").alias("d")).collect()
    assert len(sizes) == 2 and all(r["d"] == 1 for r in sizes)


def test_seeded_cuts_use_as_many_buckets_as_the_rows_need(spark):
    whole = R.seeded_cuts(spark.range(2000), "id", 7, [500, 700])
    assert R.seeded_cuts(spark.range(2000), "id", 7, [500, 700], buckets=2, most=20) == whole
    assert R.seeded_cuts(spark.range(0), "id", 7, [0, 5]) == ["", ""]

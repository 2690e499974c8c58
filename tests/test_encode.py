"""Distributed dictionary and sparse vectors against the driver-side encoding."""

import pytest
from pyspark.sql import functions as F

from claimwise.operators import encode as E, model


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(400).select(
        "id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 2 == 0).alias("flag"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 11 == 0, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 150).cast("string"))).alias("many"),
        F.element_at(F.array(*[F.lit(c) for c in "abc"]), (F.col("id") % 3 + 1).cast("int")).alias("few"), F.lit("one").alias("same"),
        F.lit(None).cast("string").alias("none"), (F.col("id") * 1.5).alias("y")).repartition(5)


@pytest.mark.parametrize("few_levels,most", [(20_000, 10 ** 6), (2, 20)])
def test_vectors_hold_what_the_plain_encoding_holds(frame, few_levels, most):
    got = E.encode(frame, "y", ["id"], most=most, few_levels=few_levels)
    vectors, names = model.feature_vectors(frame.fillna({"many": "hot"}), "y", ["id"])
    want = {r["id"]: ({names[i]: v for i, v in zip(r["features"].indices, r["features"].values)} if hasattr(r["features"], "indices")
                      else {n: v for n, v in zip(names, r["features"]) if v}, r["label"]) for r in vectors.collect()}
    slots = {r["slot"]: r["name"] for r in got.slots.collect()}
    assert sorted(slots) == list(range(got.size)) and set(slots.values()) == set(names)
    rows = {r["id"]: r for r in got.vectors.collect()}
    assert len(rows) == 400
    for i, (features, label) in want.items():
        assert {slots[j]: v for j, v in zip(rows[i]["features"].indices, rows[i]["features"].values)} == features, i
        assert rows[i]["features"].size == got.size and rows[i]["label"] == label


def test_dictionary_has_no_large_window(frame):
    table = E.dictionary(frame, ["many", "few", "same", "none"], 3, most=10)
    rows = sorted((r["f"], r["level"], r["slot"]) for r in table.collect() if r["slot"] is not None)
    assert sorted(s for _, _, s in rows) == list(range(3, 3 + len(rows)))
    assert all(max(s for f, _, s in rows if f == a) < min(s for f, _, s in rows if f == b) for a, b in ((0, 1),))
    assert table.where("slot is null").count() == 3


def test_vectors_fit_the_model_library(frame):
    found = E.encode(frame.select("id", "x", "few", "y"), "y", ["id"])
    fitted = model.forest(trees=3, depth=3).fit(found.vectors)
    assert fitted.numFeatures == found.size == 3
    empty = E.encode(frame.limit(0), "y", ["id"])
    assert empty.vectors.count() == 0 and empty.size == 2
    totals = {(r["feature"], r["level"]): r["rows"] for r in E.slot_totals(found).collect()}
    assert totals["few", "b"] == 133 and ("few", "a") not in totals

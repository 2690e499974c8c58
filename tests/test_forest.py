"""Forests grown from histograms against trees grown row by row, and over any number of blocks."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from claimwise.operators import forest as R, model
from claimwise.plans import analysis


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(500).select(
        "id", (F.col("id") * 7 % 31).cast("double").alias("a"), (F.col("id") * 13 % 200 - 100).cast("double").alias("b"),
        (F.col("id") % 3 == 0).cast("double").alias("c"), F.lit(2.5).alias("same"))
    df = df.withColumn("label", F.col("a") * 3 + F.when(F.col("c") == 1, F.col("b")).otherwise(-F.col("b")) + F.col("id") % 5 / 4)
    return model.stage(VectorAssembler(inputCols=["a", "b", "c", "same"], outputCol="features").transform(df).select("id", "features", "label"), "rows")


def grown(rows, blocks, depth=4, trees=3):
    return R.train(rows.repartition(7), [F.col("id") % 4 != 0, F.col("id") >= 0], F.xxhash64("id"), trees, depth, 5, blocks=blocks)


def test_blocks_change_no_tree(rows):
    one = grown(rows, 1)
    for blocks in (2, 5):
        for a, b in zip(one, grown(rows, blocks)):
            assert len(a.trees) == len(b.trees) == 3
            for x, y in zip(a.trees, b.trees):
                assert all(np.array_equal(getattr(x, k), getattr(y, k)) for k in ("place", "cut", "value", "gain"))


def test_trees_are_those_of_all_rows(rows):
    """Every node has the best split of its drawn rows, looked for row by row."""
    data = sorted((r["id"], r["features"].toArray(), r["label"], r["h"]) for r in rows.withColumn("h", F.xxhash64("id")).collect())
    forest = grown(rows, 3)[0]
    binned = np.array([[np.searchsorted(b, v) for b, v in zip(forest.bins.borders, x)] for _, x, _, _ in data])
    block = R.Block.__new__(R.Block)
    block.draw, block.marks = np.array([h for *_, h in data]).view(np.uint64), np.array([i % 4 != 0 for i, *_ in data], np.int64)
    y = np.array([label for _, _, label, _ in data])
    for number, tree in enumerate(forest.trees):
        drawn, times = block.bag(0, number, 5)
        assert 0.5 < len(drawn) / block.marks.sum() < 0.75 and 0.85 < times.sum() / block.marks.sum() < 1.15
        here = {0: (drawn, times)}
        for node in range(len(tree.place)):
            if node not in here:
                continue
            at, w = here[node]
            assert tree.value[node] == pytest.approx((w * y[at]).sum() / w.sum())
            if node > len(tree.place) // 2 - 1:
                continue
            best = 0.0
            for p in range(4):
                for cut in range(len(forest.bins.borders[p])):
                    left = binned[at, p] <= cut
                    n, m = w[left].sum(), w[~left].sum()
                    if n and m:
                        away = (w * y[at])[left].sum() / n - (w * y[at])[~left].sum() / m
                        best = max(best, n * m / (n + m) * away ** 2)
            if best < 1e-9:
                assert tree.place[node] == -1
                continue
            left = binned[at, tree.place[node]] <= tree.cut[node]
            n, m = w[left].sum(), w[~left].sum()
            away = (w * y[at])[left].sum() / n - (w * y[at])[~left].sum() / m
            assert n * m / (n + m) * away ** 2 == pytest.approx(best)
            here[2 * node + 1], here[2 * node + 2] = (at[left], w[left]), (at[~left], w[~left])
    walked = [np.mean([walk(t, b) for t in forest.trees]) for b in binned]
    found = {r["id"]: r["prediction"] for r in forest.transform(rows).collect()}
    assert [found[i] for i, *_ in data] == pytest.approx(walked)


def walk(tree, bins):
    node = 0
    while tree.place[node] >= 0:
        node = 2 * node + 1 + int(bins[tree.place[node]] > tree.cut[node])
    return tree.value[node]


@pytest.fixture(scope="module")
def wide(spark):
    """300 levels in places of their own, a number of 300 values, and two columns of few levels."""
    df = spark.range(900).select("id", (F.col("id") * 7 % 300).cast("int").alias("level"), (F.col("id") * 11 % 300 / 2).alias("z"),
                                 (F.col("id") % 3).cast("int").alias("k"), (F.col("id") * 5 % 4).cast("int").alias("m"))
    hot = [F.when(F.col("level") == i, 1.0).otherwise(0.0) for i in range(1, 300)]
    hot += [F.when(F.col(c) == i, 1.0).otherwise(0.0) for c, n in (("k", 3), ("m", 4)) for i in range(1, n)]
    places = array_to_vector(F.array(F.col("z") - 40, *hot))
    return model.stage(df.select("id", places.alias("features"), (F.col("z") * F.col("k") + 50 * F.col("m") + F.col("level") % 7 * 20).alias("label")), "wide")


def packed(rows, most):
    data = rows.orderBy("id").toArrow()
    bins = R.find_bins(rows, 305, 900, most)
    row, place, found = bins.cells(data["features"].combine_chunks())
    layout, there = R.Layout(bins), found != bins.home[place]
    return data, layout, bins.table(data["features"].combine_chunks()), layout.pack(row[there], (bins.offset[place] + found)[there], 900)


@pytest.mark.parametrize("most, long", [(32, 0), (600, 1)])
def test_places_that_never_meet_share_bytes(wide, most, long):
    """305 places lie in a few bytes; counts and steps are those of the bins."""
    data, layout, table, (lines, words) = packed(wide, most)
    assert layout.bytes + layout.words <= 4 and layout.words == long
    draws = np.arange(900, dtype=np.uint64)
    block = R.Block([(draws, np.ones(900, np.uint8), np.arange(900.0), lines, words)])
    rows, at, times = np.arange(0, 900, 2), np.arange(450) % 3, np.arange(450) % 4 + 1.0
    tally = R.Tally(layout, 3)
    tally.add(block, rows, times, at)
    n, s = tally.counts()
    for node in range(3):
        mine = at == node
        assert (n[node, -1], s[node, -1]) == (times[mine].sum(), (times * rows)[mine].sum())
        for p in range(305):
            found = np.bincount(table[rows[mine], p], times[mine], len(layout.bins.borders[p]) + 1)
            found[layout.bins.home[p]] = 0
            assert np.array_equal(n[node, layout.bins.offset[p]:][:len(found)], found)
    for p, cut in [(p, c) for p in (0, 1, 150, 290, 301, 304) for c in (0, len(layout.bins.borders[p]) // 2)]:
        tree = R.Tree.root(1)
        tree.place[0], tree.cut[0] = p, cut
        walk = R.Walk(block, rows, times)
        R._down([walk], {0: tree}, 0, layout, True)
        assert np.array_equal(walk.node == 2, table[rows, p] > cut)


@pytest.mark.parametrize("most", [32, 600])
def test_values_are_means_of_the_drawn_rows(wide, most):
    one, many = (R.train(wide.repartition(5), [F.col("id") % 5 != i for i in range(3)], F.xxhash64("id"), 2, 6, 3, most, n) for n in (1, 3))
    data = wide.withColumn("h", F.xxhash64("id")).orderBy("id").toArrow()
    table, y = one[0].bins.table(data["features"].combine_chunks()), data["label"].to_numpy()
    block = R.Block.__new__(R.Block)
    block.draw = data["h"].to_numpy().view(np.uint64)
    for i, forest in enumerate(one):
        block.marks = (np.arange(900) % 5 != i).astype(np.int64)
        for number, tree in enumerate(forest.trees):
            assert all(np.array_equal(getattr(tree, k), getattr(many[i].trees[number], k)) for k in ("place", "cut", "value", "gain"))
            rows, times = block.bag(0, number, 3)
            node = np.zeros(len(rows), np.int64)
            for _ in range(6):
                goes = tree.place[node] >= 0
                node = np.where(goes, 2 * node + 1 + (table[rows, tree.place[node]] > tree.cut[node]), node)
            assert len(np.unique(node)) > 20
            total, n = np.bincount(node, times * y[rows]), np.bincount(node, times)
            used = np.flatnonzero(n)
            assert tree.value[used] == pytest.approx(total[used] / n[used])


def test_draws_are_poisson_by_exact_limits():
    block = R.Block.__new__(R.Block)
    block.draw = np.random.default_rng(1).integers(0, 2 ** 63, 200_000).astype(np.uint64)
    times = block.times(3, 5)
    z = block.draw + np.uint64((5 * 1_000_003 + 4) * 0x9E3779B97F4A7C15 % 2 ** 64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z = (z ^ (z >> np.uint64(31))) >> np.uint64(32)
    assert np.array_equal(times, (z[:, None] >= R._LIMITS).sum(axis=1))


def test_forest_does_not_depend_on_blocks(spark):
    df = spark.range(300).select("id", (F.col("id") % 17).cast("double").alias("x"), (F.col("id") * 7 % 23).cast("double").alias("z")).withColumn(
        "vehicle_claim", F.col("x") * 10 + F.col("z"))
    runs = [[r["importance"] for r in analysis.baseline(df, "id", trees=5, depth=4, partitions=n, cross_validation=False)["importances"].orderBy("feature").collect()]
            for n in (1, 2, 4)]
    assert runs[0] == runs[1] == runs[2] and sum(runs[0]) == pytest.approx(1)


def test_missing_numbers_and_empty_tables_are_errors(rows):
    with pytest.raises(Exception, match="missing or not finite"):
        grown(rows.withColumn("label", F.when(F.col("id") != 3, F.col("label"))), 1)
    with pytest.raises(ValueError, match="no rows"):
        grown(rows.limit(0), 1)


def test_other_estimators_stay_with_the_library(rows):
    found = model.train_all(rows, model.forest(3, 3, minInstancesPerNode=5), {"t": F.col("id") % 5 == 0}, "id")
    assert found["t"][0].numFeatures == 4 and found["t"][1]["n"] == 100


def test_trees_that_split_alike_are_counted_together(rows):
    """Forests grown together, most rows in several of them, are those grown one by one."""
    marks = [F.col("id") % 5 != i for i in range(5)]
    together = R.train(rows, marks, F.xxhash64("id"), 2, 4, 5, blocks=1)
    for i, forest in enumerate(together):
        alone, = R.train(rows, marks[i:i + 1], F.xxhash64("id"), 2, 4, 5, blocks=1)
        for x, y in zip(alone.trees, forest.trees):
            assert all(np.array_equal(getattr(x, k), getattr(y, k)) for k in ("place", "cut", "value", "gain"))


def test_rows_of_alike_trees_are_counted_once(wide, monkeypatch):
    """Five trees without a split have one root, counted over every row once and not once a tree."""
    _, layout, _, (lines, words) = packed(wide, 32)
    block = R.Block([(np.arange(900, dtype=np.uint64), (31 - (1 << np.arange(900) % 5)).astype(np.uint8), np.arange(900.0), lines, words)])
    seen, add = [], R.Tally.add
    monkeypatch.setattr(R.Tally, "add", lambda tally, block, rows, *rest: (seen.append(len(rows)), add(tally, block, rows, *rest)))
    times = np.ones(900, np.uint8)
    found = R._count([block.drawn(31, times)], {f: R.Tree.root(3) for f in range(5)}, layout)
    assert seen == [900]
    for f in range(5):
        alone, = R._count([block.drawn(1 << f, times)], {f: R.Tree.root(3)}, layout).values()
        assert all(np.array_equal(x, y) for x, y in zip(alone, found[f])) and found[f][0][0, -1] == 720


def sketched(values, points, held):
    """The quantiles of a place from sketches of parts of its values, held so many at a time."""
    vector = pa.StructArray.from_arrays(
        [pa.array(np.ones(len(values), np.int8)), pa.array([None] * len(values), pa.int32()), pa.array([None] * len(values), pa.list_(pa.int32())),
         pa.array([[v] for v in values], pa.list_(pa.float64()))], names=["type", "size", "indices", "values"])
    batches = pa.Table.from_arrays([vector], names=["features"]).to_batches(max_chunksize=500)
    return R._joined(pa.Table.from_batches([b for b in R._sketched(iter(batches), points, held) if b.num_rows])).to_pylist()[0]


def test_quantiles_of_a_place_are_exact_while_its_values_are_few():
    values = np.random.default_rng(3).integers(-2000, 2000, 9_700).astype(float)
    other = np.sort(values[(values != 0) & (values != 1)])
    found = sketched(values, 10_240, 1_000)
    assert (found["ones"], found["others"]) == ((values == 1).sum(), len(other))
    assert found["every"] == [other[int(np.ceil(i / 1024 * len(other))) - 1] for i in range(1, 1024)]
    assert found["points"][0] == other[0] and found["points"][-1] == other[-1]


def test_quantiles_of_many_values_are_near():
    values = np.random.default_rng(4).normal(size=20_000) ** 3
    found, order = sketched(values, 200, 3_000), np.sort(values)
    at = np.searchsorted(order, found["every"]) / len(order)
    assert found["others"] == 20_000 and np.abs(at - np.arange(1, 1024) / 1024).max() < 2 / 200
    assert (found["points"][0], found["points"][-1]) == (order[0], order[-1])


@pytest.mark.parametrize("blocks", [1, 3])
def test_forests_without_rows_predict_zero(rows, blocks):
    """Rows of no mark are not dealt out; forests that have none, alone or beside others, are roots."""
    some = F.col("id") % 4 == 1
    none, alone = (R.train(rows, marks, F.xxhash64("id"), 2, 3, 5, blocks=blocks) for marks in ([F.lit(False), some], [F.lit(False)]))
    for forest in (none[0], alone[0]):
        assert len(forest.trees) == 2 and [r["prediction"] for r in forest.transform(rows.limit(3)).collect()] == [0.0] * 3
    assert (none[1].trees[0].place >= 0).sum() == 7
    # rows of two forests that are all in one block
    marks = [F.col("id") < 3, F.col("id") < 3, F.col("id") > 2]
    lone = R.train(rows.where("id < 3 OR id % 2 = 0").repartition(6), marks, F.xxhash64("id"), 6, 3, 5, blocks=6)
    assert all(np.array_equal(x.place, y.place) for x, y in zip(lone[0].trees, lone[1].trees))

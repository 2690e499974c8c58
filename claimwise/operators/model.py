"""Regression baseline: encoding, split, random forest, scores, importances."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from claimwise.functions.text import quoted
from claimwise.operators import forest as forests
from claimwise.operators.cleaning import column_roles
from claimwise.session import stage


def category_levels(df: DataFrame, columns: list[str], most: int | None = None) -> dict[str, list[str]]:
    """Sorted distinct values per column, where they become names of columns; over ``most`` in one column are an error."""
    if not columns:
        return {}
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), quoted(c).cast("string").alias("level")) for c in columns])
    found = df.select(F.inline(cells)).where("level IS NOT NULL").distinct()
    if most is not None:
        # one row a column beyond the bound
        wide = [r["feature"] for r in found.groupBy("feature").count().where(F.col("count") > most).collect()]
        if wide:
            raise ValueError(f"{sorted(wide)} have over {most} levels: take encode(), or raise most_levels")
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for r in found.toLocalIterator():
        levels[r["feature"]].append(r["level"])
    return {c: sorted(v) for c, v in levels.items()}


def one_hot(df: DataFrame, columns: list[str], most_levels: int = 2000) -> DataFrame:
    """Replace text columns by 0/1 columns ``column_level``, without the first level.

    A missing value has zeros in all columns of its feature. Over ``most_levels`` levels of a column are an error, as no table is that wide:
    :func:`~claimwise.operators.encode.encode` has them as places of one vector.
    """
    levels = category_levels(df, columns, most_levels)
    rest = [quoted(c) for c in df.columns if c not in columns]
    flags = [F.coalesce((quoted(c).cast("string") == level).cast("int"), F.lit(0)).alias(f"{c}_{level}")
             for c in columns for level in levels[c][1:]]
    return df.select(*rest, *flags)


def feature_vectors(
    df: DataFrame, target: str, keep: list[str] = (),
) -> tuple[DataFrame, list[str]]:
    """(``keep``, ``features`` as sparse vector, ``label``) and the feature names.

    Numeric and boolean columns enter as they are, text columns drop-first
    one-hot. Rows with a missing numeric feature or target are an error of the
    model library; impute first.
    """
    numeric, categorical = column_roles(df, target)
    numeric = [c for c in numeric if c not in keep]
    categorical = [c for c in categorical if c not in keep]
    flags = [f.name for f in df.schema.fields
             if isinstance(f.dataType, T.BooleanType) and f.name not in keep and f.name != target]
    levels = category_levels(df, categorical)
    categorical = [c for c in categorical if len(levels[c]) > 1]
    plain = [*numeric, *flags]
    work = df.select(
        *[quoted(k) for k in keep],
        *[quoted(c).cast("double").alias(f"_n{i}") for i, c in enumerate(plain)],
        *[F.coalesce(quoted(c), F.lit(levels[c][0])).alias(f"_c{i}") for i, c in enumerate(categorical)],
        quoted(target).cast("double").alias("label"),
    )
    inputs = [f"_n{i}" for i in range(len(plain))]
    names = list(plain)
    if categorical:
        # Labels in descending order put the first level last, where the encoder drops it.
        for i, c in enumerate(categorical):
            indexer = StringIndexerModel.from_labels(levels[c][::-1], inputCol=f"_c{i}", outputCol=f"_i{i}")
            work = indexer.transform(work)
        encoder = OneHotEncoder(
            inputCols=[f"_i{i}" for i in range(len(categorical))],
            outputCols=[f"_o{i}" for i in range(len(categorical))], dropLast=True)
        work = encoder.fit(work).transform(work)
        inputs += [f"_o{i}" for i in range(len(categorical))]
        names += [f"{c}_{level}" for c in categorical for level in levels[c][:0:-1]]
    vectors = VectorAssembler(inputCols=inputs, outputCol="features").transform(work)
    # names are returned, so per-slot metadata need not travel with the rows
    plain_vector = F.col("features").alias("features", metadata={})
    return vectors.select(*[quoted(k) for k in keep], plain_vector, "label"), names


def forest(trees: int = 200, depth: int = 10, seed: int = 42, **params) -> RandomForestRegressor:
    """Random forest regressor considering every feature at each split.

    Tree nodes are grown in groups, one pass over the rows per group; a larger
    ``maxMemoryInMB`` means fewer passes. Numbers are split at ``maxBins`` - 1 places
    at most, 31 by default; pass more for finer splits.
    """
    params = {"maxMemoryInMB": 1024, **params}
    return RandomForestRegressor(
        featuresCol="features", labelCol="label", predictionCol="prediction",
        numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="all", **params)


def in_fixed_order(vectors: DataFrame, key: str, partitions: int) -> DataFrame:
    """Rows dealt by key into a fixed number of partitions, in key order.

    Bootstrap samples depend on the partition and place of a row, so this makes
    one seed give one forest on any cluster.
    """
    return vectors.repartition(partitions, quoted(key)).sortWithinPartitions(quoted(key))


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row ``n, r2, mae``; r2 is NULL for a constant label."""
    y, p = quoted(label).cast("double"), quoted(prediction).cast("double")
    sums = df.agg(
        F.count("*").alias("n"), F.sum((y - p) * (y - p)).alias("sse"),
        (F.var_pop(y) * F.count(y)).alias("sst"), F.avg(F.abs(y - p)).alias("mae"))
    return sums.select("n", (1 - F.try_divide(F.col("sse"), F.col("sst"))).alias("r2"), "mae")


def training_partitions(rows: int) -> int:
    """Partitions of the training rows, from their number alone, so that a seed gives one forest on any cluster.

    Each partition sends the statistics of every open node, so few are better: up to 8 of at least 4,000 rows, which
    would else leave cores idle, then one for every 25,000 rows, up to 512.
    """
    return max(1, min(8, rows // 4_000), min(512, rows // 25_000))


#: What :mod:`~claimwise.operators.forest` grows: bootstrap, all features at each node, down to single rows.
_GROWN = {"featureSubsetStrategy": "all", "subsamplingRate": 1.0, "minInstancesPerNode": 1, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0,
          "bootstrap": True}


def _fitted(vectors: DataFrame, estimator: RandomForestRegressor, train: dict[str, Column], key: str | None, partitions: int | None, at_once: int) -> dict:
    """The models of an estimator that looks at some features only, or is set otherwise: by MLlib, side by side."""
    spark = vectors.sparkSession
    learner = estimator.copy({estimator.maxMemoryInMB: max(64, estimator.getMaxMemoryInMB() // at_once)})
    partitions = partitions or training_partitions(vectors.count())

    def one(name: str) -> RandomForestRegressionModel:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"forest {name}")
        rest = vectors.where(train[name])
        return learner.fit(rest if key is None else in_fixed_order(rest, key, partitions))

    with ThreadPool(at_once) as pool:
        return dict(zip(train, pool.map(inheritable_thread_target(spark)(one), train, chunksize=1)))


def train_all(
    vectors: DataFrame, estimator: RandomForestRegressor, tests: dict[str, Column], key: str | None = None,
    partitions: int | None = None, at_once: int | None = None,
) -> dict[str, tuple[RandomForestRegressionModel | forests.Forest, Row]]:
    """Per name a model of the rows outside its test rows, and ``n, r2, mae`` on the test rows.

    Forests that look at every feature and split down to single rows are grown together by :mod:`~claimwise.operators.forest`, in ``partitions``
    blocks of rows, which change no forest. Other estimators are fitted by MLlib side by side, each in its own scheduler pool, and share the memory
    set for node statistics. ``at_once`` limits the models fitted or scored at a time. ``vectors`` should be staged by the caller.
    With a ``key`` a seed gives one forest on any cluster.
    """
    spark = vectors.sparkSession
    at_once = max(1, min(len(tests), at_once or len(tests)))
    names = list(tests)
    marked = stage(vectors.select(*[quoted(c) for c in vectors.columns], *[(~tests[n]).alias(f"_train{i}") for i, n in enumerate(names)]), "marked")
    train = {n: F.col(f"_train{i}") for i, n in enumerate(names)}
    if all(estimator.getOrDefault(p) == v for p, v in _GROWN.items()) and estimator.getMaxDepth() <= 12 and len(tests) <= 62:
        draw = F.xxhash64(quoted(key)) if key is not None else F.xxhash64(F.monotonically_increasing_id())
        models = dict(zip(names, forests.train(marked, list(train.values()), draw, estimator.getNumTrees(), estimator.getMaxDepth(),
                                               estimator.getSeed(), estimator.getMaxBins(), partitions)))
    else:
        models = _fitted(marked, estimator, train, key, partitions, at_once)

    def scores(name: str) -> Row:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"forest {name}")
        # one row of three numbers
        return regression_metrics(models[name].transform(marked.where(~train[name]).select("features", "label"))).first()

    with ThreadPool(at_once) as pool:
        return {n: (models[n], r) for n, r in zip(names, pool.map(inheritable_thread_target(spark)(scores), names, chunksize=1))}


def score_table(spark, found: dict[str, tuple[RandomForestRegressionModel, Row]]) -> DataFrame:
    """``part, n, r2, mae`` of :func:`train_all`; one row a model."""
    return spark.createDataFrame([(name, *scores) for name, (_, scores) in found.items()], "part string, n bigint, r2 double, mae double")


def cross_validate(
    vectors: DataFrame, estimator: RandomForestRegressor, fold_column: str = "fold", folds: int = 5,
    key: str | None = None, partitions: int | None = None, at_once: int | None = None,
) -> DataFrame:
    """``fold, n, r2, mae`` per fold: trained on the other folds, scored on this one; folds side by side."""
    found = train_all(vectors, estimator, {str(i): F.col(fold_column) == i for i in range(folds)}, key, partitions, at_once)
    return score_table(vectors.sparkSession, found).select(F.col("part").cast("int").alias("fold"), "n", "r2", "mae")


def cv_summary(scores: DataFrame) -> DataFrame:
    """One row: mean and population standard deviation of r2 over folds."""
    return scores.agg(F.avg("r2").alias("r2_mean"), F.stddev_pop("r2").alias("r2_std"))


def importances(model: RandomForestRegressionModel, slots: DataFrame) -> DataFrame:
    """``feature, importance`` for every place of the vectors, ``slots`` with ``slot, name``; those no tree uses have 0.

    The forest has no more used places than nodes, which is what the driver holds of them.
    """
    values = model.featureImportances
    used = slots.sparkSession.createDataFrame([(int(i), float(values[int(i)])) for i in values.indices] if hasattr(values, "indices")
                                              else list(enumerate(values.toArray().tolist())), "slot bigint, importance double")
    return slots.join(used, "slot", "left").select(F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance"))


def top_importances(table: DataFrame, n: int = 15) -> DataFrame:
    return table.orderBy(F.desc("importance"), "feature").limit(n)

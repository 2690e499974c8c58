"""Value-count cube: one scan counts every value of every column; profiles and statistics are read from the counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from claimwise.functions.numbers import as_double
from claimwise.functions.text import quoted
from claimwise.operators.ranking import BUCKET_ROWS, quantiles_of_counts, refined, refinements
from claimwise.operators.stats import anova_of_levels, histogram_of_counts
from claimwise.session import stage


def value_cube(df: DataFrame, target: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """``feature, number, level, n``, staged: the rows per value of each column, read once.

    Numbers and booleans stand in ``number``, all else as text in ``level``; the row with
    neither counts the gaps. With a ``target``, ``y_n, y_mean, y_var`` are its moments over the rows of the
    value. Equal values are combined before the shuffle; a value of a third of the rows is one row a task.
    """
    columns = columns if columns is not None else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}

    def cell(c: str):
        number = isinstance(types[c], (T.NumericType, T.BooleanType))
        return F.struct(F.lit(c).alias("feature"), (as_double(quoted(c), types[c]) if number else F.lit(None).cast("double")).alias("number"),
                        (F.lit(None).cast("string") if number else quoted(c).cast("string")).alias("level"))
    y = [] if target is None else [as_double(quoted(target), types[target]).alias("y")]
    moments = [] if target is None else [F.count("y").alias("y_n"), F.avg("y").alias("y_mean"), F.var_pop("y").alias("y_var")]
    cells = df.select(*y, F.inline(F.array(*[cell(c) for c in columns])))
    return stage(cells.groupBy("feature", "number", "level").agg(F.count("*").alias("n"), *moments), "cube")


def nulls(cube: DataFrame, columns: list[str]) -> DataFrame:
    """``column, nulls``, most nulls first; an empty table has none."""
    gaps = cube.where("number IS NULL AND level IS NULL").select(F.col("feature").alias("column"), F.col("n").alias("nulls"))
    none = cube.sparkSession.createDataFrame([(c, 0) for c in columns], "column string, nulls bigint")
    return gaps.unionByName(none).groupBy("column").agg(F.sum("nulls").alias("nulls")).orderBy(F.desc("nulls"), "column")


def profile(cube: DataFrame, df: DataFrame) -> DataFrame:
    """``column, dtype, non_null, rows`` for every column of ``df``, whose cube this is."""
    kinds = cube.sparkSession.createDataFrame(list(df.dtypes), "feature string, dtype string")
    there = F.col("number").isNotNull() | F.col("level").isNotNull()
    counts = cube.groupBy("feature").agg(F.sum(F.when(there, F.col("n")).otherwise(0)).alias("non_null"), F.sum("n").alias("rows"))
    zero = F.lit(0).cast("bigint")
    return kinds.join(counts, "feature", "left").select(
        F.col("feature").alias("column"), "dtype", F.coalesce("non_null", zero).alias("non_null"), F.coalesce("rows", zero).alias("rows"))


def quantiles(cube: DataFrame, columns: list[str], probs: list[float], most: int = BUCKET_ROWS) -> DataFrame:
    """``feature, prob, quantile``: exact, linearly interpolated. Buckets hold equal numbers of distinct values, up to ``most``."""
    values = cube.where(F.col("feature").isin(*columns) & F.col("number").isNotNull()).select(
        "feature", F.col("number").alias("value"), F.lit(0).cast("bigint").alias("bucket"), "n")
    names = ["feature"]
    return quantiles_of_counts(refined(values, names, refinements(values, names, most)), names, probs, few_groups=True)


def medians(cube: DataFrame, columns: list[str], most: int = BUCKET_ROWS) -> DataFrame:
    """``feature, median`` over the values that are there."""
    return quantiles(cube, columns, [0.5], most).select("feature", F.col("quantile").alias("median"))


def modes(cube: DataFrame, columns: list[str]) -> DataFrame:
    """``feature, mode``: the most frequent text, the smallest one on ties."""
    return (cube.where(F.col("feature").isin(*columns) & F.col("level").isNotNull())
            .groupBy("feature").agg(F.min_by("level", F.struct(-F.col("n"), F.col("level"))).alias("mode")))


def describe(cube: DataFrame, columns: list[str], most: int = BUCKET_ROWS) -> DataFrame:
    """``feature, count, mean, std, min, p25, p50, p75, max``; squares are taken around the mean."""
    names = cube.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    numbers = cube.where(F.col("feature").isin(*columns) & F.col("number").isNotNull()).select("feature", "number", "n")
    first = numbers.groupBy("feature").agg(
        F.sum("n").alias("count"), (F.sum(F.col("number") * F.col("n")) / F.sum("n")).alias("mean"), F.min("number").alias("min"), F.max("number").alias("max"))
    away = F.col("number") - F.col("mean")
    # one row a column
    squares = numbers.join(F.broadcast(first.select("feature", "mean")), "feature").groupBy("feature").agg(F.sum(F.col("n") * away * away).alias("m2"))
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("quantile")))
    quarters = quantiles(cube, columns, [0.25, 0.5, 0.75], most).groupBy("feature").agg(at(0.25).alias("p25"), at(0.5).alias("p50"), at(0.75).alias("p75"))
    std = F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1)))
    return (names.join(first, "feature", "left").join(squares, "feature", "left").join(quarters, "feature", "left")
            .select("feature", F.coalesce("count", F.lit(0)).alias("count"), "mean", std.alias("std"), "min", "p25", "p50", "p75", "max"))


def histogram(cube: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """``bin, low, high, count`` of one number column."""
    return histogram_of_counts(cube.where(F.col("feature") == column).select(F.col("number").alias("v"), "n"), bins)


def anova(cube: DataFrame, features: list[str], target: str) -> DataFrame:
    """``feature, k, n, f_stat, effect`` of the text columns, from the moments of the target per level."""
    numbers = cube.where((F.col("feature") == target) & F.col("number").isNotNull())
    overall = numbers.agg(F.try_divide(F.sum(F.col("number") * F.col("n")), F.sum("n"))).scalar()
    levels = cube.where(F.col("feature").isin(*features) & F.col("level").isNotNull() & (F.col("y_n") > 0)).select(
        "feature", "level", F.col("y_n").alias("n"), F.col("y_mean").alias("m"), F.col("y_var").alias("v"))
    return anova_of_levels(levels, overall)


def group_mean(cube: DataFrame, by: str) -> DataFrame:
    """``by, mean`` of the target, highest first; the levels of one text column."""
    return (cube.where((F.col("feature") == by) & F.col("level").isNotNull())
            .select(F.col("level").alias(by), F.col("y_mean").alias("mean")).orderBy(F.desc_nulls_last("mean"), quoted(by)))


def filled(df: DataFrame, cube: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Gaps of ``df`` filled from its cube: number columns by the median, as DOUBLE, text columns by the mode.

    A number column without a gap keeps its type, and one without values its gaps. One scan of ``df``.
    """
    # one row a column
    gaps = {r["feature"] for r in cube.where("number IS NULL AND level IS NULL").select("feature").collect()}
    numeric, categorical = [c for c in numeric if c in gaps], [c for c in categorical if c in gaps]
    types, out = {f.name: f.dataType for f in df.schema.fields}, df
    for columns, found, name in ((numeric, medians, "median"), (categorical, modes, "mode")):
        if columns:
            fill = F.map_from_entries(F.collect_list(F.struct("feature", name)))
            out = out.withColumn("_fill", found(cube, columns).agg(fill.alias("m")).scalar()).withColumns({
                c: F.coalesce(as_double(quoted(c), types[c]) if name == "median" else quoted(c), F.try_element_at("_fill", F.lit(c))) for c in columns
            }).drop("_fill")
    return out

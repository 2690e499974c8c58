"""Descriptive statistics, correlations and analysis of variance."""

from __future__ import annotations

from collections import Counter
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from claimwise.functions.numbers import as_double
from claimwise.functions.pvalues import correlation_p, f_survival
from claimwise.functions.text import quoted
from claimwise.operators import moments
from claimwise.operators.ranking import (
    BUCKET_ROWS, add_buckets, bounded, clean_splits, default_buckets, doubles, exact_quantiles, running_positions, within,
)


def _typed(df: DataFrame, column: str) -> Column:
    return as_double(quoted(column), df.schema[column].dataType)


def group_mean(df: DataFrame, by: str, target: str) -> DataFrame:
    """``by, mean``, highest mean first; null keys are left out."""
    return (
        df.where(quoted(by).isNotNull()).groupBy(quoted(by))
        .agg(F.avg(_typed(df, target)).alias("mean"))
        .orderBy(F.desc_nulls_last("mean"), quoted(by))
    )


def group_summary(df: DataFrame, by: str, target: str) -> DataFrame:
    """``by, mean, median, count`` of the target; null keys are left out.

    The median is exact and does not gather a group in one task.
    """
    named = df.where(quoted(by).isNotNull()).select(quoted(by).alias(by), _typed(df, target).alias("_y"))
    base = named.groupBy(quoted(by)).agg(F.avg("_y").alias("mean"), F.count("_y").alias("count"))
    middle = exact_quantiles(named, ["_y"], [0.5], by=[by]).select(quoted(by), F.col("quantile").alias("median"))
    return base.join(middle, by, "left").select(quoted(by), "mean", "median", "count")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """``feature, count, mean, std, min, p25, p50, p75, max`` with exact quantiles."""
    values = doubles(df, columns, [])
    row = values.agg(*[
        F.struct(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                 F.min(v).alias("min"), F.max(v).alias("max")).alias(v)
        for v in values.columns])
    base = row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.col(f"_v{i}.{part}").alias(part)
                                              for part in ("count", "mean", "std", "min", "max")])
        for i, c in enumerate(columns)])))
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("quantile")))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).groupBy("feature").agg(
        at(0.25).alias("p25"), at(0.5).alias("p50"), at(0.75).alias("p75"))
    return base.join(quartiles, "feature", "left").select(
        "feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """``bin, low, high, count`` for equal-width bins, the last one closed.

    Border values are settled by comparing with the border itself. A constant
    column gets bins from half below to half above the value.
    """
    return histogram_of_counts(df.select(_typed(df, column).alias("v"), F.lit(1).cast("bigint").alias("n")), bins)


def histogram_of_counts(values: DataFrame, bins: int = 30) -> DataFrame:
    """:func:`histogram` of values ``v`` that stand for ``n`` rows each."""
    value = values.where("v IS NOT NULL")
    ends = value.agg(F.min("v").alias("a"), F.max("v").alias("b")).select(
        F.when(F.col("a") == F.col("b"), F.col("a") - 0.5).otherwise(F.col("a")).alias("low"),
        F.when(F.col("a") == F.col("b"), F.col("b") + 0.5).otherwise(F.col("b")).alias("high"))
    span = ends.select(F.struct("low", "high").alias("s")).scalar()
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))

    def border(i: Column) -> Column:
        return F.when(i == bins, F.col("high")).otherwise(F.col("low") + i * width)

    placed = (
        value.select("v", "n", span.alias("s")).select("v", "n", "s.low", "s.high")
        .withColumn("i", F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("low")) / width).cast("int")))
        .withColumn("bin", F.when(F.col("v") < border(F.col("i")), F.col("i") - 1)
                    .when((F.col("v") >= border(F.col("i") + 1)) & (F.col("i") < bins - 1), F.col("i") + 1)
                    .otherwise(F.col("i")))
    )
    counts = placed.groupBy("bin").agg(F.sum("n").alias("count"))
    frame = ends.where("low IS NOT NULL").select("low", "high", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return frame.join(counts, "bin", "left").select(
        (F.col("bin") + 1).alias("bin"), border(F.col("bin")).alias("low"),
        border(F.col("bin") + 1).alias("high"), F.coalesce("count", F.lit(0).cast("bigint")).alias("count"))


def contingency(df: DataFrame, row: str, column: str) -> DataFrame:
    """``row, column, count`` of the occurring pairs; null keys are left out."""
    return (df.where(quoted(row).isNotNull() & quoted(column).isNotNull())
            .groupBy(quoted(row), quoted(column)).agg(F.count("*").alias("count")))


def crosstab(df: DataFrame, row: str, column: str, most_levels: int = 2000) -> DataFrame:
    """Contingency table in wide form, absent pairs as 0.

    One output column per level, so the levels are listed first; over ``most_levels`` of them
    are an error, as no table is that wide. :func:`contingency` has one row per pair instead.
    """
    cells = contingency(df, row, column)
    levels = sorted(r[0] for r in cells.select(quoted(column)).distinct().take(most_levels + 1))
    if len(levels) > most_levels:
        raise ValueError(f"{column} has over {most_levels} levels: take contingency(), or raise most_levels")
    wide = cells.groupBy(quoted(row)).pivot(column, levels).agg(F.sum("count"))
    return wide.na.fill(0, subset=[c for c in wide.columns if c != row])


def pearson_matrix(df: DataFrame, columns: list[str] | None = None, pairs_per_pass: int = 60) -> DataFrame:
    """``col_a, col_b, r`` over rows where both are present; NULL for a constant.

    One scan without a shuffle of rows: up to ``pairs_per_pass`` pairs are one
    aggregate, wider frames merge moment matrices (:mod:`moments`). Both orders of a
    pair are returned.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    values = doubles(df, columns, [])
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, r double")
    if len(pairs) > pairs_per_pass:
        return moments.correlations(values, columns)
    sums = values.agg(*[
        F.struct(
            F.regr_sxy(f"_v{a}", f"_v{b}").alias("xy"),
            F.regr_syy(f"_v{a}", f"_v{b}").alias("yy"),
            F.regr_sxx(f"_v{a}", f"_v{b}").alias("xx"),
        ).alias(f"_p{a}_{b}") for a, b in pairs])
    cells = [F.struct(F.lit(columns[x]).alias("col_a"), F.lit(columns[y]).alias("col_b"),
                      F.col(f"_p{a}_{b}").alias("s"))
             for a, b in pairs for x, y in ({(a, b), (b, a)})]
    part = sums.select(F.inline(F.array(*cells))).select(
        "col_a", "col_b",
        F.try_divide(F.col("s.xy"), F.sqrt("s.xx") * F.sqrt("s.yy")).alias("r"))
    # rounding may leave the range by one unit in the last place
    return part.withColumn("r", F.when(F.abs("r") > 1, F.signum("r")).when(~F.isnan("r"), F.col("r")))


def spearman(
    df: DataFrame, features: list[str], target: str, buckets: int | None = None, salts: int = 64, most: int = BUCKET_ROWS,
) -> DataFrame:
    """``feature, n, effect``: rank correlation of each numeric feature with the target.

    Pairs with a missing side are dropped per feature; features with fewer than
    two distinct values are skipped; the effect is NULL for a constant target.

    Ranks of the target are joined to the rows once for all complete features
    together (a feature with gaps has its own ranks, over its own rows). Then
    rows collapse to one per feature value, where feature ranks meet them key
    to key. The only join of rows is thus the one on the target value. A value
    that holds over two in 1,000 rows shows up as a repeated quantile (at most
    500 such values); its rows are spread over ``salts`` copies of its rank.
    """
    columns = [*features, target]
    y = len(features)
    values = doubles(df, columns, []).where(f"_v{y} IS NOT NULL")
    buckets = buckets or default_buckets(df.sparkSession)
    shares = [i / buckets for i in range(1, buckets)]
    info = values.agg(
        F.count("*").alias("n"),
        *[F.count(f"_v{i}").alias(f"_n{i}") for i in range(y)],
        *[F.percentile_approx(f"_v{i}", shares, max(10000, 10 * buckets)).alias(f"_s{i}") for i in range(y + 1)],
        F.percentile_approx(f"_v{y}", [i / 1000 for i in range(1, 1000)], 10000).alias("_hot"),
    ).first()
    repeats = Counter(info["_hot"] or [])
    frequent = [float(v) for v, times in repeats.items() if times > 1]
    total = info["n"]
    fine = bounded(total, buckets, most)
    complete = [i for i in range(y) if info[f"_n{i}"] == total]
    partial = [i for i in range(y) if 0 < info[f"_n{i}"] < total]
    binned = add_buckets(values, [clean_splits(info[f"_s{i}"] or []) for i in range(y + 1)])

    def cell(i: int) -> Column:
        return F.struct(F.lit(i).alias("f"), F.col(f"_v{i}").alias("value"),
                        F.col(f"_b{i}").alias("bucket"))

    # scope -1: all rows, for the complete features; scope i: rows where feature i is present
    scopes = [F.struct(F.lit(i).alias("scope"), F.array(cell(i)).alias("cells")) for i in partial]
    if complete:
        scopes.append(F.struct(F.lit(-1).alias("scope"), F.array(*[cell(i) for i in complete]).alias("cells")))
    if not scopes:
        return df.sparkSession.createDataFrame([], "feature string, n bigint, effect double")
    rows = (
        binned.select(F.coalesce(f"_v{y}", F.lit(0.0)).alias("y"), F.col(f"_b{y}").alias("by"), F.inline(F.array(*scopes)))
        .where("scope = -1 OR cells[0].value IS NOT NULL")
    )
    middle = F.element_at(F.create_map(*[
        F.lit(v) for i in range(-1, y) if i == -1 or i in partial
        for v in (i, (float(total if i == -1 else info[f"_n{i}"]) + 1) / 2)]), F.col("scope"))

    target_counts = rows.groupBy("scope", F.col("y").alias("value"), F.col("by").alias("bucket")).agg(F.count("*").alias("n"))
    target_ranks = running_positions(within(target_counts, ["scope"], fine, most), ["scope"], few_groups=fine).select(
        "scope", F.col("value").alias("y"),
        (F.col("before") + (F.col("n") + 1) / F.lit(2.0) - middle).alias("ry"))
    if frequent:
        often = F.col("y").isin(*frequent)
        copies = F.when(often, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        target_ranks = target_ranks.withColumn("salt", F.explode(copies))
        rows = rows.withColumn("salt", F.when(often, F.pmod(F.xxhash64("cells", F.spark_partition_id()), F.lit(salts)).cast("int")).otherwise(0))
        ranked = rows.join(target_ranks, ["scope", "y", "salt"])
    else:
        ranked = rows.join(target_ranks, ["scope", "y"])
    ranked = ranked.select("ry", F.inline("cells"))
    by_value = ranked.groupBy("f", "value", "bucket").agg(
        F.count("*").alias("n"), F.sum("ry").alias("sy"), F.sum(F.col("ry") * F.col("ry")).alias("syy"))
    # bucket sizes need no ranks: counted from the rows, a few numbers per task
    sizes = rows.select(F.inline("cells")).groupBy("f", "bucket").agg(F.count("*").alias("n")) if fine else None
    placed = running_positions(within(by_value, ["f"], fine, most), ["f"], few_groups=fine, sizes=sizes)
    centre = F.element_at(F.create_map(*[F.lit(v) for i in range(y) for v in (i, (float(info[f"_n{i}"]) + 1) / 2)]), F.col("f"))
    placed = placed.withColumn("rx", F.col("before") + (F.col("n") + 1) / F.lit(2.0) - centre)
    names = F.element_at(F.array(*[F.lit(c) for c in features]), F.col("f") + 1)
    return (
        placed.groupBy("f").agg(
            F.sum("n").alias("n"), F.count("*").alias("levels"),
            F.sum(F.col("rx") * F.col("sy")).alias("xy"),
            F.sum(F.col("n") * F.col("rx") * F.col("rx")).alias("xx"), F.sum("syy").alias("yy"))
        .where("levels > 1")
        .select(names.alias("feature"), "n",
                F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy"))).alias("effect"))
    )


def anova(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """``feature, k, n, f_stat, effect``: one-way ANOVA and eta squared per feature.

    One scan: rows collapse map-side to (feature, level) moments, and those to
    features. Squares between levels are taken around the overall mean, so
    nothing cancels. Features with fewer than two levels are skipped.
    """
    y = _typed(df, target)
    kept = df.select(y.alias("y"), *[quoted(c).cast("string").alias(f"_c{i}") for i, c in enumerate(features)]).where("y IS NOT NULL")
    overall = kept.agg(F.avg("y")).scalar()
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_c{i}").alias("level")) for i, c in enumerate(features)])
    levels = (
        kept.select("y", F.inline(cells)).where("level IS NOT NULL")
        .groupBy("feature", "level").agg(F.count("*").alias("n"), F.avg("y").alias("m"), F.var_pop("y").alias("v"))
    )
    return anova_of_levels(levels, overall)


def anova_of_levels(levels: DataFrame, overall: Column) -> DataFrame:
    """:func:`anova` from ``feature, level, n, m, v``: rows, mean and variance of the target per level, and its mean over all rows."""
    shift = F.col("m") - overall
    sums = levels.groupBy("feature").agg(
        F.count("*").alias("k"), F.sum("n").alias("n"),
        F.sum(F.col("n") * shift).alias("s1"), F.sum(F.col("n") * shift * shift).alias("s2"),
        F.sum(F.col("n") * F.col("v")).alias("within"))
    between = F.col("s2") - F.col("s1") * F.col("s1") / F.col("n")
    sums = sums.where("k > 1").withColumn("between", F.greatest(F.lit(0.0), between))
    f_stat = F.when((F.col("within") == 0) & (F.col("between") > 0) & (F.col("n") > F.col("k")), F.lit(float("inf"))).otherwise(
        F.try_divide(F.col("between") / (F.col("k") - 1), F.try_divide(F.col("within"), F.col("n") - F.col("k"))))
    return sums.select(
        "feature", "k", "n", f_stat.alias("f_stat"),
        F.try_divide(F.col("between"), F.col("between") + F.col("within")).alias("effect"))


def spearman_table(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """``feature, test, effect, p_value`` by rank correlation."""
    found = spearman(df, features, target)
    return found.select("feature", F.lit("spearman").alias("test"), "effect",
                        correlation_p(F.col("effect"), F.col("n")).alias("p_value"))


def anova_table(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """``feature, test, effect, p_value`` by analysis of variance."""
    return anova_p(anova(df, features, target))


def anova_p(found: DataFrame) -> DataFrame:
    """The result of :func:`anova` as ``feature, test, effect, p_value``."""
    return found.select("feature", F.lit("anova").alias("test"), "effect",
                        f_survival(F.col("f_stat"), F.col("k") - 1, F.col("n") - F.col("k")).alias("p_value"))


def effect_ranking(df: DataFrame, numeric: list[str], categorical: list[str], target: str) -> DataFrame:
    """Both tables stacked, largest signed effect first, missing effects last."""
    parts = []
    if numeric:
        parts.append(spearman_table(df, numeric, target))
    if categorical:
        parts.append(anova_table(df, categorical, target))
    return stacked_effects(df.sparkSession, parts)


def stacked_effects(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    """Tables of effects, largest signed effect first, missing ones last."""
    if not parts:
        return spark.createDataFrame([], "feature string, test string, effect double, p_value double")
    return reduce(DataFrame.unionByName, parts).orderBy(F.desc_nulls_last("effect"), "feature")


def significant(table: DataFrame, level: float = 0.05) -> DataFrame:
    return table.where(F.col("p_value") < level)

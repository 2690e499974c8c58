"""Analysis job: profile, impute, describe, test and model one claims frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwise.operators import cleaning, cube, encode, model, stats
from claimwise.operators.prepare import typed_claims
from claimwise.operators.ranking import fold_index, holdout_split
from claimwise.session import stage
from claimwise.sources.readers import read_claims_strict


def impute_and_deduplicate(df: DataFrame) -> DataFrame:
    """Sentinel to NULL, median and mode imputation, copies dropped."""
    df = cleaning.nan_to_null_columns(cleaning.nullify_tokens(df))
    return cleaning.drop_duplicate_rows(cleaning.impute_mode(cleaning.impute_median(df)))


def run_analysis(spark: SparkSession, source: str, target: str = "vehicle_claim", level: float = 0.05) -> dict[str, DataFrame]:
    """From the claims CSV to the named frames of the exploratory part.

    Typed (flags as text, like every category) and written once, sentinel to NULL. That table is read twice: for
    the counts of its values, which give medians and modes, and to fill its gaps and drop copies. Then
    :func:`explore` and the effects significant at ``level``.
    """
    typed = cleaning.nan_to_null_columns(cleaning.nullify_tokens(typed_claims(read_claims_strict(spark, source), flags=False)))
    typed = stage(typed, "typed")
    counts = cube.value_cube(typed)
    filled = cube.filled(typed, counts, *cleaning.column_roles(typed))
    clean = stage(cleaning.drop_duplicate_rows(filled), "clean")
    result = {"clean": clean, "raw nulls": cube.nulls(counts, typed.columns), **explore(clean, target)}
    result["significant"] = stats.significant(result["effects"], level)
    return result


def explore(df: DataFrame, target: str = "vehicle_claim",
            groups: tuple[str, ...] = ("incident_type", "incident_severity"),
            cross: tuple[str, str] = ("incident_type", "collision_type")) -> dict[str, DataFrame]:
    """Named result frames of the exploratory part, over a cleaned (staged) frame.

    Profile, gaps, describe, histogram, group means and the analysis of variance come from one
    value-count cube; only ranks, correlations, group medians and the cross table read rows again.
    """
    numeric, categorical = cleaning.column_roles(df, target)
    counts = cube.value_cube(df, target)
    effects = [stats.spearman_table(df, numeric, target)] if numeric else []
    effects += [stats.anova_p(cube.anova(counts, categorical, target))] if categorical else []
    result = {
        "profile": cube.profile(counts, df),
        "nulls": cube.nulls(counts, df.columns),
        "describe": cube.describe(counts, [target]),
        "histogram": cube.histogram(counts, target),
        "correlations": stats.pearson_matrix(df),
        "effects": stats.stacked_effects(df.sparkSession, effects),
    }
    for by in groups:
        if by in df.columns:
            result[f"mean by {by}"] = cube.group_mean(counts, by) if by in categorical else stats.group_mean(df, by, target)
            result[f"summary by {by}"] = stats.group_summary(df, by, target)
    if all(c in df.columns for c in cross):
        result["crosstab"] = stats.crosstab(df, *cross)
    return result


def baseline(df: DataFrame, key: str, target: str = "vehicle_claim", test_share: float = 0.2, folds: int = 5,
             seed: int = 42, trees: int = 200, depth: int = 10, partitions: int | None = None,
             cross_validation: bool = True, holdout: bool = True) -> dict[str, DataFrame]:
    """Holdout scores, fold scores and importances of the random-forest baseline.

    ``key`` identifies a row and is not a feature. ``df`` is read several
    times, so pass a staged frame. Levels of text columns stay in a table (:mod:`~claimwise.operators.encode`). Encoded rows are staged once; the marks for
    holdout and folds are expressions over them, and all their forests are trained side by side. The folds cover all rows,
    those of the holdout included. Training rows lie in ``partitions`` partitions (by default as many as their
    number asks for) in key order, so a seed gives the same forest whatever the cluster or the files.
    """
    spark = df.sparkSession
    clean = cleaning.drop_leakage(df, target)
    encoded = encode.encode(clean, target, keep=[key])
    rows, tests = stage(encoded.vectors, "vectors"), {}
    if holdout:
        rows = holdout_split(rows, key, test_share, seed)
        tests["holdout"] = F.col("is_test")
    if cross_validation:
        rows = fold_index(rows, key, folds, seed)
        tests |= {f"fold {i}": F.col("fold") == i for i in range(folds)}
    found = model.train_all(rows, model.forest(trees, depth, seed), tests, key, partitions)
    scores = model.score_table(spark, found)
    result = {}
    if holdout:
        result["holdout"] = scores.where("part = 'holdout'").drop("part")
        result["importances"] = model.importances(found["holdout"][0], encoded.slots)
        result["top importances"] = model.top_importances(result["importances"])
    if cross_validation:
        result["folds"] = scores.where("part <> 'holdout'").select(F.substring("part", 6, 9).cast("int").alias("fold"), "n", "r2", "mae")
        result["cross validation"] = model.cv_summary(result["folds"])
    return result

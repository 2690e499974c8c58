"""Row positions, ranks, exact quantiles and seeded splits without a global sort.

Every operator here follows one scheme. A monotone *bucket* of the value is
computed from split points (at most ``buckets`` numbers per column, held as
literals), rows are counted per bucket, the running total over the few buckets
gives each bucket its offset, and only inside a bucket are values ordered. No
window is ever unpartitioned over data rows. Split points steer balance only;
any split points give the same result. Equal values are collapsed to a count
before the shuffle, so a value that fills a third of the table is one row.

No window orders more than ``BUCKET_ROWS`` rows. Quantile borders prove that for
tables of up to about that many rows a bucket. For larger ones, and for borders given
by the caller, buckets are counted, and those with more distinct values are split
again by their own quantiles, round by round (:func:`refinements`).
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from claimwise.functions.hashing import order_key as seeded_order, slot
from claimwise.functions.numbers import as_double
from claimwise.functions.text import quoted
from claimwise.session import stage

#: Most rows that one window orders.
BUCKET_ROWS = 1_000_000
#: Parts into which one round splits a bucket, and the relative error of the borders: a part has at most
#: 1 / FAN + 2 / CUT_ACCURACY of the rows.
FAN = 64
CUT_ACCURACY = 2000
#: Rows of a round's borders that are broadcast, each at most FAN numbers.
_FEW = 20_000


def default_buckets(spark: SparkSession) -> int:
    """As many buckets as the session has shuffle partitions."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def doubles(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """Project to ``keep`` plus DOUBLE columns ``_v0 _v1 ...``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    values = [as_double(quoted(c), types[c]).alias(f"_v{i}") for i, c in enumerate(columns)]
    return df.select(*[quoted(k) for k in keep], *values)


def clean_splits(points: list[float | None]) -> list[float]:
    inner = sorted({float(p) for p in points if p is not None and math.isfinite(p)})
    return [-math.inf, *inner, math.inf]


def _measured_splits(df: DataFrame, columns: list[str], buckets: int, sample_fraction: float = 1.0) -> tuple[dict[str, list[float]], int]:
    """Borders per column, and the most values that a column has."""
    values = doubles(df, columns, [])
    if sample_fraction < 1.0:
        values = values.sample(sample_fraction, seed=11)
    shares = [i / buckets for i in range(1, buckets)]
    row = values.agg(
        *[F.percentile_approx(f"_v{i}", shares, max(10000, 10 * buckets)).alias(f"_s{i}") for i in range(len(columns))],
        *[F.count(f"_v{i}").alias(f"_n{i}") for i in range(len(columns))]).first()
    return ({c: clean_splits(row[f"_s{i}"] or []) for i, c in enumerate(columns)},
            max((row[f"_n{i}"] for i in range(len(columns))), default=0))


def split_points(
    df: DataFrame, columns: list[str], buckets: int | None = None, sample_fraction: float = 1.0,
) -> dict[str, list[float]]:
    """Approximate quantiles of each column, as bucket borders.

    One mergeable-sketch aggregate over all columns; at most ``buckets``
    numbers per column reach the driver. On very large inputs a
    ``sample_fraction`` makes this pass cheaper and only affects balance.
    """
    return _measured_splits(df, columns, buckets or default_buckets(df.sparkSession), sample_fraction)[0]


def bounded(rows: int, buckets: int, most: int) -> bool:
    """Whether quantile borders alone keep every bucket of ``rows`` values within ``most`` distinct ones.

    A border is off by at most a tenth of a bucket, and a bucket has two.
    """
    return rows * 1.2 / buckets + 1 <= most


def _borders(df: DataFrame, columns: list[str], buckets: int | None, splits: dict | None, most: int) -> tuple[dict, bool]:
    """Borders per column, and whether they are known to be fine enough. Borders of the caller are not."""
    if splits:
        return splits, False
    buckets = buckets or default_buckets(df.sparkSession)
    found, rows = _measured_splits(df, columns, buckets)
    return found, bounded(rows, buckets, most)


def refinements(values: DataFrame, by: list[str], most: int = BUCKET_ROWS, value: str = "value", bucket: str = "bucket") -> list[DataFrame]:
    """Rounds of borders that split every bucket of over ``most`` rows of ``values``, a staged frame with ``by, value, bucket``.

    A round sketches every bucket where the rows lie and merges the sketches, so that a crowded
    bucket is no single task. The borders are written, as all later steps must see the same
    ones. Equal values stay together; callers collapse them first.
    """
    rounds: list[DataFrame] = []
    keys = [*[quoted(b) for b in by], quoted(bucket)]
    while True:
        now = refined(values, by, rounds, value, bucket)
        shares = [i / FAN for i in range(1, FAN)]
        sketched = now.groupBy(*keys).agg(
            F.count("*").alias("_rows"), (F.min(value) < F.max(value)).alias("_wide"),
            F.percentile_approx(value, shares, CUT_ACCURACY).alias("_cuts"))
        cuts = stage(sketched.where((F.col("_rows") > most) & F.col("_wide")).select(*keys, F.array_distinct("_cuts").alias("_cuts")), "cuts")
        if cuts.isEmpty():
            return rounds
        rounds.append(cuts)


def refined(frame: DataFrame, by: list[str], rounds: list[DataFrame], value: str = "value", bucket: str = "bucket") -> DataFrame:
    """``frame`` with its buckets split by the borders of :func:`refinements`; the order of buckets stays that of the values."""
    if not rounds:
        return frame
    frame = frame.withColumn(bucket, quoted(bucket).cast("bigint"))
    for cuts in rounds:
        cuts = cuts.withColumn(bucket, quoted(bucket).cast("bigint"))
        few = cuts.count() <= _FEW
        below = F.size(F.filter("_cuts", lambda c: c < quoted(value)))
        frame = (frame.join(F.broadcast(cuts) if few else cuts, [*by, bucket], "left")
                 .withColumn(bucket, quoted(bucket) * FAN + F.coalesce(F.when(F.col("_cuts").isNotNull(), below), F.lit(0))).drop("_cuts"))
    return frame


def within(counts: DataFrame, by: list[str], fine: bool, most: int) -> DataFrame:
    """``counts`` as they are where the borders are ``fine``, else staged and refined."""
    if fine:
        return counts
    counts = stage(counts, "value-counts")
    return refined(counts, by, refinements(counts, by, most))


def add_buckets(wide: DataFrame, splits: list[list[float]]) -> DataFrame:
    """Add ``_b{i}``, the bucket of ``_v{i}``, for each list of borders.

    A missing value gets -1, so the column is never NULL and the branches that
    read it keep one common plan, which Spark then runs once.
    """
    binned = [i for i, borders in enumerate(splits) if len(borders) > 2]
    if binned:
        wide = Bucketizer(
            inputCols=[f"_v{i}" for i in binned], outputCols=[f"_b{i}" for i in binned],
            splitsArray=[splits[i] for i in binned], handleInvalid="keep",
        ).transform(wide)
    return wide.withColumns({
        f"_b{i}": F.coalesce(F.col(f"_b{i}").cast("int"), F.lit(-1)) if i in binned else F.lit(0)
        for i in range(len(splits))
    })


def long_values(
    df: DataFrame, columns: list[str], keep: list[str] = (), splits: dict | None = None,
) -> DataFrame:
    """``keep``, ``feature``, ``value``, ``bucket``: one row per non-null cell."""
    splits = splits or split_points(df, columns)
    wide = add_buckets(doubles(df, columns, list(keep)), [splits[c] for c in columns])
    cells = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"_v{i}").alias("value"),
                 F.col(f"_b{i}").alias("bucket"))
        for i, c in enumerate(columns)
    ])
    return (wide.select(*[quoted(k) for k in keep], F.inline(cells)).where("value IS NOT NULL")
            .withColumn("value", F.coalesce("value", F.lit(0.0))))


def value_counts(long: DataFrame, by: list[str]) -> DataFrame:
    """Rows per group and distinct value; equal values collapse map-side."""
    return long.groupBy(*[quoted(b) for b in by], "value", "bucket").agg(F.count("*").alias("n"))


def bucket_offsets(counts: DataFrame, by: list[str]) -> DataFrame:
    """Per group and bucket: its rows ``size``, rows before it ``offset``, group ``total``."""
    group = Window.partitionBy(*by)
    earlier = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.groupBy(*by, "bucket").agg(F.sum("n").alias("size"))
        .withColumn("offset", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        .withColumn("total", F.sum("size").over(group))
    )


def running_positions(
    counts: DataFrame, by: list[str], few_groups: bool, sizes: DataFrame | None = None,
) -> DataFrame:
    """Add ``before``: rows of the group with a smaller value.

    ``few_groups`` states that ``by`` is bounded by the schema (feature names) and no bucket was
    split, so the offset table has at most features x buckets rows and is broadcast;
    otherwise Spark chooses the join from the measured sizes. ``sizes`` may give
    counts per group and bucket from a cheaper source than ``counts``.
    """
    offsets = bucket_offsets(counts if sizes is None else sizes, by).select(*by, "bucket", "offset")
    joined = counts.join(F.broadcast(offsets) if few_groups else offsets, [*by, "bucket"])
    earlier = (Window.partitionBy(*by, "bucket").orderBy("value")
               .rowsBetween(Window.unboundedPreceding, -1))
    return joined.withColumn(
        "before", F.col("offset") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def average_rank(
    df: DataFrame, columns: list[str], buckets: int | None = None,
    splits: dict | None = None, most: int = BUCKET_ROWS,
) -> DataFrame:
    """``feature, value, n, avg_rank`` for each distinct value of each column.

    Ties share the mean of the positions they occupy (1-based).
    """
    splits, fine = _borders(df, columns, buckets, splits, most)
    counts = within(value_counts(long_values(df, columns, splits=splits), ["feature"]), ["feature"], fine, most)
    placed = running_positions(counts, ["feature"], few_groups=fine)
    return placed.select(
        "feature", "value", "n",
        (F.col("before") + (F.col("n") + 1) / F.lit(2.0)).alias("avg_rank"))


def exact_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], by: list[str] = (),
    buckets: int | None = None, splits: dict | None = None, most: int = BUCKET_ROWS,
) -> DataFrame:
    """Exact, linearly interpolated quantiles: ``by..., feature, prob, quantile``.

    Only the buckets that hold a wanted position are ordered, so per group and
    probability about one bucket of distinct values passes through a window.
    Rows with a null group key or null value do not count.
    """
    by = list(by)
    splits, fine = _borders(df, columns, buckets, splits, most)
    for key in by:
        df = df.where(quoted(key).isNotNull())
    group = [*by, "feature"]
    renamed = {b: f"_g{i}" for i, b in enumerate(by)}
    names = [*renamed.values(), "feature"]
    long = long_values(df, columns, by, splits)
    long = long.select(*[quoted(b).alias(a) for b, a in renamed.items()], "feature", "value", "bucket")
    found = quantiles_of_counts(within(value_counts(long, names), names, fine, most), names, probs, few_groups=not by)
    return (found.select(*[F.col(a).alias(b) for b, a in renamed.items()], "feature", "prob", "quantile")
            .select(*[quoted(g) for g in group], "prob", "quantile"))


def quantiles_of_counts(counts: DataFrame, names: list[str], probs: list[float], few_groups: bool) -> DataFrame:
    """``names..., prob, quantile`` from ``names..., value, bucket, n``; buckets in the order of the values.

    ``few_groups`` as in :func:`running_positions`: then what is wanted is at most two buckets a group and probability.
    """
    # positions wanted in every group, with their interpolation weights
    place = F.col("prob") * (F.col("total") - 1)
    low, share = F.floor(place), place - F.floor(place)
    wanted = (
        bucket_offsets(counts, names)
        .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .select("*", F.inline(F.array(
            F.struct(low.alias("position"), (1 - share).alias("weight")),
            F.struct((low + 1).alias("position"), share.alias("weight")))))
        .where("weight > 0 AND position >= offset AND position < offset + size")
        .groupBy(*names, "bucket")
        .agg(F.first("offset").alias("offset"),
             F.collect_list(F.struct("prob", "position", "weight")).alias("targets"))
    )
    earlier = (Window.partitionBy(*names, "bucket").orderBy("value")
               .rowsBetween(Window.unboundedPreceding, -1))
    found = (
        counts.join(F.broadcast(wanted) if few_groups else wanted, [*names, "bucket"])
        .withColumn("before", F.col("offset") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .select("*", F.inline("targets"))
        .where("position >= before AND position < before + n")
    )
    return found.groupBy(*names, "prob").agg(F.sum(F.col("weight") * F.col("value")).alias("quantile"))


def medians(df: DataFrame, columns: list[str], **options) -> DataFrame:
    """``feature, median`` over non-null values."""
    return exact_quantiles(df, columns, [0.5], **options).select(
        "feature", F.col("quantile").alias("median"))


def row_index(
    df: DataFrame, order_by: str, name: str = "row_index", start: int = 1,
    buckets: int | None = None, most: int = BUCKET_ROWS,
) -> DataFrame:
    """Contiguous number in the order of a unique numeric or time column.

    Missing keys come first, as in any ascending order; they share one bucket.
    """
    kind = dict(df.dtypes)[order_by]
    key = quoted(order_by)
    if kind == "date":
        key = F.unix_date(key)
    elif kind in ("timestamp", "timestamp_ntz"):
        key = F.unix_micros(key.cast("timestamp"))
    keyed = df.withColumn("_v0", key.cast("double"))
    splits, fine = _borders(keyed, ["_v0"], buckets, None, most)

    def placed(frame: DataFrame) -> DataFrame:
        return add_buckets(frame, [splits["_v0"]]).withColumnRenamed("_b0", "_bucket")

    rounds = [] if fine else refinements(stage(placed(keyed.select("_v0")), "keys"), [], most, "_v0", "_bucket")

    def bucketed(frame: DataFrame) -> DataFrame:
        return refined(placed(frame), [], rounds, "_v0", "_bucket")

    sizes = bucketed(keyed.select("_v0")).groupBy("_bucket").agg(F.count("*").alias("_n"))
    # one row per bucket: a millionth of the rows beyond the first buckets
    earlier = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_bucket").orderBy(quoted(order_by))
    return (
        bucketed(keyed).join(F.broadcast(offsets) if fine else offsets, "_bucket")
        .withColumn(name, (F.col("_offset") + F.row_number().over(inside) + (start - 1)).cast("bigint"))
        .drop("_bucket", "_offset", "_v0")
    )


def file_row_index(df: DataFrame, name: str = "row_index", start: int = 1) -> DataFrame:
    """Contiguous number in file order for a frame read with its positions.

    Needs the columns ``_file, _block, _seq`` of ``read_csv_text(positions=True)``.
    A file block is read by one task, so a row's number inside it is its ``_seq`` minus the
    block's smallest; rows are not moved to be numbered. The offsets table has
    one row per file block.
    """
    blocks = df.groupBy("_file", "_block").agg(F.count("*").alias("_n"), F.min("_seq").alias("_low"))
    in_file = Window.partitionBy("_file")
    before = in_file.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    files = (Window.partitionBy(F.lit(0)).orderBy("_file")
             .rowsBetween(Window.unboundedPreceding, -1))
    per_file = (blocks.groupBy("_file").agg(F.sum("_n").alias("_rows"))
                .select("_file", F.coalesce(F.sum("_rows").over(files), F.lit(0)).alias("_file_start")))
    offsets = (
        blocks.withColumn("_in_file", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .join(per_file, "_file")
        .select("_file", "_block", (F.col("_file_start") + F.col("_in_file") - F.col("_low")).alias("_offset"))
    )
    return (
        df.join(offsets, ["_file", "_block"])
        .withColumn(name, (F.col("_offset") + F.col("_seq") + start).cast("bigint"))
        .drop("_file", "_block", "_seq", "_offset")
    )


def seeded_cuts(
    df: DataFrame, key: str, seed: int, sizes: list[int], buckets: int | None = None,
    total: int | None = None, most: int = BUCKET_ROWS,
) -> list[str]:
    """Upper borders that cut the seeded order of ``key`` into parts of exact sizes.

    The order key starts with a uniform hash, so its leading digits are the
    bucket and no split points are needed; there are as many buckets as keep each at half of
    ``most`` rows. Only the buckets holding a border are ordered; the driver
    receives one bucket and one text per border. ``key`` must be unique.
    """
    total = df.count() if total is None else total
    buckets = max(buckets or default_buckets(df.sparkSession), -(-2 * total // most))
    text = seeded_order(quoted(key), seed)
    keyed = df.select(text.alias("_order")).withColumn(
        "_bucket", F.floor(slot(F.col("_order"), 0) * buckets / F.lit(2.0 ** 32)).cast("bigint"))
    ends = [sum(sizes[:i + 1]) for i in range(len(sizes))]
    inner = sorted({e for e in ends if 0 < e <= total})
    if not inner:
        return ["" for _ in ends]
    # one row per bucket passes this window
    reached = F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_bucket"))
    hits = (keyed.groupBy("_bucket").agg(F.count("*").alias("_n")).withColumn("_last", reached)
            .withColumn("_end", F.explode(F.array(*[F.lit(e).cast("bigint") for e in inner])))
            .where("_end <= _last and _end > _last - _n").select("_bucket", "_end", (F.col("_end") - F.col("_last") + F.col("_n")).alias("_place")).collect())
    inside = Window.partitionBy("_bucket").orderBy("_order")
    hit = F.lit(False)
    for h in hits:
        hit = hit | ((F.col("_bucket") == h["_bucket"]) & (F.col("_at") == h["_place"]))
    rows = (
        keyed.where(F.col("_bucket").isin(*{h["_bucket"] for h in hits}))
        .withColumn("_at", F.row_number().over(inside)).where(hit).collect()
    )
    text_at = {(r["_bucket"], r["_at"]): r["_order"] for r in rows}
    border = {h["_end"]: text_at[h["_bucket"], h["_place"]] for h in hits}
    return [border.get(e, "") for e in ends]


def holdout_split(
    df: DataFrame, key: str, fraction: float = 0.2, seed: int = 42, name: str = "is_test",
    buckets: int | None = None,
) -> DataFrame:
    """Mark exactly ceil(fraction x rows) rows as test rows, by a seeded hash of the key.

    The flag is a comparison with one literal: no shuffle of the data.
    """
    total = df.count()
    border, = seeded_cuts(df, key, seed, [math.ceil(fraction * total)], buckets, total)
    return df.withColumn(name, seeded_order(quoted(key), seed) <= F.lit(border))


def fold_index(
    df: DataFrame, key: str, folds: int = 5, seed: int = 42, name: str = "fold",
    buckets: int | None = None,
) -> DataFrame:
    """Shuffled folds 0..folds-1; the first (rows mod folds) folds hold one row more."""
    total = df.count()
    sizes = [total // folds + (1 if i < total % folds else 0) for i in range(folds)]
    borders = seeded_cuts(df, key, seed, sizes[:-1], buckets, total)
    order: Column = seeded_order(quoted(key), seed)
    fold = F.lit(0)
    for border in borders:
        fold = fold + (order > F.lit(border)).cast("int")
    return df.withColumn(name, fold)

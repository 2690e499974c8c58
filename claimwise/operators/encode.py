"""Drop-first encoding of text columns with any number of levels: a distributed dictionary and sparse vectors built by tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from claimwise.functions.text import quoted
from claimwise.operators.cleaning import column_roles
from claimwise.operators.ranking import BUCKET_ROWS
from claimwise.session import stage

#: Levels of a column whose part of the dictionary is broadcast.
FEW_LEVELS = 20_000
#: A level of over this share of the rows is hot; so there are at most as many as its inverse.
HOT_SHARE = 0.001
SALTS = 64


@dataclass
class Encoded:
    """``vectors`` (kept columns, ``features``, ``label``), ``slots`` (``slot, name, feature, level``), and the number of slots."""

    vectors: DataFrame
    slots: DataFrame
    size: int


def dictionary(df: DataFrame, columns: list[str], first_slot: int = 0, most: int = BUCKET_ROWS) -> DataFrame:
    """``f, level, n, slot``, staged: every level of each column with its rows and its place in the vector.

    The first level of a column in text order has no place (NULL). Places of a column follow one another, in the order of
    hash buckets and of the text inside a bucket; a bucket holds about half of ``most`` levels. Only bucket
    sizes, a millionth of the levels, pass one window. Levels are combined map-side.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("f"), quoted(c).cast("string").alias("level")) for i, c in enumerate(columns)])
    counts = stage(df.select(F.inline(cells)).where("level IS NOT NULL").groupBy("f", "level").agg(F.count("*").alias("n")), "levels")
    # one row a column
    firsts = counts.groupBy("f").agg(F.min("level").alias("first"), F.count("*").alias("levels"))
    buckets = F.ceil(F.col("levels") * F.lit(2.0 / most))
    placed = counts.join(F.broadcast(firsts), "f").withColumn("bucket", F.pmod(F.xxhash64("level"), F.greatest(buckets, F.lit(1))))
    counted = placed.where("level > first")
    earlier = Window.partitionBy(F.lit(0)).orderBy("f", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.groupBy("f", "bucket").agg(F.count("*").alias("size")).select(
        "f", "bucket", (F.coalesce(F.sum("size").over(earlier), F.lit(0)) + first_slot).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("f", "bucket").orderBy("level"))
    slots = counted.withColumn("at", inside).join(offsets, ["f", "bucket"]).select("f", "level", "n", (F.col("offset") + F.col("at") - 1).alias("slot"))
    return stage(slots.unionByName(placed.where("level = first").select("f", "level", "n", F.lit(None).cast("bigint").alias("slot"))), "dictionary")


def _looked_up(rows: DataFrame, column: str, part: DataFrame, name: str, few: bool, hot: list[str]) -> DataFrame:
    """``rows`` with the place of the level of ``column``, from ``part`` of the dictionary.

    A large part is joined by a shuffle. Rows of hot levels are spread over copies of their entry, and rows without a level over keys of
    their own, so that no task gets more than a share of them.
    """
    key, part = quoted(column).cast("string"), part.select(F.col("level").alias("_level"), F.col("slot").alias(name))
    if few:
        return rows.join(F.broadcast(part), key == F.col("_level"), "left").drop("_level")
    often = F.coalesce(key.isin(*hot), F.lit(False)) if hot else F.lit(False)
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    rows = rows.withColumns({"_salt": F.when(often | key.isNull(), spread).otherwise(0)})
    copies = F.when(F.col("_level").isin(*hot) if hot else F.lit(False), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    part = part.withColumn("_part", F.explode(copies))
    return rows.join(part, (key == F.col("_level")) & (F.col("_salt") == F.col("_part")), "left").drop("_level", "_salt", "_part")


def _vectors(batches: Iterator[pa.RecordBatch], keep: list[str], plain: int, slots: int, size: int) -> Iterator[pa.RecordBatch]:
    """Sparse vectors from the number columns and the places of the levels; zeros are left out."""
    for batch in batches:
        columns = batch.columns
        first = len(keep) + plain
        numbers = [c.fill_null(float("nan")).to_numpy() for c in columns[len(keep):first]]
        places = [c.cast(pa.float64()).fill_null(-1.0).to_numpy() for c in columns[first:first + slots]]
        at = np.column_stack([*[np.full(batch.num_rows, i) for i in range(plain)], *places]).astype(np.int64).reshape(batch.num_rows, -1)
        value = np.column_stack([*numbers, *[np.ones(batch.num_rows)] * slots]).reshape(batch.num_rows, -1)
        order = np.argsort(at, axis=1, kind="stable")
        at, value = np.take_along_axis(at, order, 1), np.take_along_axis(value, order, 1)
        there = (at >= 0) & (value != 0)
        bounds = pa.array(np.concatenate([[0], np.cumsum(there.sum(axis=1))]).astype(np.int32))
        vector = pa.StructArray.from_arrays(
            [pa.array(np.zeros(batch.num_rows, np.int8)), pa.array(np.full(batch.num_rows, size, np.int32)),
             pa.ListArray.from_arrays(bounds, pa.array(at[there].astype(np.int32))), pa.ListArray.from_arrays(bounds, pa.array(value[there]))],
            names=["type", "size", "indices", "values"])
        yield pa.RecordBatch.from_arrays([*columns[:len(keep)], vector, columns[-1]], names=[*keep, "features", "label"])


def encode(df: DataFrame, target: str, keep: list[str] = (), most: int = BUCKET_ROWS, few_levels: int = FEW_LEVELS) -> Encoded:
    """Sparse feature vectors of all columns but ``target`` and ``keep``: numbers and flags as they are, text drop-first one-hot.

    Nothing that grows with the rows or the levels reaches the driver: of the dictionary only the
    number of levels per column, and the at most 1,000 levels of a large column that are hot. Columns of up to ``few_levels``
    levels meet a broadcast part of the dictionary, larger ones are joined by a salted shuffle. A missing
    level has no entry in its vector; a missing number is NaN; a column of one level has no place. Equal rows give equal
    vectors; an empty table has none. ``df`` is read twice: pass a staged frame.
    """
    keep = list(keep)
    numeric, categorical = column_roles(df, target)
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType) and f.name != target]
    plain = [c for c in [*numeric, *flags] if c not in keep]
    categorical = [c for c in categorical if c not in keep]
    table = dictionary(df, categorical, len(plain), most) if categorical else None
    # one row a column
    sizes = {} if table is None else {r["f"]: r for r in table.groupBy("f").agg(
        F.count("slot").alias("slots"), F.count("*").alias("levels"), F.sum("n").alias("rows"), F.max("n").alias("top")).collect()}
    used = [i for i in range(len(categorical)) if i in sizes and sizes[i]["slots"]]
    size = len(plain) + sum(sizes[i]["slots"] for i in used)
    rows = df.select(*[quoted(k) for k in keep], *[quoted(c).cast("double").alias(f"_n{i}") for i, c in enumerate(plain)],
                     *[quoted(categorical[i]).cast("string").alias(f"_c{i}") for i in used], quoted(target).cast("double").alias("label"))
    for i in used:
        part, few = table.where(F.col("f") == i), sizes[i]["levels"] <= few_levels
        hot = [] if few else [r["level"] for r in part.where(F.col("n") > max(1, int(HOT_SHARE * sizes[i]["rows"]))).select("level").collect()]
        rows = _looked_up(rows, f"_c{i}", part, f"_s{i}", few, hot)
    narrow = rows.select(*[quoted(k) for k in keep], *[f"_n{i}" for i in range(len(plain))], *[f"_s{i}" for i in used], "label")
    schema = T.StructType([*[df.schema[k] for k in keep], T.StructField("features", VectorUDT()), T.StructField("label", T.DoubleType())])
    vectors = narrow.mapInArrow(lambda it: _vectors(it, keep, len(plain), len(used), size), schema)
    numbers = df.sparkSession.createDataFrame([(i, c, c, None) for i, c in enumerate(plain)], "slot bigint, name string, feature string, level string")
    if table is None:
        return Encoded(vectors, numbers, size)
    name: Column = F.element_at(F.array(*[F.lit(c) for c in categorical]), F.col("f") + 1)
    levels = table.where("slot IS NOT NULL").select("slot", F.concat(name, F.lit("_"), "level").alias("name"), name.alias("feature"), "level")
    return Encoded(vectors, numbers.unionByName(levels), size)


def _set_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0).field("indices").cast(pa.list_(pa.int32())), batch.column(0).field("values").cast(pa.list_(pa.float64()))],
                                         names=["slots", "values"])


def slot_totals(encoded: Encoded) -> DataFrame:
    """``feature, level, rows, total``: per place of the vectors the rows that have a value there, and its sum."""
    cells = encoded.vectors.select("features").mapInArrow(_set_places, "slots array<int>, values array<double>").select(
        F.inline(F.arrays_zip("slots", "values"))).groupBy(F.col("slots").cast("bigint").alias("slot")).agg(
        F.count("*").alias("rows"), F.sum("values").alias("total"))
    return encoded.slots.join(cells, "slot").select("feature", "level", "rows", "total")

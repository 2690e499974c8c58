"""Moment matrices of many columns with gaps, merged pairwise: one scan for all pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: First merge: tasks that share a group, so that no group grows with the tasks alone.
_SALTS = 64
_PARTS = ("n", "ma", "mb", "c", "va", "vb")
_SCHEMA = "a int, salt int, " + ", ".join(f"{p} array<double>" for p in _PARTS)


def of_block(values: np.ndarray) -> np.ndarray:
    """``[6, k, k]`` for rows of k columns with NaN as gap: rows where both are present, their means, co-moment and squares.

    Entry (a, b) of the parts: count, mean of a, mean of b, sum of (a - mean)(b - mean), of (a - mean)^2, of (b - mean)^2.
    Columns are centred on their own mean first, so that nothing cancels.
    """
    there = ~np.isnan(values)
    count = there.sum(axis=0)
    mean = np.where(there, values, 0.0).sum(axis=0) / np.maximum(count, 1)
    x, m = np.where(there, values - mean, 0.0), there.astype(float)
    n, sx, sxx = m.T @ m, x.T @ m, (x * x).T @ m
    share = sx / np.maximum(n, 1)
    va = np.maximum(sxx - sx * share, 0.0)
    ma = mean[:, None] + share
    return np.stack([n, ma, ma.T, x.T @ x - sx * share.T, va, va.T])


def merge(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The moments of both sets of rows, from those of each."""
    n = one[0] + two[0]
    part = np.divide(two[0], n, out=np.zeros_like(n), where=n > 0)
    da, db, weight = two[1] - one[1], two[2] - one[2], one[0] * part
    return np.stack([n, one[1] + da * part, one[2] + db * part, one[3] + two[3] + da * db * weight,
                     one[4] + two[4] + da * da * weight, one[5] + two[5] + db * db * weight])


def _blocks(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """One row per column for the rows of the task."""
    total, task = np.zeros((6, k, k)), 0
    for batch in batches:
        if batch.num_rows:
            task = batch.column(k)[0].as_py()
            columns = [c.cast(pa.float64()).fill_null(float("nan")).to_numpy() for c in batch.columns[:k]]
            total = merge(total, of_block(np.column_stack(columns)))
    yield _rows(range(k), task, total)


def _rows(names, salt: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(names), pa.int32()), pa.array([salt % _SALTS] * total.shape[1], pa.int32()),
         *[pa.array(list(part), pa.list_(pa.float64())) for part in total]], names=["a", "salt", *_PARTS])


def _merged(table: pa.Table) -> pa.Table:
    total = None
    for row in table.to_batches(max_chunksize=1):
        one = np.stack([np.array(row.column(p)[0].values) for p in _PARTS])
        total = one if total is None else merge(total, one)
    return pa.Table.from_batches([_rows([table["a"][0].as_py()], 0, total[:, None, :])])


def correlations(values: DataFrame, columns: list[str]) -> DataFrame:
    """``col_a, col_b, r`` for every pair of the DOUBLE columns of ``values``, named by ``columns``; NULL for a constant.

    Each task sends one row per column, which hold the moments with all other columns; these are merged in two steps.
    """
    k = len(columns)
    doubles = values.select(*values.columns, F.spark_partition_id().alias("_task"))
    # empty moments for every column, so that a table without rows has its pairs too
    none = values.sparkSession.range(k).select(F.col("id").cast("int").alias("a"), F.lit(0).alias("salt"), *[
        F.array_repeat(F.lit(0.0), k).alias(p) for p in _PARTS])
    rows = doubles.mapInArrow(lambda it: _blocks(it, k), _SCHEMA).unionByName(none)
    merged = rows.groupBy("a", "salt").applyInArrow(_merged, _SCHEMA).groupBy("a").applyInArrow(_merged, _SCHEMA)
    names = F.array(*[F.lit(c) for c in columns])
    cells = merged.select(F.element_at(names, F.col("a") + 1).alias("col_a"), F.inline(F.arrays_zip(names.alias("col_b"), "c", "va", "vb")))
    r = F.try_divide(F.col("c"), F.sqrt("va") * F.sqrt("vb"))
    # rounding may leave the range by one unit in the last place
    return cells.select("col_a", "col_b", r.alias("r")).withColumn("r", F.when(F.abs("r") > 1, F.signum("r")).when(~F.isnan("r"), F.col("r")))

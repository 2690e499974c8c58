"""Frames the operators share: plain inputs, staged tables, block pairs, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from claimwise.session import scratch_path


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` only, so that further columns cannot clash."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until the frame has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def staged(df: DataFrame, label: str) -> DataFrame:
    """Written once to the shared folder and read again; cuts the lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deal_in_block_pairs(df: DataFrame, group: str, member: str, size: Column, block: int) -> DataFrame:
    """Rows of large groups, dealt so that any two members of a group meet in one block pair.

    Adds ``lo, hi, side``: a group of ``size`` rows is split by a hash into
    about ``size / block`` blocks, and each row goes to the pairs of its block.
    A group within ``block`` is one pair (0, 0).
    """
    blocks = F.ceil(size / F.lit(float(block))).cast("int")
    own = F.pmod(F.xxhash64(F.col(member)), blocks.cast("long")).cast("int")
    return (df.withColumn("_own", own)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("lo", F.least("_own", "_other")).withColumn("hi", F.greatest("_own", "_other"))
            .withColumn("side", (F.col("_own") != F.col("lo")).cast("int"))
            .drop("_own", "_other"))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the row bounds of each, from batches sorted by ``keys``.

    Only the open group is carried from batch to batch.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last is not None and any(c[0] != x for c, x in zip(columns, last))
        last = [c[-1] for c in columns]
        starts = np.flatnonzero(new)
        if not len(starts):
            held.append(batch)
            continue
        table = pa.Table.from_batches([*held, batch.slice(0, starts[-1])])
        before = sum(b.num_rows for b in held)
        bounds = np.concatenate([[0], starts + before])
        yield table.combine_chunks(), bounds[np.concatenate([[True], np.diff(bounds) > 0])]
        held = [batch.slice(starts[-1])]
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, np.array([0, table.num_rows])


def stars(pairs: np.ndarray, size: int) -> np.ndarray:
    """For members 0 .. size-1, the smallest member connected by ``pairs`` (rows of two)."""
    root = np.arange(size)
    while len(pairs):
        low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        before = root.copy()
        np.minimum.at(root, root[pairs[:, 0]], low)
        np.minimum.at(root, root[pairs[:, 1]], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """``node, root`` for every node of the edges ``u, v``; root is the smallest node reachable.

    Alternating large-star and small-star steps, each written to the shared
    folder. Minima are combined before the shuffle; the join that hands them to the edges has the edges of a hub in one task.
    Raises if it has not settled after ``rounds``.
    """
    now = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .where("u <> v").distinct(), "edges")
    last = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e")
        ).select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct()
        now = staged(small, "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        last = state
    raise RuntimeError(f"components have not settled after {rounds} rounds")

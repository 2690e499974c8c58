"""Packing token sequences as a cutting-stock problem solved by column generation."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from claimwise.llm.frames import staged, texts
from claimwise.llm.tokens import tokenizer

END = 2


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    own, end = tokenizer(path), np.array([END], "<u4").tobytes()
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            part = batch.slice(low, 256)
            columns = ([], [], [], [], [])
            for doc, ids in zip(part.column(0).to_pylist(), own.encode([t or "" for t in part.column(1).to_pylist()])):
                ids = memoryview(ids + end)
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    stop = min(total, start + capacity)
                    for column, x in zip(columns, (doc, start, stop - start, zlib.crc32(ids[start * 4:stop * 4]), total)):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])


def _best_pattern(price: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """Knapsack by dynamic programming: the pattern of greatest price; item i is i + 1 units."""
    best, last = np.zeros(size + 1), np.zeros(size + 1, int)
    for room in range(1, size + 1):
        k = min(room, len(price))
        value = price[:k] + best[room - k:room][::-1]
        top = int(value.argmax())
        best[room], last[room] = (value[top], top + 1) if value[top] > best[room - 1] else (best[room - 1], 0)
    pattern, room = np.zeros(len(price), int), size
    while room:
        if last[room]:
            pattern[last[room] - 1] += 1
            room -= last[room]
        else:
            room -= 1
    return float(best[size]), pattern


def generate_patterns(demand: np.ndarray, size: int, rounds: int = 20000) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used, covering ``demand[i]`` items of i + 1 units in bins of ``size``.

    Revised simplex on the linear program; knapsack pricing brings in columns until none
    improves it. Use counts are rounded down, and what is left is filled first-fit decreasing.
    The tables are ``size`` x ``size`` whatever the number of items.
    """
    items = np.flatnonzero(demand)
    out: list[tuple[np.ndarray, int]] = []
    left = demand.astype(np.int64).copy()
    if len(items):
        m = len(items)
        columns = np.zeros((m, m))
        columns[np.arange(m), np.arange(m)] = size // (items + 1)
        inverse, cost = np.diag(1.0 / columns.diagonal()), np.ones(m)
        use = inverse @ demand[items]
        for turn in range(rounds):
            dual = cost @ inverse
            price = np.zeros(size)
            price[items] = dual
            worst = int(dual.argmin())
            if dual[worst] < -1e-9:  # an item may be cut once too often
                entering, charge = -np.eye(m)[worst], 0.0
            else:
                value, pattern = _best_pattern(np.maximum(price, 0), size)
                if value <= 1 + 1e-7:
                    break
                entering, charge = pattern[items].astype(float), 1.0
            step = inverse @ entering
            ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
            leave = int(ratio.argmin())
            use = np.maximum(use - ratio[leave] * step, 0)
            use[leave] = ratio[leave]
            columns[:, leave], cost[leave] = entering, charge
            pivot = inverse[leave] / step[leave]
            inverse -= np.outer(step, pivot)
            inverse[leave] = pivot
            if turn % 200 == 199:
                inverse = np.linalg.inv(columns)
                use = np.maximum(inverse @ demand[items], 0)
        for j in np.argsort(-use, kind="stable"):
            times = int(use[j] + 1e-6)
            if cost[j] and times:
                pattern = np.zeros(size, np.int64)
                pattern[items] = columns[:, j].astype(int)
                out.append((pattern, times))
                left -= pattern * times
    bins: list[list] = []
    for i in np.flatnonzero(left > 0)[::-1]:
        for _ in range(int(left[i])):
            place = next((b for b in bins if b[0] >= i + 1), None)
            if place is None:
                bins.append(place := [size, np.zeros(size, np.int64)])
            place[0] -= i + 1
            place[1][i] += 1
    return out + [(b[1], 1) for b in bins]


def _slots(patterns: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int]]:
    """``kind, low, high, each, first``: ranks low to high of a kind go ``each`` a sequence from ``first`` on."""
    rows, sequence, used = [], 0, {}
    for pattern, times in patterns:
        for kind in np.flatnonzero(pattern):
            low = used.get(kind, 0)
            used[kind] = low + int(pattern[kind]) * times
            rows.append((int(kind), low, used[kind], int(pattern[kind]), sequence))
        sequence += times
    return rows


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, unit: int = 16,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document's ids (and the end id) are cut at every ``capacity`` ids; the rest is one piece.
    Pieces are counted by length in ``unit`` ids, and that histogram of
    ``capacity / unit`` counts is all the driver sees. Column generation turns it into
    patterns, and the ranked pieces of each length class take the patterns' places in
    order, by a join with a table bounded by the square of the number of classes. Ranks are
    counted over 1024 hash ranges per class and inside each.

    Null and empty text is the end id alone. Repeated rows are packed each; a null id
    stays null; other columns are ignored; an empty table gives no row.
    """
    spark = docs.sparkSession
    kinds = capacity // unit
    cut = staged(texts(docs, id_col, text_col).mapInArrow(
        lambda it: _pieces(it, tokenizer_path, capacity), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"), "pieces")
    kind = (F.ceil(F.col("length") / unit) - 1).cast("int")
    classed = cut.withColumn("kind", kind).withColumn("range", F.pmod(F.xxhash64("doc_id", "start"), F.lit(1024)).cast("int"))
    ranges = staged(classed.groupBy("kind", "range").agg(F.count(F.lit(1)).alias("n")), "ranges")
    demand = np.zeros(kinds, np.int64)
    for row in ranges.groupBy("kind").agg(F.sum("n").alias("n")).collect():
        demand[row["kind"]] = row["n"]
    slots = spark.createDataFrame(_slots(generate_patterns(demand, kinds)), T.StructType(
        [T.StructField("kind", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("low", "high", "each", "first"))]))
    ahead = Window.partitionBy("kind").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = ranges.select("kind", "range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("kind", "range").orderBy("doc_id", "start", "ids_crc32")
    ranked = classed.join(base, ["kind", "range"]).withColumn("rank", F.col("base") + F.row_number().over(inside) - 1)
    # bounded: at most kinds x kinds rows
    seated = ranked.join(F.broadcast(slots), (ranked["kind"] == slots["kind"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", ranked["kind"], "rank",
        (F.col("first") + F.floor((F.col("rank") - F.col("low")) / F.col("each"))).alias("sequence_id"))
    before = Window.partitionBy("sequence_id").orderBy(F.col("kind").desc(), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return seated.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("kind", "rank")

"""CSV records over several lines, read by blocks: quote parity per block, records joined across borders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: File blocks whose parity is broadcast, one number each.
_FEW = 200_000
#: A record of one block, the end of one that began in an earlier block, the begin of one that goes on, a block inside one.
WHOLE, CLOSING, OPENING, INSIDE = range(4)


def quotes(line: Column) -> Column:
    """Whether the line holds an odd number of quotes, as 0 or 1."""
    return F.pmod(F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit(""))), F.lit(2)).cast("int")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, line, odd``: the lines of every file block in file order; only the line feed ends a line."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.col("value").alias("line"), quotes(F.col("value")).alias("odd"))


def block_parity(found: DataFrame) -> DataFrame:
    """``file, block, odd_lines, odd``: per file block its lines with an odd number of quotes."""
    return found.groupBy("file", "block").agg(F.sum("odd").alias("odd_lines"), F.pmod(F.sum("odd"), F.lit(2)).cast("int").alias("odd"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the blocks of a task from their lines in order, blank lines left out; those that cross a border come in parts."""
    block, inside, index, kind, held, held_index = None, 0, 0, WHOLE, None, 0

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()))],
                                          names=["file", "block", "index", "kind", "record"])

    def ended() -> list[tuple]:
        if held is None:
            return []
        return [(*block, held_index, INSIDE if kind == CLOSING else OPENING, "\n".join(held))]

    for batch in batches:
        file, at, line, odd, start = batch.columns
        file, at = file.dictionary_encode(), at.to_numpy()
        code, odd = file.indices.to_numpy(), odd.to_numpy()
        edges = [0, *(np.flatnonzero((np.diff(code) != 0) | (np.diff(at) != 0)) + 1).tolist(), len(at)] if len(at) else [0]
        for low, high in zip(edges, edges[1:]):
            now = (file.dictionary[int(code[low])].as_py(), int(at[low]))
            if now != block:
                rows = ended()
                if rows:
                    yield made(rows)
                block, index, inside = now, 0, start[low].as_py()
                kind, held, held_index = (CLOSING, [], -1) if inside else (WHOLE, None, 0)
            part = odd[low:high]
            text = line.slice(low, high - low)
            before = (inside + np.cumsum(part) - part) % 2
            blank = (before == 0) & pc.is_in(text, pa.array(["", "\r"])).to_numpy(zero_copy_only=False)
            number = index + np.cumsum((before == 0) & ~blank) - 1
            # a line of its own is a record; only others are joined one by one
            alone = (before == 0) & (part == 0)
            keep = np.flatnonzero(alone & ~blank)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block[0]] * len(keep), pa.string()), pa.array([block[1]] * len(keep), pa.int64()), pa.array(number[keep]),
                 pa.array([WHOLE] * len(keep), pa.int32()), text.take(pa.array(keep))], names=["file", "block", "index", "kind", "record"])
            rows = []
            for i in np.flatnonzero(~alone).tolist():
                if before[i] == 0:
                    kind, held, held_index = WHOLE, [text[i].as_py()], int(number[i])
                else:
                    held.append(text[i].as_py())
                    if part[i]:
                        rows.append((*block, held_index, kind, "\n".join(held)))
                        held = None
            if rows:
                yield made(rows)
            index, inside = int(number[-1]) + 1, int((inside + part.sum()) % 2)
    rows = ended()
    if rows:
        yield made(rows)


def records(spark: SparkSession, path: str, parity: DataFrame) -> DataFrame:
    """``file, block, index, record``: the text of every record, with the place where it begins.

    ``parity`` is the (staged) result of :func:`block_parity`. A prefix sum over the blocks of a file says whether a block
    starts inside quotes; the lines then stay where they are. Only parts of records that cross a border,
    at most two a block, are shuffled and put together.
    """
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = parity.select("file", "block", F.pmod(F.coalesce(F.sum("odd").over(earlier), F.lit(0)), F.lit(2)).cast("int").alias("start"))
    starts = F.broadcast(starts) if parity.count() <= _FEW else starts
    found = lines(spark, path).join(starts, ["file", "block"]).select("file", "block", "line", "odd", "start")
    parts = found.mapInArrow(_joined, "file string, block long, index long, kind int, record string")
    order = Window.partitionBy("file").orderBy("block", "index")
    # the parts of a record follow one another; it begins with the opening one
    crossing = parts.where(F.col("kind") != WHOLE).withColumn("number", F.sum((F.col("kind") == OPENING).cast("int")).over(order))
    whole = crossing.groupBy("file", "number").agg(
        F.min_by("block", F.struct("block", "index")).alias("block"), F.min_by("index", F.struct("block", "index")).alias("index"),
        F.array_sort(F.collect_list(F.struct("block", "index", "record"))).alias("parts"))
    joined = whole.select("file", "block", "index", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    return parts.where(F.col("kind") == WHOLE).select("file", "block", "index", "record").unionByName(joined)

"""Table, CSV and text sinks. Row counts are observed during the write."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from claimwise.schemas import TABLES


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


#: Names the folder of the generation that readers see.
POINTER = "_current"


def _files(spark: SparkSession, path: str):
    """The file system of ``path``, and ``path`` for it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def current_generation(spark: SparkSession, location: str) -> str:
    """The folder of the tables that readers see: that of the last complete load, or ``location`` itself without one."""
    files, pointer = _files(spark, f"{location}/{POINTER}")
    if not files.exists(pointer):
        return location
    stream = files.open(pointer)
    try:
        return f"{location}/{stream.readLine()}"
    finally:
        stream.close()


def _switch(spark: SparkSession, location: str, generation: str) -> None:
    """Point readers to a generation: the new pointer is written beside the old one and renamed over it."""
    jvm = spark.sparkContext._jvm
    files, fresh = _files(spark, f"{location}/{POINTER}-{generation}")
    out = files.create(fresh, True)
    try:
        out.writeBytes(generation + "\n")
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri() if fresh.toUri().getScheme() else files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fresh, files.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{location}/{POINTER}")), overwrite)


def _drop_generations(spark: SparkSession, location: str, keep: list[str]) -> None:
    files, top = _files(spark, location)
    for status in files.listStatus(top):
        name = status.getPath().getName()
        if name.startswith("generation-") and name not in keep:
            files.delete(status.getPath(), True)


def write_tables(tables: dict[str, DataFrame], location: str) -> dict[str, int]:
    """Full refresh of Parquet tables, parents first; rows written per table.

    All tables go to a new folder below ``location``; at the end one pointer is switched to it, so readers
    (:func:`~claimwise.sources.readers.read_tables`) see all new tables or all old ones, also after a failure. The generation before
    stays for readers that are at work; older ones go.
    """
    rows, spark = {}, next(iter(tables.values())).sparkSession
    before = current_generation(spark, location)
    generation = f"generation-{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
    for name in [n for n in TABLES if n in tables] + [n for n in tables if n not in TABLES]:
        df, seen = _observed(tables[name])
        df.write.mode("overwrite").parquet(f"{location}/{generation}/{name}")
        rows[name] = seen.get["rows"]
    _switch(spark, location, generation)
    _drop_generations(spark, location, [generation, before.rsplit("/", 1)[-1]])
    return rows


def save_bucketed_tables(tables: dict[str, DataFrame], keys: dict[str, str], buckets: int, prefix: str = "") -> dict[str, int]:
    """Full refresh of catalog tables bucketed by their join key.

    Joins between tables bucketed alike on that key need no shuffle.
    """
    rows = {}
    for name, table in tables.items():
        df, seen = _observed(table)
        (df.write.mode("overwrite").format("parquet")
         .bucketBy(buckets, keys[name]).sortBy(keys[name]).saveAsTable(prefix + name))
        rows[name] = seen.get["rows"]
    return rows


def write_csv(df: DataFrame, path: str) -> int:
    """CSV with header; empty text and NULL are empty fields. Rows written."""
    df, seen = _observed(df)
    (df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return seen.get["rows"]


def write_report(lines: DataFrame, path: str) -> None:
    """Text report from ``section, position, line``, in that order."""
    lines.orderBy("section", "position").select("line").write.mode("overwrite").text(path)

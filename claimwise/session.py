"""Session defaults and shared scratch storage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "claimwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` overrides them.

    Keyword names use ``__`` for the dots of the Spark setting.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # models trained side by side share the cores evenly
        "spark.scheduler.mode": "FAIR",
    }
    settings.update({name.replace("__", "."): value for name, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else one below the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch").rstrip("/")


_JOBS: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_dir`, deleted at the end of a surrounding :func:`scratch`."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"
    if _JOBS:
        _JOBS[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was staged inside it; results must be written by then."""
    _JOBS.append([])
    try:
        yield
    finally:
        for path in _JOBS.pop():
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to shared storage and continue from the written table.

    Used where several jobs read the same frame: the lineage is cut, later jobs
    prune columns, and a lost executor costs a re-read, not a recomputation.
    """
    target = path or scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)

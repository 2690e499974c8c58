"""Scoring of arriving reports as a stateless stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from claimwise.operators.cleaning import reject_blank
from claimwise.operators.reports import compare_with_means
from claimwise.plans.scoring import score_reports, score_texts


def report_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                  files_per_batch: int = 1000, **options: str) -> DataFrame:
    """File stream of arriving reports."""
    reader = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch)
    return reader.options(**options).load(path)


def scored_stream(reports: DataFrame, means: DataFrame | None = None, text_column: str = "text") -> DataFrame:
    """The batch columns on a stream, with the historical means if given."""
    scored = score_reports(reports, text_column)
    return scored if means is None else compare_with_means(scored, means)


def run_scores(scored: DataFrame, output: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Score everything available and stop; a restart continues from the checkpoint."""
    return (scored.writeStream.format(fmt).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(output))


def run_scores_and_rejects(reports: DataFrame, scores: str, rejects: str, checkpoint: str, means: DataFrame | None = None,
                           text_column: str = "text", fmt: str = "parquet") -> StreamingQuery:
    """Score everything available into ``scores`` and keep blank messages in ``rejects``; then stop.

    Each batch writes to a folder of its own number in both places and replaces what an
    earlier try of that batch left there, so a batch that is run again after a failure between
    the two writes, or before it was noted as done, changes nothing. The folders read as one table with the column ``batch``.
    """
    def write(batch: DataFrame, number: int) -> None:
        kept, blank = reject_blank(batch, text_column)
        scored = score_texts(kept, text_column)
        scored = scored if means is None else compare_with_means(scored, means)
        for df, place in ((scored, scores), (blank, rejects)):
            df.write.format(fmt).mode("overwrite").save(f"{place}/batch={number}")

    return (reports.writeStream.foreachBatch(write).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())

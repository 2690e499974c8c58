"""Registered queries of the operators in this package, and their SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimwise.llm import (
    chunks, compression, divergence, hnsw, jaccard, language, licences, mixture, packing, quality, ranked_search, secret_scan,
    suffixes,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@_query
def op4_compression_bands(spark: SparkSession, sf: str) -> DataFrame:
    return compression.compression_bands(_table(spark, sf, "documents"))


@_query
def op6_licence_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licences.licence_scan(_table(spark, sf, "documents"))


@_query
def op7_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(_table(spark, sf, "documents"))


@_query
def op9_co_training(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return quality.score(docs, quality.fit(docs, _table(spark, sf, "labels")), ["doc_id"])


@_query
def op1_content_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.repeated_passages(_table(spark, sf, "documents"))


@_query
def op2_cutting_stock(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op3_chosen_path_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.jaccard_join(_table(spark, sf, "documents"))


@_query
def op5_source_schedule(spark: SparkSession, sf: str) -> DataFrame:
    return mixture.mix(mixture.sizes(_table(spark, sf, "documents")))


SQL["op5_source_schedule"] = mixture.SQL


@_query
def op8_small_world(spark: SparkSession, sf: str) -> DataFrame:
    return hnsw.near_copies(_table(spark, sf, "embeddings"))


@_query
def op10_sparse_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.repeated_passages(_table(spark, sf, "documents"))


@_query
def op11_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.digest(secret_scan.secret_scan(_table(spark, sf, "documents")))


@_query
def op12_shared_search(spark: SparkSession, sf: str) -> DataFrame:
    return ranked_search.ranked_search(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


SQL["op12_shared_search"] = ranked_search.SQL


@_query
def op13_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf, "documents"))


SQL["op13_source_divergence"] = divergence.SQL

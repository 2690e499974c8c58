"""The corpus pipeline: quality, near copies, repeated passages, source mix, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwise.llm import jaccard, mixture, packing, quality, suffixes
from claimwise.llm.frames import staged, unused
from claimwise.session import scratch_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on ``labels``, does not reject; a score on the limit stays.

    Null and empty texts go, long ones are scored whole; null ids stay; repeated rows stay or go together; without labels of both
    kinds every text with a word stays. An empty table stays empty.
    """
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, docs.columns).where("kept").select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document of smallest id; rows without id stay.

    Repeated rows of one id become one. Null and empty texts link with nothing and stay; long ones are compared whole; an empty
    table stays empty.
    """
    kept = jaccard.jaccard_join(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where("doc_id is null"))


def no_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words and more that stand in an earlier document.

    ``n_chars`` follows the text; a document of which nothing is left goes, as do null and empty texts. Of equal passages that of the
    smallest id stays, in one document the first. Rows without id are not compared and stay; long texts are
    cut where they repeat; an empty table stays empty.
    """
    cut = suffixes.without_repeats(docs, suffixes.repeated_passages(docs))
    return cut.withColumn("n_chars", F.length("text").cast("long")).where("length(text) > 0").select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as often as the mix takes them, rows without id too; ``n_chars`` follows the text.

    Null and empty texts have no words to take and go; a null source is one of its own; repeated rows are taken each; a long text may be taken in
    part; an empty table stays empty.
    """
    row = unused(docs, "_row")
    # written once, so that the keys stay the same
    keyed = staged(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    mixed = mixture.apply_mix(keyed, mixture.mix(mixture.sizes(keyed, row_col=row)), row_col=row)
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the token sequences and their places in packed sequences.

    Null text is empty and has the end token alone; long texts are cut into pieces; repeated rows and rows without id are
    packed each; an empty table gives no piece.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", good_quality),
    ("near_copies", one_of_near_copies),
    ("repeated_passages", no_repeated_passages),
    ("source_mix", mixed_sources),
    ("packing", packed),
]

#: A fitted classifier, hashed joins and a tokenizer decide rows; SQL cannot state them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out, path = stage(spark, docs, sf_dir), scratch_path(spark, name)
        out.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs

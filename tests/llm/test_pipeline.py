"""The pipeline's stages on edge cases, and what each promises."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimwise.llm import mixture
from tests.llm.conftest import sentence


@pytest.fixture(scope="module")
def folder(spark, edge_docs, labels, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rng = random.Random(18)
    passage = sentence(rng, 70, 50000)
    rows = [(1000 + i, sentence(rng, 90, 50000).capitalize() + ".", "en", f"s{i % 3}", 0) for i in range(60)]
    rows += [(2000 + i, f"{sentence(rng, 60, 50000)} {passage} {sentence(rng, 60, 50000)}", "en", "s0", 0) for i in range(4)]
    rows += [(3000 + i, "CALL NOW!! " * 40, "en", "s1", 0) for i in range(10)]
    rows += [(4000, rows[0][1], "en", "s0", 0), (4001, rows[1][1] + " one more", "en", "s0", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.unionByName(edge_docs.select(*docs.columns)).write.parquet(f"{path}/documents.parquet")
    known = [(i, 1, 0) for i in range(1000, 1040)] + [(i, 0, 0) for i in range(3000, 3010)]
    labels.unionByName(spark.createDataFrame(known, labels.schema)).write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.dtypes, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.dtypes == columns, name
        out.write.parquet(f"{folder}/{name}")
        docs = seen[name] = spark.read.parquet(f"{folder}/{name}")
    ids = {name: [r.doc_id for r in df.select("doc_id").collect()] for name, df in seen.items()}
    assert set(range(1000, 1060)) <= set(ids["quality_classifier"]) and not set(range(3000, 3010)) & set(ids["quality_classifier"])
    assert not {4000, 4001} & set(ids["near_copies"]) and set(range(2000, 2004)) <= set(ids["near_copies"])
    assert len(ids["near_copies"]) - ids["near_copies"].count(None) == len(set(ids["near_copies"]) - {None})
    words = {r.doc_id: r.n for r in seen["repeated_passages"].select("doc_id", F.size(F.split("text", r"\s+")).alias("n")).collect()}
    assert words[2000] == 190 and all(words[i] == 120 for i in (2001, 2002, 2003))
    assert all(r.n_chars == len(r.text) for r in seen["source_mix"].collect())
    packed = seen["packing"].toPandas()
    assert set(packed["doc_id"].dropna()) == set(ids["source_mix"]) - {None}
    assert (packed.groupby("sequence_id")["length"].sum() <= 4096).all()


def test_empty_corpus(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0


def test_rows_without_id_are_mixed(spark):
    rows = [(None, f"first{i} " * 100, "en", "a", 0) for i in range(3)] + [(1, "named " * 100, "en", "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = mixture.mix(mixture.sizes(docs)).collect()
    out = corpus_pipeline.mixed_sources(spark, docs, "").collect()
    words = [len(r.text.split()) for r in out if r.doc_id is None]
    assert sum(words) == sum(r.taken for r in mixed if r.doc_id is None) > 0
    assert all(len(set(r.text.split())) == 1 for r in out)

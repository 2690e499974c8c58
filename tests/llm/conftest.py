import random

import pytest

EDGE_TEXTS = [None, "", " \n\t ", "word", "ab " * 30, "x" * 5000, "Ein Wort, two words\nlines\n\nlines", "日本語 текст 中文", "  "]


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}x{rng.randrange(10)}" for _ in range(n))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns with clashing names."""
    rng = random.Random(5)
    long = sentence(rng, 150_000)
    rows = [(i, t, "en", "s1", 0) for i, t in enumerate(EDGE_TEXTS)]
    rows += [(50, long, "en", "s2", None), (51, long, None, None, 7), (None, sentence(rng, 80), "de", "s1", 1), (None, None, None, None, None),
             (3, "word", "en", "s1", 0), (3, "word", "en", "s1", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("u", "v", "root", "bucket", "kind", "range", "size", "score", "kept", "_spans", "at", "first"):
        df = df.withColumn(name, df["n_chars"].cast("string"))
    return df


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(0, 1, 0), (3, 0, 0), (4, 0, 1), (50, 1, 0), (51, 1, 0), (51, 0, 0), (None, 1, 0), (6, None, 0)],
                                 "doc_id long, quality int, toxic int")

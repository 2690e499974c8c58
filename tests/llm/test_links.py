"""Operators on pairs: the shingle join and near copies of embeddings."""

import itertools
import random

import numpy as np
import pytest

from claimwise.llm import hnsw, jaccard
from claimwise.llm.frames import components
from tests.llm.conftest import sentence


def roots(ids, pairs):
    at = {i: i for i in ids}

    def find(i):
        while at[i] != i:
            i = at[i]
        return i
    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        at[high] = low
    return {i: find(i) for i in ids}


def shingles(text):
    w = (text or "").split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"z{rng.randrange(10 ** 6)}"
    return " ".join(w)


@pytest.mark.parametrize("bucket,block", [(64, 1024), (4, 16)])
def test_join_equals_brute_force(spark, bucket, block):
    rng = random.Random(7)
    texts = [sentence(rng, rng.randrange(5, 200)) for _ in range(150)]
    base = sentence(rng, 150)
    texts += [edited(rng, base, rng.randrange(0, 5)) for _ in range(80)] + [base] * 10
    texts += [edited(rng, t, rng.randrange(1, 4)) for t in texts[:60]] + ["one two", "one two", "one two three"]
    got = {r.doc_id: r for r in jaccard.jaccard_join(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), bucket=bucket, block=block).collect()}
    sets = [shingles(t) for t in texts]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])]
    degree = [sum(i in p for p in pairs) for i in range(len(texts))]
    missed = sum(degree[i] != got[i].n_links for i in range(len(texts)))
    assert missed <= 0.01 * len(texts) and all(got[i].n_links <= degree[i] for i in range(len(texts)))
    want = roots(range(len(texts)), pairs)
    assert sum(got[i].class_id != want[i] for i in range(len(texts))) <= 0.01 * len(texts)
    assert all(got[i].kept == (got[i].class_id == i) for i in got)


def test_join_edges(spark, edge_docs, no_docs):
    assert jaccard.jaccard_join(no_docs).count() == 0
    rows = jaccard.jaccard_join(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    got = {r.doc_id: r for r in rows}
    assert got[50].n_links == got[51].n_links == 1 and got[51].class_id == 50 and not got[51].kept
    assert got[3].n_links == 2 and got[0].n_links == 0 and got[0].kept and got[None].class_id is None and got[None].kept


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, i) for i in range(501, 540)] + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)]
    ids = {x for e in edges for x in e}
    want = roots(ids, edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: want[i] for i in got} and all(a in got for e in edges for a in e if e[0] != e[1])
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_copies_equal_brute_force(spark):
    rng = np.random.default_rng(9)
    centre = rng.normal(size=(30, 16))
    x = np.concatenate([centre[rng.integers(0, 30, 400)] + rng.normal(size=(400, 16)) * 0.17, np.repeat(rng.normal(size=(1, 16)), 40, axis=0)]).astype(np.float32)
    rows = [(i, x[i].tolist(), int(i % 3)) for i in range(len(x))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (np.arange(len(x))[:, None] % 3 == np.arange(len(x)) % 3)
    np.fill_diagonal(near, False)
    want = roots(range(len(x)), np.argwhere(near).tolist())
    for sizes in ({}, {"shard": 50, "block": 40}):
        got = {r.vec_id: r for r in hnsw.near_copies(df, **sizes).collect()}
        assert sum(got[i].n_links for i in got) >= 0.98 * near.sum() and all(got[i].n_links <= near[i].sum() for i in got)
        assert np.mean([got[i].component_id == want[i] for i in got]) > 0.98
        assert all(got[i].kept == (got[i].component_id == i) for i in got)


def test_near_copies_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [0.0, 0.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [], 1), (6, [1.0, None], 1), (7, [1.0, 0.0], None),
            (8, [1.0, 0.0], 1), (9, [2.0, 0.0], 1), (10, [1.0, 0.0], 2), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (12, [1e300, 0.0], 1), (8, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "label as u", "label as root", "vec_id as dim")
    out = hnsw.near_copies(df).collect()
    assert len(out) == len(rows)
    got = {r.vec_id: r for r in out}
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (1, 2, 3, 4, 5, 6, 7, 10, 11))
    assert got[8].n_links == got[9].n_links == got[12].n_links == 3 and {got[i].component_id for i in (8, 9, 12)} == {8}
    assert got[None].component_id is None and got[None].kept
    assert hnsw.near_copies(df.limit(0)).count() == 0

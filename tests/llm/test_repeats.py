"""Repeated passages by chunks and by suffixes."""

import random

import numpy as np
import pytest

from claimwise.llm import chunks, repeats, suffixes
from tests.llm.conftest import sentence


@pytest.fixture(scope="module")
def planted(spark):
    """Documents with shared passages of 55 to 90 words, shorter shared ones, copies, and clean ones."""
    rng = random.Random(11)
    clean = {i: sentence(rng, 200, 100000) for i in range(60)}
    passages = [sentence(rng, n, 100000) for n in (50, 55, 70, 90, 300)]
    short = sentence(rng, 40, 100000)
    docs, holders = dict(clean), {}
    for k, p in enumerate(passages):
        for i in range(6):
            doc = 100 + 10 * k + i
            docs[doc] = f"{sentence(rng, rng.randrange(30, 80), 100000)} {p} {sentence(rng, rng.randrange(30, 80), 100000)}"
            holders[doc] = (p, 100 + 10 * k)
    for i in range(200, 204):
        docs[i] = f"{sentence(rng, 60, 100000)} {short} {sentence(rng, 60, 100000)}"
    docs[300] = docs[301] = sentence(rng, 120, 100000)
    return docs, holders, short


@pytest.mark.parametrize("module", [chunks, suffixes])
def test_planted_passages(spark, planted, module):
    docs, holders, short = planted
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").withColumnRenamed("doc_id", "doc_id")
    found = module.repeated_passages(df)
    rows = found.collect()
    caught = {r.doc_id for r in rows}
    assert caught == {d for d, (_, first) in holders.items() if d != first} | {301}
    assert all(r.n_words >= 50 for r in rows)
    for r in rows:
        if r.doc_id in holders:
            assert r.keep_doc_id < r.doc_id and holders[r.keep_doc_id] == holders[r.doc_id]
            cut = " ".join(docs[r.doc_id].split()[r.start:r.stop])
            assert cut == " ".join(docs[r.keep_doc_id].split()[r.keep_start:r.keep_start + r.n_words])
            assert cut == holders[r.doc_id][0]
    left = {r.doc_id: r.text for r in module.without_repeats(df, found).collect()}
    assert len(left) == len(docs) and left[301] == "" and left[300] == docs[300]
    for d, text in docs.items():
        if d in holders and holders[d][1] != d:
            assert left[d].split() == text.replace(holders[d][0], " ").split()
        elif d != 301:
            assert left[d] == text
    assert all(short in left[i] for i in range(200, 204))


@pytest.mark.parametrize("module", [chunks, suffixes])
def test_edges(spark, edge_docs, no_docs, module):
    assert module.repeated_passages(no_docs).count() == 0
    found = module.repeated_passages(edge_docs)
    rows = found.collect()
    assert {r.doc_id for r in rows} == {51} and rows[0].n_words == 150_000 and rows[0].keep_doc_id == 50
    out = module.without_repeats(edge_docs, found)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    assert {r.text for r in out.where("doc_id = 51").collect()} == {""}
    assert out.where("doc_id is null and text is not null").count() == 1


def test_minimisers_cover_every_window():
    rng = np.random.default_rng(12)
    keys, doc = rng.integers(0, 2 ** 63, 500).astype(np.uint64), np.repeat([0, 1], [200, 300])
    at = suffixes.minimisers(keys, np.ones(500, bool), doc, 26)
    for i in range(500 - 25):
        if doc[i] == doc[i + 25]:
            assert i + int(keys[i:i + 26].argmin()) in at


def test_gear_depends_on_32_bytes():
    rng = np.random.default_rng(13)
    data = rng.integers(0, 256, 300).astype(np.uint8)
    h = 0
    for i, b in enumerate(data):
        h = ((h << 1) + int(chunks._GEAR[b])) % 2 ** 32
        assert h == int(chunks.gear(data)[i])


def test_matches_over_partition_borders(spark):
    rng = np.random.default_rng(17)
    digest = np.where(rng.random(3000) < 0.4, 7, rng.integers(0, 1500, 3000))
    rows = [(int(d), i // 3, i % 3, 1) for i, d in enumerate(digest)]
    first = {}
    for d, *place, _ in rows:
        first.setdefault(d, tuple(place))
    want = sorted((doc, pos, *first[d]) for d, doc, pos, _ in rows if first[d] != (doc, pos))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in ("1", "5", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = repeats.matched(spark.createDataFrame(rows, "digest long, doc_id long, pos long, size int").repartition(6)).collect()
        assert sorted((r.doc_id, r.pos, r.ref_doc, r.ref_pos) for r in got) == want
    spark.conf.set("spark.sql.shuffle.partitions", before)


def brute(docs, least=50):
    """Words of every document in a window of ``least`` words that stands earlier."""
    first, covered = {}, {}
    for d in sorted(docs):
        words = docs[d].split()
        for i in range(len(words) - least + 1):
            if first.setdefault(tuple(words[i:i + least]), (d, i)) != (d, i):
                covered.setdefault(d, set()).update(range(i, i + least))
    return covered


def agrees(spark, module, docs):
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    covered = {}
    for r in module.repeated_passages(df).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.start, r.stop))
        assert r.n_words >= 50 and (r.keep_doc_id, r.keep_start) < (r.doc_id, r.start)
        assert docs[r.doc_id].split()[r.start:r.stop] == docs[r.keep_doc_id].split()[r.keep_start:r.keep_start + r.n_words]
    assert covered == brute(docs)
    return covered


@pytest.mark.parametrize("module", [chunks, suffixes])
def test_exact_copy_behind_edited_ones(spark, module):
    rng = random.Random(21)
    docs = {}
    for k in range(8):
        p = sentence(rng, 60, 100000).split()
        docs[10 * k] = " ".join([*p[:36], "changed", *p[37:]])
        docs[10 * k + 1] = " ".join([*p[:24], "other", *p[25:]])
        docs[10 * k + 2] = docs[10 * k + 3] = " ".join(p)
    covered = agrees(spark, module, docs)
    assert set(covered) == {10 * k + 3 for k in range(8)} and all(len(c) == 60 for c in covered.values())


@pytest.mark.parametrize("module", [chunks, suffixes])
def test_texts_of_frequent_lines_equal_brute_force(spark, module):
    rng = random.Random(22)
    lines = [sentence(rng, rng.randrange(5, 30), 50) for _ in range(12)]
    docs = {i: "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 25))) for i in range(60)}
    assert agrees(spark, module, docs)


@pytest.mark.parametrize("module", [chunks, suffixes])
def test_passages_begun_in_an_earlier_text(spark, module):
    rng = random.Random(23)
    docs = {}
    for k in range(20):
        p = sentence(rng, 50 + k % 11, 100000).split()
        docs[10 * k] = " ".join([*p[:45], sentence(rng, 30, 100000)])
        for i in (1, 2):
            docs[10 * k + i] = " ".join([sentence(rng, 40, 100000), *p, sentence(rng, 40, 100000)])
    covered = agrees(spark, module, docs)
    assert set(covered) == {10 * k + 2 for k in range(20)}


@pytest.mark.parametrize("module", [chunks, suffixes])
def test_periodic_sections(spark, module):
    rng = random.Random(24)
    docs = {}
    for k, period in enumerate((1, 3, 7, 24, 26, 60)):
        part = (" ".join(sentence(rng, period, 100000) for _ in range(1)) + " ") * (1000 // period)
        for i in range(2):
            docs[10 * k + i] = f"{sentence(rng, 30, 100000)} {part}{sentence(rng, 30, 100000)}"
    covered = agrees(spark, module, docs)
    assert all(len(covered[10 * k + 1]) == 1000 // p * p for k, p in enumerate((1, 3, 7, 24, 26, 60)))


@pytest.mark.parametrize("module", [chunks, suffixes])
def test_passages_of_short_words(spark, module):
    rng = random.Random(25)
    docs = {}
    for k in range(60):
        size = 1 + k % 2
        word = lambda: "".join(rng.choice("abcdefghij0123456789") for _ in range(size))  # noqa: B023, E731
        passage = [word() for _ in range(50 + k % 11)]
        for i in range(2):
            docs[10 * k + i] = " ".join([sentence(rng, 30, 100000), *passage, sentence(rng, 30, 100000)])
    assert len(agrees(spark, module, docs)) == 60


@pytest.mark.parametrize("module", [chunks, suffixes])
def test_one_id_two_texts(spark, module):
    rng = random.Random(29)
    p, q, r = (sentence(rng, 60, 100000) for _ in range(3))
    a, b, c, e = (sentence(rng, 40, 100000) for _ in range(4))
    rows = [(1, f"{a} {p} {b}"), (5, f"{b} {p} {c}"), (5, f"{c} {q} {a}"), (5, f"{c} {q} {a}"), (5, f"{r} {a} {r}"), (7, f"{a} {q} {c}"),
            (8, f"{p} {e}"), (9, None), (9, "")] + [(10 + i, sentence(rng, 90, 100000)) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = module.repeated_passages(df)
    hashes = {t: h for t, h in df.selectExpr("text", "xxhash64(text)").collect()}
    texts = {h: t for t, h in hashes.items()}
    one = {d: t for d, t in rows if d not in (5, 9)}
    spans = []
    for f in found.collect():
        text, kept = (texts[h] if h is not None else one[d] for d, h in ((f.doc_id, f.text_hash), (f.keep_doc_id, f.keep_text_hash)))
        assert (f.text_hash is not None) == (f.doc_id == 5) and (f.keep_text_hash is not None) == (f.keep_doc_id == 5)
        assert 0 <= f.start and f.stop - f.start == f.n_words
        words = text.split()[f.start:f.stop]
        assert words == kept.split()[f.keep_start:f.keep_start + f.n_words]
        spans.append((text, " ".join(words)))
    assert sorted(spans) == sorted([(f"{b} {p} {c}", p), (f"{r} {a} {r}", r), (f"{a} {q} {c}", q), (f"{p} {e}", p)])
    left = sorted((d, t or "") for d, t in module.without_repeats(df, found).collect())
    want = {f"{b} {p} {c}": f"{b} {c}", f"{r} {a} {r}": f"{r} {a}", f"{a} {q} {c}": f"{a} {c}", f"{p} {e}": e}
    assert [(d, t.split()) for d, t in left] == [(d, t.split()) for d, t in sorted((d, want.get(t, t) or "") for d, t in rows)]


def test_many_texts_of_one_id_are_numbered(spark):
    df = spark.range(300).selectExpr("if(id < 200, 4L, id) doc_id", "concat('t ', id) text").union(spark.sql("select 4L, 't 0'"))
    got = repeats.shared_ids(df).orderBy("doc_id", "text_hash").collect()
    assert [r.copy for r in got] == list(range(200)) and {r.doc_id for r in got} == {4}

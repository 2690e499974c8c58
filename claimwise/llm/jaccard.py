"""Similarity join on word shingles by chosen paths, with exact verification.

Sets are split on tokens they share: at each level of each run a set of n shingles
follows every shingle whose hash is under ``1 / (threshold n)``, so that
similar sets follow a common shingle with a constant chance. Small buckets
are compared by brute force, on sketches; several runs make a miss unlikely, and
a capture-recapture audit of the runs adds further ones until the target
recall is met. What the buckets connect is verified on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimwise.llm.frames import components, deal_in_block_pairs, staged, stars, texts, whole_groups
from claimwise.llm.wordhash import Spans, grams, inside_text, mix, slices, span_hashes

_U = np.uint64
_MASK = _U((1 << 52) - 1)
LEVELS = 3
SKETCH = 64
_SEEDS = np.random.default_rng(77).integers(1, 1 << 63, 4096, dtype=np.uint64)


def shingle_sets(data: np.ndarray, off: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, one text after the other, and their bounds.

    A text of fewer words than a shingle has one shingle of all its words.
    """
    w = Spans(data, off)
    h = span_hashes(data, w.start, w.end)
    own = np.flatnonzero(inside_text(w, words))
    keys, docs = [grams(h, words)[own]], [w.doc[own]]
    length = np.diff(w.first)
    for few in range(1, words):
        short = np.flatnonzero(length == few)
        if len(short):
            keys.append(grams(h, few)[w.first[short]])
            docs.append(short)
    key, doc = np.concatenate(keys), np.concatenate(docs).astype(np.uint64)
    both = np.unique((doc << _U(52)) | (key & _MASK))
    bounds = np.searchsorted(both, np.arange(len(off), dtype=np.uint64) << _U(52))
    bounds[-1] = len(both)
    return mix(both & _MASK), bounds


def _describe(batches: Iterator[pa.RecordBatch], words: int, threshold: float, runs: range) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, off in slices(batch.column(1)):
            sets, bounds = shingle_sets(data, off, words)
            n = high - low
            size = np.diff(bounds)
            full = np.flatnonzero(size)
            begin = bounds[:-1][full]
            digest = np.zeros((2, n), np.uint64)
            sketch = np.zeros((n, SKETCH), np.uint16)
            doc = np.repeat(np.arange(n), size)
            limit = np.minimum(1.0 / (threshold * np.maximum(size, 1)), 1.0)
            limit = (limit * float(1 << 63)).astype(np.uint64)[doc] * _U(2) - _U(1)
            with np.errstate(over="ignore"):
                if len(full):
                    digest[0, full] = np.add.reduceat(mix(sets), begin)
                    digest[1, full] = np.add.reduceat(mix(sets ^ _U(0x5851F42D4C957F2D)), begin)
                    for k in range(SKETCH):
                        low_hash = np.minimum.reduceat((sets ^ _SEEDS[k]) * (_SEEDS[k + SKETCH] | _U(1)), begin)
                        sketch[full, k] = mix(low_hash) >> _U(48)
                run_at, level_at, token, where = [], [], [], []
                for run in runs:
                    for level in range(LEVELS):
                        seed = _SEEDS[(200 + (run * LEVELS + level) * 2) % 4096]
                        hashed = (sets ^ seed) * (_SEEDS[(201 + (run * LEVELS + level) * 2) % 4096] | _U(1))
                        hit = np.flatnonzero(hashed <= limit)
                        token.append(mix(sets[hit]))
                        where.append(doc[hit])
                        run_at.append(np.full(len(hit), run, np.int32))
                        level_at.append(np.full(len(hit), level, np.int8))
            where = np.concatenate(where)
            order = np.argsort(where, kind="stable")
            steps = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(run_at)[order]), pa.array(np.concatenate(level_at)[order]),
                 pa.array(np.concatenate(token)[order].view(np.int64))], ["run", "level", "token"])
            counts = np.concatenate([[0], np.cumsum(np.bincount(where, minlength=n))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, n), pa.array(digest[0].view(np.int64)), pa.array(digest[1].view(np.int64)),
                 pa.array(size.astype(np.int32)), pa.array([r.tobytes() for r in sketch], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(counts, pa.int32()), steps)],
                names=["doc_id", "d1", "d2", "n", "sketch", "steps"])


_DESCRIBED = ("doc_id long, d1 long, d2 long, n int, sketch binary, "
              "steps array<struct<run:int,level:tinyint,token:long>>")


def _buckets(sets: DataFrame, limit: int) -> DataFrame:
    """``bucket, run, doc_id, size``: the buckets of two or more sets in which the recursion ends."""
    steps = lambda level: F.filter("steps", lambda s: s["level"] == level)
    now = sets.select("doc_id", F.explode(steps(0)).alias("s")).select(
        "doc_id", F.col("s.run").alias("run"), F.xxhash64("s.run", "s.token").alias("bucket"))
    done = []
    for level in range(LEVELS):
        # written, so that the join is on two shuffles of its own and a large bucket can be split
        sizes = staged(now.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
        sized = staged(now.join(sizes, "bucket"), "buckets")
        if level == LEVELS - 1:
            done.append(sized)
            break
        done.append(sized.where(F.col("size") <= limit))
        large = sized.where(F.col("size") > limit).drop("size")
        now = (large.join(sets.select("doc_id", steps(level + 1).alias("steps")), "doc_id")
               .select("doc_id", "run", "bucket", F.explode(F.filter("steps", lambda s: s["run"] == F.col("run"))).alias("s"))
               .select("doc_id", "run", F.xxhash64("bucket", "s.token").alias("bucket")))
    return reduce(DataFrame.unionByName, done)


def _compare(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Star edges among the sets of each bucket whose sketches agree in ``least`` of their places."""
    for table, bounds in whole_groups(batches, ["bucket", "lo", "hi"]):
        ids, run = table["doc_id"].to_numpy(), table["run"].to_numpy()
        side = table["side"].to_numpy()
        sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint16).reshape(-1, SKETCH)
        us, vs, runs = [], [], []
        size = np.diff(bounds)
        two = bounds[:-1][size == 2]
        near = (sketch[two] == sketch[two + 1]).mean(axis=1) >= least
        two = two[near]
        us.append(ids[two])
        vs.append(ids[two + 1])
        runs.append(run[two])
        for a, b in zip(bounds[:-1][size > 2], bounds[1:][size > 2]):
            part = sketch[a:b]
            pairs = []
            rows = np.flatnonzero(side[a:b] == 0)
            others = np.arange(b - a) if table["lo"][a].as_py() == table["hi"][a].as_py() else np.flatnonzero(side[a:b] == 1)
            for i in rows:
                j = others[(part[others] == part[i]).mean(axis=1) >= least]
                pairs.append(np.column_stack([np.full(len(j), i), j]))
            root = stars(np.concatenate(pairs) if pairs else np.zeros((0, 2), int), b - a)
            moved = np.flatnonzero(root != np.arange(b - a))
            us.append(ids[a:b][moved])
            vs.append(ids[a:b][root[moved]])
            runs.append(run[a:b][moved])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (us, vs, runs)], names=["u", "v", "run"])


def _verify(batches: Iterator[pa.RecordBatch], words: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Per set its number of links inside a block pair (copies counted), and star edges of linked sets."""
    for table, bounds in whole_groups(batches, ["root", "lo", "hi"]):
        ids, copies = table["doc_id"].to_numpy(), table["copies"].to_numpy()
        side, lo, hi = (table[c].to_numpy() for c in ("side", "lo", "hi"))
        us, vs, links = [], [], []
        for a, b in zip(bounds[:-1], bounds[1:]):
            m = b - a
            sets, edge = [], [0]
            for _, _, data, off in slices(table["text"].slice(a, m).combine_chunks()):
                own, at = shingle_sets(data, off, words)
                sets.append(own)
                edge.extend((edge[-1] + at[1:]).tolist())
            token, where = np.concatenate(sets), np.repeat(np.arange(m), np.diff(edge))
            n = np.diff(edge)
            order = np.argsort(token, kind="stable")
            token, where = token[order], where[order]
            first = np.concatenate([[True], token[1:] != token[:-1]])
            number = np.cumsum(first) - 1
            shared = np.bincount(number)[number] > 1
            number, where = np.unique(number[shared], return_inverse=True)[1], where[shared]
            common = np.zeros((m, m), np.float32)
            for start in range(0, int(number.max(initial=-1)) + 1, 4096):
                inside = slice(np.searchsorted(number, start), np.searchsorted(number, start + 4096))
                x = np.zeros((m, 4096), np.float32)
                x[where[inside], number[inside] - start] = 1
                common += x @ x.T
            both = n[:, None] + n[None, :] - common
            near = (common >= threshold * both - 1e-6) & (both > 0)
            np.fill_diagonal(near, False)
            if lo[a] != hi[a]:
                near &= side[a:b][:, None] != side[a:b][None, :]
            root = stars(np.argwhere(near), m)
            us.append(ids[a:b])
            vs.append(ids[a:b][root])
            links.append(near @ copies[a:b])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (us, vs, links)], names=["u", "v", "links"])


def _candidates(sets: DataFrame, limit: int, block: int, least: float) -> DataFrame:
    """Edges ``u, v, run`` between sets whose sketches agree inside a common bucket."""
    leaves = _buckets(sets, limit).join(sets.select("doc_id", "sketch"), "doc_id")
    dealt = deal_in_block_pairs(leaves, "bucket", "doc_id", F.col("size"), block)
    keys = ["bucket", "lo", "hi"]
    return (dealt.select("bucket", "lo", "hi", "side", "run", "doc_id", "sketch").repartition(*[F.col(k) for k in keys])
            .sortWithinPartitions(*keys).mapInArrow(lambda it: _compare(it, least), "u long, v long, run int"))


def _recall(edges: DataFrame) -> float:
    """Capture-recapture over the sets linked by even and by odd runs."""
    seen = (edges.select(F.explode(F.array("u", "v")).alias("doc"), (F.col("run") % 2 + 1).alias("half"))
            .groupBy("doc").agg(F.bit_or("half").alias("halves")).groupBy("halves").count())
    n = {r["halves"]: r["count"] for r in seen.collect()}
    even, odd, both = n.get(1, 0), n.get(2, 0), n.get(3, 0)
    return (even + odd + both) * both / ((even + both) * (odd + both)) if both else float(not (even or odd))


def jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, threshold: float = 0.8,
    runs: int = 12, target: float = 0.99, bucket: int = 64, block: int = 1024, most_rounds: int = 5,
) -> DataFrame:
    """One row per document: ``doc_id, class_id, set_id, n_links, kept``.

    Two documents are linked when the Jaccard similarity of their sets of ``words``-word
    shingles is ``threshold`` or more. ``n_links`` counts the linked documents, copies
    included; ``class_id`` is the smallest id reachable by links, ``set_id`` the
    smallest with the same set, and ``kept`` marks that class's smallest id.

    Equal sets are joined by digest first, and only one of each goes on. Large
    groups are dealt in pairs of blocks of about ``block`` sets, so no task and no
    row holds a whole group, and pairs are counted but never written out. Texts
    without a word (null, empty) link with nothing and are kept; rows without id
    have no class and are kept; repeated rows of an id count as one more copy
    each. Other columns are ignored. After each ``runs`` runs the audit decides about
    more, up to ``most_rounds`` times; a join that has not reached the ``target`` by then is an error.
    """
    rows = texts(docs, id_col, text_col)
    candidates, described = None, None
    for turn in range(most_rounds):
        taken = range(turn * runs, (turn + 1) * runs)
        fresh = staged(rows.where("doc_id is not null").mapInArrow(
            lambda it, taken=taken: _describe(it, words, threshold, taken), _DESCRIBED), "shingles")
        if described is None:
            described = fresh
            classes = staged(described.where("n > 0").groupBy("d1", "d2").agg(
                F.min("doc_id").alias("set_id"), F.count(F.lit(1)).alias("copies")), "classes")
        sets = staged(fresh.drop("d1", "d2").join(classes.select(F.col("set_id").alias("doc_id")).distinct(), "doc_id")
                      .dropDuplicates(["doc_id"]), "sets")
        found = staged(_candidates(sets, bucket, block, threshold - 0.25), "candidates")
        candidates = found if candidates is None else candidates.unionByName(found)
        recall = _recall(candidates)
        if recall >= target:
            break
    else:
        raise RuntimeError(f"recall is {recall:.4f} of {target} after {most_rounds * runs} runs; allow more with most_rounds")
    groups = staged(components(candidates.select("u", "v")), "groups")
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    members = (groups.join(sizes, "root").withColumnRenamed("node", "doc_id")
               .join(classes.groupBy(F.col("set_id").alias("doc_id")).agg(F.sum("copies").alias("copies")), "doc_id"))
    sourced = rows.join(members, "doc_id").dropDuplicates(["doc_id"])
    keys = ["root", "lo", "hi"]
    verified = staged(
        deal_in_block_pairs(sourced, "root", "doc_id", F.col("size"), block)
        .select("root", "lo", "hi", "side", "doc_id", "copies", "text").repartition(*[F.col(k) for k in keys])
        .sortWithinPartitions(*keys).mapInArrow(lambda it: _verify(it, words, threshold), "u long, v long, links long"), "links")
    links = verified.groupBy(F.col("u").alias("set_id")).agg(F.sum("links").alias("links"))
    linked = components(verified.where("u <> v").select("u", "v")).select(F.col("node").alias("set_id"), "root")
    known = classes.join(links, "set_id", "left").join(linked, "set_id", "left").select(
        "d1", "d2", "set_id", F.coalesce("root", "set_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    worded = described.where("n > 0").select("doc_id", "d1", "d2").join(known, ["d1", "d2"]).select("doc_id", "class_id", "set_id", "n_links")
    alone = described.where("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("set_id"), F.lit(0).cast("long").alias("n_links"))
    nameless = rows.where("doc_id is null").select("doc_id", *[F.lit(None).cast("long").alias(c) for c in ("class_id", "set_id")], F.lit(0).cast("long").alias("n_links"))
    return worded.unionByName(alone).unionByName(nameless).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))

"""Near copies of embeddings: navigable small-world graphs per shard, audited beams, components."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from claimwise.llm.frames import components, staged


class Graph:
    """A hierarchical navigable small-world graph over unit vectors, by dot product."""

    def __init__(self, vectors: np.ndarray, links: int = 12, beam: int = 64, seed: int = 1):
        self.x, self.links = vectors, links
        n = len(vectors)
        levels = np.minimum((-np.log(np.random.default_rng(seed).random(n) + 1e-12) / np.log(links)).astype(int), 8)
        self.near = [np.full((n, 2 * links), -1, np.int32)]
        self.near += [{} for _ in range(int(levels.max(initial=0)))]
        self.count = np.zeros(n, np.int32)
        self.seen, self.tag = np.zeros(n, np.int64), 0
        self.entry, self.top = 0, int(levels[0]) if n else 0
        for level in range(1, self.top + 1):
            self.near[level][0] = np.zeros(0, np.int64)
        for i in range(1, n):
            self._insert(i, int(levels[i]), beam)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("x", "seen")}

    def open(self, vectors: np.ndarray) -> "Graph":
        """The graph again over its vectors, after it was stored without them."""
        self.x, self.seen, self.tag = vectors, np.zeros(len(vectors), np.int64), 0
        return self

    def _of(self, node: int, level: int) -> np.ndarray:
        return self.near[0][node, :self.count[node]] if level == 0 else self.near[level][node]

    def _set(self, node: int, level: int, ids: np.ndarray) -> None:
        if level == 0:
            self.near[0][node, :len(ids)] = ids
            self.count[node] = len(ids)
        else:
            self.near[level][node] = ids

    def _search(self, q: np.ndarray, entry: list[tuple[float, int]], beam: int, level: int) -> list[tuple[float, int]]:
        """The ``beam`` nearest nodes found, nearest first."""
        self.tag += 1
        seen, tag = self.seen, self.tag
        heap, best = [], []
        for s, node in entry:
            seen[node] = tag
            heap.append((-s, node))
            best.append((s, node))
        heapq.heapify(heap)
        heapq.heapify(best)
        while heap:
            s, node = heapq.heappop(heap)
            if -s < best[0][0] and len(best) >= beam:
                break
            around = self._of(node, level)
            around = around[seen[around] != tag]
            if not len(around):
                continue
            seen[around] = tag
            for t, other in zip((self.x[around] @ q).tolist(), around.tolist()):
                if len(best) < beam:
                    heapq.heappush(best, (t, other))
                    heapq.heappush(heap, (-t, other))
                elif t > best[0][0]:
                    heapq.heapreplace(best, (t, other))
                    heapq.heappush(heap, (-t, other))
        return sorted(best, reverse=True)

    def _choose(self, found: list[tuple[float, int]], most: int) -> np.ndarray:
        """Neighbours nearer to the node than to each other first, then the nearest of the rest."""
        ids = np.array([node for _, node in found])
        sims = np.array([s for s, _ in found])
        if len(ids) <= most:
            return ids
        between = self.x[ids] @ self.x[ids].T
        chosen, rest = [], []
        for i in range(len(ids)):
            (chosen if not chosen or between[i, chosen].max() < sims[i] else rest).append(i)
            if len(chosen) == most:
                break
        return ids[(chosen + rest)[:most]]

    def _insert(self, i: int, level: int, beam: int) -> None:
        q = self.x[i]
        entry = [(float(self.x[self.entry] @ q), self.entry)]
        for up in range(self.top, level, -1):
            entry = self._search(q, entry, 1, up)
        for now in range(min(level, self.top), -1, -1):
            entry = self._search(q, entry, beam, now)
            most = 2 * self.links if now == 0 else self.links
            own = self._choose(entry, self.links)
            self._set(i, now, own)
            for other in own.tolist():
                around = np.append(self._of(other, now), i)
                if len(around) > most:
                    sims = self.x[around] @ self.x[other]
                    order = np.argsort(-sims)
                    around = self._choose(list(zip(sims[order].tolist(), around[order].tolist())), most)
                self._set(other, now, around)
        for now in range(self.top + 1, level + 1):
            self.near[now][i] = np.zeros(0, np.int64)
        if level > self.top:
            self.top, self.entry = level, i

    def within(self, q: np.ndarray, least: float, beam: int) -> np.ndarray:
        """Nodes found with a dot product of ``least`` or more; the beam doubles while it holds nothing else."""
        entry = [(float(self.x[self.entry] @ q), self.entry)]
        for up in range(self.top, 0, -1):
            entry = self._search(q, entry, 1, up)
        while True:
            found = self._search(q, entry, beam, 0)
            if len(found) < beam or found[-1][0] < least:
                return np.array([node for s, node in found if s >= least], np.int64)
            beam *= 2


_VECTORS = "vec_id long, label string, dim int, copies long, unit binary"


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Normalised vectors in double precision; null for vectors that link with nothing."""
    for batch in batches:
        dims, units = [], []
        for v in batch.column("vector"):
            unit = None
            if v.is_valid and len(v) and not v.values.null_count:
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all() and x.any():
                    x = x / np.abs(x).max()
                    unit = x / np.linalg.norm(x)
            dims.append(0 if unit is None else len(unit))
            units.append(None if unit is None else unit.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(units, pa.binary())],
                                         names=["vec_id", "label", "dim", "unit"])


def _matrix(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def _build(table: pa.Table, links: int, beam: int) -> pa.Table:
    table = table.sort_by("vec_id")
    vectors = _matrix(table["unit"].to_pylist())
    first = {c: table[c][0].as_py() for c in ("label", "dim", "shard")}
    return pa.table({**{c: [v] for c, v in first.items()}, "ids": [table["vec_id"].to_numpy().tobytes()],
                     "vectors": [vectors.tobytes()], "graph": [pickle.dumps(Graph(vectors, links, beam))]},
                    schema=pa.schema([("label", pa.string()), ("dim", pa.int32()), ("shard", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()), ("graph", pa.binary())]))


def _block(table: pa.Table) -> pa.Table:
    table = table.sort_by("vec_id")
    return pa.table({"label": [table["label"][0].as_py()], "dim": [table["dim"][0].as_py()],
                     "block": [table["block"][0].as_py()], "asked": [table["vec_id"].to_numpy().tobytes()], "queries": [b"".join(table["unit"].to_pylist())]},
                    schema=pa.schema([("label", pa.string()), ("dim", pa.int32()), ("block", pa.int32()), ("asked", pa.binary()), ("queries", pa.binary())]))


def _audit(ids: np.ndarray, vectors: np.ndarray, asked: np.ndarray, queries: np.ndarray, least: float, sample: int, evidence: int) -> list[tuple[int, np.ndarray]]:
    """Queries with their true links to other vectors, by brute force: ``sample`` of them, and twice as many until they have ``evidence`` links.

    Without so many links all queries are compared, and then no link is missing from the audit. The order does not follow the ids.
    """
    order, done, links, out = np.random.default_rng(len(asked)).permutation(len(asked)), 0, 0, []
    while done < len(order) and links < evidence:
        part = order[done:done + max(sample, done)]
        near = (queries[part] @ vectors.T >= least) & (ids[None, :] != asked[part][:, None])
        out += [(int(part[i]), np.flatnonzero(near[i])) for i in np.flatnonzero(near.any(axis=1))]
        links, done = links + int(near.sum()), done + len(part)
    return out


def _query(batches: Iterator[pa.RecordBatch], least: float, beam: int, audit: int, evidence: int, target: float) -> Iterator[pa.RecordBatch]:
    """Links of every query of a block in one shard, as lists of partners with a larger or smaller id."""
    for batch in batches:
        for i in range(batch.num_rows):
            dim = batch.column("dim")[i].as_py()
            ids, vectors, asked, queries = (np.frombuffer(batch.column(c)[i].as_py(), kind) for c, kind in
                                            (("ids", np.int64), ("vectors", np.float64), ("asked", np.int64), ("queries", np.float64)))
            vectors, queries = vectors.reshape(-1, dim), queries.reshape(-1, dim)
            # written by _build of the same job
            graph = pickle.loads(batch.column("graph")[i].as_py()).open(vectors)
            true = _audit(ids, vectors, asked, queries, least, audit, evidence)
            width = beam
            while true and width < len(ids):
                # every query counts alike, so that a large group does not hide others
                if np.mean([len(np.intersect1d(graph.within(queries[j], least, width), e)) / len(e) for j, e in true]) >= target:
                    break
                width *= 2
            for low in range(0, len(asked), 256):
                us, vs = [], []
                for j in range(low, min(low + 256, len(asked))):
                    q = queries[j]
                    found = graph.within(q, least, width) if width < len(ids) else np.flatnonzero(vectors @ q >= least)
                    found = ids[found[vectors[found] @ q >= least]]
                    us.append(int(asked[j]))
                    vs.append(found[found != asked[j]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(us, pa.int64()), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(v) for v in vs])]), pa.int32()),
                                                                        pa.array(np.concatenate(vs), pa.int64()))], names=["u", "vs"])


def near_copies(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.93,
    shard: int = 8192, block: int = 2048, links: int = 12, build_beam: int = 64, beam: int = 32, audit: int = 32,
    evidence: int = 64, target: float = 0.99,
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors of one label and length are linked by a cosine of ``least`` or more in double
    precision. Equal unit vectors of a label are one, counted as copies. Each label is dealt by
    hash into shards of about ``shard`` vectors with a graph each, stored once, and
    blocks of about ``block`` queries; every block searches every shard of its label. In each such
    pair ``audit`` queries, and more until ``evidence`` links to other vectors are seen or all are taken, are compared with
    brute force, and the beam doubles until ``target`` of their links are found on average over these queries, at last by comparing all.

    Null, zero and non-finite vectors, and null labels, link with nothing: 0 links,
    their own component, kept. A null id has a null component, and is kept. Repeated rows
    count as copies. Other columns are ignored.
    """
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    all_rows = staged(rows.mapInArrow(_unit, "vec_id long, label string, dim int, unit binary"), "units")
    good = F.col("unit").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    keyed = all_rows.where(good).withColumn("digest", F.sha2("unit", 256))
    classes = staged(keyed.groupBy("label", "dim", "digest").agg(F.min("vec_id").alias("set_id"), F.count(F.lit(1)).alias("copies")), "classes")
    sets = staged(keyed.join(classes, ["label", "dim", "digest"]).where("vec_id = set_id").select("label", "dim", "vec_id", "unit")
                  .dropDuplicates(["label", "dim", "vec_id"]), "sets")
    sizes = sets.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))

    def part(size: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("n") / size)).cast("int")

    sized = sets.join(F.broadcast(sizes) if sizes.count() <= 100_000 else sizes, ["label", "dim"])
    graphs = staged(sized.withColumn("shard", part(shard)).drop("n").groupBy("label", "dim", "shard").applyInArrow(
        lambda t: _build(t, links, build_beam), "label string, dim int, shard int, ids binary, vectors binary, graph binary"), "graphs")
    asked = staged(sized.withColumn("block", part(block)).drop("n").groupBy("label", "dim", "block").applyInArrow(
        _block, "label string, dim int, block int, asked binary, queries binary"), "blocks")
    found = staged(asked.join(graphs.hint("merge"), ["label", "dim"]).repartition(F.col("label"), F.col("dim"), F.col("shard"), F.col("block"))
                   .mapInArrow(lambda it: _query(it, least, beam, audit, evidence, target), "u long, vs array<long>"), "links")
    pairs = found.select("u", F.explode("vs").alias("v"))
    edges = staged(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    copies = classes.groupBy(F.col("set_id").alias("v")).agg(F.sum("copies").alias("copies"))
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    degree = both.join(copies, "v").groupBy(F.col("u").alias("set_id")).agg(F.sum("copies").alias("others"))
    roots = components(edges).withColumnRenamed("node", "set_id")
    known = classes.join(degree, "set_id", "left").join(roots, "set_id", "left").select(
        "label", "dim", "digest", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "set_id").alias("component_id"))
    linked = keyed.select("vec_id", "label", "dim", "digest").join(known, ["label", "dim", "digest"]).select("vec_id", "n_links", "component_id")
    alone = all_rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

"""Ranked lexical search: shared term sets of many queries are summed once a document, then combined."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from claimwise.llm.frames import staged, texts
from claimwise.llm.wordhash import Spans, byte_class, slices, span_hashes

#: Bytes of ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+`` once A-Z are lower case.
TERM = byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Terms of items that one pass over the documents serves; more items take more passes.
PASS_TERMS = 250_000
_CELLS = 4_000_000
_SALTS = 64


def terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of the texts, and the bounds of each text."""
    data = _LOWER[data]
    w = Spans(data, off, TERM)
    return span_hashes(data, w.start, w.end), w.first


def counted(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, value, times)`` of the distinct values of each text, in order of both."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], values[at], np.diff(np.append(at, len(values)))


class Plan(NamedTuple):
    """A query-sharing graph over term sets.

    ``vocabulary`` holds sorted term hashes. Entry ``leaf_at[t]:leaf_at[t + 1]`` of ``leaf_node`` and
    ``leaf_times`` says to which sets term t counts and how often. Node i from ``sets`` on is
    the sum of ``left[i - sets]`` and ``right[i - sets]``; ``levels`` bounds runs of nodes that only
    need earlier ones. Item j is the sum of the nodes ``parts[part_at[j]:part_at[j + 1]]``.
    """

    vocabulary: np.ndarray
    leaf_at: np.ndarray
    leaf_node: np.ndarray
    leaf_times: np.ndarray
    sets: int
    left: np.ndarray
    right: np.ndarray
    levels: list[int]
    parts: np.ndarray
    part_at: np.ndarray

    @property
    def nodes(self) -> int:
        return self.sets + len(self.left)


def share(items: list[dict[int, int]]) -> Plan:
    """The graph for ``items``, each a map of term hash to times.

    Terms that stand as often in exactly the same items are one set. Each item lists its sets,
    frequent ones first, and neighbours that are neighbours in several items become a node of their
    own, round by round, until no pair is shared.
    """
    where: dict[tuple[int, int], list[int]] = {}
    for number, item in enumerate(items):
        for entry in item.items():
            where.setdefault(entry, []).append(number)
    alike: dict[tuple[int, ...], list[tuple[int, int]]] = {}
    for entry in sorted(where):
        alike.setdefault(tuple(where[entry]), []).append(entry)
    lists: list[list[int]] = [[] for _ in items]
    leaves = []
    for node, (owners, entries) in enumerate(sorted(alike.items(), key=lambda a: (-len(a[0]), a[0]))):
        for number in owners:
            lists[number].append(node)
        leaves += [(term, node, times) for term, times in entries]
    sets, pairs, depth = len(alike), [], [0] * len(alike)
    while True:
        seen = Counter(pair for own in lists for pair in set(zip(own, own[1:])))
        taken: set[int] = set()
        made: dict[tuple[int, int], int] = {}
        for pair, times in sorted(seen.items(), key=lambda s: (-s[1], s[0])):
            if times > 1 and not taken & set(pair):
                taken |= set(pair)
                made[pair] = sets + len(pairs)
                depth.append(max(depth[pair[0]], depth[pair[1]]) + 1)
                pairs.append(pair)
        if not made:
            break
        for number, own in enumerate(lists):
            out, i = [], 0
            while i < len(own):
                node = made.get((own[i], own[i + 1])) if i + 1 < len(own) else None
                out.append(own[i] if node is None else node)
                i += 1 if node is None else 2
            lists[number] = out
    # nodes in order of depth, so that each level reads earlier ones only
    order = sorted(range(sets, sets + len(pairs)), key=lambda n: (depth[n], n))
    name = {n: n for n in range(sets)} | {n: sets + i for i, n in enumerate(order)}
    levels = [i for i, n in enumerate(order) if i == 0 or depth[n] != depth[order[i - 1]]] + [len(order)]
    leaves.sort()
    vocabulary = np.array(sorted({t for t, _, _ in leaves}), np.uint64)
    return Plan(
        vocabulary, np.searchsorted(np.array([t for t, _, _ in leaves], np.uint64), np.append(vocabulary, np.uint64(2 ** 64 - 1)), "left"),
        np.array([n for _, n, _ in leaves], np.int64), np.array([k for _, _, k in leaves], np.int64), sets,
        np.array([name[pairs[n - sets][0]] for n in order], np.int64), np.array([name[pairs[n - sets][1]] for n in order], np.int64), levels,
        np.array([name[n] for own in lists for n in own], np.int64), np.concatenate([[0], np.cumsum([len(own) for own in lists])]).astype(np.int64))


def accumulate(plan: Plan, text: np.ndarray, term: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    """Scores of ``size`` texts, a row per item, from ``value`` of every (text, term) posting."""
    reach = plan.leaf_at[term + 1] - plan.leaf_at[term]
    at = np.arange(int(reach.sum())) - np.repeat(np.cumsum(reach) - reach, reach) + np.repeat(plan.leaf_at[term], reach)
    total = np.zeros((plan.nodes, size), np.int64)
    np.add.at(total, (plan.leaf_node[at], np.repeat(text, reach)), np.repeat(value, reach) * plan.leaf_times[at])
    for low, high in zip(plan.levels, plan.levels[1:]):
        total[plan.sets + low:plan.sets + high] = total[plan.left[low:high]] + total[plan.right[low:high]]
    out = np.zeros((len(plan.part_at) - 1, size), np.int64)
    full = np.flatnonzero(np.diff(plan.part_at))
    if len(full):
        out[full] = np.add.reduceat(total[plan.parts], plan.part_at[full], axis=0)
    return out


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, _, data, off in slices(batch.column(1)):
            text, value, times = counted(*terms(data, off))
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column(0).to_numpy()[low:][text]), pa.array(value.view(np.int64)), pa.array(times)], names=["item", "term", "times"])


_POSTINGS = "doc_id long, n long, terms array<int>, tf array<long>"


def _postings(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Texts with a term: their number of terms, and the places of those of the vocabulary with their counts."""
    for batch in batches:
        for low, high, data, off in slices(batch.column(1)):
            hashes, first = terms(data, off)
            at = np.minimum(np.searchsorted(vocabulary, hashes), max(0, len(vocabulary) - 1))
            known = np.flatnonzero(vocabulary[at] == hashes) if len(vocabulary) else np.zeros(0, np.int64)
            text, term, times = counted(at[known], np.searchsorted(known, first))
            bounds = pa.array(np.searchsorted(text, np.arange(high - low + 1)).astype(np.int32))
            n = np.diff(first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, high - low), pa.array(n), pa.ListArray.from_arrays(bounds, pa.array(term.astype(np.int32))),
                 pa.ListArray.from_arrays(bounds, pa.array(times))], names=["doc_id", "n", "terms", "tf"]).filter(pa.array(n > 0))


class Best:
    """The ``k`` best texts of each item so far; equal scores by smaller id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.ones(items, np.int64)
        self.rows = [np.zeros((0, 4), np.int64)]

    def add(self, score: np.ndarray, doc: np.ndarray, missing: np.ndarray) -> None:
        item, text = np.nonzero(score >= self.least[:, None])
        self.rows.append(np.column_stack([item, -score[item, text], missing[text], doc[text]]))
        if sum(map(len, self.rows)) > 4 * self.k * len(self.least):
            self.prune()

    def prune(self) -> np.ndarray:
        rows = np.concatenate(self.rows)
        rows = rows[np.lexsort(rows.T[::-1])]
        first = np.searchsorted(rows[:, 0], np.arange(len(self.least) + 1))
        rows = rows[np.arange(len(rows)) - first[rows[:, 0]] < self.k]
        self.rows = [rows]
        last = np.searchsorted(rows[:, 0], np.arange(len(self.least)), "right")
        full = np.diff(np.append(0, last)) == self.k
        self.least[full] = -rows[last[full] - 1, 1]
        return rows


def _best(batches: Iterator[pa.RecordBatch], plan: Plan, weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> Iterator[pa.RecordBatch]:
    best = Best(len(plan.part_at) - 1, k)
    step = max(16, _CELLS // max(1, plan.nodes))
    for batch in batches:
        for low in range(0, batch.num_rows, step):
            part = batch.slice(low, step)
            docs, sizes = part.column(0), part.column(1).to_numpy()
            reach = part.column(2).value_lengths().to_numpy()
            text, term, tf = np.repeat(np.arange(part.num_rows), reach), part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy()
            m = 100 - 25 + (25 * sizes * n_docs) // max(1, n_terms)
            value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[text]))
            best.add(accumulate(plan, text, term, value, part.num_rows), docs.fill_null(0).to_numpy(), docs.is_null().to_numpy(zero_copy_only=False).astype(np.int64))
    rows = best.prune()
    yield pa.RecordBatch.from_arrays(
        [pa.array(rows[:, 0].astype(np.int32)), pa.array(rows[:, 3], pa.int64(), mask=rows[:, 2] > 0), pa.array(-rows[:, 1])], names=["number", "doc_id", "score"])


def _one_pass(rows: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``item, doc_id, score`` for items whose terms fit one pass; up to ``k`` rows an item and task."""
    entries = wanted.orderBy("item", "term").toArrow()  # bounded by PASS_TERMS
    item, start = np.unique(entries["item"].to_numpy(), return_index=True)
    term, times = entries["term"].to_numpy().view(np.uint64).tolist(), entries["times"].to_numpy().tolist()
    ends = np.append(start, len(term)).tolist()
    plan = share([dict(zip(term[a:b], times[a:b])) for a, b in zip(ends, ends[1:])])
    postings = staged(rows.mapInArrow(lambda it: _postings(it, plan.vocabulary), _POSTINGS), "postings")
    n_docs, n_terms = postings.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(plan.vocabulary), np.int64)
    for place, n in postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most one row a term of the pass
        df[place] = n
    weight = np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)
    names = rows.sparkSession.createDataFrame([(i, int(x)) for i, x in enumerate(item)], "number int, item long")
    found = postings.select("doc_id", "n", "terms", "tf").mapInArrow(
        lambda it: _best(it, plan, weight, n_docs, n_terms, k), "number int, doc_id long, score long")
    return found.join(F.broadcast(names), "number").select("item", "doc_id", "score")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", pass_terms: int = PASS_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item, all of them if fewer score above 0.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z lowered. The score sums, over the
    terms of the item with repeats, ``w * (10^9 tf div (1000 tf + 12 m))`` with ``w =
    floor(1000 ln((2N + 2) / (2 df + 1)))`` and ``m = 75 + 25 n N div L``, in 64-bit integers but for w.

    Term sets that several items share are mined first; a document sums each set once, and items add up sets along
    the graph. Documents are cut into terms once a pass and keep only terms of the items; every task keeps
    ``k`` rows an item, which are ranked in two steps. One pass serves items of
    about ``pass_terms`` terms together, which bounds what goes through the driver and to
    the tasks (one item alone may be longer); more items take more passes over the documents.

    Null, empty and blank texts have no term and no rank, nor do items without one; long texts are
    counted whole; equal scores go by smaller doc_id, null ids last; repeated rows of documents
    are ranked each; equal rows of items are one, different texts under one item_id
    are ranked each by itself; empty tables give no row; other columns are ignored. Terms are compared by 64-bit hashes.
    """
    rows = texts(docs, id_col, text_col)
    keyed = staged(items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text")).distinct()
                   .withColumn("item", F.monotonically_increasing_id()), "items")
    entries = staged(keyed.select("item", "text").mapInArrow(_item_terms, "item long, term long, times long"), "item-terms")
    passes = max(1, -(-entries.count() // pass_terms))
    number = F.pmod(F.xxhash64("item"), F.lit(passes))
    found = None
    for p in range(passes):
        one = _one_pass(rows, entries.where(number == p), k)
        found = one if found is None else found.unionByName(one)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(_SALTS)))
    some = salted.withColumn("at", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("at") <= k)
    top = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return top.join(keyed.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms FROM documents),
s AS (SELECT count(*) AS big_n, sum(len(terms))::BIGINT AS big_l FROM d WHERE len(terms) > 0),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark),
w AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(big_n) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
  FROM p CROSS JOIN s WHERE term IN (SELECT term FROM q) GROUP BY term),
t AS (
  SELECT q.item_id, d.doc_id, d.r, sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * len(d.terms) * s.big_n) // s.big_l))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN d ON d.r = p.r CROSS JOIN s GROUP BY q.item_id, d.doc_id, d.r),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM t WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 20
"""

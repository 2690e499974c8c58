"""Random regression forests from histograms of bins: blocks of rows, exact sums, one round a level.

MLlib sends the statistics of every open node of every tree from every partition. Here rows are binned once into bounded blocks; a task
takes one block and some of the trees, and of two sister nodes counts the smaller one only: the other is their parent less that one.
Places that never meet in a row, such as the levels of a column, share a code, and codes share bytes: a row is a few bytes, and counts of
the values of a byte give those of all its bins.
Where all rows fit one block its tasks grow their trees to the end, else the counts of the blocks meet tree by tree, level by level.
Labels are summed as integers, so no sum hangs on the order of rows, blocks or tasks: one seed gives one forest on any cluster.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.linalg import SparseVector
from pyspark.sql import Column, DataFrame, functions as F, types as T

from claimwise.session import stage

#: Most bytes of the rows of a block, and the rows a task counts at a time.
BLOCK_BYTES = 256_000_000
PIECE_ROWS = 1 << 20
#: Most nodes times sets of forests that are counted at once.
MOST_SHARED = 1024
#: Rows that make a block worth a task of its own where one block does not hold them all.
SHARE_ROWS = 1_000_000
#: Points of a place's sketch, from which its borders are taken.
POINTS = 1024
#: A draw of a row is below the n-th limit with the chance that Poisson(1) is at most n.
_LIMITS = np.array([min(2 ** 32 - 1, round(2 ** 32 * sum(math.exp(-1) / math.factorial(i) for i in range(n + 1)))) for n in range(11)], np.uint64)
#: Times by the upper half of a draw; 255 where a limit lies inside.
_TIMES = (np.arange(65_536, dtype=np.uint64)[:, None] << np.uint64(16) >= _LIMITS).sum(axis=1).astype(np.uint8)
_TIMES[(_LIMITS >> np.uint64(16)).astype(np.int64)] = 255


class Bins:
    """Borders of every place; a value's bin is the number of borders below it. Bins of all places stand in one row.

    ``before`` is, per place, the last one left of it that is not zero in one row together with it, else -1.
    """

    def __init__(self, borders: list[np.ndarray], before: np.ndarray):
        self.borders, self.before, self.places = borders, before, len(borders)
        counts = np.array([len(b) + 1 for b in borders], np.int64)
        self.offset = np.cumsum(counts) - counts
        self.size = int(counts.sum())
        self.of_bin = np.repeat(np.arange(self.places), counts)
        self.last = np.zeros(self.size, bool)
        self.last[self.offset + counts - 1] = True
        self.home = np.array([np.searchsorted(b, 0.0) for b in borders], np.int64)
        self.first = np.array([b[0] if len(b) else np.inf for b in borders])
        self.many = [p for p, b in enumerate(borders) if len(b) > 1]

    def cells(self, features: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, place and bin of the stored values of vectors; places not stored are zero."""
        row, place, value = _stored(features)
        found = (value > self.first[place]).astype(np.int64)
        for p in self.many:
            here = np.flatnonzero(place == p)
            found[here] = np.searchsorted(self.borders[p], value[here])
        return row, place, found

    def table(self, features: pa.StructArray) -> np.ndarray:
        """Bin per row and place."""
        out = np.tile(self.home.astype(np.uint16), (len(features), 1))
        row, place, found = self.cells(features)
        out[row, place] = found
        return out


def _stored(features: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and value of what vectors store."""
    if features.null_count:
        raise ValueError("a row without features")
    kind, values = features.field("type").to_numpy(zero_copy_only=False), features.field("values")
    lengths = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    row, value = np.repeat(np.arange(len(features)), lengths), values.flatten().to_numpy(zero_copy_only=False)
    if not np.isfinite(value).all():
        raise ValueError("a feature is missing or not finite")
    place = np.arange(len(value)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    place[np.repeat(kind == 0, lengths)] = features.field("indices").flatten().to_numpy(zero_copy_only=False)
    return row, place, value


def _at(values: np.ndarray, rows: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Places among sorted values, each with its rows, of quantiles: the first value that at least that share of the rows does not exceed."""
    below = np.cumsum(rows)
    return np.searchsorted(below, np.ceil(shares * below[-1])).clip(0, len(values) - 1)


_SKETCH = "place int, before int, ones bigint, value array<double>, rows array<double>"


def _sketched(batches: Iterator[pa.RecordBatch], points: int = 10 * POINTS, held: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Per place of some rows its ones and, sorted, its values other than zero and one with their rows, or as many quantiles where there are more.

    ``before`` as in :class:`Bins`.
    """
    ones, before, places, values, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], [], 0

    def sketch() -> pa.RecordBatch:
        place, value = np.concatenate([np.empty(0, np.int64), *places]), np.concatenate([np.empty(0), *values])
        order = np.argsort(place, kind="stable")
        there, start = np.unique(place[order], return_index=True)
        found = dict.fromkeys(np.flatnonzero((ones > 0) | (before >= 0)).tolist(), (np.empty(0), np.empty(0)))
        for p, cells in zip(there.tolist(), np.split(value[order], start[1:])):
            v, n = np.unique(cells, return_counts=True)
            if len(v) > points:
                kept = np.unique([0, *_at(v, n, np.arange(1, points + 1) / points)])
                v, n = v[kept], np.diff(np.cumsum(n)[kept], prepend=0)
            found[p] = v, n.astype(np.float64)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()), pa.array(before[list(found)], pa.int32()), pa.array(ones[list(found)], pa.int64()),
             pa.array([v for v, _ in found.values()], pa.list_(pa.float64())), pa.array([n for _, n in found.values()], pa.list_(pa.float64()))],
            names=["place", "before", "ones", "value", "rows"])

    for batch in batches:
        row, place, value = _stored(batch.column(0))
        new = int(place.max(initial=-1)) + 1 - len(ones)
        if new > 0:
            ones, before = np.append(ones, np.zeros(new, np.int64)), np.append(before, np.full(new, -1))
        ones += np.bincount(place[value == 1], minlength=len(ones))
        filled = np.flatnonzero(value)
        if (place[filled[1:]] <= place[filled[:-1]])[row[filled[1:]] == row[filled[:-1]]].any():
            filled = filled[np.lexsort((place[filled], row[filled]))]
        same = row[filled[1:]] == row[filled[:-1]]
        np.maximum.at(before, place[filled[1:]][same], place[filled[:-1]][same])
        other = np.flatnonzero((value != 0) & (value != 1))
        places.append(place[other])
        values.append(value[other])
        size += len(other)
        if size >= held:
            yield sketch()
            ones[:], before[:], places, values, size = 0, -1, [], [], 0
    yield sketch()


def _joined(table: pa.Table) -> pa.Table:
    """The sketches of one place as one, and so many quantiles of it: its distinct points, and one for each."""
    value, rows = (table[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("value", "rows"))
    points = every = np.empty(0)
    if len(value):
        value, at = np.unique(value, return_inverse=True)
        found = value[_at(value, np.bincount(at, rows), np.arange(POINTS + 1) / POINTS)]
        points, every = np.unique(found), found[1:-1]
    before, ones = (table[c].to_pylist() for c in ("before", "ones"))
    return pa.table({"place": table["place"][:1], "before": pa.array([max(before)], pa.int32()), "ones": pa.array([sum(ones)], pa.int64()),
                     "others": pa.array([int(rows.sum())], pa.int64()), "points": pa.array([points], pa.list_(pa.float64())),
                     "every": pa.array([every], pa.list_(pa.float64()))})


def find_bins(rows: DataFrame, size: int, count: int, most: int) -> Bins:
    """Borders from the values of all rows: between neighbours where a place has few values, else by quantiles, under ``most`` in either case.

    Zeros and ones, which fill one-hot places, are counted; other values are sketched by the tasks. The driver gets the quantiles per place.
    """
    found = rows.select("features").mapInArrow(_sketched, _SKETCH).groupBy("place").applyInArrow(
        _joined, "place int, before int, ones bigint, others bigint, points array<double>, every array<double>").collect()
    borders, before = [np.empty(0)] * size, np.full(size, -1)
    for r in found:
        before[r["place"]] = r["before"]
        weight = {0.0: count - r["ones"] - r["others"], 1.0: r["ones"]}
        for v in r["every"]:
            weight[v] = weight.get(v, 0) + r["others"] / (POINTS - 1)
        for v in r["points"]:
            weight.setdefault(v, 1)
        values = np.array(sorted(v for v, n in weight.items() if n > 0))
        middle = (values[1:] + values[:-1]) / 2
        if len(middle) >= most:
            mass = np.cumsum([weight[v] for v in values])
            middle = middle[np.unique(np.searchsorted(mass, mass[-1] * np.arange(1, most) / most)).clip(0, len(middle) - 1)]
        borders[r["place"]] = np.unique(middle)
    return Bins(borders, before)


class Layout:
    """How bins lie in the bytes of a row.

    Neighbouring places that no row fills together are one code: 0 where all are in the bin of zero, else a number per other bin. Codes are digits
    of bytes. A place of over 256 bins has a word of its own behind the bytes.
    """

    def __init__(self, bins: Bins):
        self.bins = bins
        others = np.diff(np.append(bins.offset, bins.size)) - 1
        fields: list[list[int]] = []
        for p in np.flatnonzero(others):
            if fields and bins.before[p] < fields[-1][0] and others[fields[-1]].sum() + others[p] < 256:
                fields[-1].append(p)
            else:
                fields.append([p])
        sizes = [int(others[f].sum()) + 1 for f in fields]
        full: list[int] = []
        #: Per place its byte or word, the value of a digit, digits, and its first code.
        self.unit, self.digit, self.digits, self.code = (np.zeros(bins.places, np.int64) for _ in range(4))
        words = [i for i, n in enumerate(sizes) if n > 256]
        for i in sorted(set(range(len(fields))) - set(words), key=lambda i: (-sizes[i], i)):
            u = next((u for u, n in enumerate(full) if n * sizes[i] <= 256), len(full))
            if u == len(full):
                full.append(1)
            self.unit[fields[i]], self.digit[fields[i]], full[u] = u, full[u], full[u] * sizes[i]
        full = full or [1]
        self.bytes, self.words = len(full), len(words)
        for u, i in enumerate(words, self.bytes):
            self.unit[fields[i]], self.digit[fields[i]] = u, 1
            full.append(sizes[i])
        for f, n in zip(fields, sizes):
            self.digits[f], self.code[f] = n, 1 + np.cumsum(others[f]) - others[f]
        self.others, self.full = others, full
        # the code of a bin, 0 for that of zero
        nth = np.arange(bins.size) - bins.offset[bins.of_bin]
        home = bins.home[bins.of_bin]
        self.code_of_bin = np.where(nth == home, 0, self.code[bins.of_bin] + nth - (nth > home))

    @cached_property
    def maps(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per byte or word its bins, and per bin (column) a one for each value that has it."""
        out = []
        for u, size in enumerate(self.full):
            at = np.flatnonzero((self.unit[self.bins.of_bin] == u) & (self.code_of_bin > 0))
            place = self.bins.of_bin[at]
            if u < self.bytes:
                out.append((at, (np.arange(256)[:, None] // self.digit[place] % self.digits[place] == self.code_of_bin[at]).astype(np.float64)))
            else:
                out.append((at, None))
        return out

    def pack(self, row: np.ndarray, at: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and words, one line each, of rows with the bins ``at`` that are not those of zero."""
        place = self.bins.of_bin[at]
        lines = np.bincount(self.unit[place] * rows + row, self.code_of_bin[at] * self.digit[place], len(self.full) * rows).reshape(-1, rows)
        return lines[:self.bytes].astype(np.uint8), lines[self.bytes:].astype(np.uint16 if max(self.full, default=0) <= 65_536 else np.uint32)

    def right(self, place: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per split the codes, from and to, of the rows that go right, or where the last is true of those that go left."""
        zero_left = self.bins.home[place] <= cut
        middle = self.code[place] + cut + 1 - zero_left
        return np.where(zero_left, middle, self.code[place]), np.where(zero_left, self.code[place] + self.others[place], middle), ~zero_left


def _packed(batches: Iterator[pa.RecordBatch], layout: Layout, blocks: int, scale: float, kind: type, small: bool) -> Iterator[pa.RecordBatch]:
    """A batch of rows as one cell: draw, marks, integer label, bytes and words."""
    bins = layout.bins
    for i, batch in enumerate(batches):
        row, place, found = bins.cells(batch.column(0))
        there = found != bins.home[place]
        label = np.rint(batch.column(1).to_numpy(zero_copy_only=False) * scale)
        if not np.isfinite(label).all():
            raise ValueError("a label is missing or not finite")
        cell = (batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64),
                batch.column(3).to_numpy(zero_copy_only=False).astype(kind), label.astype(np.int32) if small else label,
                *layout.pack(row[there], (bins.offset[place] + found)[there], batch.num_rows))
        block = (TaskContext.get().partitionId() + i) % blocks
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([pickle.dumps(cell, 5)], pa.binary())], names=["block", "cell"])


@dataclass
class Tree:
    """Nodes in heap order: place (-1: leaf), the last bin that goes left, mean label and what the split gains; nodes to be counted next."""

    place: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    open: np.ndarray

    @classmethod
    def root(cls, depth: int) -> Tree:
        nodes = 2 ** (depth + 1) - 1
        return cls(np.full(nodes, -1, np.int32), np.zeros(nodes, np.int32), np.zeros(nodes), np.zeros(nodes), np.zeros(1, np.int64))

    def level(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and last left bins of a level."""
        nodes = slice(2 ** number - 1, 2 ** (number + 1) - 1)
        return self.place[nodes], self.cut[nodes]


class Block:
    """Some rows of a block: their draws, marks, labels, bytes and words."""

    def __init__(self, cells: list[tuple]):
        self.draw, self.marks, self.label = (np.concatenate([c[i] for c in cells]) for i in range(3))
        self.bytes, self.words = (np.concatenate([c[i] for c in cells], axis=1) for i in (3, 4))

    @cached_property
    def kinds(self) -> tuple[np.ndarray, np.ndarray]:
        """The sets of marks there are, and per row the number of its set."""
        sets, kind = np.unique(self.marks, return_inverse=True)
        return sets.astype(np.int64), kind.astype(np.uint8 if len(sets) <= 256 else np.int32)

    def times(self, tree: int, seed: int) -> np.ndarray:
        """How often a tree draws each row: Poisson(1), from the row's own draw."""
        out = np.empty(len(self.draw), np.uint8)
        salt = np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
        for start in range(0, len(out), 1 << 15):
            z = self.draw[start:start + (1 << 15)] + salt
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                z ^= z >> np.uint64(shift)
                z *= np.uint64(factor)
            z ^= z >> np.uint64(31)
            found = _TIMES.take((z >> np.uint64(48)).view(np.int64))
            near = np.flatnonzero(found == 255)
            found[near] = ((z[near] >> np.uint64(32))[:, None] >= _LIMITS).sum(axis=1)
            out[start:start + (1 << 15)] = found
        return out

    def bag(self, mark: int, tree: int, seed: int, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The rows a tree draws among those of its mark, and how often."""
        times = self.times(tree, seed) if times is None else times
        rows = np.flatnonzero((times > 0) & ((self.marks >> mark) & 1 == 1))
        return rows, times[rows].astype(np.float64)

    def drawn(self, marks: int, times: np.ndarray, nodes: np.ndarray | None = None) -> Walk:
        """The rows drawn of any of the marks, at the root or where ``nodes`` has them."""
        rows = (times > 0) & (self.marks & self.marks.dtype.type(marks) != 0)
        if nodes is not None:
            rows &= nodes >= 0
        rows = np.flatnonzero(rows)
        return Walk(self, rows, times.take(rows), None if nodes is None else nodes.take(rows))


class Tally:
    """Counts of nodes: per value of every byte and word the rows and the sum of their labels."""

    def __init__(self, layout: Layout, nodes: int, marks: int = 1):
        self.layout, self.nodes, self.marks = layout, nodes, marks
        self.units = [[0, 0] for _ in layout.full]
        self.total = [0, 0]

    def add(self, block: Block, rows: np.ndarray, times: np.ndarray, at: np.ndarray) -> None:
        weights = (times, times * block.label.take(rows))
        self.total = [t + np.bincount(at, w, self.nodes) for t, w in zip(self.total, weights)]
        base = at << 8
        for u, unit in enumerate(self.units):
            if u < self.layout.bytes:
                key, size = base + block.bytes[u].take(rows), 256
            else:
                size = self.layout.full[u]
                key = at * size + block.words[u - self.layout.bytes].take(rows)
            for i in (0, 1):
                unit[i] += np.bincount(key, weights[i], self.nodes * size)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Per node and bin the rows and the sum of their labels, bins of zero left out; behind the bins those of the node."""
        out = []
        for i in (0, 1):
            found = np.zeros((self.nodes, self.layout.bins.size + 1), np.int64)
            found[:, -1] = self.total[i]
            for unit, (at, ones) in zip(self.units, self.layout.maps):
                # sums of whole numbers, exact in any order
                values = np.reshape(unit[i], (self.nodes, -1))
                found[:, at] = values[:, 1:] if ones is None else values @ ones
            out.append(found)
        return out[0], out[1]


class Walk:
    """The rows of a block that trees have drawn, on their way down."""

    def __init__(self, block: Block, rows: np.ndarray, times: np.ndarray, node: np.ndarray | None = None):
        self.block, self.rows, self.times = block, rows.astype(np.int32), times.astype(np.uint8)
        self.node = np.zeros(len(rows), np.int32) if node is None else node.astype(np.int32)

    def only(self, marks: int) -> Walk:
        """Those of the rows that have one of the marks."""
        sets, kind = self.block.kinds
        here = np.flatnonzero((sets & marks != 0).take(kind.take(self.rows)))
        return Walk(self.block, self.rows.take(here), self.times.take(here), self.node.take(here))

    def count(self, place: np.ndarray, classes: np.ndarray, tally: Tally) -> None:
        """Adds the rows whose node has a ``place``, each place once for every class: set of marks among those counted."""
        at = place.take(self.node)
        here = np.flatnonzero(at >= 0)
        rows, at = self.rows.take(here).astype(np.int64), at.take(here)
        if len(classes) > 1:
            sets, kind = self.block.kinds
            at *= len(classes)
            at += np.searchsorted(classes, sets & tally.marks).take(kind.take(rows))
        tally.add(self.block, rows, self.times.take(here).astype(np.float64), at)

    def down(self, step: Step) -> None:
        """To the nodes of the next level; rows in leaves are left behind."""
        local = self.node.astype(np.int64) - step.first
        if step.leaves:
            goes = np.flatnonzero(step.inner.take(local))
            self.rows, self.times, local = self.rows.take(goes), self.times.take(goes), local.take(goes)
        rows, lines = self.rows.astype(np.int64), self.block
        line = step.unit.take(local)
        line *= len(lines.draw)
        line += rows
        key = step.test.take(local)
        key += lines.bytes.reshape(-1).take(line)
        if step.words.any():
            far = np.flatnonzero(step.words.take(local))
            test = key[far] >> 8
            code = lines.words.reshape(-1).take(step.word.take(test) * len(lines.draw) + rows[far])
            right = ((code >= step.low[test]) & (code < step.high[test])) != step.turned[test]
        goes = step.right.take(key)
        if step.words.any():
            goes[far] = right
        local += step.first
        local *= 2
        local += 1
        local += goes
        self.node = local.astype(np.int32)


class Step:
    """Where the rows in the nodes of a level go: per node its test, and per test and value of a byte whether that is right."""

    def __init__(self, tree: Tree, level: int, layout: Layout):
        self.first = 2 ** level - 1
        place, cut = tree.level(level)
        self.inner = place >= 0
        self.leaves = not self.inner.all()
        tests, test = np.unique(layout.bins.offset[np.maximum(place, 0)] + cut, return_inverse=True)
        place = layout.bins.of_bin[tests]
        cut = tests - layout.bins.offset[place]
        self.low, self.high, self.turned = layout.right(place, cut)
        code = np.arange(256) // np.maximum(layout.digit[place], 1)[:, None] % np.maximum(layout.digits[place], 1)[:, None]
        self.right = (((code >= self.low[:, None]) & (code < self.high[:, None])) != self.turned[:, None]).reshape(-1)
        self.word = layout.unit[place] - layout.bytes
        self.test, self.words, self.unit = test << 8, (self.word >= 0)[test], np.where(self.word >= 0, 0, layout.unit[place])[test]


def split(tree: Tree, n: np.ndarray, s: np.ndarray, nodes: np.ndarray, bins: Bins, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Split ``nodes`` by their counts where the variance falls; the counts of those split, and by how many rows more go left.

    ``tree.open`` gets their smaller children.

    Bins of zero are not counted: they are the node less the other bins of a place.
    """
    total, sums = n[:, bins.size:bins.size + 1], s[:, bins.size:bins.size + 1]
    tree.value[nodes] = np.divide(sums[:, 0], total[:, 0], out=np.zeros(len(nodes)), where=total[:, 0] > 0) / scale
    left = []
    for whole, all_ in ((n[:, :bins.size], total), (s[:, :bins.size], sums)):
        filled = whole.copy()
        filled[:, bins.offset + bins.home] = all_ - np.add.reduceat(whole, bins.offset, axis=1)
        # bins of a place add up to the node, and integers stay exact
        left.append(np.cumsum(filled, axis=1) - all_ * bins.of_bin)
    ln, ls = left[0].astype(np.float64), left[1].astype(np.float64)
    rn, rs = (total - left[0]).astype(np.float64), (sums - left[1]).astype(np.float64)
    fits = (ln > 0) & (rn > 0) & ~bins.last
    gain = np.divide((ls * rn - rs * ln) ** 2, ln * rn * total, out=np.zeros(ln.shape), where=fits)
    best = gain.argmax(axis=1)
    won = np.flatnonzero(gain[np.arange(len(nodes)), best] > 0)
    best, parents = best[won], nodes[won]
    tree.place[parents], tree.cut[parents] = bins.of_bin[best], best - bins.offset[bins.of_bin[best]]
    tree.gain[parents] = gain[won, best]
    a, b = ln[won, best], rn[won, best]
    tree.value[2 * parents + 1], tree.value[2 * parents + 2] = ls[won, best] / a / scale, rs[won, best] / b / scale
    tree.open = 2 * parents + 1 + (b < a)
    return n[won], s[won], a - b


def _both(open_: np.ndarray, n: np.ndarray, s: np.ndarray, above: tuple[np.ndarray, ...] | None):
    """Counts of the smaller children and, as their parents less those, of their sisters."""
    if above is None:
        return n, s, open_
    return np.concatenate([n, above[0] - n]), np.concatenate([s, above[1] - s]), np.concatenate([open_, open_ + np.where(open_ % 2 == 1, 1, -1)])


#: Trees of one number by forest.
Family = dict[int, Tree]


def _marks(family: Family) -> int:
    return sum(1 << f for f in family)


def _first(family: Family) -> Tree:
    return next(iter(family.values()))


def _alike(family: Family, level: int) -> list[Family]:
    """The trees by what they split at a level."""
    groups: dict[bytes, Family] = {}
    for f, tree in family.items():
        groups.setdefault(b"".join(x.tobytes() for x in tree.level(level)), {})[f] = tree
    return list(groups.values())


def _count(walks: list[Walk], family: Family, layout: Layout) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per forest the counts of the open nodes of its tree, of trees with the same nodes: rows are counted once, by the set of forests they are in."""
    marks, open_ = _marks(family), np.unique(np.concatenate([t.open for t in family.values()]))
    classes = np.array([marks])
    if len(family) > 1:
        classes = np.unique(np.concatenate([w.block.kinds[0] & marks for w in walks]))
        classes = classes[classes != 0] if classes.any() else np.array([marks])
        if len(open_) * len(classes) > MOST_SHARED:
            return {f: counts for f, tree in family.items() for counts in _count([w.only(1 << f) for w in walks], {f: tree}, layout).values()}
    place = np.full(len(_first(family).place), -1, np.int64)
    place[open_] = np.arange(len(open_))
    tally = Tally(layout, len(open_) * len(classes), marks)
    for walk in walks:
        walk.count(place, classes, tally)
    n, s = (x.reshape(len(open_), len(classes), x.shape[1]) for x in tally.counts())
    out = {}
    for f, tree in family.items():
        nodes, mine = place[tree.open], np.flatnonzero(classes >> f & 1)
        out[f] = (n[nodes][:, mine].sum(axis=1), s[nodes][:, mine].sum(axis=1))
    return out


def _down(walks: list[Walk], family: Family, level: int, layout: Layout, whole: bool) -> list[Walk]:
    """The rows one level deeper in trees that split alike: the walks themselves if they are ``whole`` of the family, else copies of what it has."""
    step = Step(_first(family), level, layout)
    walks = walks if whole else [w.only(_marks(family)) for w in walks]
    for walk in walks:
        walk.down(step)
    return walks


def grow(walks: list[Walk], family: Family, layout: Layout, depth: int, scale: float, level: int = 0,
         above: dict[int, tuple[np.ndarray, ...]] | None = None) -> None:
    """Grows the trees of one number over the rows of a single block. Those that split alike so far share walks and counts."""
    counted, after = _count(walks, family, layout), {}
    for f, tree in family.items():
        n, s, nodes = _both(tree.open, *counted.pop(f), above and above[f])
        after[f] = split(tree, n, s, nodes, layout.bins, scale)
    if level + 1 == depth:
        return
    for part in _alike(family, level):
        if len(_first(part).open):
            # one sister for all of them
            lean = sum(after[f][2] for f in part)
            for tree in part.values():
                tree.open = (tree.open - 1) // 2 * 2 + 1 + (lean > 0)
            grow(_down(walks, part, level, layout, len(part) == len(family)), part, layout, depth, scale, level + 1, {f: after.pop(f) for f in part})


def _walked(walks: list[Walk], family: Family, level: int, target: int, layout: Layout) -> Iterator[tuple[list[Walk], Family]]:
    """The rows in the nodes of a deeper level, with the trees that are alike down to there."""
    if level == target:
        yield walks, family
        return
    for part in _alike(family, level):
        yield from _walked(_down(walks, part, level, layout, len(part) == len(family)), part, level + 1, target, layout)


def _prefix(tree: Tree, levels: int) -> bytes:
    return tree.place[:2 ** levels - 1].tobytes() + tree.cut[:2 ** levels - 1].tobytes()


def _common(trees: list[Tree], target: int) -> tuple[Tree, int]:
    """A tree whose first levels at least half of the trees have, and the number of those levels."""
    for levels in range(target, 0, -1):
        (prefix, n), = Counter(_prefix(t, levels) for t in trees).most_common(1)
        if 1 < n >= len(trees) / 2:
            return next(t for t in trees if _prefix(t, levels) == prefix), levels
    return trees[0], 0


def _nodes(block: Block, tree: Tree, levels: int, layout: Layout) -> np.ndarray:
    """Per row its node at a level, -1 where it stays in a leaf above."""
    every = np.arange(len(block.draw))
    walk = Walk(block, every, np.ones(len(every), np.uint8))
    for level in range(levels):
        walk.down(Step(tree, level, layout))
    out = np.full(len(every), -1, np.int32)
    out[walk.rows] = walk.node
    return out


_STATE = "forest int, number int, tree binary, n binary"


def _grown(batches: Iterator[pa.RecordBatch], layout: Layout, seed: int, depth: int, scale: float, single: bool) -> Iterator[pa.RecordBatch]:
    """Of one block and some trees: the trees grown to the end, or the counts of their open nodes."""
    blocks, cells, states, held = [], [], [], 0
    for batch in batches:
        for cell, forest, number, state in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("cell", "forest", "number", "tree"))):
            if not cell.is_valid:
                states.append((number.as_py(), forest.as_py(), state.as_py()))
                continue
            cells.append(pickle.loads(cell.as_buffer()))
            held += len(cells[-1][0])
            if held >= PIECE_ROWS:
                blocks.append(Block(cells))
                cells, held = [], 0
    if cells:
        blocks.append(Block(cells))
    del cells
    if single and states and not blocks:
        # no row has a mark: roots without rows
        yield pa.RecordBatch.from_arrays([pa.array([f for _, f, _ in states], pa.int32()), pa.array([n for n, _, _ in states], pa.int32()),
                                          pa.array([t for _, _, t in states], pa.binary()), pa.nulls(len(states), pa.binary())],
                                         names=["forest", "number", "tree", "n"])
    families: dict[int, Family] = {}
    for number, forest, state in sorted(states, key=lambda x: x[:2]):
        tree = pickle.loads(state)
        if len(tree.open):
            families.setdefault(number, {})[forest] = tree
    del states
    if not blocks or not families:
        return
    target = int(_first(_first(families)).open[0] + 1).bit_length() - 1
    common, levels = _common([t for family in families.values() for t in family.values()], target)
    prefix, nodes = _prefix(common, levels), [_nodes(b, common, levels, layout) if levels else None for b in blocks]
    for number, family in families.items():
        # the trees of one number draw alike in all forests
        times = [b.times(number, seed) for b in blocks]
        near = all(_prefix(t, levels) == prefix for t in family.values())
        walks = [b.drawn(_marks(family), t, at if near else None) for b, t, at in zip(blocks, times, nodes)]
        del times
        if single:
            grow(walks, family, layout, depth, scale)
            found = {f: (pickle.dumps(tree, 5), None) for f, tree in family.items()}
        else:
            found = {f: (None, pickle.dumps(counts, 5)) for some, part in _walked(walks, family, levels if near else 0, target, layout)
                     for f, counts in _count(some, part, layout).items()}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()), pa.array([number] * len(found), pa.int32()), pa.array([t for t, _ in found.values()], pa.binary()),
             pa.array([n for _, n in found.values()], pa.binary())], names=["forest", "number", "tree", "n"])


def _merged(table: pa.Table, bins: Bins, scale: float, last: bool) -> pa.Table:
    """A tree of the level before, the counts it was split by, and the counts of its open nodes per block: the tree one level deeper."""
    tree, above, n, s = None, None, 0, 0
    for batch in table.to_batches():
        for r in batch.to_pylist():
            if r["tree"] is not None:
                tree, above = pickle.loads(r["tree"]), None if r["n"] is None else pickle.loads(r["n"])
            else:
                part = pickle.loads(r["n"])
                n, s = n + part[0], s + part[1]
    if len(tree.open) and not isinstance(n, int):
        n, s, nodes = _both(tree.open, n, s, above)
        above = split(tree, n, s, nodes, bins, scale)[:2]
    return pa.table({"forest": table["forest"][:1], "number": table["number"][:1], "tree": pa.array([pickle.dumps(tree, 5)], pa.binary()),
                     "n": pa.array([None if above is None or last else pickle.dumps(above, 5)], pa.binary())})


class Forest:
    """A grown forest; its trees lie on the driver and go to the tasks that predict."""

    def __init__(self, bins: Bins, trees: list[Tree]):
        self.bins, self.trees, self.numFeatures = bins, trees, bins.places

    @cached_property
    def featureImportances(self) -> SparseVector:
        """Per place the gains of its splits, of each tree as shares, together 1."""
        found = np.zeros(self.numFeatures)
        for tree in self.trees:
            if tree.gain.any():
                found += np.bincount(tree.place[tree.place >= 0], tree.gain[tree.place >= 0], self.numFeatures) / tree.gain.sum()
        used = np.flatnonzero(found)
        return SparseVector(self.numFeatures, used, found[used] / found.sum())

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the mean of the trees as ``prediction``."""
        bins, nodes = self.bins, []
        for tree in self.trees:
            place, cut, value = tree.place.copy(), tree.cut.copy(), tree.value.copy()
            inner = np.arange(len(place) // 2)
            for i in inner[place[inner] < 0]:
                # below a leaf all rows go left, with its value
                place[i], cut[i], value[2 * i + 1] = 0, 2 ** 30, value[i]
            nodes.append((place, cut, value))
        names, at, depth = [*df.columns, "prediction"], df.columns.index("features"), int(len(nodes[0][0]) + 1).bit_length() - 2

        def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                table = bins.table(batch.column(at)).reshape(-1)
                base, total = np.arange(batch.num_rows) * bins.places, np.zeros(batch.num_rows)
                for place, cut, value in nodes:
                    node = np.zeros(batch.num_rows, np.int64)
                    for _ in range(depth):
                        node = 2 * node + 1 + (table[base + place[node]] > cut[node])
                    total += value[node]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total / len(nodes))], names=names)

        return df.mapInArrow(predicted, T.StructType([*df.schema.fields, T.StructField("prediction", T.DoubleType())]))


def train(rows: DataFrame, marks: list[Column], draw: Column, trees: int, depth: int, seed: int, max_bins: int = 32, blocks: int | None = None) -> list[Forest]:
    """A forest per mark, over the rows (staged, ``features, label``) where it is true; at most 62 marks.

    All splits at all places are looked at. ``draw`` is a BIGINT that spreads the rows: a row's times in a tree follow from it. Rows of one draw are
    drawn together. Blocks (by default of 256 MB) change no forest. The driver gets borders and grown trees.
    """
    spark = rows.sparkSession
    facts = rows.agg(F.count("*").alias("rows"), F.max(F.abs("label")).alias("most")).first()
    if not facts["rows"]:
        raise ValueError("no rows to train on")
    size = len(rows.select("features").first()[0])
    bins = find_bins(rows, size, facts["rows"], max_bins)
    # sums of labels, drawn twice on average at the utmost, are whole numbers below 2 ** 52
    most = max(facts["most"] or 0.0, 1e-300)
    scale = 2.0 ** math.floor(52 - math.log2(most * (2 * facts["rows"] + 100)))
    mark = F.lit(0).cast("bigint")
    for i, m in enumerate(marks):
        mark = mark + F.when(m, F.lit(2 ** i)).otherwise(0)
    layout, small, kind = Layout(bins), most * scale < 2 ** 31 - 1, np.uint8 if len(marks) <= 8 else np.int64
    cores = spark.sparkContext.defaultParallelism
    if blocks is None:
        width = layout.bytes + 4 * layout.words + 8 + np.dtype(kind).itemsize + (4 if small else 8)
        blocks = -(-facts["rows"] * width // BLOCK_BYTES)
        if blocks > 1:
            # tasks, blocks times groups of trees, come out even on the cores
            shared = -(-cores * SHARE_ROWS // facts["rows"])
            blocks = -(-blocks // cores) * cores if blocks > cores else max(blocks, cores // shared)
    # rows of no mark are in no tree
    cells = stage(rows.select("features", "label", draw.alias("draw"), mark.alias("mark")).where("mark <> 0").mapInArrow(
        lambda it: _packed(it, layout, blocks, scale, kind, small), "block int, cell binary"), "binned")
    groups = max(1, min(trees, cores // blocks))
    first = pickle.dumps(Tree.root(depth), 5)
    state = spark.range(trees * len(marks)).select(
        (F.col("id") % len(marks)).cast("int").alias("forest"), F.floor(F.col("id") / len(marks)).cast("int").alias("number"),
        F.lit(first).alias("tree"), F.lit(None).cast("binary").alias("n"))
    group = F.col("number") % groups
    for level in range(1 if blocks == 1 else depth):
        dealt = cells.select("cell", "block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")).unionByName(
            state.select("forest", "number", "tree", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), group.alias("group")),
            allowMissingColumns=True)
        tasks = dealt.repartitionById(blocks * groups, (F.col("block") * groups + F.col("group")).cast("int"))
        found = tasks.mapInArrow(lambda it: _grown(it, layout, seed, depth, scale, blocks == 1), _STATE)
        if blocks > 1:
            found = state.unionByName(found).groupBy("forest", "number").applyInArrow(lambda t: _merged(t, bins, scale, level == depth - 1), _STATE)
        state = stage(found, "trees")
    out: list[list[tuple[int, Tree]]] = [[] for _ in marks]
    for r in state.select("forest", "number", "tree").toLocalIterator():
        out[r["forest"]].append((r["number"], pickle.loads(r["tree"])))
    return [Forest(bins, [t for _, t in sorted(f, key=lambda x: x[0])]) for f in out]

"""Quality classifier by co-training: a text view and a page-metadata view teach each other."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimwise.llm.wordhash import Spans, grams, inside_text, per_text, slices, span_hashes

#: Character classes whose trigrams describe a text; all other bytes are the last class.
_CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\f\v", "\n", ".", ",", "!?", "#*$%&<>", "|")
_CLASS = np.full(256, len(_CLASSES), np.int64)
_CLASS[128:] = len(_CLASSES) + 1
for _i, _chars in enumerate(_CLASSES):
    _CLASS[[ord(c) for c in _chars]] = _i
_K = len(_CLASSES) + 2
CONTENT = _K ** 3 + 3
SOURCES, LANGS = 64, 16
META = SOURCES + LANGS + 4


@dataclass
class Model:
    """Weights of both views, the Platt scale of each, and the weights that join them."""

    content: np.ndarray
    meta: np.ndarray
    scale: np.ndarray
    join: np.ndarray

    def score(self, content: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability of good quality: by text, by metadata, joined."""
        views = [_bias(x) @ w * s[0] + s[1] for x, w, s in zip((content, meta), (self.content, self.meta), self.scale)]
        joined = self.join[0] * views[0] + self.join[1] * views[1] + self.join[2]
        return _sigmoid(views[0]), _sigmoid(views[1]), _sigmoid(joined)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _bias(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)


def content_view(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Square-rooted shares of character-class trigrams, and how far words repeat."""
    n = len(off) - 1
    doc = np.repeat(np.arange(n), np.diff(off))
    c = _CLASS[data]
    tri = (c[:-2] * _K + c[1:-1]) * _K + c[2:]
    own = doc[:-2] == doc[2:]
    x = np.bincount(doc[:-2][own] * _K ** 3 + tri[own], minlength=n * _K ** 3).reshape(n, _K ** 3)
    x = np.sqrt(x / np.maximum(1, x.sum(axis=1, keepdims=True)))
    w = Spans(data, off)
    words = np.maximum(1, np.diff(w.first))
    h = span_hashes(data, w.start, w.end)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
    pair = grams(h, 2)[inside_text(w, 2)] if len(h) > 1 else np.zeros(0, np.uint64)
    pair_doc = w.doc[:-1][inside_text(w, 2)] if len(h) > 1 else np.zeros(0, np.int64)
    distinct = np.unique(np.stack([pair_doc.astype(np.uint64), pair]), axis=1)[0].astype(np.int64) if len(pair) else pair_doc
    fresh = np.bincount(distinct, minlength=n) / np.maximum(1, np.bincount(pair_doc, minlength=n))
    return np.column_stack([x, per_text(again, w.first) / words, fresh, np.log1p(np.diff(w.first)) / 10]).astype(np.float32)


def meta_view(data: np.ndarray, off: np.ndarray, source: list, lang: list) -> np.ndarray:
    """Hashed source and language, size, and layout in lines."""
    n = len(off) - 1
    x = np.zeros((n, META), np.float32)
    rows = np.arange(n)
    x[rows, [zlib.crc32(str(s).encode()) % SOURCES for s in source]] = 1
    x[rows, [SOURCES + zlib.crc32(str(s).encode()) % LANGS for s in lang]] = 1
    size, lines = np.diff(off), per_text(data == 10, off)
    x[:, -4] = np.log1p(size) / 10
    x[:, -3] = np.log1p(lines) / 5
    x[:, -2] = np.log1p(size / (1 + lines)) / 10
    x[:, -1] = lines / np.maximum(1, size) * 50
    return x


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, steps: int = 300) -> np.ndarray:
    """Logistic regression with equal weight on both classes; accelerated gradient steps."""
    x = _bias(x)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
    # products in the precision of x, without a wider copy of it; steps in double precision
    rate = 4.0 / (float(np.einsum("ij,ij,i->", x, x, weight.astype(x.dtype))) + l2)
    w = ahead = np.zeros(x.shape[1])
    for t in range(steps):
        away = weight * (_sigmoid((x @ ahead.astype(x.dtype)).astype(np.float64)) - y)
        grad = x.T @ away.astype(x.dtype) + l2 * ahead
        new = ahead - rate * grad
        ahead = new + t / (t + 3) * (new - w)
        w = new
    return w


def co_train(content: np.ndarray, meta: np.ndarray, y: np.ndarray, rounds: int = 4, grow: float = 0.1, sure: float = 0.9) -> Model:
    """Labels are 1, 0, or -1 for unlabelled rows. One labelled row in five calibrates and is never fitted.

    In each round each view labels the ``grow`` share of the pool it is surest of,
    above ``sure``, and these rows join the other view's training rows.
    """
    known = np.flatnonzero(y >= 0)
    check = known[np.arange(len(known)) % 5 == 0]
    if len(np.unique(y[check])) < 2:
        check = known
    base = np.setdiff1d(known, check) if len(check) < len(known) else known
    pool = np.flatnonzero(y < 0)
    views = (content, meta)
    taught = [dict(zip(base.tolist(), y[base].tolist())) for _ in views]
    weights = [np.zeros(v.shape[1] + 1) for v in views]
    for turn in range(rounds + 1):
        for v, x in enumerate(views):
            rows = np.fromiter(taught[v], np.int64)
            weights[v] = logistic(x[rows], np.fromiter(taught[v].values(), np.float64))
        if turn == rounds:
            break
        for v, x in enumerate(views):
            free = np.array([i for i in pool.tolist() if i not in taught[1 - v]], np.int64)
            p = _sigmoid(_bias(x[free]) @ weights[v]) if len(free) else np.zeros(0)
            trust = np.abs(p - 0.5)
            for i in np.argsort(-trust, kind="stable")[:int(len(pool) * grow)]:
                if trust[i] >= sure - 0.5:
                    taught[1 - v][int(free[i])] = int(p[i] > 0.5)
    raw = [_bias(x[check]) @ w for x, w in zip(views, weights)]
    target = y[check].astype(np.float64)
    scale = np.array([logistic(r[:, None] / 10, target, 1e-3, 2000) for r in raw]) * np.array([0.1, 1.0])
    joint = np.column_stack([r * s[0] + s[1] for r, s in zip(raw, scale)])
    join = logistic(joint / 10, target, 1e-3, 2000) * np.array([0.1, 0.1, 1.0])
    return Model(weights[0].astype(np.float32), weights[1].astype(np.float32), scale, join)


def _views(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Both views of rows that begin with text, source and language, slice by slice."""
    source, lang = batch.column(1).to_pylist(), batch.column(2).to_pylist()
    for low, high, data, off in slices(batch.column(0)):
        yield low, high, content_view(data, off), meta_view(data, off, source[low:high], lang[low:high])


def _inputs(docs: DataFrame, *more) -> DataFrame:
    return docs.select(F.col("text"), F.col("source").cast("string"), F.col("lang").cast("string"), *more).toDF(
        *"012", *[str(i + 3) for i in range(len(more))])


def fit(docs: DataFrame, labels: DataFrame, labelled: int = 6000, pool: int = 3000) -> Model | None:
    """Fit on at most ``labelled`` labelled rows and a pool of ``pool`` rows without label.

    Both are the rows with the smallest hash of the id, so a rerun takes the
    same. These two bounds are all that limits the fit, and everything scored
    later is the whole table. Several labels of an id count as their smallest;
    null labels are none. None if a class has no labelled row.
    """
    order = F.md5(F.col("doc_id").cast("string"))
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("y"))
    near = known.orderBy(order).limit(labelled)
    free = (docs.where("doc_id is not null").select("doc_id").distinct()
            .join(known, "doc_id", "left_anti").orderBy(order).limit(pool).withColumn("y", F.lit(-1)))
    chosen = near.unionByName(free)

    def view(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, content, meta in _views(batch):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(3).slice(low, high - low), batch.column(4).slice(low, high - low),
                     pa.array([np.concatenate(r).astype(np.float16).tobytes() for r in zip(content, meta)], pa.binary())],
                    names=["doc_id", "y", "x"])

    # bounded by the two limits: of repeated rows of an id one, the smallest, is taken before they leave the tasks
    rows = (_inputs(docs.join(F.broadcast(chosen), "doc_id"), "doc_id", "y")
            .mapInArrow(view, "doc_id long, y int, x binary").groupBy("doc_id").agg(F.min("y").alias("y"), F.min("x").alias("x")))
    found = rows.coalesce(1).mapInArrow(_learn, "content array<float>, meta array<float>, scale array<double>, joined array<double>").first()
    if found is None:
        return None
    return Model(np.array(found["content"], np.float32), np.array(found["meta"], np.float32), np.array(found["scale"]).reshape(2, 2),
                 np.array(found["joined"]))


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fit, in one task over the bounded sample, so that the driver gets only weights; no row if a class is missing."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held).sort_by("doc_id")
    del held
    y = rows["y"].to_numpy()
    if not (y == 0).any() or not (y == 1).any():
        return
    x = np.empty((rows.num_rows, CONTENT + META), np.float32)
    for i, r in enumerate(rows["x"]):
        x[i] = np.frombuffer(r.as_buffer(), np.float16)
    del rows
    model = co_train(x[:, :CONTENT], x[:, CONTENT:], y)
    yield pa.RecordBatch.from_arrays(
        [pa.array([v.tolist()], pa.list_(kind)) for v, kind in ((model.content, pa.float32()), (model.meta, pa.float32()),
                                                                (model.scale.ravel(), pa.float64()), (model.join, pa.float64()))],
        names=["content", "meta", "scale", "joined"])


def score(docs: DataFrame, model: Model | None, carry: list[str], least: float = 0.5) -> DataFrame:
    """The ``carry`` columns of every row with ``score, kept, text_score, meta_score``.

    A map without shuffle. ``score`` is the joined probability of good quality and
    a row is kept from ``least`` on. Null text and text without a word
    scores 0 and is not kept. Without a model everything else scores 1 and is kept.
    Repeated rows score alike. A carried column of one of those four names is replaced.
    """
    carry = [c for c in carry if c not in ("score", "kept", "text_score", "meta_score")]
    rows = _inputs(docs, *[F.col(f"`{c}`") for c in carry])
    schema = docs.select(*[F.col(f"`{c}`") for c in carry]).schema
    for name, kind in (("score", "double"), ("kept", "boolean"), ("text_score", "double"), ("meta_score", "double")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, content, meta in _views(batch):
                n = high - low
                text, page, joined = model.score(content, meta) if model else (np.ones(n), np.ones(n), np.ones(n))
                joined = np.where(content[:, -1] > 0, joined, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i + 3).slice(low, n) for i in range(len(carry))), pa.array(joined), pa.array(joined >= least), pa.array(text), pa.array(page)],
                    names=[*carry, "score", "kept", "text_score", "meta_score"])

    return rows.mapInArrow(run, schema)

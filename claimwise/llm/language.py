"""Language identification: script ranges, per-word scores, Viterbi labels of mixed text."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from claimwise.llm.wordhash import Spans, byte_class, slices

_LETTERS = byte_class([*range(65, 91), *range(97, 123), *range(128, 256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = re.compile(r"[^\W\d_]")
BUCKETS = 1 << 15
#: Code points of scripts, as first and last; all others count as the Latin one, number 0.
_RANGES = (
    (0x0370, 0x03FF, 1), (0x1F00, 0x1FFF, 1),  # Greek
    (0x0400, 0x052F, 2), (0x1C80, 0x1C8F, 2), (0x2DE0, 0x2DFF, 2), (0xA640, 0xA69F, 2),  # Cyrillic
    (0x0530, 0x058F, 3),  # Armenian
    (0x0590, 0x05FF, 4), (0xFB1D, 0xFB4F, 4),  # Hebrew
    (0x0600, 0x06FF, 5), (0x0750, 0x077F, 5), (0x08A0, 0x08FF, 5), (0xFB50, 0xFDFF, 5), (0xFE70, 0xFEFF, 5),  # Arabic
    (0x0900, 0x097F, 6),  # Devanagari
    (0x0980, 0x0DFF, 7),  # further scripts of India
    (0x0E00, 0x0E7F, 8), (0x0E80, 0x0FFF, 9),  # Thai; Lao and Tibetan
    (0x10A0, 0x10FF, 10), (0x1C90, 0x1CBF, 10), (0x2D00, 0x2D2F, 10),  # Georgian
    (0x1100, 0x11FF, 11), (0x3130, 0x318F, 11), (0xA960, 0xA97F, 11), (0xAC00, 0xD7FF, 11),  # Hangul
    (0x3040, 0x30FF, 12), (0x31F0, 0x31FF, 12),  # Kana
    (0x2E80, 0x2FDF, 13), (0x3400, 0x4DBF, 13), (0x4E00, 0x9FFF, 13), (0xF900, 0xFAFF, 13), (0x20000, 0x3FFFF, 13),  # Han
    (0x1200, 0x139F, 14),  # Ethiopic
    (0x1780, 0x17FF, 15), (0x19E0, 0x19FF, 15),  # Khmer
)
SCRIPTS = 16


@lru_cache(maxsize=1)
def _code_points() -> tuple[np.ndarray, np.ndarray]:
    """Per code point whether it is a letter or a mark on one, and its script."""
    letter = np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)])
    script = np.zeros(0x110000, np.int64)
    for low, high, number in _RANGES:
        script[low:high + 1] = number
    return letter, script


def _decoded(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with every character beyond ASCII that is no letter as blanks, and the script at each first byte."""
    head = np.flatnonzero(data >= 0xC0)
    script = np.zeros(len(data), np.int64)
    if not len(head):
        return data, script
    lead = data[head].astype(np.int64)
    size = 1 + (lead >= 0xC0).astype(int) + (lead >= 0xE0) + (lead >= 0xF0)
    code = lead & (0xFF >> (size + 1))
    for i in (1, 2, 3):
        more = size > i
        code[more] = code[more] << 6 | (data[np.minimum(head[more] + i, len(data) - 1)] & 0x3F)
    letter, of = _code_points()
    code = np.minimum(code, 0x10FFFF)
    script[head] = of[code]
    other = ~letter[code]
    data = data.copy()
    for i in range(4):
        place = head[other & (size > i)] + i
        data[place[place < len(data)]] = 0x20
    return data, script


@dataclass
class Model:
    """Log-probabilities of letter trigrams by language, and the languages of each script."""

    languages: list[str]
    weight: np.ndarray
    allowed: np.ndarray


def _trigrams(data: np.ndarray, off: np.ndarray) -> tuple[Spans, np.ndarray, np.ndarray, np.ndarray]:
    """Words, the trigram bucket at every word byte, first of them per word, script per word."""
    data, scripts = _decoded(_LOWER[data])
    accent = np.flatnonzero(data[:-1] == 0xC3) + 1
    upper = accent[(data[accent] >= 0x80) & (data[accent] <= 0x9E) & (data[accent] != 0x97)]
    data[upper] += 0x20
    w = Spans(data, off, _LETTERS)
    inside = np.flatnonzero(_LETTERS[data])
    length = w.end - w.start
    first = np.cumsum(length) - length
    now = data[inside].astype(np.uint32)
    before, after = np.zeros_like(now), np.zeros_like(now)
    before[1:], after[:-1] = now[:-1], now[1:]
    before[first] = 0
    after[first + length - 1] = 0
    bucket = ((before * np.uint32(65599) + now) * np.uint32(65599) + after) * np.uint32(2654435761) >> np.uint32(17)
    return w, bucket.astype(np.int64), first, scripts[w.start]


def _count(batches: Iterator[pa.RecordBatch], languages: list[str]) -> Iterator[pa.RecordBatch]:
    grams = np.zeros((len(languages), BUCKETS), np.int64)
    scripts = np.zeros((len(languages), SCRIPTS), np.int64)
    number = {name: i for i, name in enumerate(languages)}
    for batch in batches:
        lang = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
        for low, high, data, off in slices(batch.column(0)):
            w, bucket, first, script = _trigrams(data, off)
            own = lang[low:high][w.doc]
            length = w.end - w.start
            grams += np.bincount(np.repeat(own, length) * BUCKETS + bucket, minlength=grams.size).reshape(grams.shape)
            scripts += np.bincount(own * SCRIPTS + script, minlength=scripts.size).reshape(scripts.shape)
    both = np.concatenate([grams, scripts], axis=1)
    where, what = np.nonzero(both)
    yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(what), pa.array(both[where, what])], names=["lang", "feature", "n"])


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts over every given row with text and language; the table has languages x ``BUCKETS`` cells.

    That table is all the driver receives, whatever the number of rows. A script
    counts for a language if one in 200 of its words is written in it.
    """
    rows = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")).dropna()
    languages = sorted(r[0] for r in rows.select("lang").distinct().collect())
    counts = np.zeros((len(languages), BUCKETS + SCRIPTS))
    if languages:
        found = (rows.mapInArrow(lambda it: _count(it, languages), "lang long, feature long, n long")
                 .groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow())
        counts[found["lang"].to_numpy(), found["feature"].to_numpy()] = found["n"].to_numpy()
    grams, scripts = counts[:, :BUCKETS] + 0.5, counts[:, BUCKETS:]
    weight = np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32)
    share = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True))
    return Model(languages, np.ascontiguousarray(weight.T), (share >= 0.005).T)


def viterbi(score: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word; ``first[d]:first[d + 1]`` are the words of text d.

    Texts of like length advance together, word by word, so the loop is as
    long as the longest text and not as the batch.
    """
    label = np.zeros(len(score), np.int32)
    length = np.diff(first)
    kind = np.ceil(np.log2(np.maximum(length, 1))).astype(int)
    for size in np.unique(kind[length > 0]):
        docs = np.flatnonzero((kind == size) & (length > 0))
        docs = docs[np.argsort(-length[docs], kind="stable")]
        n, steps = length[docs], int(length[docs].max())
        live = np.searchsorted(-n, -np.arange(steps), "left")
        begin = first[docs]
        keep = np.zeros((steps, len(docs)), np.int32)
        stays = np.zeros((steps, len(docs), score.shape[1]), bool)
        best = score[begin].astype(np.float64)
        for t in range(1, steps):
            m = live[t]
            top = best[:m].argmax(axis=1)
            enter = best[np.arange(m), top] - penalty
            keep[t, :m] = top
            stay = best[:m] >= enter[:, None]
            stays[t, :m] = stay
            best[:m] = np.where(stay, best[:m], enter[:, None]) + score[begin[:m] + t]
        now = best.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            m = live[t]
            label[begin[:m] + t] = now[:m]
            if t:
                here = now[:m]
                now[:m] = np.where(stays[t, np.arange(m), here], here, keep[t, :m])
    return label


_SPANS = "array<struct<first:long,last:long,lang:string>>"


def _predict(batches: Iterator[pa.RecordBatch], model: Model, penalty: float) -> Iterator[pa.RecordBatch]:
    k = len(model.languages)
    for batch in batches:
        column = batch.column(1)
        for low, high, data, off in slices(column, 8 << 20):
            scores, first = [], [0]
            for start in range(0, high - low, 256):
                stop = min(high - low, start + 256)
                part, own = data[off[start]:off[stop]], off[start:stop + 1] - off[start]
                w, bucket, begin, script = _trigrams(part, own)
                s = np.add.reduceat(model.weight[bucket], begin, axis=0) if len(begin) else np.zeros((0, k), np.float32)
                allowed = model.allowed[script]
                s[~allowed & allowed.any(axis=1)[:, None]] = -1e4
                scores.append(s)
                first.extend((first[-1] + w.first[1:]).tolist())
            score, first = np.concatenate(scores), np.array(first)
            n = high - low
            lang, share = ["und"] * n, np.zeros(n)
            offsets, runs = [0], ([], [], [])
            if k:
                label = viterbi(score, first, penalty)
                doc = np.repeat(np.arange(n), np.diff(first))
                votes = np.bincount(doc * k + label, minlength=n * k).reshape(n, k)
            for d in range(n):
                text = column[low + d].as_py()
                if k and text and any(m[0].isalpha() for m in _LETTER.finditer(text)):
                    if first[d + 1] > first[d]:
                        top = int(votes[d].argmax())
                        share[d] = votes[d, top] / votes[d].sum()
                        own = label[first[d]:first[d + 1]]
                        cut = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]])
                        runs[0].extend(cut[:-1].tolist())
                        runs[1].extend((cut[1:] - 1).tolist())
                        runs[2].extend(model.languages[x] for x in own[cut[:-1]])
                        lang[d] = model.languages[top]
                offsets.append(len(runs[0]))
            spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(runs[0], pa.int64()), pa.array(runs[1], pa.int64()), pa.array(runs[2], pa.string())], ["first", "last", "lang"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, n), batch.column(2).slice(low, n), pa.array(lang), pa.array(share), spans],
                names=["doc_id", "held_out", "lang_pred", "score", "spans"])


def predict(docs: DataFrame, model: Model, held_out: Column, id_col: str = "doc_id", text_col: str = "text", penalty: float = 12.0) -> DataFrame:
    """Language of every text from the labels of its words, with the labelled spans.

    A switch of language costs ``penalty`` in log-probability. The text gets the language
    of most of its words, the first in order on ties; ``score`` is their share. Words are runs of letters and marks of any script, so
    quotes, dashes and signs never vote, and
    spans count them from 0. Long texts are labelled whole. Null text and text without a letter gives ``und`` with
    score 0 and no span, as does everything when nothing was learned. A map without
    shuffle; repeated rows give repeated results; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), held_out.alias("held_out"))
    return rows.mapInArrow(lambda it: _predict(it, model, penalty),
                           f"doc_id long, held_out boolean, lang_pred string, score double, spans {_SPANS}")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", penalty: float = 12.0) -> DataFrame:
    """Learn from two thirds of the rows, chosen by the CRC of the id, and predict all rows.

    Null ids are never learned from and count as not held out.
    """
    third = F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(3)) == 1
    model = fit(docs.where(~third), text_col, lang_col)
    return predict(docs, model, F.coalesce(third, F.lit(False)), id_col, text_col, penalty)

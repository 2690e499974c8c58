"""Quality rules by compression bands: zstandard ratios of whole texts and fixed chunks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from claimwise.llm.frames import texts
from claimwise.llm.wordhash import NOT_SPACE, Spans, grams, inside_text, mix, per_text, slices, span_hashes


@dataclass(frozen=True)
class Bands:
    """Limits of compressed / raw bytes, by length of the text in bytes.

    A text in the band ``[length, next length)`` passes with a ratio within
    ``[low, high]``; texts under the first length are not judged by ratio. A text of a chunk or more
    also passes only if every chunk lies within ``chunk_low, chunk_high``; the last chunk ends with the text, so that no byte
    is left out. The upper limits lie between the highest ratio measured for English prose and that of base64 text: 0.90 and
    0.92 at 300 bytes, 0.67 and 0.78 at 1500, 0.59 and 0.76 at 4096, 0.50 and 0.75 at 20,000; under 256 bytes the two
    cannot be told apart. Random letters (0.60 to 0.65 from 1000 bytes on) and hexadecimal digits (0.50 to 0.55) lie where
    prose does and pass; repeated lines or words fall far below.
    """

    lengths: tuple[int, ...] = (128, 256, 512, 1024, 2048, 4096, 8192)
    low: tuple[float, ...] = (0.25, 0.25, 0.22, 0.22, 0.20, 0.20, 0.15)
    high: tuple[float, ...] = (1.0, 0.91, 0.785, 0.74, 0.69, 0.68, 0.65)
    chunk: int = 4096
    chunk_low: float = 0.10
    chunk_high: float = 0.68
    level: int = 3

    def chunks(self, size: int) -> list[int]:
        """First bytes of the chunks of a text of ``size`` bytes."""
        if size < self.chunk:
            return []
        whole = list(range(0, size - self.chunk + 1, self.chunk))
        return whole if whole[-1] == size - self.chunk else [*whole, size - self.chunk]


_SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, kept boolean, ratio double, chunk_min double, chunk_max double")
_SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
_HEAD = np.arange(256) & 0xC0 != 0x80


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice


def _counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The counted columns of every text of a slice."""
    w = Spans(data, off)
    hashes = span_hashes(data, w.start, w.end)
    n_words = np.diff(w.first)
    covered = np.zeros(len(w.start) + 1, np.int64)
    if len(w.start) >= 8:
        window = grams(hashes, 8)
        own = np.flatnonzero(inside_text(w, 8))
        with np.errstate(over="ignore"):
            keys = mix(window[own] + w.doc[own].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        twice = own[_repeated(keys)]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + 8, -1)
    repeat = per_text(np.cumsum(covered)[:-1] > 0, w.first)
    breaks = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([off[:-1], breaks + 1]))
    start = start[start < len(data)]
    end = np.append(start[1:], len(data))
    doc = np.searchsorted(off, start, "right") - 1
    end = end - ((end > start) & (data[np.maximum(end - 1, 0)] == 10))
    worded = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end, doc = start[worded], end[worded], doc[worded]
    with np.errstate(over="ignore"):
        line = mix(span_hashes(data, start, end) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    first = np.zeros(len(line), bool)
    first[np.unique(line, return_index=True)[1]] = True
    head = _HEAD[data]
    return {
        "n_words": n_words,
        "word_chars": per_text(head & NOT_SPACE[data], off),
        "n_symbols": per_text(_SYMBOL[data], off),
        "n_dup_lines": np.bincount(doc[~first], minlength=len(off) - 1).astype(np.int64),
        "n_repeat_words": repeat,
    }


def _judge(batches: Iterator[pa.RecordBatch], bands: Bands) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=bands.level)
    for batch in batches:
        ids, column = batch.column(0), batch.column(1)
        for low, high, data, off in slices(column):
            c = _counts(data, off)
            n = high - low
            ratio, least, most = np.full(n, np.nan), np.full(n, np.nan), np.full(n, np.nan)
            good = np.ones(n, bool)
            for d in range(n):
                raw = data[off[d]:off[d + 1]]
                if len(raw) >= bands.lengths[0]:
                    ratio[d] = len(packer.compress(raw)) / len(raw)
                    band = int(np.searchsorted(bands.lengths, len(raw), "right")) - 1
                    good[d] = bands.low[band] <= ratio[d] <= bands.high[band]
                parts = [len(packer.compress(raw[i:i + bands.chunk])) / bands.chunk for i in bands.chunks(len(raw))]
                if parts:
                    least[d], most[d] = min(parts), max(parts)
                    good[d] &= bands.chunk_low <= least[d] and most[d] <= bands.chunk_high
            failed = (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])
            yield pa.RecordBatch.from_arrays(
                [ids.slice(low, n), *(pa.array(c[k], pa.int64()) for k in
                 ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                 pa.array(failed), pa.array(good & ~failed), *(pa.array(x, from_pandas=True) for x in (ratio, least, most))],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept", "ratio", "chunk_min", "chunk_max"])


def compression_bands(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """One row per text: base counts, ratios and the verdict ``kept``.

    A map over texts without shuffle. Null and empty text has no words and so
    fails the base rule; its ratios are NULL, as are chunk ratios of texts shorter
    than a chunk, which are judged whole. Long texts are judged to their last byte. Repeated rows are judged row by row; a ratio on a limit
    passes; an empty table gives no row; a null id stays null; other
    columns are ignored. Counts compare 64-bit hashes of windows and lines.
    """
    return texts(docs, id_col, text_col).mapInArrow(lambda it: _judge(it, bands), _SCHEMA)

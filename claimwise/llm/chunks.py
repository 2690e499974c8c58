"""Substring dedup by content-defined chunks: gear rolling hash over words, digests, matched windows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from claimwise.llm import repeats
from claimwise.llm.frames import texts
from claimwise.llm.wordhash import Spans, grams, inside_text, mix

_GEAR = np.random.default_rng(99).integers(0, 1 << 32, 256, dtype=np.uint32)
_BASE = np.uint64(0x9FB21C651E98DF25)


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash ``h = (h << 1) + gear[byte]`` at every byte, from the last 32 bytes."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        later = h.copy()
        later[step:] += h[:-step] << np.uint32(step)
        h = later
    return h


def cut_points(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Words after which a chunk ends: ``bits`` bits of the gear hash over words are 0.

    The lowest but one bits are taken, which hold the last ``bits + 1`` words only.
    """
    h = gear((hashes >> np.uint64(56)).astype(np.uint8))
    return np.flatnonzero((h >> np.uint32(1)) & np.uint32((1 << bits) - 1) == 0)


def digests(hashes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of the words ``start`` to ``stop`` (exclusive) of each span; spans may overlap."""
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(len(hashes) + 1, _BASE)) * np.uint64(pow(int(_BASE), -1, 1 << 64))
        back = np.cumprod(np.full(len(hashes) + 1, pow(int(_BASE), -1, 1 << 64), np.uint64)) * _BASE
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[:-1], dtype=np.uint64)])
        return mix((total[stop] - total[start]) * back[start] + (stop - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def chosen(w: Spans, hashes: np.ndarray, bits: int, ahead: int, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Seeds of :func:`repeats.passages`: chunks of under ``words`` words with the ``ahead`` words before them.

    Cuts hang on the last words only and those stand in the seed, so the same words
    have the same seeds wherever they stand. A window that holds no chunk is a seed itself.
    """
    whole = inside_text(w, words)
    if not len(whole):
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    cut = cut_points(hashes, bits) + 1
    begin, stop = cut[:-1] - ahead, cut[1:]
    own = (begin >= w.first[w.doc[stop - 1]]) & (stop - begin < words)
    begin, stop = begin[own], stop[own]
    first = np.maximum(stop - words, w.first[w.doc[begin]])
    held = np.zeros(len(hashes) + 2, np.int64)
    np.add.at(held, first, 1)
    np.add.at(held, begin + 1, -1)
    bare = np.flatnonzero(whole & (np.cumsum(held)[:len(whole)] == 0))
    return (np.concatenate([begin, bare]), np.concatenate([digests(hashes, begin, stop), grams(hashes, words)[bare]]),
            np.concatenate([first, bare]), np.concatenate([begin, bare]))


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 50, bits: int = 3, ahead: int = 8,
) -> DataFrame:
    """``doc_id, start, stop, n_words, keep_doc_id, keep_start, text_hash, keep_text_hash``: passages that stand earlier elsewhere.

    Word spans (words from 0, ``stop`` exclusive) of at least ``least_words`` words, each with
    the place of the same words in the smallest document, or further ahead in the same
    one, that stays. Texts are cut after words, every 8 on average by default, where the last
    words say so, and an insertion moves cuts only near it. Windows of ``least_words``
    words whose chunks (each with the ``ahead`` words before it) all stand twice, or which hold
    no chunk and stand twice, are matched as a whole and chained, so every such passage is found.

    Null and empty texts and rows without id have no passage. Repeated rows of one id
    are one place; different texts of one id are texts of their own, in the order of their hashes, which tell them apart
    (``text_hash`` and ``keep_text_hash``, null for ids with one text). Words and windows are compared by 64-bit hashes. Other columns are ignored.
    """
    rows = texts(docs, id_col, text_col).where("doc_id is not null")
    return repeats.passages(rows, lambda w, h: chosen(w, h, bits, ahead, least_words), least_words)


def without_repeats(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the passages of :func:`repeated_passages`."""
    return repeats.without(docs, passages, id_col, text_col)

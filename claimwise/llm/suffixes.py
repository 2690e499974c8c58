"""Suffix-array dedup: suffixes at minimiser positions, sorted, windows around shared ones sorted in turn."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from claimwise.llm import repeats
from claimwise.llm.frames import texts
from claimwise.llm.wordhash import Spans, grams, inside_text


def smallest(keys: np.ndarray, inside: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of ``window`` positions of one text, and the position of the smallest key of each; the first of equal keys counts."""
    if len(keys) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.where(inside, keys, np.uint64(2 ** 64 - 1))
    span = np.lib.stride_tricks.sliding_window_view(low, window)
    whole = inside[:len(span)] & inside[window - 1:] & (doc[:len(span)] == doc[window - 1:len(keys)])
    starts = np.flatnonzero(whole)
    return starts, starts + span[starts].argmin(axis=1)


def minimisers(keys: np.ndarray, inside: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest key of every ``window`` positions of one text."""
    return np.unique(smallest(keys, inside, doc, window)[1])


def chosen(w: Spans, hashes: np.ndarray, words: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Seeds of :func:`repeats.passages`: suffixes at minimisers, each deciding for the windows it is the smallest of."""
    keys = grams(hashes, words)
    starts, at = smallest(keys, inside_text(w, words), w.doc, window)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (np.diff(starts) != 1)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(at))[:len(begin)] - 1
    return at[begin], keys[at[begin]], starts[begin], starts[last]


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 50) -> DataFrame:
    """``doc_id, start, stop, n_words, keep_doc_id, keep_start, text_hash, keep_text_hash``: passages that stand earlier elsewhere.

    Word spans (words from 0, ``stop`` exclusive) of at least ``least_words`` words, each with
    the place of the same words in the smallest document, or further ahead in the same
    one, that stays. Half of ``least_words`` is the compared head of a suffix, and
    windows of the other half choose the suffixes, periodic text included, so each
    ``least_words`` words hold a chosen one. Suffixes are sorted by their heads; around
    those whose head stands twice all windows of ``least_words`` words are sorted in turn and
    matched with the first place of the same words, and chained, so every such passage is found.

    Null and short texts and rows without id have no passage. Repeated rows of one id are
    one place; different texts of one id are texts of their own, in the order of their hashes, which tell them apart
    (``text_hash`` and ``keep_text_hash``, null for ids with one text). Words and windows are compared by 64-bit hashes. Other columns are ignored.
    """
    head = least_words // 2
    window = least_words - head + 1
    rows = texts(docs, id_col, text_col).where("doc_id is not null")
    return repeats.passages(rows, lambda w, h: chosen(w, h, head, window), least_words)


def without_repeats(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the passages of :func:`repeated_passages`."""
    return repeats.without(docs, passages, id_col, text_col)

"""Licence scan: matching statistics from a generalised suffix automaton of template words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from claimwise.llm.frames import texts
from claimwise.llm.wordhash import Spans, byte_class, slices, span_hashes

#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
WORD = byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Fixed phrases and their labels: every place counts, and the label is given.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Usual notices, by label. Callers may pass others.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation "
            "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "licensed under the mit license"),
    ("mit", "released under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in "
                 "compliance with the license you may obtain a copy of the license at"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("gpl", "this work is licensed under the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "copyright all rights reserved"),
)


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of word ids.

    A state knows, for every sequence it occurs in, all its end positions there.
    """

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.ends = [-1], [0], [{}]
        for number, words in enumerate(sequences):
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, word)
                self.ends[last].setdefault(number, set()).add(place)
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            for number, places in self.ends[state].items():
                self.ends[self.link[state]].setdefault(number, set()).update(places)

    def _new(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(dict(follow))
        self.length.append(length)
        self.link.append(link)
        self.ends.append({})
        return len(self.next) - 1

    def _split(self, state: int, word: int) -> int:
        """The state for ``word`` after ``state`` whose longest member has that length."""
        old = self.next[state][word]
        if self.length[old] == self.length[state] + 1:
            return old
        copy = self._new(self.length[state] + 1, self.next[old], self.link[old])
        self.link[old] = copy
        while state >= 0 and self.next[state].get(word) == old:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        made = self._new(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = made
            state = self.link[state]
        self.link[made] = 0 if state < 0 else self._split(state, word)
        return made

    def statistics(self, words: list[int]) -> list[tuple[int, int]]:
        """``(length, state)`` of the longest match that ends at each word."""
        out, state, length = [], 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            out.append((length, state))
        return out


class Scanner:
    """Templates and phrases, ready to scan slices of texts."""

    def __init__(self, templates, phrases, min_words: int, gap: int, min_cover: float):
        self.min_words, self.gap, self.min_cover = min_words, gap, min_cover
        split = [t.encode().lower().split() for _, t in templates]
        fixed = [p.encode().lower().split() for p, _ in phrases]
        words = sorted({w for t in split + fixed for w in t})
        joined = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        spans = Spans(joined, np.array([0, len(joined)]))
        hashes = span_hashes(joined, spans.start, spans.end)
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        ids = {w: i for i, w in enumerate(words)}
        self.labels, self.base_labels = [label for label, _ in templates], [label for _, label in phrases]
        self.templates = [[ids[w] for w in t] for t in split]
        self.phrases = [np.array([ids[w] for w in p]) for p in fixed]
        self.automaton = SuffixAutomaton(self.templates)
        self.pair = np.zeros((len(words) + 1, len(words) + 1), bool)
        for t in self.templates:
            self.pair[t[:-1], t[1:]] = True

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Word ids; the last id stands for all other words."""
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], len(self.sorted))

    def matches(self, run: list[int]) -> dict[int, list[tuple[int, int, int]]]:
        """Per template ``(first word, last word, template place of the last word)`` of the longest matches to the left and right.

        The state of a word has the places of the longest match that ends there; shorter ones of other places, in other templates or the same,
        belong to the states above it.
        """
        found: dict[int, list[tuple[int, int, int]]] = {}
        automaton = self.automaton
        for i, (length, state) in enumerate(automaton.statistics(run)):
            seen: dict[int, set[int]] = {}
            while length >= self.min_words:
                for number, places in automaton.ends[state].items():
                    words, known = self.templates[number], seen.setdefault(number, set())
                    for place in places - known:
                        if i + 1 == len(run) or place + 1 == len(words) or run[i + 1] != words[place + 1]:
                            found.setdefault(number, []).append((i - length + 1, i, place))
                    known |= places
                state = automaton.link[state]
                length = automaton.length[state]
        return found

    def best_chain(self, matches: list[tuple[int, int, int]]) -> tuple[int, int, int]:
        """``(words, first word, last word)`` of the chain that covers most; matches in the order of their last words.

        Links go ahead in the text, by at most ``gap`` words, and in the template. What a match shares with the one before it,
        here or there, is cut from its front, so every word of either counts once.
        """
        score, begin = [], []
        for j, (first, last, place) in enumerate(matches):
            start, top, origin = place - (last - first), last - first + 1, first
            for i in range(j - 1, -1, -1):
                _, before, at = matches[i]
                if before < first - self.gap - 1:
                    break
                cut = max(before - first + 1, at - start + 1, 0)
                if cut <= last - first and score[i] + last - first + 1 - cut > top:
                    top, origin = score[i] + last - first + 1 - cut, begin[i]
            score.append(top)
            begin.append(origin)
        j = max(range(len(matches)), key=lambda x: (score[x], -matches[x][1]))
        return score[j], begin[j], matches[j][1]

    def chains(self, run: list[int]) -> list[tuple[int, float, int, int]]:
        """``(template, covered share, first word, last word)`` of the best chains in a run, per template without overlap."""
        out = []
        for number, matches in self.matches(run).items():
            size, rest = len(self.templates[number]), sorted(matches, key=lambda m: (m[1], m[0], m[2]))
            while rest:
                words, begin, end = self.best_chain(rest)
                if words < self.min_cover * size:
                    break
                out.append((number, words / size, begin, end))
                rest = [m for m in rest if m[1] < begin or m[0] > end]
        return out

    def scan(self, data: np.ndarray, off: np.ndarray) -> list[tuple]:
        """One tuple per text, in the order of the result columns after the id."""
        w = Spans(data := _LOWER[data], off, WORD)
        ids = self.ids(span_hashes(data, w.start, w.end))
        n = len(off) - 1
        places: list[list[tuple[int, str]]] = [[] for _ in range(n)]
        for phrase, label in zip(self.phrases, self.base_labels):
            k = len(phrase)
            hit = np.ones(max(0, len(ids) - k + 1), bool)
            for j, word in enumerate(phrase):
                hit &= ids[j:len(ids) - k + 1 + j] == word
            for i in np.flatnonzero(hit):
                if w.doc[i] == w.doc[i + k - 1]:
                    places[w.doc[i]].append((int(i - w.first[w.doc[i]]), label))
        spans: list[list[tuple[str, float, int, int]]] = [[] for _ in range(n)]
        linked = self.pair[ids[:-1], ids[1:]] & (w.doc[:-1] == w.doc[1:]) if len(ids) > 1 else np.zeros(0, bool)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], linked.astype(np.int8), [0]])))
        known = ids < len(self.sorted)
        for begin, end in self._joined(edge[::2], edge[1::2], w.doc):
            doc = w.doc[begin]
            shift = begin - w.first[doc]
            run = ids[begin:end + 1]
            for number, share, first, last in self.chains(np.where(known[begin:end + 1], run, -1).tolist()):
                spans[doc].append((self.labels[number], share, int(shift + first), int(shift + last)))
        out = []
        for d in range(n):
            base = sorted({label for _, label in places[d]})
            labels = sorted({*base, *(s[0] for s in spans[d])})
            starts = [p for p, _ in places[d]]
            score = 1.0 if base else max((s[1] for s in spans[d]), default=0.0)
            out.append((int(w.first[d + 1] - w.first[d]), len(starts), min(starts, default=None), max(starts, default=None),
                        ",".join(base), ",".join(labels), score, sorted(spans[d], key=lambda s: s[2:])))
        return out

    def _joined(self, begins, ends, doc) -> Iterator[tuple[int, int]]:
        """Stretches of template word pairs, joined over gaps within one text."""
        now = None
        for b, e in zip(begins.tolist(), ends.tolist()):
            if e - b + 1 < self.min_words:
                continue
            if now and b - now[1] - 1 <= self.gap and doc[b] == doc[now[0]]:
                now = (now[0], e)
            else:
                if now:
                    yield now
                now = (b, e)
        if now:
            yield now


_SPAN = pa.list_(pa.struct([("label", pa.string()), ("share", pa.float64()), ("first", pa.int64()), ("last", pa.int64())]))
_COLUMNS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
            ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", _SPAN)]
_SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
           "score double, spans array<struct<label:string,share:double,first:long,last:long>>")


def licence_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES,
    min_words: int = 4, gap: int = 8, min_cover: float = 0.6,
) -> DataFrame:
    """One row per text: places of the fixed phrases, licence labels, and covered template spans.

    Words are compared by 64-bit hashes. A stretch of text counts for a template when
    matches of at least ``min_words`` words, in template order and at most ``gap`` words
    apart, cover ``min_cover`` of it; the chain that covers most counts, each word of text and template once, and of equal ones the first. ``score`` is the best covered share, 1 with a fixed
    phrase, 0 without any find. A map over texts without shuffle: null text is
    empty, with no words, empty labels and score 0; long texts are scanned whole; repeated rows give repeated
    results; an empty table gives no row; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases, min_words, gap, min_cover)
        for batch in batches:
            for low, high, data, off in slices(batch.column(1)):
                columns = list(zip(*scanner.scan(data, off)))
                arrays = [pa.array(list(c), kind) for c, (_, kind) in zip(columns, _COLUMNS[:-1])]
                arrays.append(pa.array([[dict(zip(("label", "share", "first", "last"), s)) for s in row] for row in columns[-1]], _SPAN))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), *arrays],
                                                 names=["doc_id", *(n for n, _ in _COLUMNS)])

    return texts(docs, id_col, text_col).mapInArrow(run, _SCHEMA)

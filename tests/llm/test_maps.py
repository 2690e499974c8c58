"""Operators that judge text by text: compression, licences, language, quality."""

import collections
import random
import re
import zlib

import numpy as np

from claimwise.llm import compression, language, licences, quality
from tests.llm.conftest import sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def test_compression_counts_equal_direct_ones(spark, edge_docs):
    rng = random.Random(1)
    texts = [sentence(rng, rng.randrange(1, 60), 3) + "\n" + sentence(rng, 5, 2) + "\r\n" + sentence(rng, 5, 2) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(edge_docs.select("doc_id", "text"))
    want = sorted(((r.doc_id, *counted(r.text)) for r in df.collect()), key=str)
    got = compression.compression_bands(df).collect()
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=str) == want
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in got)
    assert all(not (r.base_failed and r.kept) for r in got)


def test_compression_bands_reject_both_ends(spark):
    rng = random.Random(2)
    prose = sentence(rng, 2000)
    noise = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(30)) for _ in range(200))
    same = " ".join(f"{a} {b}" for a in "abcdefghij" for b in "klmnopqrst") + (" a k" * 30)
    rows = {r.doc_id: r for r in compression.compression_bands(
        spark.createDataFrame([(1, prose), (2, noise), (3, same * 20)], "doc_id long, text string")).collect()}
    assert rows[1].kept and not rows[2].kept and not rows[3].kept


def test_compression_judges_tails_and_encoded_text(spark):
    import base64

    rng = random.Random(21)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 8))) for _ in range(300)]

    def prose(n):
        out = ""
        while len(out) < n:
            out += " ".join(rng.choice(vocabulary) for _ in range(12)).capitalize() + ". "
        return out[:n]

    def noise(n):
        raw = base64.b64encode(rng.randbytes(n)).decode()
        return " ".join(raw[i:i + 60] for i in range(0, n, 60))[:n]

    texts = {1: prose(300), 2: prose(1500), 3: prose(8191), 4: prose(20_000), 11: noise(1400), 12: noise(8191), 13: noise(20_000),
             14: prose(4096) + noise(4095), 15: noise(4095) + prose(4096), 16: prose(16_000) + noise(4000)}
    got = {r.doc_id: r for r in compression.compression_bands(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert all(got[i].kept for i in (1, 2, 3, 4)), [got[i] for i in (1, 2, 3, 4)]
    assert not any(got[i].kept for i in texts if i > 10)
    bands = compression.Bands()
    for size in (0, 4095, 4096, 4097, 8191, 8192, 20_000):
        starts = bands.chunks(size)
        assert (size < 4096) == (not starts) and {b for s in starts for b in (s, s + 4095)} <= set(range(size))
        assert not starts or (starts[0] == 0 and starts[-1] + 4096 == size and all(b - a <= 4096 for a, b in zip(starts, starts[1:])))


def test_language_of_many_languages_and_scripts(spark):
    """Over 128 languages, each with letters of its own; signs and digits are no words."""
    rng = random.Random(22)
    names = [f"l{i:03d}" for i in range(150)]
    pools = {n: [chr(0x4E00 + 20 * i + j) for j in range(8)] for i, n in enumerate(names)}
    rows = [(i, " ".join("".join(rng.choice(pools[names[i % 150]]) for _ in range(4)) for _ in range(12)), names[i % 150]) for i in range(1500)]
    got = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).where("held_out").collect()
    assert np.mean([r.lang_pred == names[r.doc_id % 150] for r in got]) > 0.99 and {r.lang_pred for r in got} > {names[149], names[129]}
    data = np.frombuffer("a – “b” 。， ☺ é ç 日本 かな Ω д 𠀀 x́".encode(), np.uint8)
    w, _, _, script = language._trigrams(data, np.array([0, len(data)]))
    words = [data[a:b].tobytes().decode() for a, b in zip(w.start, w.end)]
    assert words == ["a", "b", "é", "ç", "日本", "かな", "Ω", "д", "𠀀", "x́"]
    assert script.tolist() == [0, 0, 0, 0, 13, 12, 1, 2, 13, 0]


def test_empty_tables(spark, no_docs, labels):
    assert compression.compression_bands(no_docs).count() == 0
    assert licences.licence_scan(no_docs).count() == 0
    assert language.identify(no_docs).count() == 0
    assert quality.score(no_docs, quality.fit(no_docs, labels), ["doc_id"]).count() == 0


def test_licences(spark, edge_docs):
    rows = [(100, "Free Under the MIT License; under the mit-license"), (101, "Apache  License,\nVersion 2.0"), (102, "by nc cc cc by-nc"),
            (103, "x " * 5 + "Permission is hereby granted, free of charge, to any person obtaining a copy of this FINE software and associated "
             "documentation files (the Software), to deal in the Software without restriction, including without limitation "
             "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
            (104, "under the mit"), (105, "license of the free software and the terms")]
    got = {r.doc_id: r for r in licences.licence_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[100].n_base, got[100].first_word, got[100].last_word, got[100].base_labels) == (2, 1, 5, "mit")
    assert got[101].base_labels == "apache-2" and got[102].first_word == 3 and got[102].base_labels == "cc-by-nc"
    assert got[103].labels == "mit" and got[103].base_labels == "" and got[103].spans[0].first == 5 and got[103].score > 0.9
    assert got[104].labels == got[105].labels == "" and got[105].score == 0
    edge = licences.licence_scan(edge_docs).collect()
    assert len(edge) == edge_docs.count() and all(r.n_base == 0 and r.first_word is None for r in edge)


def test_automaton_equals_brute_force():
    rng = random.Random(3)
    sequences = [[rng.randrange(4) for _ in range(rng.randrange(1, 30))] for _ in range(6)]
    automaton = licences.SuffixAutomaton(sequences)
    parts = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    text = [rng.randrange(5) for _ in range(300)]
    for i, (length, state) in enumerate(automaton.statistics(text)):
        want = next((n for n in range(min(i + 1, 40), 0, -1) if tuple(text[i + 1 - n:i + 1]) in parts), 0)
        assert length == want
        at = {n: {k + length - 1 for k in range(len(s)) if s[k:k + length] == text[i + 1 - length:i + 1]} for n, s in enumerate(sequences)} if length else {}
        assert {n: p for n, p in at.items() if p} == (automaton.ends[state] if length else {})


def scanner(templates, least=4, gap=8, cover=0.6):
    return licences.Scanner([(f"l{i}", t) for i, t in enumerate(templates)], [], least, gap, cover)


def found_spans(s, text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return [(label, round(share, 3), first, last) for label, share, first, last in s.scan(raw, np.array([0, len(raw)]))[0][-1]]


def test_licence_chains_count_words_once_and_know_all_places():
    twice = scanner(["a b c d e p q b c d e f g h"])
    assert found_spans(twice, "a b c d e f g h") == []
    assert found_spans(scanner(["a b c d e p q b c d e f g h"], cover=0.5), "a b c d e f g h") == [("l0", round(8 / 14, 3), 0, 7)]
    again = scanner(["a b c d x y z w a b c d"])
    assert found_spans(again, "x y z w zz a b c d") == [("l0", round(8 / 12, 3), 0, 8)]
    # a template that only has a part of the longest match of another one
    assert found_spans(scanner(["k k2 k3 m n o p q", "m n o p q r"]), "k k2 k3 m n o p q r") == [("l0", 1.0, 0, 7), ("l1", 1.0, 3, 8)]
    assert len(found_spans(scanner(["a b c d e"]), " ".join(["a b c d e"] * 500))) == 500


def test_licence_chains_equal_brute_force():
    """The best chain against all ways to pair words of text and template in order, in blocks of at least four with small gaps."""
    rng = random.Random(9)
    for _ in range(150):
        template = [rng.randrange(4) for _ in range(rng.randrange(6, 16))]
        run = [rng.randrange(4) for _ in range(rng.randrange(4, 22))]
        s = scanner([" ".join(f"w{x}" for x in template)], cover=0.0)
        ids = {w: i for i, w in enumerate(sorted({f"w{x}" for x in template}))}
        chain = s.best_chain(sorted(s.matches([ids.get(f"w{x}", -1) for x in run]).get(0, []), key=lambda m: (m[1], m[0], m[2]))) if s.matches(
            [ids.get(f"w{x}", -1) for x in run]).get(0) else (0, 0, 0)
        # any diagonal block of 4 and more equal words is a match; blocks may be cut where they meet
        blocks = [(i, p, n) for i in range(len(run)) for p in range(len(template)) for n in range(1, min(len(run) - i, len(template) - p) + 1)
                  if run[i:i + n] == template[p:p + n]]
        long = {(i - p, x) for i, p, n in blocks if n >= 4 for x in range(i, i + n)}
        blocks = [b for b in blocks if all((b[0] - b[1], x) in long for x in range(b[0], b[0] + b[2]))]
        blocks.sort(key=lambda b: b[0] + b[2])
        best = {}
        for i, p, n in blocks:
            best[i, p, n] = n + max((v for (a, q, m), v in best.items() if a + m <= i and q + m <= p and i - (a + m) <= 8), default=0)
        assert chain[0] == max(best.values(), default=0), (template, run)


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(1)
    score, first, penalty = rng.normal(size=(90, 3)) * 3, np.array([0, 5, 5, 6, 40, 90]), 2.0
    label = language.viterbi(score, first, penalty).astype(int)
    for a, b in zip(first[:-1], first[1:]):
        own = score[a:b]
        if len(own):
            best = own[0].copy()
            for row in own[1:]:
                best = np.maximum(best, best.max() - penalty) + row
            path = label[a:b]
            assert abs(best.max() - (own[np.arange(b - a), path].sum() - penalty * (np.diff(path) != 0).sum())) < 1e-9


def test_language_learns_labels_and_spans(spark, edge_docs):
    rng = random.Random(4)

    def text(lang, n):
        return " ".join("".join(rng.choice("aeiou" if lang == "xx" else "kztrs") for _ in range(5)) for _ in range(n))

    rows = [(i, text(lang := ("xx", "yy")[i % 2], 40), lang, "s", 0) for i in range(200)] + [(999, text("xx", 50) + ". " + text("yy", 30), None, "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in language.identify(df).collect()}
    held = [r for r in got.values() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in got if zlib.crc32(str(i).encode()) % 3 == 1}
    assert all(r.lang_pred == ("xx", "yy")[r.doc_id % 2] for r in held if r.doc_id < 999)
    assert [(s.first, s.last, s.lang) for s in got[999].spans] == [(0, 49, "xx"), (50, 79, "yy")] and got[999].lang_pred == "xx"
    edge = language.identify(edge_docs).collect()
    assert len(edge) == edge_docs.count()
    assert all((r.lang_pred == "und") == (r.doc_id in (0, 1, 2, 8)) for r in edge if r.doc_id is not None)
    assert all(0 <= r.score <= 1 for r in edge)


def test_quality_views_and_edges(spark, edge_docs, labels):
    rng = random.Random(6)
    good = [(i, sentence(rng, 60).capitalize() + ".", "en", f"s{i % 3}", 0) for i in range(150)]
    bad = [(i, "BUY NOW!! " * 30 if i % 2 else "| " + " | ".join(sentence(rng, 40).split()), "en", f"s{i % 3}", 0) for i in range(150, 300)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string, lang string, source string, n_chars long")
    known = spark.createDataFrame([(i, int(i < 150)) for i in range(0, 300, 3)], "doc_id long, quality int")
    model = quality.fit(df, known)
    got = {r.doc_id: r for r in quality.score(df, model, ["doc_id"]).collect()}
    assert np.mean([got[i].kept == (i < 150) for i in got if i % 3]) > 0.98
    assert quality.score(df, quality.fit(df, known), ["doc_id"]).orderBy("doc_id").collect() == [got[i] for i in range(300)]
    edge = quality.score(edge_docs, quality.fit(edge_docs, labels), edge_docs.columns).collect()
    assert len(edge) == edge_docs.count() and all(not r.kept for r in edge if not (r.text or "").strip(" \n\t"))
    assert quality.fit(edge_docs, labels.where("quality = 1")) is None

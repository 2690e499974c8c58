"""Source divergence audit: (group block, group block, term block) cells, summed along the terms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from claimwise.llm.frames import staged
from claimwise.llm.wordhash import Spans, byte_class, mix, slices, span_hashes

#: Bytes of ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` once A-Z are lower case.
TERM = byte_class([*range(0x61, 0x7B), *range(0x80, 0x100)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

SMOOTHING = 5
#: Groups that may be broadcast, as the counted rows show.
_FEW = 65_536
_SALTS = 32


def spelled(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes of the spans as strings."""
    size = end - start
    bounds = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(bounds[-1]) + np.repeat(start - bounds[:-1], size)
    return pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(data[place].tobytes())])


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, source, term, count, docs`` of each slice of texts."""
    for batch in batches:
        # lang and source as codes, one code a pair
        lang, source = pc.dictionary_encode(batch.column(0)), pc.dictionary_encode(batch.column(1))
        width = max(1, len(source.dictionary))
        group = lang.indices.to_numpy().astype(np.int64) * width + source.indices.to_numpy()
        for low, high, data, off in slices(batch.column(2), 1 << 23):
            data = _LOWER[data]
            w = Spans(data, off, TERM)
            if not len(w.start):
                continue
            own = group[low:high][w.doc]
            key = mix(span_hashes(data, w.start, w.end) + own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            order = np.lexsort((w.doc, key))
            key, doc = key[order], w.doc[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            other = new.copy()
            other[1:] |= doc[1:] != doc[:-1]
            at = np.flatnonzero(new)
            first = order[at]
            yield pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(own[first] // width)), source.dictionary.take(pa.array(own[first] % width)),
                 spelled(data, w.start[first], w.end[first]), pa.array(np.diff(np.append(at, len(key)))), pa.array(np.add.reduceat(other, at, dtype=np.int64))],
                names=["lang", "source", "term", "count", "docs"])


def per_billion(count: Column, total: Column) -> Column:
    """``floor(10^9 count / total)`` by long division in three steps, so that 64 bits suffice to totals of 9 x 10^15."""
    whole, rest = F.lit(0).cast("long"), count
    for _ in range(3):
        whole = whole * 1000 + F.call_function("div", rest * 1000, total)
        rest = rest * 1000 % total
    return whole


def profiles(docs: DataFrame, least_docs: int, lang_col: str, source_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Groups ``lang, source, n, v, p0`` and kept terms that occur, ``lang, source, term, p, q``; both staged.

    ``p`` is the smoothed share of the group, ``q`` that of the language, ``p0`` that of a term the
    group lacks, in billionths and one up.
    """
    named = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a)
                          for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    # counts are combined per task before the shuffle, so a frequent term or group is one row a task
    counts = (named.mapInArrow(_term_counts, "lang string, source string, term string, count long, docs long")
              .groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs")))
    term = Window.partitionBy("lang", "term")  # at most one row a source
    kept = staged(counts.withColumn("n_docs", F.sum("docs").over(term)).where(F.col("n_docs") >= least_docs)
                  .withColumn("whole", F.sum("count").over(term)).withColumn("lead", F.min("source").over(term) == F.col("source"))
                  .select("lang", "source", "term", "count", "whole", "lead"), "kept-terms")
    sizes = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.sum(F.col("lead").cast("long")).alias("led"))
    langs = sizes.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum("led").alias("v"))
    groups = staged(named.select("lang", "source").distinct().join(sizes.drop("led"), ["lang", "source"], "left").join(langs, "lang", "left")
                    .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "lang_n")]), "groups")
    few = groups.count() <= _FEW
    share = lambda count, total: 1 + per_billion(F.col(count) + SMOOTHING, F.col(total) + SMOOTHING * F.col("v"))
    shares = staged(kept.join(F.broadcast(groups) if few else groups, ["lang", "source"])
                    .select("lang", "source", "term", share("count", "n").alias("p"), share("whole", "lang_n").alias("q")), "shares")
    nothing = 1 + F.when(F.col("v") > 0, per_billion(F.lit(SMOOTHING).cast("long"), F.greatest(F.lit(1), F.col("n") + SMOOTHING * F.col("v")))).otherwise(0)
    return groups.select("lang", "source", "n", "v", nothing.alias("p0")), shares


_CELL = "lang string, a string, b string, f long, terms long"


def _cell(table: pa.Table) -> pa.Table:
    """Partial differences of the pairs of a cell over its terms, and how many terms it has."""
    sides = table["own"].to_numpy()
    head = table["term"].is_null().to_numpy()
    source = table["source"].combine_chunks().dictionary_encode()
    code = source.indices.to_numpy()
    n = len(source.dictionary)
    share, base, block = table["p"].to_numpy(), np.zeros(n, np.int64), np.zeros(n, np.int64)
    base[code[head]], block[code[head]] = share[head], sides[head]
    term, place = np.unique(table["term"].filter(pa.array(~head)).to_numpy(), return_inverse=True)
    matrix = np.repeat(base[:, None], len(term), axis=1)
    matrix[code[~head], place] = share[~head]
    gi, gj = table["gi"][0].as_py(), table["gj"][0].as_py()
    names = source.dictionary.to_pylist()
    # shuffles hand the rows of each cell over in an order of their own: a pair is named alike in all its cells
    place_of = np.empty(n, np.int64)
    place_of[sorted(range(n), key=names.__getitem__)] = np.arange(n)
    rows = [i for i in range(n) if block[i] == gi]
    columns = np.array([i for i in range(n) if block[i] == gj], np.int64)
    a, b, f = [], [], []
    for i in rows:
        other = columns if gi != gj else columns[place_of[columns] > place_of[i]]
        f += np.abs(matrix[i] - matrix[other]).sum(axis=1).tolist()
        a += [names[i]] * len(other)
        b += [names[j] for j in other]
    return pa.table({"lang": pa.array([table["lang"][0].as_py()] * len(a), pa.string()), "a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()),
                     "f": pa.array(f, pa.int64()), "terms": pa.array([len(term)] * len(a), pa.int64())})


def pair_sums(groups: DataFrame, shares: DataFrame, group_block: int, term_block: int) -> DataFrame:
    """``lang, a, b, value``: summed differences of each two sources of a language, in both directions.

    A cell holds two blocks of groups and one block of terms, whatever the language; each row
    goes to one cell per block of groups. A cell counts the terms it has; terms that
    no group of the cell has add the difference of the groups' ``p0``, after the sum over the term blocks.
    """
    most_groups, most_terms = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("g"), F.max("v").alias("v")).agg(
        F.coalesce(F.max("g"), F.lit(0)), F.coalesce(F.max("v"), F.lit(0))).first()
    side, deep = max(1, -(-most_groups // group_block)), max(1, -(-most_terms // term_block))
    own = F.pmod(F.xxhash64("source"), F.lit(side)).cast("int")
    key = F.xxhash64("term")
    heads = groups.select("lang", "source", own.alias("own"), F.explode(F.sequence(F.lit(0), F.lit(deep - 1))).alias("tb"),
                          F.lit(None).cast("long").alias("term"), F.col("p0").alias("p"))
    body = shares.select("lang", "source", own.alias("own"), F.pmod(key, F.lit(deep)).cast("int").alias("tb"), key.alias("term"), "p")
    cells = (heads.unionByName(body).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(side - 1))))
             .withColumn("gi", F.least("own", "other")).withColumn("gj", F.greatest("own", "other")).drop("other"))
    parts = cells.groupBy("lang", "gi", "gj", "tb").applyInArrow(_cell, _CELL)
    total = parts.groupBy("lang", "a", "b").agg(F.sum("f").alias("f"), F.sum("terms").alias("terms"))
    known = groups.select("lang", "source", "p0", "v")
    for name in ("a", "b"):
        total = total.join(known.select("lang", F.col("source").alias(name), F.col("p0").alias(f"{name}0"), "v"), ["lang", name])
        total = total.drop("v") if name == "a" else total
    value = F.col("f") + (F.col("v") - F.col("terms")) * F.abs(F.col("a0") - F.col("b0"))
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return total.select("lang", value.cast("long").alias("value"), F.explode(both).alias("e")).select("lang", "e.source", "e.item", "value")


def source_divergence(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = 30, most_terms: int = 50,
    group_block: int = 16, term_block: int = 1024,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far the sources of each language lie apart, and by which terms.

    Terms are runs of letters and characters beyond ASCII, A-Z lowered, that at least ``least_docs``
    documents of the language hold. A group's share of a term is ``1 + floor(10^9 (count + 5) / (n + 5 v))`` over its n
    words that are kept terms and the language's v kept terms. Part ``pair``: for every other source the sum of the absolute
    differences over all kept terms. Part ``term``: the ``most_terms`` terms a group has more of than
    its language, by that difference. All in 64-bit integers; cells know terms by 64-bit hashes.

    Null text, lang and source are empty text; a group without any kept term has the same share for each;
    a language without kept terms has values 0; repeated rows count again; long texts count
    whole; ties go by the item in byte order; empty tables give no row; other columns are ignored.
    """
    groups, shares = profiles(docs, least_docs, lang_col, source_col, text_col)
    order = [F.col("value").desc(), F.col("item")]
    own = Window.partitionBy("lang", "source").orderBy(*order)
    pairs = pair_sums(groups, shares, group_block, term_block).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(own).alias("rank"))
    above = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    salted = Window.partitionBy("lang", "source", F.pmod(F.xxhash64("item"), F.lit(_SALTS))).orderBy(*order)
    some = above.withColumn("at", F.row_number().over(salted)).where(F.col("at") <= most_terms).drop("at")
    top = some.select("lang", "source", F.lit("term").alias("part"), "item", "value", F.row_number().over(own).alias("rank")).where(F.col("rank") <= most_terms)
    return pairs.unionByName(top)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{80}-\x{10FFFF}]+') AS terms FROM documents),
c AS (
  SELECT lang, source, term, count(*) AS c, count(DISTINCT r) AS docs
  FROM (SELECT r, lang, source, unnest(terms) AS term FROM d) GROUP BY lang, source, term),
k AS (SELECT lang, term, sum(c)::BIGINT AS c FROM c GROUP BY lang, term HAVING sum(docs) >= 30),
v AS (SELECT lang, count(*) AS v, sum(c)::BIGINT AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, sum(c.c)::BIGINT AS n FROM c JOIN k USING (lang, term) GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (coalesce(n.n, 0) + 5 * v.v) AS p,
    1 + (1000000000::HUGEINT * (k.c + 5)) // (v.n + 5 * v.v) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE c > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""

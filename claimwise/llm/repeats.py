"""Repeated passages from content-selected seeds: matching, extension and removal.

A seed is a stretch of a text with a digest of its content, chosen by that content
alone. Each seed decides for some windows of ``least_words`` words: a window that
stands twice has all its seeds twice, so only windows without a seed of its own are left
out. The others are matched as a whole with the first place of the same words, and
windows on one diagonal of one pair of texts chain to a stretch. Two ways of choosing seeds
use this: content-defined chunks (:mod:`chunks`) and minimiser suffixes (:mod:`suffixes`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from claimwise.llm.frames import staged, unused
from claimwise.llm.wordhash import Spans, grams, inside_text, slices, span_hashes

#: From the words of texts and their hashes: places of the seeds, digests, and the first and last window each decides for.
Choose = Callable[[Spans, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


#: Bits for the place of a word in its text, of which a text of under 2 GB has at most 2**30.
_PLACE_BITS = 31


def shared_ids(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, copy``: the different texts of ids that have several, numbered in the order of id and hash.

    ``docs`` has ``doc_id, text``. Ids and hashes are written once and combined map-side; only texts of shared ids are sorted,
    id and hash together, so one id with many texts is dealt over several tasks. The running total has one row a partition.
    """
    seen = staged(docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("text_hash")), "ids")
    several = staged(seen.groupBy("doc_id").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high"))
                     .where("low <> high").select("doc_id"), "shared_ids")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = staged(seen.join(several, "doc_id", "left_semi").distinct().repartitionByRange(parts, "doc_id", "text_hash")
                   .sortWithinPartitions("doc_id", "text_hash").withColumn("at", F.monotonically_increasing_id()), "shared_texts")
    rows = found.withColumn("part", F.shiftright("at", 33))
    before = (rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
              .select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")))
    return staged(rows.join(F.broadcast(before), "part").select(
        "doc_id", "text_hash", (F.col("before") + F.col("at").bitwiseAND(2 ** 33 - 1)).alias("copy")), "copies")


def _place() -> Column:
    return F.col("pos").bitwiseAND(2 ** _PLACE_BITS - 1)


_PLACED = ["digest", "doc_id", "pos", "size", "ref_doc", "ref_pos", "border"]


def _first_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by digest and place, each with the first place of its digest in this partition.

    That first place itself is left out, but for the first and the last digest of the
    partition, which may go on in a neighbouring one: theirs comes marked as ``border``.
    """
    key, anchor, lead = None, None, True

    def made(columns, border: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(border)], names=_PLACED)

    for batch in batches:
        if not batch.num_rows:
            continue
        digest, doc, pos, size = (batch.column(c).to_numpy() for c in range(4))
        new = np.concatenate([[key is None or digest[0] != key], digest[1:] != digest[:-1]])
        at = np.maximum.accumulate(np.where(new, np.arange(len(digest)), -1))
        carried = (doc[0], pos[0]) if anchor is None else anchor[1:3]
        ref_doc = np.where(at < 0, carried[0], doc[np.maximum(at, 0)])
        ref_pos = np.where(at < 0, carried[1], pos[np.maximum(at, 0)])
        border = np.zeros(len(digest), bool)
        border[0] = key is None
        out = ~new | border
        yield made([c[out] for c in (digest, doc, pos, size, ref_doc, ref_pos)], border[out])
        begins = np.flatnonzero(new)
        if len(begins):
            lead = key is None and len(begins) == 1
            i = begins[-1:]
            anchor = (digest[i], doc[i[0]], pos[i[0]], doc[i], pos[i], size[i])
        key = digest[-1]
    if anchor is not None and not lead:
        yield made([anchor[0], *anchor[3:], anchor[3], anchor[4]], np.ones(1, bool))


def matched(seeds: DataFrame) -> DataFrame:
    """``doc_id, pos, size, ref_doc, ref_pos``: seeds with the first place of their digest, that place left out.

    One sort of ``digest, doc_id, pos, size`` over all tasks: places are part of the range, so a
    frequent digest is dealt over several. The sorted run is written with the first places inside
    each partition, and at most two rows a partition that may belong to a digest which goes over a border.
    When it is read, the digests on borders, of which there are fewer than partitions, get
    their first place over all of them.
    """
    parts = int(seeds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = staged(seeds.repartitionByRange(parts, "digest", "doc_id", "pos").sortWithinPartitions("digest", "doc_id", "pos").mapInArrow(
        _first_places, "digest long, doc_id long, pos long, size int, ref_doc long, ref_pos long, border boolean"), "matches")
    over = staged(found.where("border").groupBy("digest").agg(F.min(F.struct("doc_id", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1").select("digest", "first"), "borders")
    joined = found.join(F.broadcast(over), "digest", "left")
    return joined.select("doc_id", "pos", "size", F.coalesce("first.doc_id", "ref_doc").alias("ref_doc"),
                         F.coalesce("first.pos", "ref_pos").alias("ref_pos")).where("doc_id <> ref_doc or pos <> ref_pos")


def chains(hits: DataFrame) -> DataFrame:
    """``doc_id, start, stop, ref_doc, ref_start``: stretches covered by seeds on one diagonal.

    ``hits`` has ``doc_id, pos, size, ref_doc, ref_pos``, each place once. The groups are pairs
    of texts on one diagonal, at most as long as a text.
    """
    lane = Window.partitionBy("doc_id", "ref_doc", "shift").orderBy("pos")
    reach = F.max(F.col("pos") + F.col("size")).over(lane.rowsBetween(Window.unboundedPreceding, -1))
    return (hits.select("doc_id", "pos", "size", "ref_doc", (F.col("pos") - F.col("ref_pos")).alias("shift"))
            .withColumn("new", (F.coalesce(reach, F.lit(-1)) < F.col("pos")).cast("int"))
            .withColumn("part", F.sum("new").over(lane))
            .groupBy("doc_id", "ref_doc", "shift", "part")
            .agg(F.min("pos").alias("start"), F.max(F.col("pos") + F.col("size")).alias("stop"))
            .select("doc_id", "start", "stop", "ref_doc", (F.col("start") - F.col("shift")).alias("ref_start")))


def _seeds(batches: Iterator[pa.RecordBatch], choose: Choose) -> Iterator[pa.RecordBatch]:
    """Digests and places of the seeds of every text; places begin at the number of the text."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        base = batch.column(2).to_numpy() << _PLACE_BITS
        for low, high, data, off in slices(batch.column(1)):
            w = Spans(data, off)
            at, digest, first, last = choose(w, span_hashes(data, w.start, w.end))
            doc = w.doc[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest.view(np.int64)), pa.array(ids[low:high][doc]), pa.array(at - w.first[doc] + base[low:high][doc]),
                 pa.array((last - first + 1).astype(np.int32))],
                names=["digest", "doc_id", "pos", "size"])


def _windows(batches: Iterator[pa.RecordBatch], choose: Choose, words: int) -> Iterator[pa.RecordBatch]:
    """Digests and places of the windows of ``words`` words that no seed found only here decides for."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        base = batch.column(2).to_numpy() << _PLACE_BITS
        for low, high, data, off in slices(batch.column(1)):
            w = Spans(data, off)
            h = span_hashes(data, w.start, w.end)
            at, _, first, last = choose(w, h)
            asked = batch.column(3).slice(low, high - low)
            doc = np.repeat(np.arange(high - low), asked.value_lengths().to_numpy())
            place = asked.flatten().to_numpy() + w.first[doc]
            twice = np.zeros(len(h) + 1, bool)
            twice[place[place < w.first[doc + 1]]] = True
            once = ~twice[at]
            change = np.zeros(len(h) + 2, np.int64)
            np.add.at(change, first[once], 1)
            np.add.at(change, last[once] + 1, -1)
            whole = inside_text(w, words)
            kept = np.flatnonzero(whole & (np.cumsum(change)[:len(whole)] == 0))
            doc = w.doc[kept]
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams(h, words)[kept].view(np.int64)), pa.array(ids[low:high][doc]), pa.array(kept - w.first[doc] + base[low:high][doc]),
                 pa.array(np.full(len(kept), words, np.int32))], names=["digest", "doc_id", "pos", "size"])


def passages(docs: DataFrame, choose: Choose, least_words: int) -> DataFrame:
    """``doc_id, start, stop, n_words, keep_doc_id, keep_start, text_hash, keep_text_hash``: all windows that stand earlier, chained.

    Every window of ``least_words`` words must hold a seed that depends on its
    words only. A stretch inside another one is left out, and of equal ones that
    with the smallest place counts. Different texts of one id are texts of their own, in the order of their hashes: while
    places are sorted they begin at the number of the text, and ``text_hash`` (null for ids with one text) tells them apart.

    Texts are read twice: for the seeds, and for the windows between seeds found twice.
    """
    schema = "digest long, doc_id long, pos long, size int"
    copies = shared_ids(docs)
    rows = docs.withColumn("text_hash", F.xxhash64("text")).join(copies, ["doc_id", "text_hash"], "left").select(
        "doc_id", "text", F.coalesce("copy", F.lit(0)).alias("copy"))
    seeds = staged(rows.mapInArrow(lambda it: _seeds(it, choose), schema), "seeds")
    twice = matched(seeds)
    # combined before the shuffle, so the first place of a frequent digest is one row a task
    places = twice.select("doc_id", "pos").unionByName(twice.select(F.col("ref_doc").alias("doc_id"), F.col("ref_pos").alias("pos"))).distinct()
    asked = places.groupBy("doc_id", F.shiftright("pos", _PLACE_BITS).alias("copy")).agg(F.collect_list(_place()).alias("asked"))
    windows = staged(rows.join(asked, ["doc_id", "copy"]).dropDuplicates(["doc_id", "copy"]).select("doc_id", "text", "copy", "asked").mapInArrow(
        lambda it: _windows(it, choose, least_words), schema), "windows")
    lane = Window.partitionBy("doc_id").orderBy("start", F.col("stop").desc(), "ref_doc", "ref_start")
    reach = F.max("stop").over(lane.rowsBetween(Window.unboundedPreceding, -1))
    longest = chains(matched(windows)).withColumn("reach", reach).where("reach is null or reach < stop")
    own = copies.withColumnRenamed("text_hash", "hash")
    for doc, start, name in (("doc_id", "start", "text_hash"), ("ref_doc", "ref_start", "keep_text_hash")):
        of = own.select(F.col("doc_id").alias(doc), F.col("copy").alias("_copy"), F.col("hash").alias(name))
        longest = longest.withColumn("_copy", F.shiftright(start, _PLACE_BITS)).join(of, [doc, "_copy"], "left").drop("_copy")
    low = lambda c: F.col(c).bitwiseAND(2 ** _PLACE_BITS - 1)
    words = F.col("stop") - F.col("start")
    return longest.select("doc_id", low("start").alias("start"), (low("start") + words).alias("stop"), words.alias("n_words"),
                          F.col("ref_doc").alias("keep_doc_id"), low("ref_start").alias("keep_start"), "text_hash", "keep_text_hash")


def merged(spans: DataFrame) -> DataFrame:
    """``doc_id, text_hash, spans``: per text its removed stretches, joined where they touch."""
    lane = Window.partitionBy("doc_id", "text_hash").orderBy("start", "stop")
    reach = F.max("stop").over(lane.rowsBetween(Window.unboundedPreceding, -1))
    return (spans.select("doc_id", "text_hash", "start", "stop").distinct()
            .withColumn("part", F.sum((F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int")).over(lane))
            .groupBy("doc_id", "text_hash", "part").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
            .groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans")))


def _remove(batches: Iterator[pa.RecordBatch], text_col: str, cut: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column(cut)
        for low, high, data, off in slices(batch.column(text_col)):
            w = Spans(data, off)
            out = []
            for d in range(high - low):
                own = spans[low + d].as_py()
                if not own:
                    out.append(batch.column(text_col)[low + d].as_py())
                    continue
                place = lambda i: int(w.start[w.first[d] + i]) if w.first[d] + i < w.first[d + 1] else int(off[d + 1])  # noqa: B023, E731
                kept, at = [], int(off[d])
                for s in own:
                    kept.append(data[at:place(s["start"])].tobytes())
                    at = place(s["stop"])
                kept.append(data[at:off[d + 1]].tobytes())
                out.append(b"".join(kept).decode("utf-8", "replace").strip(" \t\r\n"))
            names = [n for n in batch.schema.names if n != cut]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.string()) if n == text_col else batch.column(n).slice(low, high - low) for n in names], names=names)


def without(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the stretches cut from the texts; all columns and rows stay.

    A text that loses something is also stripped at its ends. Rows without id
    pass unchanged, as do rows without a stretch. Of several texts of one id each loses its own stretches.
    """
    doc, cut, mark, of = (unused(docs, name) for name in ("_doc", "_spans", "_hash", "_of"))
    cuts = merged(spans).select(F.col("doc_id").alias(doc), F.coalesce("text_hash", F.lit(0)).alias(of), F.col("spans").alias(cut))
    ident = F.col(f"`{id_col}`").cast("long")
    named = docs.where(F.col(f"`{id_col}`").isNotNull())
    shared = shared_ids(named.select(ident.alias("doc_id"), F.col(f"`{text_col}`").alias("text"))).select(
        F.col("doc_id").alias(doc), F.col("text_hash").alias(mark))
    told = named.join(shared, (ident == F.col(doc)) & (F.xxhash64(f"`{text_col}`") == F.col(mark)), "left").drop(doc)
    joined = told.join(cuts, (ident == F.col(doc)) & (F.coalesce(mark, F.lit(0)) == F.col(of)), "left").select(*[f"`{c}`" for c in docs.columns], cut)
    done = joined.mapInArrow(lambda it: _remove(it, text_col, cut), docs.schema)
    return done.unionByName(docs.where(F.col(f"`{id_col}`").isNull()))

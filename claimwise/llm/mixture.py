"""Mixing sources to target weights by a low-discrepancy schedule of equal-word blocks.

DataFrame and SQL functions only. The same SQL text, with few dialect words
exchanged, is the DuckDB counterpart.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimwise.llm.frames import staged, unused

BLOCK = 64
CYCLE = (1.0, 2.0, 3.0)
CAP = 3
_SPAN = 1 << 32
_GOLDEN = 2654435769  # 2^32 / golden ratio, odd
#: Sources of fewer words are cut into blocks of equal size, at least so many or one a word, so that a slot is a small part of them.
SMALL = 1 << 16
LEAST_BLOCKS = 32
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def row_key(sized: DataFrame) -> list[str]:
    """The column ``row`` where :func:`sizes` was given a key."""
    return ["row"] if "row" in sized.columns else []


def source_targets(sized: DataFrame, cap: int = CAP, cycle: tuple[float, ...] = CYCLE) -> DataFrame:
    """``source, sid, source_size, target``: shares by weight, none above ``cap`` times its size.

    Sources in code point order, null last, get the weights of ``cycle`` in turn.
    The excess over the caps is shared by weight among the rest until none is above: that is
    one level for all sources not capped, found by a running sum over sources in
    the order in which they reach their cap. One row per source passes these windows.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(w) for w in cycle])
    weighed = (sources.withColumn("sid", turn.cast("int"))
               .withColumn("weight", weights[F.col("sid") % len(cycle)]).withColumn("most", F.col("source_size") * cap))
    order = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(after)
    leveled = weighed.withColumn("level", level)
    reached = F.when(F.col("most") / F.col("weight") >= F.col("level"), F.col("level"))
    return leveled.withColumn("level", F.max(reached).over(every)).select(
        "source", "sid", "source_size", F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def n_blocks(block: int) -> Column:
    """Blocks of a source: of ``block`` words, more of equal size in a small source."""
    size = F.col("source_size")
    whole = F.ceil(size / block).cast("long")
    return F.when(size < SMALL, F.greatest(whole, F.least(size, F.lit(LEAST_BLOCKS)))).otherwise(whole)


def block_start(number: Column, block: int) -> Column:
    """First word of a block of its source; that of the block after the last is the source's size."""
    size, blocks = F.col("source_size"), F.col("blocks")
    return F.when(size < SMALL, F.call_function("div", number * size, blocks)).otherwise(F.least(number * block, size))


def block_of(word: Column, block: int) -> Column:
    """The block that holds a word of its source."""
    size, blocks = F.col("source_size"), F.col("blocks")
    return F.when(size < SMALL, F.call_function("div", (word + 1) * blocks - 1, size)).otherwise(F.call_function("div", word, F.lit(block).cast("long")))


def placed(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``doc_id, size, sid, at``: first word of every document in its source's shuffled stream.

    The order is by MD5 of the id. Running sums go over 4096 hash ranges per source and
    inside each range, so a large source is many groups.
    """
    row = row_key(sized)
    known = (sized.join(targets.select("source", "sid"), sized["source"].eqNullSafe(targets["source"]))
             .select("doc_id", "size", "sid", *row, F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("h"))
             .withColumn("range", F.substring("h", 1, 3)))
    ranges = known.groupBy("sid", "range").agg(F.sum("size").alias("n"))
    ahead = Window.partitionBy("sid").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("sid", "range").orderBy("h", "doc_id", "size", *row).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = ranges.select("sid", "range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    return known.join(base, ["sid", "range"]).select(
        "doc_id", "size", "sid", *row, (F.col("base") + F.sum("size").over(inside) - F.col("size")).alias("at"))


def schedule(targets: DataFrame, slots: int, block: int = BLOCK, cap: int = CAP) -> DataFrame:
    """``slot, sid, turn``: the source of every slot and the slot's rank within it.

    Slot n holds the point ``n x golden ratio mod 1``; the source whose interval of
    cumulative ``slots`` holds it takes the slot. Intervals are looked up by
    equal cells of the unit line, so the join is on a key. Ranks are counted per run of
    65,536 slots and inside each.
    """
    spark = targets.sparkSession
    order = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("slots").over(Window.partitionBy())
    edges = (targets.where("slots > 0").withColumn("high", F.floor(F.sum("slots").over(order) / total * _SPAN))
             .withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("sid")), F.lit(0)))
             .withColumn("high", F.when(F.lead("sid").over(Window.orderBy("sid")).isNull(), F.lit(_SPAN)).otherwise(F.col("high"))).where("high > low"))
    cells = edges.select("sid", "low", "high", F.explode(F.sequence(F.shiftright("low", 20), F.shiftright(F.col("high") - 1, 20))).alias("cell"))
    points = spark.range(slots).select(F.col("id").alias("slot"), (F.col("id") % (1 << 31) * _GOLDEN % _SPAN).alias("x"))
    owned = (points.withColumn("cell", F.shiftright("x", 20)).join(cells, "cell").where("x >= low and x < high")
             .select("slot", "sid", F.shiftright("slot", 16).alias("run")))
    runs = owned.groupBy("sid", "run").agg(F.count(F.lit(1)).alias("n"))
    base = runs.select("sid", "run", F.coalesce(F.sum("n").over(
        Window.partitionBy("sid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return owned.join(base, ["sid", "run"]).select(
        "slot", "sid", (F.col("base") + F.row_number().over(Window.partitionBy("sid", "run").orderBy("slot")) - 1).alias("turn"))


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """``doc_id, source, size`` of every row, written once, and ``row`` where a column of unique row keys is given."""
    row = [F.col(f"`{row_col}`").alias("row")] if row_col else []
    return staged(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                              word_count(F.col(f"`{text_col}`")).alias("size"), *row), "sizes")


def mix(sized: DataFrame, block: int = BLOCK, cap: int = CAP, cycle: tuple[float, ...] = CYCLE) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` (and ``row``, if there) for every row of :func:`sizes`.

    The slots of a source take its blocks of about ``block`` words in order, from the front again
    when they are used up, at most ``cap`` times; ``taken`` sums what they take of a
    document. A source gets slots for its target at its own size of blocks, so each comes within
    a few blocks of its target, and a block is a small part of a small source. Null and empty texts have size 0 and nothing is taken; a
    null source is a source of its own; a null id sorts like empty text; repeated
    rows stand one after the other in the stream; long texts are many blocks; empty tables have no row. Reruns agree, since no order
    depends on partitions.
    """
    wanted = F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0)
    targets = staged(source_targets(sized, cap, cycle).withColumn("blocks", n_blocks(block)).withColumn("slots", wanted), "targets")
    # rounded, so that the order of the sum does not show
    slots = math.ceil(round(targets.agg(F.sum("slots")).first()[0] or 0.0, 6))
    taken = (schedule(targets, slots, block, cap).join(targets.select("sid", "blocks"), "sid")
             .where(F.col("turn") < F.col("blocks") * cap)
             .groupBy("sid", (F.col("turn") % F.col("blocks")).alias("block")).agg(F.count(F.lit(1)).alias("times")))
    row = row_key(sized)
    places = staged(placed(sized, targets), "places")
    pieces = places.where("size > 0").join(targets.select("sid", "source_size", "blocks"), "sid").withColumn(
        "block", F.explode(F.sequence(block_of(F.col("at"), block), block_of(F.col("at") + F.col("size") - 1, block))))
    overlap = F.least(F.col("at") + F.col("size"), block_start(F.col("block") + 1, block)) - F.greatest("at", block_start(F.col("block"), block))
    some = (pieces.withColumn("overlap", overlap).join(taken, ["sid", "block"], "left").groupBy("sid", "at", "doc_id", "size", *row)
            .agg(F.sum(F.coalesce("times", F.lit(0)) * F.col("overlap")).alias("taken")).select("doc_id", "size", "sid", "taken", *row))
    none = places.where("size = 0").select("doc_id", "size", "sid", F.lit(0).cast("long").alias("taken"), *row)
    return some.unionByName(none).join(targets.drop("source"), "sid").select("doc_id", "size", "source_size", "target", "taken", *row)


def apply_mix(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``docs`` with the words the mix takes of each text, as one text per document.

    Whole passes follow one another on new lines, then the words of a pass
    broken off. Documents of which nothing is taken go. With ``row_col``,
    the key given to :func:`sizes`, each row gets what the mix takes of it, rows without id
    too. Else rows of one id share what the mix takes of that id, and rows without id go.
    """
    doc, words, size = (unused(docs, name) for name in ("_doc", "_taken", "_size"))
    shares = mixed.where("taken > 0").groupBy(F.col("row" if row_col else "doc_id").alias(doc)).agg(F.sum("taken").alias(words), F.sum("size").alias(size))
    text = F.col(f"`{text_col}`")
    whole = F.floor(F.col(words) / F.col(size)).cast("int")
    rest = (F.col(words) - whole * F.col(size)).cast("int")
    part = F.when(rest > 0, F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + _WORD), F.lit(0)), F.lit(1), rest), ""))
    out = F.concat_ws("\n", F.array_repeat(text, whole), part)
    return docs.join(shares, F.col(f"`{row_col or id_col}`").cast("long") == F.col(doc)).withColumn(text_col, out).drop(doc, words, size)


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
weighed AS (
  SELECT source, source_size, sid, CAST(1 + sid % 3 AS DOUBLE) AS weight, {CAP} * source_size AS most FROM (
    SELECT source, source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS sid FROM (
      SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source))),
leveled AS (
  SELECT *, ((sum(source_size) OVER ())::BIGINT - coalesce((sum(most) OVER (ORDER BY most / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::BIGINT, 0))
    / sum(weight) OVER (ORDER BY most / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
targets AS (
  SELECT source, sid, source_size, least(most::DOUBLE, weight * (max(CASE WHEN most / weight >= level THEN level END) OVER ())) AS target FROM leveled),
cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN target * blocks / source_size ELSE 0.0::DOUBLE END AS slots FROM (
    SELECT *, CASE WHEN source_size < {SMALL} THEN greatest((source_size + {BLOCK} - 1) // {BLOCK}, least(source_size, {LEAST_BLOCKS}))
      ELSE (source_size + {BLOCK} - 1) // {BLOCK} END::BIGINT AS blocks FROM targets)),
placed AS (
  SELECT doc_id, size, t.sid, (sum(size) OVER (PARTITION BY t.sid ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size ROWS UNBOUNDED PRECEDING))::BIGINT - size AS pos
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
bounds AS (
  SELECT sid, coalesce(lag(high) OVER (ORDER BY sid), 0) AS low,
    CASE WHEN lead(sid) OVER (ORDER BY sid) IS NULL THEN {_SPAN} ELSE high END AS high FROM (
    SELECT sid, floor(sum(slots) OVER (ORDER BY sid ROWS UNBOUNDED PRECEDING) / (sum(slots) OVER ()) * {_SPAN})::BIGINT AS high
    FROM cut WHERE slots > 0)),
points AS (
  SELECT n AS slot, (n % 2147483648) * {_GOLDEN} % {_SPAN} AS x
  FROM range(0, (SELECT coalesce(ceil(round(sum(slots), 6)), 0)::BIGINT FROM cut)) r(n)),
owned AS (
  SELECT sid, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS turn FROM points JOIN bounds ON x >= low AND x < high),
taken AS (
  SELECT o.sid, turn % blocks AS block, count(*) AS times FROM owned o JOIN cut t ON o.sid = t.sid
  WHERE turn < {CAP} * blocks GROUP BY 1, 2),
pieces AS (
  SELECT *, unnest(CASE WHEN source_size < {SMALL} THEN range(((pos + 1) * blocks - 1) // source_size, ((pos + size) * blocks - 1) // source_size + 1)
    ELSE range(pos // {BLOCK}, (pos + size - 1) // {BLOCK} + 1) END) AS block FROM placed JOIN cut USING (sid) WHERE size > 0),
ends AS (
  SELECT *, CASE WHEN source_size < {SMALL} THEN block * source_size // blocks ELSE least(block * {BLOCK}, source_size) END AS low,
    CASE WHEN source_size < {SMALL} THEN (block + 1) * source_size // blocks ELSE least(block * {BLOCK} + {BLOCK}, source_size) END AS high FROM pieces),
sums AS (
  SELECT p.sid, p.pos, doc_id, size, sum(coalesce(times, 0) * (least(pos + size, high) - greatest(pos, low)))::BIGINT AS taken
  FROM ends p LEFT JOIN taken k ON p.sid = k.sid AND p.block = k.block GROUP BY ALL)
SELECT doc_id, size, source_size, target, taken FROM (
  SELECT sid, doc_id, size, taken FROM sums UNION ALL SELECT sid, doc_id, size, 0 FROM placed WHERE size = 0) u JOIN targets USING (sid)
"""

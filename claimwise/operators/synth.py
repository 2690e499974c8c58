"""Generated report text as column expressions.

Every choice is a byte of a hash of (row key, seed): repeatable, independent of
partitioning, and free of shuffles and Python workers. Choices are drawn as
integers; texts are looked up once in constant arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimwise.functions.hashing import digest
from claimwise.functions.text import after_first_blank, before_first_blank, quoted, squeeze, strip
from claimwise.phrases import DEFAULT_BOOK, NUMBERS, PhraseBook
from claimwise.schemas import CASE_TYPES, DEFAULT_CASE, MAJOR_SEVERITIES

#: Draws of one byte in a 60-bit integer, two of which come from one digest.
DRAWS = 7
LEVELS = ("major", "minor")


def case_type(candidates: list[Column]) -> Column:
    """First trimmed candidate that is a known case type, else the default."""
    known = [F.when(strip(c).isin(*CASE_TYPES), strip(c)) for c in candidates]
    return F.coalesce(*known, F.lit(DEFAULT_CASE))


def severity_bucket(c: Column) -> Column:
    return F.when(c.isin(*MAJOR_SEVERITIES), "major").otherwise("minor")


def vehicle_name(df: DataFrame) -> tuple[Column, Column]:
    """(make, model): the combined name split at its first blank, else the separate columns."""
    def text(name: str) -> Column:
        return F.coalesce(strip(quoted(name).cast("string")), F.lit("")) if name in df.columns else F.lit("")
    both = text("auto_make_model")
    make = F.when(both != "", before_first_blank(both)).otherwise(text("auto_make"))
    model = F.when(both != "", strip(after_first_blank(both))).otherwise(text("auto_model"))
    return make, model


def draw_names(book: PhraseBook) -> list[str]:
    """All draws of a report, in the order of the bytes they take."""
    most = max(high for _, high in book.harm.values())
    return ["plan", "count", *[f"item {i}" for i in range(most)], *book.parts, *[f"number {p}" for p in NUMBERS if p in book.parts]]


def plan_pools(book: PhraseBook, scenes: list[tuple[str, str]]) -> tuple[list[list[str]], list[int], list[int]]:
    """All plans of the book once, and first place and number of those of each scene."""
    groups: list[list[list[str]]] = []
    for scene in scenes:
        if book.plans_of(*scene) not in groups:
            groups.append(book.plans_of(*scene))
    starts = [sum(map(len, groups[:i])) for i in range(len(groups))]
    own = [groups.index(book.plans_of(*scene)) for scene in scenes]
    return [p for g in groups for p in g], [starts[g] for g in own], [len(groups[g]) for g in own]


def _array(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _at(values: list, index: Column) -> Column:
    """Entry of a constant array, counted from 0."""
    return F.element_at(_array(values), (index + 1).cast("int"))


def generate_reports(
    df: DataFrame, key: str, name: str = "generated_description", seed: int = 42,
    book: PhraseBook = DEFAULT_BOOK,
) -> DataFrame:
    """Add (or overwrite) a text column with one generated report per row.

    Reads ``auto_make_model`` or ``auto_make`` and ``auto_model``, ``auto_year``,
    ``incident_severity``, and of ``collision_type`` and ``incident_type`` those
    that exist. ``key`` must identify the row. The text leaves a one-entry ``explode``, so
    filters on it stay above the operator.
    """
    candidates = [quoted(c).cast("string") for c in ("collision_type", "incident_type") if c in df.columns]
    scenes = [(case, level) for case in sorted(CASE_TYPES) for level in LEVELS]
    make, model = vehicle_name(df)
    names = draw_names(book)
    words = -(-len(names) // DRAWS)
    half = lambda i: F.substr(digest(quoted(key), seed, i // 2), F.lit(16 * (i % 2) + 1), F.lit(15))
    work = df.withColumns({
        "_vehicle": F.concat_ws(" ", make, model, F.concat(F.lit("("), F.nullif(quoted("auto_year").cast("string"), F.lit("")), F.lit(")"))),
        "_scene": F.array_position(_array([f"{c} {s}" for c, s in scenes]), F.concat(
            case_type(candidates), F.lit(" "), severity_bucket(quoted("incident_severity")))).cast("int") - 1,
        **{f"_w{i}": F.conv(half(i), 16, 10).cast("bigint") for i in range(words)},
    })
    scene = F.col("_scene")

    def draw(label: str) -> Column:
        i = names.index(label)
        return F.shiftright(F.col(f"_w{i // DRAWS}"), 8 * (i % DRAWS)).bitwiseAND(255).cast("int")

    def pools(part: str) -> tuple[list[str], list[int], list[int]]:
        """All clauses of a part, and first place and number of those of each scene."""
        each = [book.pool(part, *s) for s in scenes]
        first = [sum(map(len, each[:i])) for i in range(len(each))]
        return [c for pool in each for c in pool], first, [len(p) for p in each]

    # harm: items drawn without replacement, as integers
    items, first, size = pools("harm")
    ranges = [book.harm_range(*s) for s in scenes]
    work = work.withColumns({
        "_n": _at([low for low, _ in ranges], scene) + draw("count") % _at([high - low + 1 for low, high in ranges], scene),
        "_rest0": F.sequence(_at(first, scene), _at(first, scene) + _at(size, scene) - 1)})
    most = max(high for _, high in ranges)
    for i in range(most):
        rest = F.col(f"_rest{i}")
        work = work.withColumn(f"_pick{i}", F.when((F.col("_n") > i) & (F.size(rest) > 0), F.element_at(rest, draw(f"item {i}") % F.greatest(F.size(rest), F.lit(1)) + 1)))
        work = work.withColumn(f"_rest{i + 1}", F.coalesce(F.array_remove(rest, F.col(f"_pick{i}")), rest))
    picked = F.array_compact(F.array(*[F.col(f"_pick{i}") for i in range(most)]))
    harm = F.concat(F.array_join(F.transform(picked, lambda i: _at(items, i)), ", "), F.lit("."))
    places = {}
    for part in book.parts:
        if part != "harm":
            _, first, size = pools(part)
            places[f"_at {part}"] = _at(first, scene) + draw(part) % _at(size, scene)
    plans, first, size = plan_pools(book, scenes)
    work = work.withColumns({**places, "_plan": _at(first, scene) + draw("plan") % _at(size, scene), "_harm": harm})

    def clause(part: str) -> Column:
        if part == "harm":
            return F.col("_harm")
        texts, at = pools(part)[0], quoted(f"_at {part}")
        if part in NUMBERS:
            least, step, count = NUMBERS[part]
            value = (draw(f"number {part}") % count * step + least).cast("string")
        else:
            value = F.col("_vehicle")
        if not any("{}" in t for t in texts):
            return _at(texts, at)
        head, tail = [t.partition("{}")[0] for t in texts], [t.partition("{}")[2] for t in texts]
        return F.concat(_at(head, at), F.when(_at(["{}" in t for t in texts], at), value).otherwise(""), _at(tail, at))

    # each clause is made once, then placed as the plan says: one branch a plan is more code than the compiler takes
    parts = list(dict.fromkeys(p for plan in plans for p in plan))
    work = work.withColumn("_clauses", F.array(*[clause(p) for p in parts]))
    places = _at([[parts.index(p) + 1 for p in plan] for plan in plans], F.coalesce("_plan", F.lit(0)))
    text = F.array_join(F.transform(places, lambda i: F.element_at("_clauses", i)), " ")
    made = work.select("*", F.explode(F.array(squeeze(text))).alias("_text"))
    return made.select(*[F.col("_text").alias(name) if c == name else quoted(c) for c in df.columns],
                       *([] if name in df.columns else [F.col("_text").alias(name)]))

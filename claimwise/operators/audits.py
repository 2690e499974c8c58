"""Constraint audits: violations as rows, and one summary row per rule.

Row-local rules (required value, range, text length, number and date format)
of a table are counted together in one pass. A summary of many rules tags what every row
has to say: the rules it breaks, and its keys with the place they stand in. Tags are combined
map-side, so any number of equal keys or broken rules is one row a task, and one
shuffle on the key answers all unique, foreign-key and local rules together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimwise.functions.text import quoted
from claimwise.schemas import (
    FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, RANGES, ROW_ID, TABLES, UNIQUE_KEYS, spark_type, varchar_limit,
)

Rules = dict[str, Column]


def not_null_rule(column: str) -> Column:
    return quoted(column).isNull()


def range_rule(column: str, low: int, high: int) -> Column:
    """Outside low..high; a missing value passes."""
    value = quoted(column).cast("string").try_cast("bigint")
    return F.coalesce(~value.between(low, high), F.lit(False))


def length_rule(column: str, limit: int) -> Column:
    return F.coalesce(F.char_length(quoted(column).cast("string")) > limit, F.lit(False))


def type_rule(column: str, kind: str) -> Column:
    """A value that does not fit the type (format, precision or range)."""
    c = quoted(column)
    return c.isNotNull() & c.cast("string").try_cast(kind).isNull()


def count_violations(df: DataFrame, rules: Rules) -> DataFrame:
    """``rule, violations``: all rules of a table in one pass."""
    names = list(rules)
    row = df.agg(*[F.count_if(rules[n]).alias(f"_{i}") for i, n in enumerate(names)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(f"_{i}").alias("violations")) for i, n in enumerate(names)
    ])))


def violating_rows(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that break a rule, with the names of the broken rules."""
    broken = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return df.withColumn("broken_rules", broken).where(F.size("broken_rules") > 0)


def not_null_rules(table: str, prefix: str = "") -> Rules:
    columns = [c for t, c in NOT_NULL if t == table] + [PRIMARY_KEYS[table]]
    return {f"not_null {table}.{c}": not_null_rule(prefix + c) for c in columns}


def range_rules(table: str, prefix: str = "") -> Rules:
    return {f"check {table}.{c}": range_rule(prefix + c, low, high) for t, c, low, high in RANGES if t == table}


def length_rules(table: str, prefix: str = "") -> Rules:
    return {f"length {table}.{c}": length_rule(prefix + c, varchar_limit(kind))
            for _, c, kind in TABLES[table] if varchar_limit(kind)}


def numeric_rules(table: str, prefix: str = "") -> Rules:
    return {f"numeric {table}.{c}": type_rule(prefix + c, kind)
            for _, c, kind in TABLES[table] if kind.startswith("DECIMAL")}


def format_rules(table: str, prefix: str = "") -> Rules:
    """Whole numbers that must be castable before the typed load."""
    return {f"type {table}.{c}": type_rule(prefix + c, spark_type(kind))
            for _, c, kind in TABLES[table] if kind in ("INT", "BIGINT")}


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """``key, copies`` of keys that occur more than once."""
    return (df.where(quoted(column).isNotNull()).groupBy(quoted(column).alias("key"))
            .agg(F.count("*").alias("copies")).where("copies > 1"))


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """``key, children`` of foreign keys without a parent.

    Children are counted per key before the join, so a key shared by very many
    children is one row of it.
    """
    counted = (child.where(quoted(key).isNotNull()).groupBy(quoted(key).alias("key"))
               .agg(F.count("*").alias("children")))
    parents = parent.select(quoted(parent_key).alias("key"))
    return counted.join(parents, "key", "left_anti")


class _Audit:
    """Rules by number, and the tags that answer them.

    A *place* is a column that holds keys; places that a foreign key links share a domain, so that a
    key meets its parents in one group.
    """

    def __init__(self) -> None:
        self.names: list[str] = []
        self.unique: list[tuple[int, int]] = []
        self.foreign: list[tuple[int, int, int]] = []
        self.places: list[object] = []
        self.domains: list[int] = []

    def _rule(self, name: str) -> int:
        self.names.append(name)
        return len(self.names) - 1

    def place(self, key: object) -> int:
        if key not in self.places:
            self.places.append(key)
            self.domains.append(len(self.domains))
        return self.places.index(key)

    def add_unique(self, name: str, key: object) -> None:
        self.unique.append((self._rule(name), self.place(key)))

    def add_foreign(self, name: str, child: object, parent: object) -> None:
        number, at, to = self._rule(name), self.place(child), self.place(parent)
        if at != to:  # a key from its own parent column always has a parent
            self.foreign.append((number, at, to))
            old, new = self.domains[at], self.domains[to]
            self.domains = [new if d == old else d for d in self.domains]

    def tags(self, df: DataFrame, local: Rules, keys: dict[object, str]) -> DataFrame:
        """``domain, place, key`` of a table: one row per non-null key and per broken rule."""
        def tag(domain: int, place: int, key: Column) -> Column:
            return F.struct(F.lit(domain).alias("domain"), F.lit(place).alias("place"), key.alias("key"))
        cells = [F.when(rule, tag(-1, -1, F.lit(str(self._rule(name))))) for name, rule in local.items()]
        for key, column in keys.items():
            if key in self.places:
                at = self.place(key)
                cells.append(F.when(quoted(column).isNotNull(), tag(self.domains[at], at, quoted(column).cast("string"))))
        return df.select(F.inline(F.array_compact(F.array(*cells))))

    def summary(self, tags: list[DataFrame], spark: SparkSession) -> DataFrame:
        """``rule, violations`` of every rule, 0 included. Copies beyond the first of a key, and children without parent."""
        def cell(number: Column, amount: Column) -> Column:
            return F.struct(number.try_cast("int").alias("number"), amount.cast("bigint").alias("violations"))
        rows = [spark.range(len(self.names)).select(F.col("id").cast("int").alias("number"), F.lit(0).cast("bigint").alias("violations"))]
        if tags:
            groups = reduce(DataFrame.unionByName, tags).groupBy("domain", "key").agg(
                F.count("*").alias("n"), *[F.count_if(F.col("place") == i).alias(f"p{i}") for i in range(len(self.places))])
            cells = [F.when(F.col("domain") == -1, cell(F.col("key"), F.col("n")))]
            cells += [F.when(F.col(f"p{at}") > 1, cell(F.lit(number), F.col(f"p{at}") - 1)) for number, at in self.unique]
            cells += [F.when((F.col(f"p{at}") > 0) & (F.col(f"p{to}") == 0), cell(F.lit(number), F.col(f"p{at}"))) for number, at, to in self.foreign]
            rows.append(groups.select(F.inline(F.array_compact(F.array(*cells)))))
        names = F.array(*[F.lit(n) for n in self.names])
        return (reduce(DataFrame.unionByName, rows).groupBy("number").agg(F.sum("violations").alias("violations"))
                .select(F.element_at(names, F.col("number") + 1).alias("rule"), "violations"))


def _key_rules(audit: _Audit, origin: dict, unique: bool, foreign: bool) -> None:
    """The unique and foreign-key rules whose columns ``origin`` maps to places."""
    for key in [*PRIMARY_KEYS.items(), *UNIQUE_KEYS] if unique else []:
        if key in origin:
            audit.add_unique(f"unique {key[0]}.{key[1]}", origin[key])
    for child, key, parent, parent_key in FOREIGN_KEYS if foreign else []:
        if (child, key) in origin and (parent, parent_key) in origin:
            audit.add_foreign(f"foreign_key {child}.{key}", origin[child, key], origin[parent, parent_key])


def _summary(tables: dict[str, DataFrame], local: bool, unique: bool, foreign: bool) -> DataFrame:
    audit = _Audit()
    _key_rules(audit, {(t, c): (t, c) for t in tables for _, c, _ in TABLES[t]}, unique, foreign)
    tags = []
    for name, df in tables.items():
        keys = {(t, c): c for t, c in audit.places if t == name}
        rules = local_rules(name) if local else {}
        if keys or rules:
            tags.append(audit.tags(df, rules, keys))
    return audit.summary(tags, next(iter(tables.values())).sparkSession)


def unique_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """``rule, violations``: surplus copies per primary or unique key; each table is read once."""
    return _summary(tables, False, True, False)


def foreign_key_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """``rule, violations``: child rows without a parent per foreign key; each table is read once."""
    return _summary(tables, False, False, True)


def local_rules(table: str, prefix: str = "") -> Rules:
    return {name: rule for make in (not_null_rules, range_rules, length_rules, numeric_rules, format_rules)
            for name, rule in make(table, prefix).items()}


def audit_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """``rule, violations`` of every constraint of the five tables: one scan a table, one shuffle of keys."""
    return _summary(tables, True, True, True)


def audit_flat(flat: DataFrame, id_column: str) -> DataFrame:
    """As :func:`audit_tables`, for five tables that are projections of one flat frame, read once.

    A row tags each distinct source column of a key once, however many keys come from it.
    """
    origin = {(t, target): id_column if source == ROW_ID else source for t, columns in TABLES.items() for source, target, _ in columns}
    wide = flat.select(*[quoted(source).alias(f"{t}.{target}") for (t, target), source in origin.items()])
    audit = _Audit()
    _key_rules(audit, origin, True, True)
    one_of = {source: f"{t}.{target}" for (t, target), source in reversed(origin.items())}
    local = {name: rule for t in TABLES for name, rule in local_rules(t, f"{t}.").items()}
    return audit.summary([audit.tags(wide, local, {source: one_of[source] for source in audit.places})], flat.sparkSession)


class AuditError(ValueError):
    """A load was refused; the message lists the broken rules."""


def require_clean(summary: DataFrame) -> None:
    """Raise if any rule is broken. The summary has one row per rule."""
    broken = summary.where("violations > 0").orderBy("rule").collect()
    if broken:
        raise AuditError("; ".join(f"{r['rule']}: {r['violations']}" for r in broken))

"""Null handling, duplicates, imputation, value fixes and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from claimwise.functions.numbers import as_double, coerce_number
from claimwise.functions.text import has_text, quoted
from claimwise.operators.ranking import medians
from claimwise.schemas import DEFAULT_NULL_TOKENS, MAKE_FIXES, SENTINEL
from claimwise.session import stage


def drop_column(df: DataFrame, name: str) -> DataFrame:
    """Drop a column if the frame has it."""
    return df.drop(name)


def nullify_tokens(df: DataFrame, tokens: list[str] = (SENTINEL,), columns: list[str] | None = None) -> DataFrame:
    """Turn whole cells equal to a token into NULL, in all text columns."""
    chosen = set(columns if columns is not None else text_columns(df))
    return df.select(*[
        F.when(~quoted(c).isin(*tokens), quoted(c)).alias(c) if c in chosen else quoted(c)
        for c in df.columns
    ])


def nullify_file_tokens(df: DataFrame, extra: list[str] = ()) -> DataFrame:
    """The reader's default null tokens, plus ``extra`` ones."""
    return nullify_tokens(df, [*DEFAULT_NULL_TOKENS, *extra])


def nan_to_null_columns(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in all floating-point columns."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.select(*[
        F.when(~F.isnan(quoted(c)), quoted(c)).alias(c) if c in floats else quoted(c)
        for c in df.columns
    ])


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))]


def column_roles(df: DataFrame, target: str | None = None) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names without the target; schema only, no job.

    Booleans belong to neither list, as in a selection by number and object type.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    texts = text_columns(df)
    return [c for c in numeric if c != target], [c for c in texts if c != target]


def empty_columns(df: DataFrame) -> list[str]:
    """Columns without a single value; one aggregate row reaches the driver."""
    row = df.agg(*[F.count(quoted(c)).alias(f"_{i}") for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if row[f"_{i}"] == 0]


def drop_empty_columns(df: DataFrame, protect: list[str] = ()) -> DataFrame:
    return df.drop(*[c for c in empty_columns(df) if c not in protect])


def has_null(columns: list[str]) -> Column:
    hit = F.lit(False)
    for c in columns:
        hit = hit | quoted(c).isNull()
    return hit


def drop_null_rows(df: DataFrame, ignore: list[str] = ()) -> DataFrame:
    """Keep rows that are complete in every column outside ``ignore``."""
    return df.na.drop("any", subset=[c for c in df.columns if c not in ignore])


def null_rows(df: DataFrame, ignore: list[str] = ()) -> DataFrame:
    """The rows :func:`drop_null_rows` removes."""
    return df.where(has_null([c for c in df.columns if c not in ignore]))


def drop_duplicate_rows(df: DataFrame, index: str | None = None) -> DataFrame:
    """One row per distinct content; with ``index`` the earliest row survives.

    Grouping by content collapses copies map-side, however many there are.
    """
    if index is None:
        return df.dropDuplicates()
    content = [c for c in df.columns if c != index]
    return (
        df.groupBy(*[quoted(c) for c in content]).agg(F.min(quoted(index)).alias(index))
        .select(*[quoted(c) for c in df.columns])
    )


def content_hash(columns: list[str]) -> Column:
    """64 bits of the row's content: rows of unlike hashes differ, rows of one hash are to be compared."""
    return F.xxhash64(*[quoted(c) for c in columns]) if columns else F.lit(0).cast("bigint")


def _hashed(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumn("_hash", content_hash(columns))


def _repeated(narrow: DataFrame) -> DataFrame:
    """``_hash``, staged: those of several rows."""
    return stage(narrow.groupBy("_hash").agg(F.count("*").alias("_rows")).where("_rows > 1").select("_hash"), "repeated")


def _later_copies(narrow: DataFrame, df: DataFrame, content: list[str], index: str) -> DataFrame:
    """Index of every later copy among the rows of ``df``; ``narrow``, staged, has their ``_hash`` and index."""
    again = _repeated(narrow)
    alone = narrow.join(again, "_hash", "left_anti").select(quoted(index))
    kept = _hashed(df, content).join(again, "_hash", "left_semi").groupBy(*[quoted(c) for c in content], "_hash").agg(F.min(quoted(index)).alias(index))
    # a row without an index is no row that was kept
    asked = narrow.join(again, "_hash", "left_semi").select(quoted(index)).unionByName(alone.where(quoted(index).isNull()))
    return asked.join(alone.unionByName(kept.select(quoted(index))), index, "left_anti")


def duplicate_rows(df: DataFrame, index: str) -> DataFrame:
    """Index of every later copy of an earlier row.

    Only hashes of all rows are shuffled; rows whose hash comes again are compared by content, copies collapsed map-side. The anti join
    runs on the index, so a large group of copies is spread over all tasks. ``df`` is read twice.
    """
    content = [c for c in df.columns if c != index]
    return _later_copies(stage(_hashed(df, content).select("_hash", quoted(index)), "hashes"), df, content, index)


#: Columns whose gaps one number tells.
_BITS = 62


def _signatures(df: DataFrame, index: str | None) -> tuple[DataFrame, list[str]]:
    """``_hash, _complete`` and the index of every row, by one scan, staged, and the names of the columns without a value."""
    content = [c for c in df.columns if c != index]
    parts = [content[i:i + _BITS] for i in range(0, len(content), _BITS)]
    gaps = [sum((F.when(quoted(c).isNull(), F.lit(2 ** j)).otherwise(F.lit(0)) for j, c in enumerate(part)), F.lit(0).cast("bigint")).alias(f"_gaps{i}")
            for i, part in enumerate(parts)]
    found = stage(df.select(*([quoted(index)] if index else []), content_hash(content).alias("_hash"), *gaps), "signatures")
    # one row of a number per 62 columns
    row = found.agg(F.count("*").alias("rows"), *[F.bit_and(f"_gaps{i}").alias(f"_gaps{i}") for i in range(len(parts))]).first()
    emptied, complete = [], F.lit(True)
    for i, part in enumerate(parts):
        here = [c for j, c in enumerate(part) if not row["rows"] or row[f"_gaps{i}"] >> j & 1]
        used = sum(2 ** j for j, c in enumerate(part) if c not in here)
        emptied += here
        complete = complete & (F.col(f"_gaps{i}").bitwiseAND(F.lit(used).cast("bigint")) == 0)
    return found.select(*([quoted(index)] if index else []), "_hash", complete.alias("_complete")), emptied


def cleanup_summary(df: DataFrame, index: str | None = None) -> DataFrame:
    """One row of cleanup counts: hashes of complete rows are counted, and only rows whose hash comes again compared by content."""
    narrow, emptied = _signatures(df, index)
    used = [c for c in df.columns if c != index and c not in emptied]
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    hashes = stage(narrow.groupBy("_complete", F.when(F.col("_complete"), F.col("_hash")).alias("_hash")).agg(F.count("*").alias("_rows")), "hashes")
    again = stage(hashes.where("_complete AND _rows > 1").select("_hash"), "repeated")
    content = [c for c in df.columns if c != index]
    repeated = (_hashed(df.where(~has_null(used)), content).join(again, "_hash", "left_semi")
                .groupBy(*[quoted(c) for c in used], "_hash").agg(F.count("*").alias("_rows")))
    totals = hashes.agg(zero(F.sum("_rows")).alias("original_rows"), zero(F.sum(F.when(~F.col("_complete"), F.col("_rows")))).alias("null_rows"),
                        F.count_if(F.col("_complete") & (F.col("_rows") == 1)).alias("_alone"))
    final = F.col("_alone") + F.col("_distinct")
    return totals.join(repeated.agg(F.count("*").alias("_distinct"))).select(
        "original_rows",
        F.lit(len(emptied)).cast("bigint").alias("emptied_columns"),
        F.lit(", ".join(emptied) if emptied else "none").alias("emptied_names"),
        "null_rows",
        (F.col("original_rows") - F.col("null_rows") - final).alias("duplicate_rows"),
        final.alias("final_rows"),
    )


def cleanup_rejects(df: DataFrame, index: str) -> DataFrame:
    """``row_index, reason`` of every row the strict cleaning removes."""
    narrow, emptied = _signatures(df, index)
    content = [c for c in df.columns if c != index]
    copies = _later_copies(narrow.where("_complete"), df.where(~has_null([c for c in content if c not in emptied])), content, index)
    return narrow.where("NOT _complete").select(quoted(index).alias("row_index"), F.lit("null").alias("reason")).unionByName(
        copies.select(quoted(index).alias("row_index"), F.lit("duplicate").alias("reason")))


def strict_clean(df: DataFrame, index: str | None = None) -> DataFrame:
    """Drop empty columns, then incomplete rows, then copies."""
    protect = [index] if index else []
    return drop_duplicate_rows(drop_null_rows(drop_empty_columns(df, protect), protect), index)


def cleanup_report_lines(summary: DataFrame, rejects: DataFrame) -> DataFrame:
    """``section, position, line``: the text report, ordered by the first two columns."""
    # one row, read twice
    summary = stage(summary, "summary")
    head = summary.select(F.lit(0).alias("section"), F.posexplode(F.array(
        F.concat(F.lit("Original rows: "), F.col("original_rows")),
        F.concat(F.lit("Removed fully empty columns ("), F.col("emptied_columns"), F.lit("): "), F.col("emptied_names")),
        F.concat(F.lit("Removed rows with null values: "), F.col("null_rows")),
        F.concat(F.lit("Removed duplicate rows: "), F.col("duplicate_rows")),
        F.concat(F.lit("Final rows: "), F.col("final_rows")),
    )).alias("position", "line")).withColumn("position", F.col("position").cast("bigint"))
    titles = summary.select(F.inline(F.array(
        F.struct(F.lit(1).alias("section"), F.col("null_rows").alias("hits"),
                 F.lit("Rows removed because of null values:").alias("title")),
        F.struct(F.lit(2).alias("section"), F.col("duplicate_rows").alias("hits"),
                 F.lit("Duplicate rows removed:").alias("title")),
    ))).where("hits > 0").select("section", F.inline(F.array(
        F.struct(F.lit(-2).cast("bigint").alias("position"), F.lit("").alias("line")),
        F.struct(F.lit(-1).cast("bigint").alias("position"), F.col("title").alias("line")),
    )))
    items = rejects.select(
        F.when(F.col("reason") == "null", 1).otherwise(2).alias("section"),
        F.col("row_index").alias("position"),
        F.concat(F.lit("- row_index="), F.col("row_index")).alias("line"))
    return head.unionByName(titles).unionByName(items)


def coerce_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text to number in the named columns; malformed text becomes NULL."""
    return df.withColumns({c: coerce_number(quoted(c)) for c in columns})


def parse_dates(df: DataFrame, columns: list[str], fmt: str | list[str] = "yyyy-MM-dd", on_error: str = "raise") -> DataFrame:
    """Text to DATE by the first format that fits; other text is an error unless ``on_error="null"``."""
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be 'raise' or 'null'")
    formats = [fmt] if isinstance(fmt, str) else list(fmt)

    def read(c: Column) -> Column:
        found = F.coalesce(*[F.try_to_date(c, f) for f in formats])
        if on_error == "null":
            return found
        wrong = F.raise_error(F.concat(F.lit("no date in "), F.lit(" / ".join(formats)), F.lit(": "), c))
        return F.coalesce(found, F.when(c.isNotNull(), wrong.cast("date")))

    return df.withColumns({c: read(quoted(c)) for c in columns})


def flag_to_boolean(df: DataFrame, column: str, true: str = "Y", false: str = "N") -> DataFrame:
    """Two flag texts to BOOLEAN; anything else becomes NULL."""
    c = quoted(column)
    return df.withColumn(column, F.when(c == true, True).when(c == false, False))


def gapped(df: DataFrame, columns: list[str]) -> list[str]:
    """Those of ``columns`` with a NULL; one aggregate row reaches the driver."""
    if not columns:
        return []
    row = df.agg(*[F.coalesce(F.bool_or(quoted(c).isNull()), F.lit(False)).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if row[f"_{i}"]]


def impute_median(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fill numeric columns that have gaps with their exact median, as DOUBLE.

    A column without a gap keeps its type; one scan finds the gaps. The
    medians form one single-row subquery; no join with the data.
    """
    columns = gapped(df, columns if columns is not None else column_roles(df)[0])
    if not columns:
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    found = medians(df, columns).agg(F.map_from_entries(F.collect_list(F.struct("feature", "median"))).alias("m"))
    # one subquery column, not one subquery per imputed column
    return df.withColumn("_fill", found.scalar()).withColumns({
        c: F.coalesce(as_double(quoted(c), types[c]), F.try_element_at("_fill", F.lit(c))) for c in columns
    }).drop("_fill")


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """``feature, mode``: the most frequent value, the smallest one on ties.

    Values are counted across the cluster first, so a column of distinct
    addresses needs no in-memory map.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), quoted(c).alias("value")) for c in columns])
    counts = (df.select(F.inline(cells)).where("value IS NOT NULL")
              .groupBy("feature", "value").agg(F.count("*").alias("n")))
    return counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))


def impute_mode(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fill text columns that have gaps with their mode; a column without values stays NULL.

    One scan finds the gaps, so that only values of columns to be filled are counted.
    """
    columns = gapped(df, columns if columns is not None else column_roles(df)[1])
    if not columns:
        return df
    found = modes(df, columns).agg(F.map_from_entries(F.collect_list(F.struct("feature", "mode"))).alias("m"))
    return df.withColumn("_fill", found.scalar()).withColumns({
        c: F.coalesce(quoted(c), F.try_element_at("_fill", F.lit(c))) for c in columns
    }).drop("_fill")


def fix_values(df: DataFrame, column: str = "auto_make", fixes: dict[str, str] | None = None) -> DataFrame:
    """Replace misspelt values by a dictionary."""
    return df.na.replace(fixes or MAKE_FIXES, subset=[column])


def null_profile(df: DataFrame) -> DataFrame:
    """``column, nulls``, most nulls first."""
    row = df.agg(*[F.count_if(quoted(c).isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("nulls")) for i, c in enumerate(df.columns)
    ]))).orderBy(F.desc("nulls"), "column")


def total_nulls(df: DataFrame) -> DataFrame:
    """One row: number of missing cells in the frame."""
    cells = sum((quoted(c).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    return df.agg(F.coalesce(F.sum(cells), F.lit(0).cast("bigint")).alias("nulls"))


def table_profile(df: DataFrame) -> DataFrame:
    """``column, dtype, non_null, rows`` for every column, in one pass."""
    row = df.agg(F.count("*").alias("_rows"), *[F.count(quoted(c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column"), F.lit(kind).alias("dtype"),
                 F.col(f"_{i}").alias("non_null"), F.col("_rows").alias("rows"))
        for i, (name, kind) in enumerate(df.dtypes)
    ])))


def head_ordered(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return df.orderBy(*[quoted(c) for c in order_by]).limit(n)


def drop_leakage(df: DataFrame, target: str, word: str = "claim") -> DataFrame:
    """Drop columns whose name contains ``word``, except the target."""
    return df.drop(*[c for c in df.columns if word in c.lower() and c != target])


def reject_blank(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows with text, rows whose text is missing or white space only)."""
    filled = has_text(quoted(column))
    return df.where(filled), df.where(~filled)

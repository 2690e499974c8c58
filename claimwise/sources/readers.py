"""CSV and table readers for claims data and report texts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from claimwise.functions.text import quoted
from claimwise.operators.cleaning import nullify_tokens
from claimwise.schemas import CLAIMS_RAW, DEFAULT_NULL_TOKENS, SENTINEL
from claimwise.session import stage
from claimwise.sources import records
from claimwise.sources.writers import current_generation

_RAW = "_csv_record"
_CSV = {"header": True, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW}


def _checked(df: DataFrame, names: list[str], places: list[Column], file: Column) -> DataFrame:
    """The named fields, NULL as empty text, and ``places``; a record with more fields than columns is an error that shows it.

    Shorter records stay: their absent fields are empty. The message also holds the first
    field, since a CSV scan needs one beside the raw record.
    """
    bare = F.regexp_replace(_RAW, '"(?:[^"]|"")*"', "")
    surplus = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) >= len(names)
    message = F.concat(F.lit("more fields than columns in "), file, F.lit(", record "),
                       F.coalesce(quoted(names[0]), F.lit("")), F.lit(": "), F.col(_RAW))
    return df.where(F.when(surplus, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).select(
        *[F.coalesce(quoted(c), F.lit("")).alias(c) for c in names], *places)


def _parsed(spark: SparkSession, path: str, parity: DataFrame, names: list[str], positions: bool) -> DataFrame:
    """The records of files with line breaks in quotes, parsed one by one where their lines lie."""
    found = records.records(spark, path, parity)
    text = F.regexp_replace("record", r"\r\z", "").alias(_RAW)
    inner = [f"c{i}" for i in range(len(names))]
    schema = ", ".join(f"{c} string" for c in inner)
    fields = F.from_csv(F.col(_RAW), schema, {k: str(_CSV[k]) for k in ("quote", "escape", "mode")} | {"multiLine": "true", "maxCharsPerColumn": "-1"})
    rows = found.select("file", "block", "index", text).withColumn("_fields", fields)
    named = rows.select(*[F.col(f"_fields.{c}").alias(n) for c, n in zip(inner, names)], _RAW, "file", "block", "index")
    head = (F.col("block") == 0) & (F.col("index") == 0)
    wrong = F.lit(False)
    for n in names:
        wrong = wrong | ~quoted(n).eqNullSafe(F.lit(n))
    message = F.concat(F.lit("the header of "), F.col("file"), F.lit(" differs from the columns: "), F.col(_RAW))
    body = named.where(F.when(head & wrong, F.raise_error(message).cast("boolean")).otherwise(~head))
    places = [F.col("file").alias("_file"), F.col("block").alias("_block"), F.col("index").alias("_seq")] if positions else []
    return _checked(body, names, places, F.col("file"))


def read_csv_text(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multiline: bool = True, positions: bool = False,
) -> DataFrame:
    """Every field as text, by header name, without null tokens.

    Without a schema the header names the columns. With one, the header of
    every file is checked against it. Absent trailing fields read as empty
    text; surplus fields are an error. Line breaks inside quotes are read, or are an error without
    ``multiline``; a quote that is never closed is an error. ``positions`` adds ``_file, _block,
    _seq`` for ``file_row_index``.

    Files are read by blocks in any case. A pass over the lines counts quotes per
    block: where every line has an even number, each line is a record and the built-in
    reader takes the files; else records are joined from lines (:mod:`records`). A quote inside
    a field that is not quoted counts like any other.
    """
    if schema is None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in spark.read.options(**_CSV, multiLine=multiline).csv(path).columns])
    names = schema.fieldNames()
    parity = stage(records.block_parity(records.lines(spark, path)), "parity")
    odd_lines = parity.agg(F.coalesce(F.sum("odd_lines"), F.lit(0))).first()[0]
    if odd_lines and not multiline:
        line = records.lines(spark, path).where("odd = 1").first()
        raise ValueError(f"unbalanced quotes in {line['file']}: {line['line']!r}; read it with multiline=True")
    if odd_lines:
        open_file = parity.groupBy("file").agg(F.sum("odd").alias("odd")).where("odd % 2 = 1").first()
        if open_file is not None:
            raise ValueError(f"unbalanced quotes in {open_file['file']}: a quote is never closed")
        return _parsed(spark, path, parity, names, positions)
    whole = T.StructType([*schema.fields, T.StructField(_RAW, T.StringType())])
    df = spark.read.options(**_CSV, multiLine=False, enforceSchema=False).schema(whole).csv(path)
    places = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
              F.monotonically_increasing_id().alias("_seq")] if positions else []
    return _checked(df, names, places, F.col("_metadata.file_path"))


def read_claims(
    spark: SparkSession, path: str, extra_null_tokens: list[str] = (), schema: T.StructType | None = None,
    positions: bool = False, multiline: bool = True,
) -> DataFrame:
    """Claims CSV as text columns with the usual null tokens read as NULL.

    ``positions`` adds ``_file, _block, _seq`` for ``file_row_index``.
    """
    df = read_csv_text(spark, path, schema, multiline, positions)
    places = ("_file", "_block", "_seq") if positions else ()
    return nullify_tokens(df, [*DEFAULT_NULL_TOKENS, *extra_null_tokens], [c for c in df.columns if c not in places])


def read_claims_strict(spark: SparkSession, path: str, **options) -> DataFrame:
    """As :func:`read_claims`, with the sentinel as a further null token."""
    return read_claims(spark, path, extra_null_tokens=[SENTINEL], **options)


def read_claims_optional(spark: SparkSession, path: str, schema: T.StructType = CLAIMS_RAW, **options) -> DataFrame:
    """As :func:`read_claims`; a missing path gives an empty frame."""
    try:
        return read_claims(spark, path, schema=schema, **options)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_tables(spark: SparkSession, location: str, names: list[str]) -> dict[str, DataFrame]:
    """Parquet tables of the last complete ``write_tables``."""
    base = current_generation(spark, location)
    return {name: spark.read.parquet(f"{base}/{name}") for name in names}

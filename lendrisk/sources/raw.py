"""Reading the three raw tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lendrisk import fixed_values as V
from lendrisk.functions.text import null_if_in

INGEST_SEQ = "ingest_seq"

# Columns of a checked scan: the text of a record that can't be taken apart, and what of a record could not be used.
MALFORMED, REJECTS = "_malformed", "_rejects"

# Text columns in which the scan reads no null tokens: a member may be called "None". It reads them in all others.
SPARED_COLUMNS = ("first_name", "last_name")


@dataclass(frozen=True)
class RawTables:
    """The raw tables. ``member_order`` names the members column that says which of two duplicates came first; ``rejects`` holds
    what reading them could not use, if they were read from text."""

    members: DataFrame
    loans: DataFrame
    payments: DataFrame
    member_order: str = INGEST_SEQ
    rejects: DataFrame | None = None

    def named(self) -> dict[str, DataFrame]:
        return {f"raw_{name}": getattr(self, name) for name in ("members", "loans", "payments")}


def _path_order(path: Column) -> Column:
    """What file paths sort by so that the numbers in them compare as numbers: every number padded to 20 digits."""
    padded = F.regexp_replace(path, r"(\d+)", "00000000000000000000$1")
    return F.regexp_replace(padded, r"\d*?(\d{20})(?!\d)", "$1")


def with_ingest_seq(scan: DataFrame, name: str = INGEST_SEQ) -> DataFrame:
    """Add each row's place in the source: file path, then position in the file (H1).

    Use it directly on a file scan, before any shuffle. Across files "first" means the lower path, with the numbers in it
    compared as numbers: part-99999 comes before part-100000. What a path sorts by is worked out once a file and broadcast, a row
    per file, as it costs more than reading a row; a path that the scan spells otherwise than its list of files is worked out by row.
    """
    # a scan spells local files with one slash
    paths = {path.replace("file:///", "file:/", 1) if path.startswith("file:///") else path for path in scan.inputFiles()}
    files = scan.sparkSession.createDataFrame([(path,) for path in sorted(paths)], "_path string")
    placed = scan.withColumn("_place", F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ))
    ordered = F.broadcast(files.withColumn("_order", _path_order(F.col("_path"))))
    order = F.coalesce(F.col("_order"), _path_order(F.col("_place.file")))
    place = F.struct(order.alias("order"), F.col("_place.file"), F.col("_place.block"), F.col("_place.row"))
    return placed.join(ordered, F.col("_place.file") == F.col("_path"), "left").select(*scan.columns, place.alias(name))


def _typed(text: Column, dtype: T.DataType, tokens: Sequence[str]) -> Column:
    """A numeric cell: null tokens and unreadable texts give NULL. Whole numbers may be written as ``60.0`` but have no fraction."""
    number = null_if_in(F.trim(text), tokens).try_cast("double")
    return F.when(number == F.rint(number), number.try_cast(dtype)) if isinstance(dtype, T.LongType) else number


def read_csv_checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    null_tokens: Sequence[str] = V.NULL_TOKENS,
    spared_columns: Sequence[str] = SPARED_COLUMNS,
) -> DataFrame:
    """``read_csv`` with the column ``_rejects``: what of a record could not be used, as (column, text) parts.

    A record with more or fewer cells than the header can't be assigned: its cells are NULL and its one part holds the whole record
    with a NULL column. A cell of a number column that is neither a null token nor a number is NULL and a part of its own.
    ``usable_rows`` and ``rejected_cells`` take the two apart; store the result once to read both from it.
    """
    texts = T.StructType([*(T.StructField(f.name, T.StringType()) for f in schema), T.StructField(MALFORMED, T.StringType())])
    options = {"header": True, "enforceSchema": False, "escape": '"', "columnNameOfCorruptRecord": MALFORMED, "columnPruning": False}
    scan = spark.read.schema(texts).options(**options).csv(path)
    whole = F.col(MALFORMED).isNull()

    def cell(field: T.StructField) -> Column:
        text = F.col(field.name)
        if not isinstance(field.dataType, T.StringType):
            text = _typed(text, field.dataType, null_tokens)
        elif field.name not in spared_columns:
            text = null_if_in(text, null_tokens)
        return F.when(whole, text).alias(field.name)

    def part(column: Column, text: Column) -> Column:
        return F.struct(column.cast("string").alias("column"), text.alias("text"))

    unreadable = [
        F.when(
            null_if_in(F.trim(F.col(f.name)), null_tokens).isNotNull() & _typed(F.col(f.name), f.dataType, null_tokens).isNull(),
            part(F.lit(f.name), F.col(f.name)),
        )
        for f in schema
        if not isinstance(f.dataType, T.StringType)
    ]
    rejects = F.when(whole, F.array_compact(F.array(*unreadable))).otherwise(F.array(part(F.lit(None), F.col(MALFORMED))))
    return with_ingest_seq(scan).select(*map(cell, schema), INGEST_SEQ, rejects.alias(REJECTS))


def malformed() -> Column:
    """True for a record that ``read_csv_checked`` could not take apart."""
    return F.exists(REJECTS, lambda r: r["column"].isNull())


def usable_rows(checked: DataFrame) -> DataFrame:
    """The records that have a cell for every column."""
    return checked.where(~malformed()).drop(REJECTS)


def rejected_cells(checked: DataFrame, source: str) -> DataFrame:
    """(source, file, place, key, column, text) of what could not be used: a NULL column is a whole record.

    ``place`` orders a file's rejects as they stand in it; ``key`` is the record's first cell.
    """
    key = F.col(checked.columns[0]).alias("key")
    place = F.struct(f"{INGEST_SEQ}.block", f"{INGEST_SEQ}.row").alias("place")
    parts = checked.where(F.size(REJECTS) > 0).select(F.col(f"{INGEST_SEQ}.file").alias("file"), place, key, F.explode(REJECTS).alias("part"))
    return parts.select(F.lit(source).alias("source"), "file", "place", "key", "part.column", "part.text")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    null_tokens: Sequence[str] = V.NULL_TOKENS,
    spared_columns: Sequence[str] = SPARED_COLUMNS,
) -> DataFrame:
    """Scan a CSV file or directory with a header, no inference (S1, S2). Header names must match the schema.

    Blanks around texts are kept: cleaning decides about them. Records with too many or too few cells are left out; see
    ``read_csv_checked`` for those and for cells that can't be read.
    """
    return usable_rows(read_csv_checked(spark, path, schema, null_tokens=null_tokens, spared_columns=spared_columns))


def read_raw(
    spark: SparkSession,
    directory: str,
    file_format: str = "csv",
    paths: Mapping[str, str] | None = None,
    *,
    null_tokens: Sequence[str] = V.NULL_TOKENS,
    spared_columns: Sequence[str] = SPARED_COLUMNS,
) -> RawTables:
    """Read ``raw_members``, ``raw_loans`` and ``raw_payments`` from a directory.

    Each is ``<directory>/<name>.<file_format>``, a file or a directory of files; ``paths`` overrides single ones. In CSV files
    ``null_tokens`` are read as missing in every column but ``spared_columns``, and ``rejects`` holds what could not be used.
    """
    read = partial(_read_table, spark, directory, file_format, paths or {}, null_tokens, spared_columns)
    tables = {name: read(name) for name in V.RAW_SCHEMAS}
    return raw_tables(tables) if file_format == "csv" else RawTables(*(_without_place(name, df) for name, df in tables.items()))


def read_raw_checked(
    spark: SparkSession,
    directory: str,
    paths: Mapping[str, str] | None = None,
    *,
    null_tokens: Sequence[str] = V.NULL_TOKENS,
    spared_columns: Sequence[str] = SPARED_COLUMNS,
) -> dict[str, DataFrame]:
    """The three raw CSV tables as ``read_csv_checked`` gives them, to be stored before ``raw_tables`` takes them apart."""
    read = partial(_read_table, spark, directory, "csv", paths or {}, null_tokens, spared_columns)
    return {name: read(name) for name in V.RAW_SCHEMAS}


def raw_tables(checked: Mapping[str, DataFrame]) -> RawTables:
    """Raw tables and their rejects from ``read_raw_checked`` or from what it was stored as."""
    rejects = [rejected_cells(df, name) for name, df in checked.items()]
    return RawTables(
        *(_without_place(name, usable_rows(df)) for name, df in checked.items()),
        rejects=rejects[0].unionByName(rejects[1]).unionByName(rejects[2]),
    )


def _without_place(name: str, table: DataFrame) -> DataFrame:
    return table if name == "raw_members" else table.drop(INGEST_SEQ)


def _read_table(
    spark: SparkSession,
    directory: str,
    file_format: str,
    paths: Mapping[str, str],
    null_tokens: Sequence[str],
    spared_columns: Sequence[str],
    name: str,
) -> DataFrame:
    path, schema = paths.get(name, f"{directory}/{name}.{file_format}"), V.RAW_SCHEMAS[name]
    if file_format == "csv":
        return read_csv_checked(spark, path, schema, null_tokens=null_tokens, spared_columns=spared_columns)
    return with_ingest_seq(spark.read.schema(schema).format(file_format).load(path))


def register(tables: Mapping[str, DataFrame]) -> None:
    """Make tables queryable by name, replacing earlier ones (S3)."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One (table, rows) row per table."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, table in tables.items()
    ]
    union = counts[0]
    for count in counts[1:]:
        union = union.unionByName(count)
    return union

"""Writing results: parquet tables, and CSV files for a dashboard."""

import json
import tempfile
import uuid
from collections.abc import Collection, Mapping
from concurrent.futures import Executor

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from lendrisk import fixed_values as V
from lendrisk.functions.text import plain_money

# Money columns, written as plain decimals.
MONEY_COLUMNS = (
    "original_amount", "expected_amount", "actual_amount", "shortfall", "amount_past_due", "amount_at_risk",
    "total_amount_past_due",
)


#: A text that no cell holds, for the CSV reader to tell a missing cell from an empty text.
NO_CELL = "\u0000"


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Store a table as parquet, replacing an earlier one, and return it as read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_csv(df: DataFrame, path: str, single: bool = False) -> int:
    """Write a table as CSV with a header, replacing an earlier one, and return its row count.

    The rows are counted while they are written, not in a second pass. Texts keep their blanks. A missing cell is written as nothing
    and an empty text as ``""``; the columns' types go to ``<path>.schema``, a folder with one small text file, from which
    ``read_export`` restores the table. ``single`` writes one part file; use it for tables of a few rows.
    """
    if single:
        df = df.coalesce(1)
    written = Observation()
    cells = [plain_money(F.col(c)).alias(c) if c in MONEY_COLUMNS else F.col(c) for c in df.columns]
    texts = [F.col(f.name) for f in df.schema if isinstance(f.dataType, T.StringType)]
    broken = F.count_if(F.coalesce(F.concat(*(F.coalesce(t, F.lit("")) for t in texts)).rlike("[\r\n]"), F.lit(False))) if texts else F.lit(0)
    (
        df.observe(written, F.count(F.lit(1)).alias("rows"), broken.alias("broken"))
        .select(*cells)
        .write.mode("overwrite")
        .options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )
    about = json.dumps({"schema": df.schema.jsonValue(), "multiLine": bool(written.get["broken"])})
    df.sparkSession.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.schema")
    return written.get["rows"]


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``export_csv`` wrote to ``path``: the same columns, types and cells, NULL and empty texts apart.

    A file whose header or cells don't fit the schema is an error. Only a table with line breaks in its texts is read in one task a
    file.
    """
    about = json.loads(spark.read.text(f"{path}.schema", wholetext=True).first()[0])
    options = {
        "header": True, "enforceSchema": False, "escape": '"', "mode": "FAILFAST", "multiLine": about["multiLine"],
        # what stands for a missing cell must not be the empty text
        "nullValue": NO_CELL, "emptyValue": "",
    }
    return spark.read.schema(T.StructType.fromJson(about["schema"])).options(**options).csv(path)


def export_tables(tables: Mapping[str, DataFrame], directory: str, pool: Executor, first: Collection[str] = ()) -> DataFrame:
    """Export each table to ``<directory>/<name>.csv``, a directory of part files; returns one (table, rows) row per table.

    Those named by ``first`` are done before the others begin: name those that are sorted, whose shuffles then don't lie on
    disk beside all the others' text.
    """
    rows: dict[str, int] = {}
    for names in ([name for name in tables if name in first], [name for name in tables if name not in first]):
        paths = [f"{directory}/{name}.csv" for name in names]
        singles = [name in V.SINGLE_FILE_EXPORTS for name in names]
        rows |= zip(names, pool.map(export_csv, [tables[name] for name in names], paths, singles))
    spark = next(iter(tables.values())).sparkSession
    schema = T.StructType([T.StructField("table", T.StringType()), T.StructField("rows", T.LongType())])
    return spark.createDataFrame([(name, rows[name]) for name in tables], schema)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for intermediate tables in the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session may fall back to the machine's own temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = tempfile.mkdtemp(prefix="lendrisk-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"

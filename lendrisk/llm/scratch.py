"""Tables that a job writes for itself, and the cut of a plan's lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Arrays of this size are mapped apart from a worker's heap, which otherwise keeps their place.
RETURNED_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors reach.

    Only a local session without that setting gets a temporary folder; any other session without it is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        base = tempfile.mkdtemp(prefix="llm-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, **options: str) -> DataFrame:
    """The rows of ``df``, stored as Parquet in the shared folder and read back: later steps start here if a task is lost."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    df.write.options(**options).parquet(folder)
    back = spark.read.schema(df.schema).parquet(folder)
    back._scratch_folder = folder
    return back


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``written`` stored. Only for tables that nothing to be run any more reads, not even after a lost task."""
    for table in tables:
        folder = getattr(table, "_scratch_folder", None)
        if folder:
            context = table.sparkSession.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if it isn't installed there.

    Workers live on from stage to stage, so they also give arrays of ``RETURNED_BYTES`` and more back to the system when done with
    them, and Arrow takes its memory where theirs is: what it gives back after each slice (``release_unused``) then is all unused memory.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    env.setdefault("MALLOC_MMAP_THRESHOLD_", str(RETURNED_BYTES))
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")

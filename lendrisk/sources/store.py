"""Tables that are replaced together: versioned folders, and a manifest that is written last."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from lendrisk.sources.raw import register

MANIFEST = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("schema", T.StringType()),
])


#: How stored tables are compressed: a third smaller than by default.
COMPRESSION = {"compression": "zstd"}


#: The setting by which Spark removes the shuffle files of an action when that action has ended.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Actions started within it leave no shuffle files behind.

    Otherwise those of all steps of a run stay on disk until the driver happens to collect garbage. Every step of a run is stored, and
    the next one starts from what is stored, so that no step needs an earlier one's shuffles.
    """
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


@dataclass(frozen=True)
class Entry:
    """A stored table: its folder below the store, its row count and its schema."""

    table: str
    path: str
    rows: int
    schema: T.StructType


class TableStore:
    """A folder of tables of which readers always see one whole version.

    A writer fills a slot that no reader resolves to and then commits a manifest, one small file that appears by a rename: a
    reader finds the old version's tables until then and the new one's from then on. A run that stops before leaves the old
    version as it was, and the next run fills the same slot again. Slots take turns, so the folder holds ``slots`` versions at
    most; a reader of the version before the last must be done when the next run begins, or the store have more slots.
    Two runs at once would fill the same slot: the second to commit fails, as its manifest is already there, and must run again.
    """

    def __init__(self, spark: SparkSession, directory: str, slots: int = 2):
        if slots < 2:
            raise ValueError("a store needs a slot to read and one to write")
        self.spark, self.directory, self.slots = spark, directory.rstrip("/"), slots

    def manifests(self) -> DataFrame:
        """(version, table, path, rows, schema) of every committed version; only the last ``slots`` still have their tables."""
        schema = T.StructType([*MANIFEST, T.StructField("version", T.LongType())])
        try:
            return self.spark.read.schema(schema).parquet(f"{self.directory}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def version(self) -> int:
        """The last committed version, 0 if there is none."""
        return self.manifests().agg(F.max("version")).first()[0] or 0

    def entries(self, version: int | None = None) -> dict[str, Entry]:
        """The tables of a version, the last by default. A row per table, so they are collected."""
        rows = self.manifests().collect()
        last = max((row["version"] for row in rows), default=0)
        wanted = last if version is None else version
        if not last - self.slots < wanted <= last or wanted < 1:
            raise ValueError(f"version {wanted} isn't there: the last is {last} and {self.slots} are kept")
        return {
            row["table"]: Entry(row["table"], row["path"], row["rows"], T.StructType.fromJson(json.loads(row["schema"])))
            for row in rows if row["version"] == wanted
        }

    def read(self, entry: Entry) -> DataFrame:
        return self.spark.read.schema(entry.schema).parquet(f"{self.directory}/{entry.path}")

    def table(self, name: str, version: int | None = None) -> DataFrame:
        return self.read(self.entries(version)[name])

    def tables(self, version: int | None = None) -> dict[str, DataFrame]:
        return {name: self.read(entry) for name, entry in self.entries(version).items()}

    def register(self) -> None:
        """Make the last version's tables queryable by name (S3)."""
        register(self.tables())

    def begin(self) -> Draft:
        """A new version to be filled and committed."""
        return Draft(self, self.version() + 1)


@dataclass
class Draft:
    """A version that no reader sees before ``commit``."""

    store: TableStore
    version: int
    entries: dict[str, Entry] = field(default_factory=dict)

    @property
    def slot(self) -> str:
        return f"slots/{self.version % self.store.slots}"

    def folder(self, name: str) -> str:
        """The path of a table or export of this version."""
        return f"{self.store.directory}/{self.slot}/{name}"

    def write(self, name: str, df: DataFrame, *metrics: Column) -> tuple[DataFrame, dict[str, int]]:
        """Store a table; returns it as read back, with ``metrics`` (and its rows) observed while it was written.

        Metrics are taken of what reaches the files, whose tasks count once however often they are repeated.
        """
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics)
        counted.write.mode("overwrite").options(**COMPRESSION).parquet(self.folder(f"tables/{name}"))
        return self.add(name, df.schema, seen.get["rows"]), seen.get

    def step(self, name: str, df: DataFrame) -> DataFrame:
        """Store what several tables are made from; returns it as read back. Readers of the version don't see it."""
        path = self.folder(f"steps/{name}")
        df.write.mode("overwrite").options(**COMPRESSION).parquet(path)
        return self.store.spark.read.schema(df.schema).parquet(path)

    def add(self, name: str, schema: T.StructType, rows: int, path: str | None = None) -> DataFrame:
        """Enter a table that is written already."""
        entry = Entry(name, path or f"{self.slot}/tables/{name}", rows, schema)
        self.entries[name] = entry
        return self.store.read(entry)

    def commit(self, names: Iterable[str] | None = None) -> None:
        """Make this version the one that readers see, with all its tables or those named."""
        kept: Mapping[str, Entry] = self.entries if names is None else {name: self.entries[name] for name in names}
        if not kept:
            raise ValueError("a version without tables")
        rows = [(e.table, e.path, e.rows, e.schema.json()) for e in kept.values()]
        # one task, one file: it is there as a whole or not at all
        manifest = self.store.spark.createDataFrame(rows, MANIFEST).coalesce(1)
        manifest.write.mode("errorifexists").parquet(f"{self.store.directory}/manifest/version={self.version}")

"""Tables of the session catalog, optionally laid out for lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dumptables.schemas import LOAD_ORDER, TABLES, TableSpec
from dumptables.sinks.base import conform, in_range_of

# The three tables that grow with the dump; the other two stay at a few rows per wiki.
LOOKUP_TABLES = ("contributor", "revision", "page")


class CatalogSink:
    """Writes to ``<database>.<table>``.

    buckets: when set, page, revision and contributor are bucketed by the first column of
        their lookup order and sorted by all of it, so a lookup by title, id or user name
        reads one bucket and skips most row groups of it, and joins on that column need no
        shuffle. Choose it so that one bucket of the finished table fits a task.
    location: folder for the table files, for catalogs without a shared default.
    """

    enforces_keys = False  # so tables may be written side by side

    def __init__(
        self,
        spark: SparkSession,
        database: str = "default",
        buckets: int | None = None,
        location: str | None = None,
    ):
        self.spark = spark
        self.database = database
        self.buckets = buckets
        self.location = location.rstrip("/") if location else None

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def ensure(self) -> None:
        place = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}{place}")
        for spec in LOAD_ORDER:
            self._ensure_table(spec)

    def _ensure_table(self, spec: TableSpec) -> None:
        name = self.table(spec.name)
        if self.spark.catalog.tableExists(name):
            stored = {c.lower() for c in self.spark.table(name).columns}
            missing = [f for f in spec.schema.fields if f.name.lower() not in stored]
            if missing:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
                self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
            return
        writer = self.spark.createDataFrame([], spec.schema).write.format("parquet")
        if self._bucketed(spec):
            writer = writer.bucketBy(self.buckets, spec.lookup[0]).sortBy(*spec.lookup)
        if self.location:
            writer = writer.option("path", f"{self.location}/{spec.name}")
        writer.saveAsTable(name)

    def _bucketed(self, spec: TableSpec) -> bool:
        return bool(self.buckets) and spec.name in LOOKUP_TABLES

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.table(name)).select(TABLES[name].columns)

    def keys(self, spec: TableSpec, new: DataFrame) -> DataFrame | None:
        return in_range_of(self.read(spec.name).select(*spec.key), new)

    def append(self, spec: TableSpec, rows: DataFrame) -> None:
        name = self.table(spec.name)
        rows = conform(rows, self.spark.table(name).schema)
        if self._bucketed(spec):
            # One task per bucket instead of every task writing a file into every bucket;
            # adaptive execution splits a bucket that is far larger than the others.
            rows = rows.hint("rebalance", self.buckets, spec.lookup[0])
        rows.write.insertInto(name)

"""One Parquet folder per table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from dumptables.schemas import TABLES, TableSpec
from dumptables.sinks.base import conform, in_range_of
from dumptables.sinks.keyindex import Bounds, KeyIndex


class ParquetSink:
    """Writes to ``<path>/<table>``, and keeps an index of all keys in ``<path>/_keys``. Assumes
    one writer per folder: plain files have no check for concurrent inserts of one key."""

    enforces_keys = False  # so tables may be written side by side

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.index = KeyIndex(spark, self.path)

    def _folder(self, spec: TableSpec) -> str:
        return f"{self.path}/{spec.name}"

    def ensure(self) -> None:
        """Nothing to do: appending makes a folder, and reading fills in missing columns."""

    def read(self, name: str) -> DataFrame:
        """A stored table; columns an older writer did not know are NULL."""
        spec = TABLES[name]
        return self.spark.read.schema(spec.schema).parquet(self._folder(spec))

    def keys(self, spec: TableSpec, new: DataFrame) -> DataFrame | None:
        try:
            stored = self.read(spec.name).select(*spec.key)
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return in_range_of(stored, new)

    def get_ready(self) -> None:
        """Bring the index of stored keys up to date, so that reading them need not wait."""
        self.index.catch_up()

    def stored_keys(self, bounds: Bounds) -> DataFrame | None:
        return self.index.read(bounds) if self.index.catch_up() else None

    def holds(self, spec: TableSpec) -> bool:
        """Whether the table is there, as far as the index knows: if so, nothing need be written
        to make it readable."""
        return self.index.knows(spec.name)

    def append(self, spec: TableSpec, rows: DataFrame) -> None:
        conform(rows, spec.schema).write.mode("append").parquet(self._folder(spec))

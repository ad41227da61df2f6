"""Tables of a relational database over JDBC."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dumptables.schemas import LOAD_ORDER, TABLES, TableSpec
from dumptables.sinks.base import conform

# SQL types of the target columns.
SQL_TYPES = {
    T.StringType(): "text",
    T.LongType(): "bigint",
    T.ShortType(): "smallint",
    T.TimestampNTZType(): "timestamp",
}


@dataclass(frozen=True)
class JdbcOptions:
    """Where the database is. There is no default user or password."""

    name: str
    user: str
    password: str = field(repr=False)
    vendor: str = "postgresql"
    host: str = "localhost"
    port: int = 5432
    driver: str | None = None
    batch_size: int = 10_000
    connections: int = 16

    @property
    def url(self) -> str:
        return f"jdbc:{self.vendor}://{self.host}:{self.port}/{self.name}"

    def properties(self) -> dict[str, str]:
        found = {"user": self.user, "password": self.password}
        if self.driver:
            found["driver"] = self.driver
        return found


def table_ddl(spec: TableSpec) -> list[str]:
    """Statements that create a table with its primary key and lookup index.

    Spark's writer cannot state keys, so run these once where the database is to enforce
    them; without them the writer creates plain tables.
    """
    key_columns = set(spec.key)
    columns = ", ".join(
        f'"{f.name}" {SQL_TYPES[f.dataType]}{" not null" if f.name in key_columns else ""}'
        for f in spec.schema.fields
    )
    quoted = lambda names: ", ".join(f'"{n}"' for n in names)
    index = "_".join(spec.lookup) + "_idx"
    return [
        f"create table if not exists {spec.name} ({columns}, primary key ({quoted(spec.key)}))",
        f"create index if not exists {index} on {spec.name} ({quoted(spec.lookup)})",
    ]


def foreign_key_ddl(spec: TableSpec) -> list[str]:
    """Statements that add a table's foreign keys; for after all tables exist."""
    quoted = lambda names: ", ".join(f'"{n}"' for n in names)
    return [
        f"alter table {spec.name} add constraint {fk.columns[0]}_fk foreign key "
        f"({quoted(fk.columns)}) references {fk.parent} ({quoted(fk.parent_columns)})"
        for fk in spec.foreign_keys
    ]


def column_ddl(spec: TableSpec, stored: Collection[str]) -> list[str]:
    """Statements that add the columns an existing table lacks."""
    return [
        f'alter table {spec.name} add column "{f.name}" {SQL_TYPES[f.dataType]}'
        for f in spec.schema.fields
        if f.name not in stored
    ]


class MissingTables(ValueError):
    """The database lacks tables or columns that only its own statements can add."""


class JdbcSink:
    """Appends to the five tables of a database.

    Spark's writer creates plain tables where there are none; keys, indexes and missing
    columns need statements of the database itself. ``statements`` lists all that are due;
    a caller that has a connection runs them before the load. Without that, ``ensure``
    creates absent tables and raises ``MissingTables`` for incomplete ones.
    """

    def __init__(self, spark: SparkSession, options: JdbcOptions):
        self.spark = spark
        self.options = options

    def reader_options(self) -> dict[str, str]:
        return {"url": self.options.url, **self.options.properties()}

    def writer_options(self, spec: TableSpec) -> dict[str, str]:
        """No column types are stated: the dialect's own are those of ``SQL_TYPES``."""
        return {
            **self.reader_options(),
            "dbtable": spec.name,
            "batchsize": str(self.options.batch_size),
            "numPartitions": str(self.options.connections),
        }

    def _reader(self):
        return self.spark.read.format("jdbc").options(**self.reader_options())

    def columns_query(self, spec: TableSpec) -> str:
        """Columns of the table in the schema that unqualified names refer to."""
        return (
            "select column_name from information_schema.columns "
            f"where table_schema = current_schema() and table_name = '{spec.name}'"
        )

    def _stored_columns(self, spec: TableSpec) -> set[str]:
        found = self._reader().option("query", self.columns_query(spec)).load()
        return {row[0] for row in found.collect()}  # as many as the table has columns

    def statements(self) -> list[str]:
        """What the database needs before a load: tables, indexes, columns, then references."""
        due, new = [], []
        for spec in LOAD_ORDER:
            stored = self._stored_columns(spec)
            if stored:
                due += column_ddl(spec, stored)
            else:
                due += table_ddl(spec)
                new += foreign_key_ddl(spec)
        return due + new

    def ensure(self) -> None:
        for spec in LOAD_ORDER:
            stored = self._stored_columns(spec)
            if not stored:
                self.append(spec, self.spark.createDataFrame([], spec.schema))
            elif missing := column_ddl(spec, stored):
                raise MissingTables("; ".join(missing))

    def read(self, name: str) -> DataFrame:
        spec = TABLES[name]
        return conform(self._reader().option("dbtable", spec.name).load(), spec.schema)

    def keys(self, spec: TableSpec, new: DataFrame) -> DataFrame | None:
        """Stored keys in the id range of the new rows, read over several connections."""
        reader = self._reader().option("dbtable", spec.name)
        if spec.key[0] == "id":
            low, high = new.agg(F.min("id"), F.max("id")).first()
            if low is None:
                return None
            reader = reader.options(
                partitionColumn="id",
                lowerBound=low,
                upperBound=max(high, low + 1),
                numPartitions=self.options.connections,
            )
            return reader.load().select(*spec.key).filter(F.col("id").between(low, high))
        return reader.load().select(*spec.key)

    def append(self, spec: TableSpec, rows: DataFrame) -> None:
        writer = conform(rows, spec.schema).write.format("jdbc").mode("append")
        writer.options(**self.writer_options(spec)).save()

from dumptables.sinks.base import CallableSink, Sink, conform
from dumptables.sinks.catalog import CatalogSink
from dumptables.sinks.jdbc import JdbcOptions, JdbcSink, foreign_key_ddl, table_ddl
from dumptables.sinks.parquet import ParquetSink

__all__ = [
    "CallableSink",
    "CatalogSink",
    "JdbcOptions",
    "JdbcSink",
    "ParquetSink",
    "Sink",
    "conform",
    "foreign_key_ddl",
    "table_ddl",
]

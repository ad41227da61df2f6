"""Load compressed wiki export dumps into five flat tables with Spark."""

from dumptables.plans import LoadOptions, LoadReport, RejectedRows, load_dump, verify_tables
from dumptables.schemas import TABLES
from dumptables.sinks import CallableSink, CatalogSink, JdbcOptions, JdbcSink, ParquetSink
from dumptables.sources import DumpOptions
from dumptables.streaming import load_in_turns, progress, rejects_of_turns

__all__ = [
    "TABLES",
    "CallableSink",
    "CatalogSink",
    "DumpOptions",
    "JdbcOptions",
    "JdbcSink",
    "LoadOptions",
    "LoadReport",
    "ParquetSink",
    "RejectedRows",
    "load_dump",
    "load_in_turns",
    "progress",
    "rejects_of_turns",
    "verify_tables",
]

"""What a load needs from the place it writes to."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dumptables.schemas import TableSpec


class Sink(Protocol):
    """A sink may also have ``stored_keys(bounds)``: the stored keys of all tables at once, in the
    form of :mod:`dumptables.operators.keys`, and ``get_ready()``, called while a dump is still
    being parsed. Without ``enforces_keys = False``, parents are written before children."""

    def ensure(self) -> None:
        """Create missing tables and columns; harmless when repeated."""

    def keys(self, spec: TableSpec, new: DataFrame) -> DataFrame | None:
        """Stored key columns of a table, or None when nothing stored can be read.

        ``new`` holds the keys about to be looked up; a sink may use their range to
        read less.
        """

    def append(self, spec: TableSpec, rows: DataFrame) -> None:
        """Add rows; they are new, valid and in the table's columns."""


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in exactly the columns of ``schema``: chosen by name, cast, NULL where absent."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def in_range_of(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored keys that lie within the range of the new ones, column by column.

    The bounds are plain values, so a scan skips the row groups and files outside them:
    a turn looks at its own wikis and id ranges, not at everything loaded before it.
    """
    names = new.columns
    if not names:
        return stored
    bounds = new.agg(
        *[f(name).alias(f"{name}_{f.__name__}") for name in names for f in (F.min, F.max)]
    ).first()
    for name in names:
        low, high = bounds[f"{name}_min"], bounds[f"{name}_max"]
        stored = stored.filter(F.lit(False) if low is None else F.col(name).between(low, high))
    return stored


class CallableSink:
    """Hands each table to a function ``(table_name, rows)``; nothing is read back."""

    def __init__(self, function: Callable[[str, DataFrame], None]):
        self.function = function

    def ensure(self) -> None:
        pass

    def keys(self, spec: TableSpec, new: DataFrame) -> DataFrame | None:
        return None

    def append(self, spec: TableSpec, rows: DataFrame) -> None:
        self.function(spec.name, rows)

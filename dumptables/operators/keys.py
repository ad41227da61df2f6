"""Keys of all tables in one form, so that one pass settles which of them can be inserted.

A row names its own key and those it refers to. Uses are counted for each key before they are
moved, so a key used by most rows costs one row per task. Stored keys are looked up once, for
repeated keys and for references alike; a store bucketed by :data:`KEY` is read where it lies.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumptables.schemas import LOAD_ORDER, TABLES, ForeignKey, TableSpec

KEY = ["kind", "id", "dbname"]
KEY_TYPES = "kind INT, id BIGINT, dbname STRING"
KINDS = {spec.name: kind for kind, spec in enumerate(LOAD_ORDER)}
# Rows of these tables name their keys again and again: the first one is meant.
REPEATING = ("siteinfo", "namespaces", "contributor")


def _key_sql(table: str, columns: Sequence[str]) -> str:
    """Fields of :data:`KEY` for a key of ``table`` found in ``columns`` of a row."""
    *number, dbname = columns
    id_ = f"CAST(`{number[0]}` AS BIGINT)" if number else "0L"
    return f"{KINDS[table]} AS kind, {id_} AS id, `{dbname}` AS dbname"


def stored_form(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys of a stored table in columns :data:`KEY`."""
    return rows.selectExpr(*_key_sql(spec.name, spec.key).split(", "))


def key_uses(rows: DataFrame, spec: TableSpec, references: Iterable[ForeignKey]) -> DataFrame:
    """Every key that a table's rows have (``refers`` false) or refer to; a reference with a
    NULL part is none."""
    found = [f"struct({_key_sql(spec.name, spec.key)}, false AS refers)"]
    for fk in references:
        use = f"struct({_key_sql(fk.parent, fk.columns)}, true AS refers)"
        whole = " AND ".join(f"`{c}` IS NOT NULL" for c in fk.columns)
        found.append(f"CASE WHEN {whole} THEN {use} END")
    # No use is a row of NULLs.
    return rows.selectExpr(f"inline(array({', '.join(found)}))").filter("refers IS NOT NULL")


def settle_keys(uses: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Every key used: ``n`` rows that have it, whether any row ``refers`` to it, and whether it
    is ``stored``. Of stored keys only those in use are kept, each once."""
    counts = uses.groupBy(*KEY).agg(
        F.expr("sum(IF(refers, 0L, 1L)) AS n"), F.expr("max(refers) AS refers")
    )
    if stored is None:
        return counts.withColumn("stored", F.lit(False))
    # A store may name a key twice; rows of one key are together after the join.
    there = stored.selectExpr(*KEY, "true AS present")
    return counts.join(there, KEY, "left").groupBy(*KEY).agg(
        F.expr("max(n) AS n"), F.expr("max(refers) AS refers"),
        F.expr("max(present) IS NOT NULL AS stored"),
    )


def is_kind(*names: str) -> str:
    return f"kind IN ({', '.join(str(KINDS[name]) for name in names)})"


# The key is referred to and nowhere to be found.
MISSING = "(refers AND n = 0 AND NOT stored)"
# The key cannot simply be inserted: stored already, or that of several rows.
CONTESTED = f"(n > 0 AND (stored OR (n > 1 AND NOT {is_kind(*REPEATING)})))"
NEW = "(n > 0 AND NOT stored)"
REPEATED = f"(n > 1 AND NOT {is_kind(*REPEATING)})"


def keys_of(settled: DataFrame, table: str, what: str) -> DataFrame:
    """Those keys of one table for which ``what`` holds, in its own key columns."""
    spec = TABLES[table]
    *number, dbname = spec.key
    kind = lambda name: spec.schema[name].dataType.simpleString()
    columns = [f"CAST(id AS {kind(name)}) AS `{name}`" for name in number]
    return settled.filter(f"{is_kind(table)} AND {what}").selectExpr(
        *columns, f"dbname AS `{dbname}`", "n", "refers", "stored"
    )


def summary() -> list[Column]:
    """Counts over settled keys, as metrics to observe: for each table its keys that are new,
    those that are contested, those that several rows have, and those that rows refer to in vain."""
    kinds = {"new": NEW, "contested": CONTESTED, "repeated": REPEATED, "missing": MISSING}
    return [
        F.expr(f"count_if({is_kind(name)} AND {what}) AS {name}_{label}")
        for name in KINDS
        for label, what in kinds.items()
    ]

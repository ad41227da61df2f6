"""Key checks over stored tables: what a database's constraints would refuse."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumptables.operators.integrity import duplicate_keys, fk_missing_keys
from dumptables.schemas import LOAD_ORDER, TABLES


def verify_tables(read: Callable[[str], DataFrame]) -> DataFrame:
    """One row per primary and foreign key: ``table, check, broken_keys, rows``.

    ``read`` gives a stored table by name, such as a sink's own. Only key columns are read;
    each check counts keys before it compares them.
    """

    def result(table: str, check: str, broken: DataFrame) -> DataFrame:
        return broken.agg(
            F.count("*").alias("broken_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")
        ).select(F.lit(table).alias("table"), F.lit(check).alias("check"), "broken_keys", "rows")

    results = []
    for spec in LOAD_ORDER:
        rows = read(spec.name)
        results.append(result(spec.name, "primary_key", duplicate_keys(rows, spec.key)))
        for fk in spec.foreign_keys:
            parent = read(fk.parent).select(*TABLES[fk.parent].key)
            results.append(result(spec.name, fk.reason, fk_missing_keys(rows, parent, fk)))
    return reduce(DataFrame.unionByName, results)

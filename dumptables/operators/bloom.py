"""A Bloom filter of keys, asked in the scan of a table before its rows are moved to a join.

Two bits per key in one array of numbers, which reaches the tasks as the result of a subquery. A
row that lacks a bit is certainly not among the keys; the others still go through the join, so
an overfull filter lets more rows pass and changes no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
LEAST_BITS, MOST_BITS = 16, 27  # powers of two: 8 kB to 16 MB


def bits_for(keys: int) -> int:
    """Size of a filter for so many keys, as a power of two."""
    return min(max((BITS_PER_KEY * keys).bit_length(), LEAST_BITS), MOST_BITS)


def _slots(columns: Sequence[str], bits: int) -> list[str]:
    names = ", ".join(f"`{c}`" for c in columns)
    hashes = (f"xxhash64({names})", f"xxhash64({names}, 1)")
    return [f"CAST({h} & {(1 << bits) - 1} AS INT)" for h in hashes]


def bloom_filter(keys: DataFrame, bits: int) -> Column:
    """The filter of all rows of ``keys``, as a scalar subquery."""
    slots = ", ".join(_slots(keys.columns, bits))
    cells = (
        keys.selectExpr(f"explode(array({slots})) AS slot")
        .selectExpr("shiftright(slot, 6) AS cell", "shiftleft(1L, slot & 63) AS mask")
        .groupBy("cell")
        .agg(F.expr("bit_or(mask) AS mask"))
    )
    # Cells are as many as the filter is large, whatever the number of keys.
    every = keys.sparkSession.range(0, 1 << (bits - 6), 1, 1).selectExpr("CAST(id AS INT) AS cell")
    full = every.join(cells, "cell", "left")
    packed = full.agg(F.expr("sort_array(collect_list(struct(cell, coalesce(mask, 0L) AS mask)))").alias("c"))
    return packed.selectExpr("c.mask AS cells").scalar()


def sifted(table: DataFrame, keys: DataFrame, bits: int) -> DataFrame:
    """Rows of ``table`` that may be among ``keys`` (in columns of the same names)."""
    passed = " AND ".join(
        f"getbit(__cells[shiftright({slot}, 6)], {slot} & 63) = 1"
        for slot in _slots(keys.columns, bits)
    )
    marked = table.withColumn("__cells", bloom_filter(keys, bits))
    return marked.filter(passed).drop("__cells")


def is_large(table: DataFrame) -> bool:
    """Whether Spark expects the table to be too large for a broadcast, so that its rows would be
    moved to a join. Read from the plan, without running it."""
    spark = table.sparkSession
    expected = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    most = spark._jvm.org.apache.spark.sql.internal.SQLConf.get().autoBroadcastJoinThreshold()
    return int(str(expected)) > most

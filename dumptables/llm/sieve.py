"""A bitmap of hashes, of fixed size, that tells in the row what need not be moved.

A set bit proves nothing, so an exact join follows; a clear bit proves absence. As the bitmap
fills it sifts less, and results stay the same.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bitmap(hashes: DataFrame, bits: int) -> Column:
    """One array of 2**bits bits with those of ``hash`` set, as a scalar subquery.

    Use it as a column of its own: subqueries are not allowed inside higher-order functions.
    """
    slot = F.expr(f"cast(pmod(hash, {1 << bits}) as int)")
    cells = (
        hashes.select(F.shiftright(slot, 6).alias("cell"), F.pmod(slot, F.lit(64)).alias("bit"))
        .groupBy("cell")
        .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask"))
    )
    every = hashes.sparkSession.range(0, 1 << (bits - 6), 1, 1)
    full = every.select(F.col("id").cast("int").alias("cell")).join(cells, "cell", "left")
    full = full.select("cell", F.coalesce("mask", F.lit(0)).alias("mask"))
    packed = full.agg(F.array_sort(F.collect_list(F.struct("cell", "mask"))).alias("cells"))
    return packed.select(F.transform("cells", lambda c: c["mask"]).alias("m")).scalar()


def passes(bitmap: Column, bits: int):
    """A test of hashes: false if the hash is certainly not in the bitmap."""

    def test(value: Column) -> Column:
        slot = F.pmod(value, F.lit(1 << bits)).cast("int")
        mask = F.get(bitmap, F.shiftright(slot, 6))
        return F.getbit(mask, slot.bitwiseAND(F.lit(63))) == 1

    return test


def bits_for(n: int, least: int = 20, most: int = 27) -> int:
    """How many bits, as a power of two, ``n`` keys need so that some 3 in 100 other keys pass;
    at most 16 MiB of them, beyond which more pass."""
    return max(least, min(most, (32 * n).bit_length()))


def local_bitmap(hashes: DataFrame, bits: int) -> bytes:
    """The same bits as bytes for use in tasks; 2**bits bits, whatever ``hashes`` holds."""
    slot = F.expr(f"cast(pmod(hash, {1 << bits}) as int)")
    cells = (
        hashes.select(F.shiftright(slot, 6).alias("cell"), F.pmod(slot, F.lit(64)).alias("bit"))
        .groupBy("cell")
        .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask"))
        .toArrow()
    )
    words = np.zeros(1 << (bits - 6), np.int64)
    words[cells.column("cell").to_numpy()] = cells.column("mask").to_numpy()
    return words.astype("<i8").tobytes()


def without(docs: DataFrame, keys: list[Column], gone: DataFrame, bits: int = 22) -> DataFrame:
    """The rows of ``docs`` whose ``keys`` are no row of ``gone`` (a column for each, null equal
    to null), all columns unchanged. Rows that the bitmap clears stay where they are; only the
    others meet ``gone``, however large that is."""
    gone = gone.toDF(*(f"__k{i}" for i in range(len(keys)))).distinct()
    found = bitmap(gone.select(F.xxhash64("*").alias("hash")), bits)
    marked = docs.withColumn("__bits", found)
    suspect = passes(F.col("__bits"), bits)(F.xxhash64(*keys))
    match = reduce(and_, (k.eqNullSafe(gone[f"__k{i}"]) for i, k in enumerate(keys)))
    names = [F.col(f"`{c}`") for c in docs.columns]
    cleared = marked.filter(~suspect).select(names)
    return cleared.union(marked.filter(suspect).select(names).join(gone, match, "left_anti"))

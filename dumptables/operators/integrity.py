"""Keys: keeping the first row of each, inserting what is absent, checking references.

Work is done on key columns only. Wide rows are filtered afterwards by their position,
which is unique and therefore never skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumptables.operators.bloom import bits_for, is_large, sifted
from dumptables.operators.files import scan_part
from dumptables.schemas import POSITION, ForeignKey


def _all_set(columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNotNull()
    return condition


def keep_first(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``; for rows without large values.

    An aggregation rather than a ranking window: each task reduces its own rows first,
    so a key holding most rows is no bottleneck.
    """
    rest = [name for name in rows.columns if name not in key and name not in order]
    kept = rows.groupBy(*key).agg(
        F.min_by(F.struct(*rest, *order), F.struct(*order)).alias("kept")
    )
    return kept.select(*[F.col(c) if c in key else F.col("kept")[c].alias(c) for c in rows.columns])


def first_places(rows: DataFrame, key: Sequence[str], stored: DataFrame | None) -> DataFrame:
    """For staged rows of which many name the same key: each key that is not among the ``stored``
    ones, with the row (``scan_part, row_id``) of its first ``place``.

    Only numbers are compared, in a hashed aggregation with partial results in every task.
    """
    first = rows.groupBy(*key).agg(F.min_by("row_id", "place").alias("row_id"))
    if stored is not None:
        first = insert_absent(first, stored, key)
    return first.withColumn("scan_part", scan_part())


def first_writers(rows: DataFrame, first: DataFrame, key: Sequence[str]) -> DataFrame:
    """Of the rows that stand in the ``first`` places of their keys, one for each key: the first
    within its place, as a row may name a key twice."""
    met = rows.join(first, ["scan_part", "row_id", *key])
    rest = [name for name in rows.columns if name not in (*key, "scan_part", "row_id")]
    kept = met.groupBy(*key).agg(F.min_by(F.struct(*rest), "nth").alias("kept"))
    return kept.select(*key, *[F.col("kept")[name].alias(name) for name in rest])


def duplicate_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def insert_absent(new: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet; a key with a NULL part never conflicts."""
    return new.join(existing.select(*key), list(key), "left_anti")


def stored_of(stored: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Those of the stored keys that are among the new ones.

    New keys are few beside what is stored, so they go to the stored ones: as a broadcast, if
    Spark finds them small, and the stored side is then read, not moved.
    """
    return stored.select(*key).join(new.select(*key), list(key), "left_semi")


def claims(rows: DataFrame, contested: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key and position of every row with a contested key, and whether that key is stored."""
    return rows.select(*key, *POSITION).join(contested.select(*key, "stored"), list(key))


def first_claims(claimed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Position of the first row of each contested key; one row per key.

    Stored keys too: which rows repeat another of the same load does not depend on what an
    earlier, half-done attempt has stored.
    """
    return claimed.groupBy(*key).agg(F.min(F.struct(*POSITION)).alias("first"))


def lost_claims(claimed: DataFrame, first: DataFrame, key: Sequence[str]) -> DataFrame:
    """Positions of the rows not to insert: all of a stored key, all but the first of another.
    ``repeated`` marks those that are not the first of their key in this load.

    Join two written tables here: then a key claimed by most rows is either looked up in a
    broadcast side, or its shuffle partition is split by adaptive execution.
    """
    repeated = F.struct(*POSITION) != F.col("first")
    return (
        claimed.join(first, list(key))
        .withColumn("repeated", repeated)
        .filter("stored OR repeated")
        .select(*POSITION, "repeated")
    )


def places(positions: DataFrame) -> DataFrame:
    """Positions as the few bytes that tell rows of one scan apart."""
    return positions.select(scan_part().alias("scan_part"), "row_id", "seg")


def at(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Rows (with ``scan_part``) standing at the given places."""
    return rows.join(places, ["scan_part", "row_id", "seg"], "left_semi")


def not_at(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Rows standing anywhere else."""
    return rows.join(places, ["scan_part", "row_id", "seg"], "left_anti")


def fk_missing_keys(
    child: DataFrame, parent: DataFrame, fk: ForeignKey, keys: int = 1_000_000
) -> DataFrame:
    """Referenced keys that the parent lacks, with the number of child rows using them.

    A reference with any NULL part is no reference. Child keys are counted before they
    are joined, so a key used by most rows is moved and looked up once per task. Of a large
    parent only those keys are moved that a Bloom filter of the referenced ones lets pass;
    ``keys`` is how many of these to make room for.
    """
    used = child.filter(_all_set(fk.columns)).groupBy(*fk.columns).agg(F.count("*").alias("n"))
    wanted = parent.select(
        *[F.col(p).alias(c) for p, c in zip(fk.parent_columns, fk.columns, strict=True)]
    )
    if is_large(wanted):
        wanted = sifted(wanted, used.select(*fk.columns), bits_for(keys))
    met = stored_of(wanted, used, fk.columns)
    return used.join(met, list(fk.columns), "left_anti")


def fk_violations(child: DataFrame, missing: DataFrame, fk: ForeignKey) -> DataFrame:
    """Child rows that refer to one of the missing keys."""
    return child.join(missing.select(*fk.columns), list(fk.columns), "left_semi")


def fk_accepted(child: DataFrame, missing: DataFrame, fk: ForeignKey) -> DataFrame:
    """Child rows whose reference is met or absent."""
    return child.join(missing.select(*fk.columns), list(fk.columns), "left_anti")


def look_up(table: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """Rows of ``table`` for each value of ``column`` in ``wanted``, with its other columns.

    A table bucketed by the column is read as it lies: the values looked up are dealt into its
    buckets, or broadcast if Spark finds them small.
    """
    return wanted.join(table, column)

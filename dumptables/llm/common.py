"""Small helpers the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dumptables.session import work_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# White space as the result contracts name it, for Java and Python patterns alike.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"
# Whole texts go to Python in Arrow batches of so many rows at most; Spark's 10,000 may be gigabytes.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` stored in the folder the cluster shares and read back.

    This cuts the lineage, lets a lost executor cost its running tasks only, and gives
    the planner a true size to choose joins by.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, for whose rows Arrow batches are small from now on in its session. A batch is held
    by the JVM and by Python at once. Plans are often run after the function that made them has
    returned, so this is no setting for the time of a block; a smaller one stays."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` does just that to a text without other letters,
    much faster than ``translate`` does."""
    plain = F.char_length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside
    a higher-order function."""
    return F.transform(F.array(value), body)[0]


def same(left: DataFrame, right: DataFrame, on: str, other: str, how: str) -> DataFrame:
    """Join with null equal to null; ``other`` is the key's name on the right and is dropped."""
    joined = left.join(right, left[on].eqNullSafe(right[other]), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(right[other])


def plain_columns(batch) -> Iterator[list]:
    """The columns of an Arrow batch as Python lists."""
    return (column.to_pylist() for column in batch.columns)

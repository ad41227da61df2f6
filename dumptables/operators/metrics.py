"""Page counts. They count what was found, before any row is rejected."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pages_per_file(files: DataFrame) -> DataFrame:
    """Finished pages of each file; a file without pages counts 0."""
    unfinished = (~F.col("complete") & (F.col("page_starts") > 0)).cast("bigint")
    return files.select("file_path", (F.col("page_starts") - unfinished).alias("pages"))


def load_totals(files: DataFrame) -> DataFrame:
    """Pages and files of a load, one row."""
    return pages_per_file(files).agg(
        F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"),
        F.count("*").alias("files"),
    )


def turn_totals(pages: DataFrame, files_per_turn: int) -> DataFrame:
    """Pages and files of each turn of so many files, by path; one narrow row per file is ranked."""
    nth = F.row_number().over(Window.orderBy("file_path"))
    turns = pages.withColumn("turn", F.floor((nth - 1) / files_per_turn))
    totals = turns.groupBy("turn").agg(F.sum("pages").alias("pages"), F.count("*").alias("files"))
    return totals.orderBy("turn").select("pages", "files")


def numbered_turns(turns: DataFrame) -> DataFrame:
    """Turns numbered one after the other, where a batch (``batch_id``) may hold several (``nth``)."""
    order = Window.orderBy("batch_id", F.coalesce("nth", F.lit(0)))
    return turns.withColumn("batch_id", F.row_number().over(order).cast("bigint") - 1)


def running_totals(turns: DataFrame) -> DataFrame:
    """Pages and files up to and including each turn. One row per turn, so the list is short."""
    upto = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return turns.select(
        "batch_id",
        "pages",
        "files",
        F.sum("pages").over(upto).alias("total_pages"),
        F.sum("files").over(upto).alias("total_files"),
    )

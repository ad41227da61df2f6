"""Scan of compressed dump files, as a batch or as a stream.

Records are cut at ``</revision>`` by the text source itself, so a file is read in
splits (bz2 included) and no record is larger than one revision, however long the
history of its page.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumptables.session import few_listings, settings

RECORD_END = "</revision>"


@dataclass(frozen=True)
class DumpOptions:
    """What to read.

    glob: file-name pattern; every file counts when unset.
    recursive: also read files in subfolders.
    skip_corrupt: keep what was read of a damaged file instead of failing. Pages next to
        damage in the middle of a file may then be joined up wrongly.
    """

    glob: str | None = None
    recursive: bool = False
    skip_corrupt: bool = False

    def reader_options(self) -> dict[str, str]:
        options = {
            "lineSep": RECORD_END,
            "recursiveFileLookup": str(self.recursive).lower(),
            "ignoreCorruptFiles": str(self.skip_corrupt).lower(),
        }
        if self.glob:
            options["pathGlobFilter"] = self.glob
        return options


def _with_origin(text: DataFrame) -> DataFrame:
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def scan_records(
    spark: SparkSession, path: str | list[str], options: DumpOptions = DumpOptions()
) -> DataFrame:
    """Records of all dump files of a folder: ``value, file_path, block_start``."""
    with settings(spark, few_listings(spark)):
        return _with_origin(spark.read.options(**options.reader_options()).text(path))


def stream_records(
    spark: SparkSession,
    path: str,
    files_per_turn: int,
    options: DumpOptions = DumpOptions(),
) -> DataFrame:
    """The same records as a stream that takes at most ``files_per_turn`` new files at a time."""
    reader = spark.readStream.options(**options.reader_options())
    return _with_origin(
        reader.option("maxFilesPerTrigger", files_per_turn).text(path)
    )

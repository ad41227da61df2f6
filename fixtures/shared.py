"""Dumps rendered and staged once per session, for the queries that share them."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import SparkSession

from dumptables import DumpOptions, LoadReport, ParquetSink, load_dump
from dumptables.plans import Staged, stage
from dumptables.session import settings, work_folder
from dumptables.sources import scan_records
from fixtures import render

RENDERERS = {
    "documents": render.render_documents,
    "conversations": render.render_conversations,
    "orders": render.render_orders,
    "faulty": render.render_faulty,
    "multistream": render.render_multistream,
}
# Files of several streams are read in splits smaller than a file.
SPLITS = {"multistream": {"spark.sql.files.maxPartitionBytes": "32768"}}
EVERY_FOLDER = DumpOptions(recursive=True)


@lru_cache(maxsize=None)
def dump(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder of the rendered dump."""
    path = f"{work_folder(spark)}/dump"
    RENDERERS[name](spark, sf_dir, path)
    return path


@lru_cache(maxsize=None)
def staged(spark: SparkSession, sf_dir: str, name: str) -> Staged:
    """The dump scanned and parsed."""
    folder = dump(spark, sf_dir, name)
    with settings(spark, SPLITS.get(name, {})):
        return stage(scan_records(spark, folder, EVERY_FOLDER), work_folder(spark))


@lru_cache(maxsize=None)
def loaded(spark: SparkSession, sf_dir: str, name: str) -> tuple[ParquetSink, LoadReport]:
    """The dump loaded into Parquet tables."""
    work = work_folder(spark)
    sink = ParquetSink(spark, f"{work}/tables")
    folder = dump(spark, sf_dir, name)
    with settings(spark, SPLITS.get(name, {})):
        report = load_dump(spark, folder, sink, work=f"{work}/work", source=EVERY_FOLDER)
    return sink, report

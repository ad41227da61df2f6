"""Exact deduplication by stateful streaming.

Documents arrive as a stream. Keyed state without expiry, kept on disk by RocksDB, holds for
every digest the number of arrivals, a stable identifier (the smallest id) and the locator of
that row's content. A digest seen more than once is a hit; the full bytes of hits are compared
before they count as copies. The checkpoint carries the state to later runs.

All steps are DataFrame operations. Copies are counted before the shuffle, so a text that
makes up a third of all rows is one row per task there; the joins on digests are sort-merge
joins, whose hot partitions adaptive execution splits.

Nulls and ties: a null text counts as empty; a null id is never the smallest while the group
has another; rows that share id and text are all kept by ``exact_groups`` (they are the same
document) and reduced to one by ``exact_dedup``. An empty table gives an empty result.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dumptables.llm.common import SPACE, written
from dumptables.llm.sieve import bitmap, passes, without
from dumptables.session import work_folder

_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Room for logs is not reserved ahead: with many small stores it would be most of the disk.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # A store is closed with its task; else an executor holds one open for each of its partitions.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
SIEVE_BITS = 22  # 512 KiB


def normalised(text: str | Column = "text") -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@contextmanager
def _state_on_disk(spark: SparkSession):
    before = {key: spark.conf.get(key, None) for key in _STATE}
    for key, value in _STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def arrivals(docs: DataFrame) -> DataFrame:
    """(id, digest, locator) of rows read from files, batch or stream."""
    return docs.select(
        F.col("doc_id").alias("id"),
        digest_of(normalised()).alias("digest"),
        F.struct("_metadata.file_path", "_metadata.row_index").alias("locator"),
    )


def register(stream: DataFrame, state: str, hits: str) -> None:
    """Run all that has arrived on ``stream`` (id, digest, locator) through the state.

    ``state`` is the checkpoint folder; a later call with the same folder goes on from it.
    Groups that changed and have more than one row are appended to ``hits``.
    """

    def keep_hits(batch: DataFrame, number: int) -> None:
        batch.filter("n > 1").write.mode("overwrite").parquet(f"{hits}/batch={number}")

    seen = stream.groupBy("digest").agg(
        F.count("*").alias("n"),
        F.min("id").alias("keep_id"),
        F.min_by("locator", "id").alias("keep_locator"),
    )
    with _state_on_disk(stream.sparkSession):
        run = (
            seen.writeStream.outputMode("update")
            .foreachBatch(keep_hits)
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start()
        )
    run.awaitTermination()


HITS = (
    "digest binary, n bigint, keep_id {id}, "
    "keep_locator struct<file_path: string, row_index: bigint>, batch int"
)


def read_hits(spark: SparkSession, hits: str, id_type: str) -> DataFrame:
    """The last state of every digest in ``hits``: counts only grow, smallest ids only fall."""
    found = spark.read.schema(HITS.format(id=id_type)).parquet(hits)
    return found.groupBy("digest").agg(
        F.max("n").alias("n"),
        F.min("keep_id").alias("keep_id"),
        F.min_by("keep_locator", "keep_id").alias("keep_locator"),
    )


def confirmed(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """Classes of equal bytes among the rows of ``docs`` whose digest is a hit.

    A sieve keeps texts that are no hits from moving. Grouping by the text itself compares
    whole texts; it combines copies within each task, so no more than one text of a class
    leaves a task.
    """
    digests = hits.select("digest")
    bits = bitmap(digests.select(F.xxhash64("digest").alias("hash")), SIEVE_BITS)
    text = docs.select("doc_id", normalised().alias("body"), bits.alias("bits"))
    text = text.withColumn("digest", digest_of(F.col("body")))
    text = text.filter(passes(F.col("bits"), SIEVE_BITS)(F.xxhash64("digest"))).drop("bits")
    hit = text.join(digests, "digest", "left_semi")
    return (
        hit.groupBy("body")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select(digest_of(F.col("body")).alias("digest"), "body", "keep_id", "group_size")
    )


def exact_groups(docs: DataFrame, stream: DataFrame, work: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest.

    ``stream`` delivers ``arrivals`` of the same rows. ``work`` keeps the state for later calls.
    """
    spark = docs.sparkSession
    work = work or work_folder(spark)
    register(stream, f"{work}/state", f"{work}/hits")
    found = read_hits(spark, f"{work}/hits", docs.schema["doc_id"].dataType.simpleString())
    hits = written(found, "hits")
    classes = written(
        confirmed(docs, hits).withColumn("many", F.expr("group_size > 1")), "classes"
    )
    rows = docs.select("doc_id", normalised().alias("body"))
    rows = rows.withColumn("digest", digest_of(F.col("body")))
    pairs = ["keep_id", "group_size"]
    if classes.groupBy("digest").count().filter("count > 1").isEmpty():
        rows = rows.drop("body").join(
            classes.filter("many").select("digest", *pairs), "digest", "left"
        )
    else:  # different texts with one digest: the bytes decide
        rows = rows.join(classes.filter("many").select("body", *pairs), "body", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        "digest",
    )


def streamed(spark: SparkSession, path: str) -> DataFrame:
    """``arrivals`` of the Parquet files at ``path``, a folder or one file, as a stream."""
    schema = spark.read.parquet(path).schema
    # As a pattern, since a stream takes a single file only so.
    return arrivals(spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged."""
    spark = docs.sparkSession
    folder = f"{work_folder(spark)}/arrivals"
    docs.select("doc_id", "text").withColumns(
        {"digest": digest_of(normalised())}
    ).select(F.col("doc_id").alias("id"), "digest").write.parquet(folder)
    narrow = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
    stream = narrow.select(
        "id", "digest", F.struct("_metadata.file_path", "_metadata.row_index").alias("locator")
    )
    groups = written(exact_groups(docs, stream), "groups")
    # An id may carry several texts, so both decide.
    both = [F.col("doc_id"), digest_of(normalised())]
    stay = without(docs, both, groups.filter("NOT kept").select("doc_id", "digest"))
    twice = groups.filter("kept").groupBy("doc_id", "digest").count().filter("count > 1")
    if not twice.isEmpty():  # whole rows repeated: one of each
        stay = stay.withColumn("__digest", digest_of(normalised()))
        stay = stay.dropDuplicates(["doc_id", "__digest"]).drop("__digest")
    return stay

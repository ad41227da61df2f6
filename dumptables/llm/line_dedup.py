"""Line deduplication over content-defined chunks of lines.

A rolling hash over the hashes of ``ROLL`` consecutive lines says where a chunk ends: after a
line whose rolling hash is divisible by ``DIVISOR``. Where boundaries fall depends on the lines
around them only, so a passage that is shifted in another document is cut alike there, from its
first boundary on. Chunks of two lines or more that occur more than once in the corpus are
removed after their first occurrence: the smallest doc_id, and the first place in it. Equal
hashes only nominate; chunks count as equal when their bytes are.

All steps are DataFrame operations. Lines are cut, hashed and chunked within the row; only
hashes move, and of the texts of chunks those whose hash occurs twice. A chunk that a third of
all documents share is counted within tasks first.

Nulls and edges: a null text has no lines; an empty text has one empty line; lines end at line
feeds alone. Rows that share a doc_id are told apart by their text; equal rows are one
document. A null doc_id is never the first occurrence while another has the chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumptables.llm.common import let, written
from dumptables.llm.passages import text_key
from dumptables.llm.sieve import bitmap, passes

ROLL = 2
DIVISOR = 4
SIEVE_BITS = 22  # 512 KiB
ROW_BITS = 22
_CHUNKS = "array<struct<first: int, n_lines: int, body: string>>"


def line_hash(line: Column) -> Column:
    """32 bits that SQL engines agree on."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("bigint")


def _ends(hashes: Column, roll: int, divisor: int) -> Column:
    """Numbers of the lines that end a chunk; the last line always does."""
    rolling = lambda i: sum(
        (F.coalesce(F.get(hashes, i - k), F.lit(0)) * (31**k) for k in range(1, roll)),
        F.get(hashes, i),
    )
    last = F.size(hashes) - 1
    return F.filter(
        F.sequence(F.lit(0), last), lambda i: (i == last) | (F.pmod(rolling(i), F.lit(divisor)) == 0)
    )


def chunked(text: Column, roll: int = ROLL, divisor: int = DIVISOR) -> Column:
    """array<struct<first, n_lines, body>> of a text."""

    def cut(lines: Column) -> Column:
        def of(ends: Column) -> Column:
            def chunk(end: Column, k: Column) -> Column:
                first = F.when(k == 0, F.lit(0)).otherwise(F.get(ends, k - 1) + 1)
                n = end - first + 1
                return F.struct(
                    first.alias("first"),
                    n.alias("n_lines"),
                    F.array_join(F.slice(lines, first + 1, n), "\n").alias("body"),
                )

            return F.transform(ends, chunk)

        return let(F.transform(lines, line_hash), lambda hashes: let(_ends(hashes, roll, divisor), of))

    return let(F.split(text, "\n", -1), cut)


def cuts(docs: DataFrame, roll: int, divisor: int) -> DataFrame:
    """doc_id, row, n_lines, n_chunks, sha256, hashes (of chunks of several lines)."""
    many = F.filter("chunks", lambda c: c["n_lines"] > 1)
    return docs.select(
        "doc_id",
        text_key().alias("row"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"),
        F.when(F.col("text").isNull(), F.array().cast(_CHUNKS))
        .otherwise(chunked(F.col("text"), roll, divisor))
        .alias("chunks"),
    ).select(
        "doc_id", "row", "sha256",
        F.aggregate("chunks", F.lit(0), lambda n, c: n + c["n_lines"]).cast("bigint").alias("n_lines"),
        F.size("chunks").cast("bigint").alias("n_chunks"),
        F.transform(many, lambda c: F.xxhash64(c["body"])).alias("hashes"),
    )


def removed_chunks(docs: DataFrame, hashes: DataFrame, roll: int, divisor: int) -> DataFrame:
    """doc_id, row, first, n_lines of the chunks that go.

    ``hashes`` has a row for each chunk of several lines.
    """
    often = hashes.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash")
    bits = bitmap(written(often, "repeated"), SIEVE_BITS)
    test = passes(F.col("bits"), SIEVE_BITS)
    found = docs.filter("text IS NOT NULL").select(
        "doc_id", text_key().alias("row"), bits.alias("bits"),
        chunked(F.col("text"), roll, divisor).alias("chunks"),
    )
    kept = F.filter("chunks", lambda c: (c["n_lines"] > 1) & test(F.xxhash64(c["body"])))
    found = found.select("doc_id", "row", F.explode(kept).alias("c")).select("doc_id", "row", "c.*")
    found = written(found, "candidates")
    # Grouping by the bytes themselves; copies combine within each task.
    same = found.groupBy("body").agg(F.count("*").alias("n"), F.min("doc_id").alias("keep_id"))
    met = found.join(same.filter("n > 1"), "body").withColumn("name", F.sha2("body", 256))
    met = written(met.drop("body", "n"), "met")
    # In the document that keeps a chunk its first place stays.
    own = met.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    first = own.groupBy("name").agg(F.min(F.struct("row", "first")).alias("stay"))
    later = own.join(first, "name").filter(F.struct("row", "first") != F.col("stay"))
    others = met.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    places = ["doc_id", "row", "first", "n_lines"]
    return others.select(places).union(later.select(places))


def kept_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """doc_id, row, n_removed, kept: what is left of the texts that lose lines (removed:
    doc_id, row, gone). Texts that lose none are sifted out before they move."""
    key = F.xxhash64("doc_id", "row")
    bits = bitmap(removed.select(key.alias("hash")), ROW_BITS)
    rows = docs.select("doc_id", text_key().alias("row"), "text", bits.alias("bits"))
    rows = rows.filter(passes(F.col("bits"), ROW_BITS)(key)).drop("bits").distinct()
    gone = removed.select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), "gone")
    met = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row")))

    def left(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    return met.select(
        "doc_id", "row",
        F.size("gone").cast("bigint").alias("n_removed"),
        let(F.split("text", "\n", -1), left).alias("kept"),
    )


def dedup(docs: DataFrame, roll: int = ROLL, divisor: int = DIVISOR) -> DataFrame:
    """doc_id, n_lines, n_chunks, n_removed (lines), kept_sha256 of every row of ``docs``."""
    cut = written(cuts(docs, roll, divisor), "cuts")
    hashes = cut.select(F.explode("hashes").alias("hash"))
    goes = removed_chunks(docs, hashes, roll, divisor)
    lines = F.sequence("first", F.col("first") + F.col("n_lines") - 1)
    removed = goes.groupBy("doc_id", "row").agg(
        F.array_distinct(F.flatten(F.collect_set(lines))).alias("gone")
    )
    removed = written(removed, "removed")
    changed = kept_lines(docs, removed).select(
        F.col("doc_id").alias("__id"), F.col("row").alias("__row"), "n_removed",
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    changed = written(changed, "changed")
    met = cut.join(
        changed, cut["doc_id"].eqNullSafe(F.col("__id")) & (cut["row"] == F.col("__row")), "left"
    )
    return met.select(
        "doc_id", "n_lines", "n_chunks",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
    )

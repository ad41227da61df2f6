"""Substring deduplication by super-k-mers.

A window is ``window`` consecutive words. The smallest hash of its m-grams is its minimiser;
consecutive windows with one minimiser overlap almost wholly and travel as one packed string to
the minimiser's bucket. Equal windows have equal minimisers, so a bucket sees all copies of its
windows: there they are sorted and the first and last document of each is taken, by comparing
words, not hashes.

1. Every text is cut once; the smallest and largest doc_id of each bucket show the buckets that
   several documents share. A bitmap of these, of fixed size, goes to all tasks.
2. A second cut packs the strings of the bitmap's buckets only. Equal strings are combined within
   tasks first, so copies of a passage, however many, are one string.
3. In its bucket a string learns for each window the smallest doc_id that has it. A bucket with
   very many different strings is not sorted in one place: its windows are dealt by content.
4. Occurrences of strings get these doc_ids back; a window first seen in a smaller doc_id goes.

Nulls and ties: a null text has no words. Rows with a null doc_id are never changed and change
nothing. Rows that share a doc_id are told apart by their text; a passage that occurs only under
one doc_id stays. Texts shorter than a window stay whole. Strings are named by their bucket and
a 64-bit hash of their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumptables.llm.common import written
from dumptables.llm.passages import (
    SEED, Bits, kept_words, rows_of, run_hashes, sliding_min, texts, word_hashes,
)
from dumptables.llm.sieve import local_bitmap

WINDOW = 50
GRAM = 8
BUCKET_BITS = 24  # 2 MiB
LONGEST = 200  # windows in one string
CROWDED = 100_000  # different strings, some 60 MB, from which on a bucket's windows are dealt out


def _runs(words: list[bytes], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, minimiser) of the runs of windows with one minimiser."""
    if len(words) < window:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    least = sliding_min(run_hashes(word_hashes(words), gram), window - gram + 1)
    places = np.arange(len(least))
    new = np.concatenate([[True], least[1:] != least[:-1]])
    # A word repeated over and over has one minimiser all along: such runs are cut.
    since = places - np.maximum.accumulate(np.where(new, places, 0))
    starts = np.flatnonzero(since % LONGEST == 0)
    return starts, np.diff(np.append(starts, len(least))), least[starts]


def cuts(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """doc_id, row, n_words, sha256 of the words, buckets (without repeats) of every row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            sizes, digests, buckets = [], [], []
            for text in batch.column(2):
                words = (text.as_py() or b"").split()
                sizes.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).digest())
                buckets.append(np.unique(_runs(words, window, gram)[2]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))],
                ["doc_id", "row", "n_words", "sha256", "buckets"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(
        make, f"doc_id {kind}, row bigint, n_words bigint, sha256 binary, buckets array<bigint>"
    )


def packed_strings(docs: DataFrame, raw: bytes, window: int, gram: int) -> DataFrame:
    """bucket, name, packed, doc_id, row, start of the strings whose bucket is in the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = Bits(shared.value)
        for batch in rows_of(batches):
            taken, starts, names, buckets, packed = [], [], [], [], []
            for k, text in enumerate(batch.column(2)):
                words = (text.as_py() or b"").split()
                begin, count, least = _runs(words, window, gram)
                for i in np.flatnonzero(bits.has(least)).tolist():
                    at = int(begin[i])
                    body = b" ".join(words[at : at + int(count[i]) + window - 1])
                    taken.append(k)
                    starts.append(at)
                    buckets.append(least[i])
                    names.append(xxhash.xxh64_intdigest(body, SEED))
                    packed.append(body)
            rows = pa.array(taken, pa.int32())
            signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [signed(buckets), signed(names), pa.array(packed, pa.binary()),
                 batch.column(0).take(rows), batch.column(1).take(rows),
                 pa.array(starts, pa.int32())],
                ["bucket", "name", "packed", "doc_id", "row", "start"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(
        make,
        f"bucket bigint, name bigint, packed binary, doc_id {kind}, row bigint, start int",
    )


def _bounds(packed: bytes, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows of a packed string begin and end, in bytes."""
    sizes = np.fromiter(map(len, packed.split(b" ")), np.int32)
    stops = np.cumsum(sizes + 1, dtype=np.int32) - 1
    starts = stops - sizes
    ends = stops[window - 1 :]
    return starts[: len(ends)], ends


def _windows(packed: bytes, window: int) -> list[bytes]:
    starts, ends = _bounds(packed, window)
    return [packed[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _first_documents(strings: list[tuple[bytes, int, int]], window: int) -> list[list[int | None]]:
    """For each string (packed, low, high) of a bucket the smallest doc_id of each of its
    windows, or None where that is the only one.

    Windows are sorted by hash and those with one hash compared by their bytes. Besides the
    strings only hashes and bounds are held.
    """
    digest = xxhash.xxh64_intdigest
    bounds = [_bounds(packed, window) for packed, _, _ in strings]
    hashes = np.concatenate(
        [np.array([digest(w, SEED) for w in _windows(packed, window)], np.uint64) for packed, _, _ in strings]
    )
    counts = [len(starts) for starts, _ in bounds]
    owner = np.repeat(np.arange(len(strings)), counts)
    place = np.concatenate([np.arange(n) for n in counts])
    low = np.array([x[1] for x in strings], np.int64)[owner]
    high = np.array([x[2] for x in strings], np.int64)[owner]

    def body(at: int) -> bytes:
        k, i = owner[at], place[at]
        return strings[k][0][bounds[k][0][i] : bounds[k][1][i]]

    order = np.argsort(hashes, kind="stable")
    cuts = np.flatnonzero(np.diff(hashes[order])) + 1
    heads = np.concatenate([[0], cuts])
    first, last = np.minimum.reduceat(low[order], heads), np.maximum.reduceat(high[order], heads)
    sizes = np.diff(np.append(heads, len(order)))
    first, last = np.repeat(first, sizes), np.repeat(last, sizes)
    for head, size in zip(heads[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        members = order[head : head + size].tolist()
        one = body(members[0])
        if all(body(m) == one for m in members):
            continue
        apart: dict[bytes, list[int]] = {}  # several windows under one hash
        for at, m in enumerate(members, head):
            apart.setdefault(body(m), []).append(at)
        for same in apart.values():
            first[same], last[same] = low[order[same]].min(), high[order[same]].max()
    found = np.empty(len(order), np.int64)
    shared = np.empty(len(order), bool)
    found[order], shared[order] = first, first < last
    values = [x if y else None for x, y in zip(found.tolist(), shared.tolist(), strict=True)]
    ends = np.cumsum(counts).tolist()
    return [values[b - n : b] for b, n in zip(ends, counts, strict=True)]


_FIRSTS = "bucket bigint, name bigint, firsts array<bigint>"


def _sorted_buckets(strings: DataFrame, window: int) -> DataFrame:
    """For each string of uncrowded buckets the smallest doc_id of each of its windows, null
    where there is no other."""

    def firsts(rows: list[tuple]) -> Iterator[tuple]:
        found = _first_documents([row[2:] for row in rows], window)
        for (bucket, name, *_), own in zip(rows, found, strict=True):
            if any(x is not None for x in own):
                yield bucket, name, own

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in rows_of(batches, 1024):
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        out: list[tuple] = []
        for _, bucket in groupby(rows(), key=lambda r: r[0]):
            out += firsts(list(bucket))
            if len(out) > 2000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        a, b, c = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.list_(pa.int64()))],
            ["bucket", "name", "firsts"],
        )

    dealt = strings.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.select("bucket", "name", "packed", "low", "high").mapInArrow(make, _FIRSTS)


def _dealt_windows(strings: DataFrame, window: int) -> DataFrame:
    """The same for crowded buckets: each window goes where its content says."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 64):
            owner, place, body = [], [], []
            for i, packed in enumerate(batch.column(2)):
                found = _windows(packed.as_py(), window)
                owner += [i] * len(found)
                place += range(len(found))
                body += found
            rows = pa.array(owner, pa.int32())
            columns = [batch.column(k).take(rows) for k in (0, 1, 3, 4)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(place, pa.int32()), pa.array(body, pa.binary())],
                ["bucket", "name", "low", "high", "place", "body"],
            )

    each = strings.select("bucket", "name", "packed", "low", "high").mapInArrow(
        make, "bucket bigint, name bigint, low bigint, high bigint, place int, body binary"
    )
    first = each.groupBy("bucket", "body").agg(F.min("low").alias("first"), F.max("high").alias("last"))
    found = each.join(first.filter("first < last"), ["bucket", "body"])
    whole = F.transform(
        F.sequence(F.lit(0), F.array_max(F.map_keys("at"))), lambda i: F.try_element_at("at", i)
    )
    return (
        found.groupBy("bucket", "name")
        .agg(F.map_from_entries(F.collect_list(F.struct("place", "first"))).alias("at"))
        .select("bucket", "name", whole.alias("firsts"))
    )


def repeated_windows(docs: DataFrame, cut: DataFrame, window: int, gram: int) -> DataFrame:
    """doc_id, row, starts: the windows that also start in a document of smaller doc_id."""
    known = docs.filter("doc_id IS NOT NULL")
    seen = cut.filter("doc_id IS NOT NULL").select("doc_id", F.explode("buckets").alias("hash"))
    shared = seen.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    raw = local_bitmap(shared.filter("low < high").select("hash"), BUCKET_BITS)
    packed = written(packed_strings(known, raw, window, gram), "packed")
    strings = packed.groupBy("bucket", "name", "packed").agg(
        F.min("doc_id").cast("bigint").alias("low"), F.max("doc_id").cast("bigint").alias("high")
    )
    strings = written(strings, "strings")
    sizes = strings.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("low").alias("bucket_low"), F.max("high").alias("bucket_high")
    )
    crowded = written(sizes.filter(F.col("n") > CROWDED).select("bucket"), "crowded")
    # A bucket of one document has nothing to find; the bitmap lets some through.
    worth = strings.join(sizes.filter("bucket_low < bucket_high").select("bucket"), "bucket", "left_semi")
    firsts = _sorted_buckets(worth.join(crowded, "bucket", "left_anti"), window)
    if not crowded.isEmpty():
        firsts = firsts.union(_dealt_windows(worth.join(crowded, "bucket", "left_semi"), window))
    firsts = written(firsts, "firsts")
    places = F.filter(
        F.transform("firsts", lambda first, i: F.when(first < F.col("doc_id"), F.col("start") + i)),
        lambda x: x.isNotNull(),
    )
    hits = packed.drop("packed").join(firsts, ["bucket", "name"])
    hits = hits.select("doc_id", "row", F.array_distinct(places).alias("places")).filter("size(places) > 0")
    # One text may come twice under one doc_id.
    return hits.groupBy("doc_id", "row").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("starts")
    )


def dedup_report(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of ``docs``."""
    cut = written(cuts(docs, window, gram), "cuts")
    windows = written(repeated_windows(docs, cut, window, gram), "windows")
    spans = windows.select(
        "doc_id", "row", "starts", F.transform("starts", lambda at: at + window).alias("stops")
    )
    changed = kept_words(docs, spans).select(
        "doc_id", "row", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
    return cut.join(written(changed, "changed"), ["doc_id", "row"], "left").select(
        "doc_id", "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("kept_sha256", F.lower(F.hex("sha256"))).alias("kept_sha256"),
    )

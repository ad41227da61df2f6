"""Hashes of word runs in whole texts, for the operators that look for repeated passages."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumptables.llm.sieve import bitmap, passes

SEED = 42
ROW_BITS = 22  # 512 KiB
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def text_key(text: str = "text") -> Column:
    """Tells rows of one doc_id apart; places in a text depend on nothing else."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def texts(docs: DataFrame) -> DataFrame:
    """doc_id, row, text as bytes."""
    return docs.select("doc_id", text_key().alias("row"), F.col("text").cast("binary").alias("text"))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(SEED)), np.uint64, len(words))


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A mixed hash of each run of ``size`` words."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total = total * _STEP + words[k : k + count]
    total ^= total >> np.uint64(31)
    total *= _MIX
    return total ^ (total >> np.uint64(29))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    return sliding(np.minimum, values, width)


def sliding(best: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """``best`` (smallest or largest) of each ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[: len(out) - step], out[step:])
        have += step
    return out


class Bits:
    """Membership test of a bitmap made by ``local_bitmap``."""

    def __init__(self, raw: bytes):
        self.words = np.frombuffer(raw, "<i8").view(np.uint64)
        self.mask = np.uint64(64 * len(self.words) - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes & self.mask
        cell = self.words[(slot >> np.uint64(6)).astype(np.int64)]
        return (cell >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def rows_of(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that what a task holds stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _covered(starts: np.ndarray, stops: np.ndarray, n_words: int) -> np.ndarray:
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, stops, -1)
    return np.cumsum(change)[:n_words] > 0


def kept_words(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, row, n_removed, kept: the words left of each text that has ``spans`` (doc_id,
    row, starts, stops), joined by blanks. Texts without any are sifted out before they move."""
    key = F.xxhash64("doc_id", "row")
    bits = bitmap(spans.select(key.alias("hash")), ROW_BITS)
    rows = texts(docs).withColumn("bits", bits)
    rows = rows.filter(passes(F.col("bits"), ROW_BITS)(key)).drop("bits").distinct()
    joined = rows.join(spans, ["doc_id", "row"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            removed, kept = [], []
            for text, starts, stops in zip(*batch.columns[2:], strict=True):
                words = (text.as_py() or b"").split()
                ends = np.array(starts.as_py(), np.int64), np.array(stops.as_py(), np.int64)
                gone = _covered(*ends, len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, x in zip(words, gone.tolist(), strict=True) if not x))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary())],
                ["doc_id", "row", "n_removed", "kept"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "row", "text", "starts", "stops").mapInArrow(
        make, f"doc_id {kind}, row bigint, n_removed bigint, kept binary"
    )

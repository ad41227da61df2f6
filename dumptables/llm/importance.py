"""Quality by importance resampling.

Two generative models over hashed n-grams (single tokens and pairs), one of target text and one
of all text, give each document its log importance weight: the sum over its n-grams of the log
ratio of their probabilities. Weight plus Gumbel noise, top k, is a sample without replacement
in proportion to the weights. Runs of letters and runs of signs are tokens; digits are one
class, and so is a pair of equal tokens, whatever the token.

Target text is that of labelled good documents, at most ``TARGETS`` of them chosen by a hash of
doc_id, a bounded set that may be broadcast. A quarter of the labelled good documents, by the
same hash, is never target text. Both models count each different text once, so a
text does not become unlikely by being copied; the model of all text covers every document.
``BUCKETS`` is the least number of buckets: it grows with the cube root of the number of
different texts, some 5 million for 100 billion of them.

k is the number of documents whose weight is on the good side of a cut between labelled bad
documents and those good ones that no model has seen as target: the weight that keeps the largest share of good ones and rejects the largest share of
bad ones, each different weight counted once, half way to the next labelled weight below.

Nulls and ties: a null or empty text has weight zero; noise depends on the text alone, so copies
share it and stay or go together, and all rows at the threshold are selected. Without labelled
good documents, or without bad ones, every row is selected. Labels of the same doc_id that differ
count once each.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumptables.llm.common import small_batches, written
from dumptables.llm.passages import rows_of
from dumptables.llm.sieve import bitmap, passes

BUCKETS = 10_000
TARGETS = 50_000
PER_ROOT = 1_000
CANDIDATES = 400
SMOOTHING = 1.0
SEED = 42
PART = 1 << 20
SIEVE_BITS = 22  # 512 KiB

_TOKEN = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^\sA-Za-z0-9\x80-\xff]+")
_DIGITS = re.compile(rb"[0-9]+")


def ngrams(text: bytes, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text, for about a million tokens at a time."""
    tokens = (zlib.crc32(m.group()) for m in _TOKEN.finditer(_DIGITS.sub(b"0", text)))
    last = np.zeros(0, np.uint64)
    while True:
        ones = np.fromiter((t for t, _ in zip(tokens, range(PART), strict=False)), np.uint64)
        if not len(ones):
            return
        run = np.concatenate([last, ones])
        pairs = run[:-1] * np.uint64(0x9E3779B97F4A7C15) + run[1:]
        pairs ^= pairs >> np.uint64(31)
        pairs[run[:-1] == run[1:]] = 0
        yield (np.concatenate([ones, pairs]) % np.uint64(buckets)).astype(np.int64)
        last = run[-1:]


def held_out() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0


def target_ids(labels: DataFrame, most: int = TARGETS) -> DataFrame:
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").filter(~held_out()).select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def buckets_for(n_texts: int) -> int:
    return max(BUCKETS, round(PER_ROOT * n_texts ** (1 / 3)))


def different_texts(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """(text, target) of each different text, and about how many there are.

    Texts whose hash occurs once stay where they are. Of the others copies combine within each
    task, so no more than one text of a group leaves a task; whole texts are compared.
    """
    targets = target_ids(labels).select(F.col("doc_id").alias("__target"))
    hash_of = F.xxhash64(F.coalesce("text", F.lit("")))
    hashes = docs.groupBy(hash_of.alias("hash")).agg(F.count("*").alias("n"))
    hashes = written(hashes, "text_hashes")
    bits = bitmap(hashes.filter("n > 1").select("hash"), SIEVE_BITS)
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), bits.alias("bits"))
    marked = plain.join(F.broadcast(targets), F.col("doc_id") == F.col("__target"), "left")
    marked = marked.withColumn("target", F.col("__target").isNotNull())
    repeated = passes(F.col("bits"), SIEVE_BITS)(F.xxhash64("text"))
    alone = marked.filter(~repeated).select("text", "target")
    shared = marked.filter(repeated).groupBy("text").agg(F.max("target").alias("target"))
    return alone.union(shared), hashes.count()


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray | None:
    """For each bucket the log ratio of its probability in target text and in all text."""
    texts, n_texts = different_texts(small_batches(docs), labels)
    buckets = buckets_for(n_texts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {True: np.zeros(buckets, np.int64), False: np.zeros(buckets, np.int64)}
        waiting, held = {True: [], False: []}, 0

        def add() -> None:
            for chosen, found in waiting.items():
                if found:
                    counts[chosen] += np.bincount(np.concatenate(found), minlength=buckets)
                    found.clear()

        for batch in rows_of(batches):
            for text, target in zip(*batch.columns, strict=True):
                for found in ngrams(text.as_py(), buckets):
                    waiting[target.as_py()].append(found)
                    held += len(found)
                    if held > PART:
                        add()
                        held = 0
        add()
        raw = counts[True] + counts[False]
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(raw[used]), pa.array(counts[True][used])],
            ["bucket", "raw", "target"],
        )

    counts = (
        texts.select(F.col("text").cast("binary").alias("text"), "target")
        .mapInArrow(count, "bucket bigint, raw bigint, target bigint")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toArrow()  # one row for each bucket
    )
    raw, target = np.zeros(buckets), np.zeros(buckets)
    places = counts.column("bucket").to_numpy()
    raw[places] = counts.column("raw").to_numpy()
    target[places] = counts.column("target").to_numpy()
    if not target.sum():
        return None
    share = lambda x: np.log((x + SMOOTHING) / (x.sum() + SMOOTHING * buckets))
    return share(target) - share(raw)


def log_weight(ratios: np.ndarray) -> Column:
    """The log importance weight of column ``text``."""

    @F.pandas_udf("double")
    def weigh(texts: pd.Series) -> pd.Series:
        weights = (sum(ratios[f].sum() for f in ngrams(t or b"", len(ratios))) for t in texts)
        return pd.Series([float(w) for w in weights], dtype=float)

    return weigh(F.col("text").cast("binary"))


def gumbel(text: str = "text") -> Column:
    """Noise that depends on nothing but the text."""
    hashed = F.xxhash64(F.lit(SEED), F.coalesce(text, F.lit("")))
    uniform = (F.shiftrightunsigned(hashed, 11) + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def kth_largest(table: DataFrame, column: str, k: int, few: int = 10_000) -> float | None:
    """The exact k-th largest value, by counting ever finer bins; of the values themselves only
    those in the last bin, ``few`` at most, come to the driver unless they are all equal."""
    low, high, n = table.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k >= n:
        return low
    rest = table.select(column)
    while n > few and low < high:
        bin_of = F.least(
            F.floor((F.col(column) - low) / ((high - low) / 1000)), F.lit(999)
        )
        counts = rest.groupBy(bin_of.alias("bin")).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for row in sorted(counts.collect(), key=lambda r: -r["bin"]):
            if k <= row["n"]:
                break
            k -= row["n"]
        rest, n, low, high = rest.filter(bin_of == row["bin"]), row["n"], row["low"], row["high"]
    if low == high:
        return low
    return sorted((r[0] for r in rest.collect()), reverse=True)[k - 1]


def separating_weight(weighed: DataFrame, labels: DataFrame, candidates: int = CANDIDATES) -> float | None:
    """The weight between labelled good and bad documents of ``weighed`` (doc_id, log_weight)."""
    judged = labels.select("doc_id", (F.col("quality") == 1).alias("good"))
    judged = judged.filter(~F.col("good") | held_out())
    judged = written(weighed.join(judged, "doc_id").select("log_weight", "good").distinct(), "judged")
    points = judged.agg(
        F.percentile_approx("log_weight", [i / candidates for i in range(candidates + 1)], 100 * candidates)
    ).first()[0]
    if not points:
        return None
    points = sorted(set(points))
    place = F.size(F.filter(F.lit(points), lambda p: p <= F.col("log_weight")))
    bins = judged.groupBy(place.alias("bin")).agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"),
        F.max("log_weight").alias("high"),
    )
    bins = sorted(bins.collect(), key=lambda r: r["bin"])  # one row a candidate
    good, bad = sum(r["good"] for r in bins), sum(r["bad"] for r in bins)
    if not good or not bad:
        return None
    best, cut, lost, out, below = 0.0, None, 0, 0, None
    for row in bins:
        gain = out / bad - lost / good
        if gain > best:
            least = points[row["bin"] - 1] if row["bin"] else below
            best, cut = gain, (below + least) / 2
        lost, out, below = lost + row["good"], out + row["bad"], row["high"]
    return cut


def _limit(weighed: DataFrame, labels: DataFrame) -> float | None:
    """The least weight with noise of ``weighed`` (doc_id, log_weight, sampled) to be selected."""
    cut = separating_weight(weighed.select("doc_id", "log_weight"), labels)
    if cut is None:
        return None
    k = weighed.filter(F.col("log_weight") >= cut).count()
    return kth_largest(weighed, "sampled", max(k, 1))


def resample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, log_weight, sampled (weight and noise), selected of every row."""
    ratios = log_ratios(docs, labels)
    weight = F.lit(0.0) if ratios is None else log_weight(ratios)
    weighed = docs.select("doc_id", weight.alias("log_weight"), gumbel().alias("noise"))
    weighed = weighed.select("doc_id", "log_weight", (F.col("log_weight") + F.col("noise")).alias("sampled"))
    weighed = written(weighed, "weighed")
    limit = None if ratios is None else _limit(weighed, labels)
    return weighed.withColumn("selected", F.lit(True) if limit is None else F.col("sampled") >= limit)


def selected_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are selected, all columns unchanged.

    Weights are computed again rather than joined, so that no text moves.
    """
    ratios = log_ratios(docs, labels)
    if ratios is None:
        return docs
    weighed = docs.select("doc_id", log_weight(ratios).alias("log_weight"), gumbel().alias("noise"))
    weighed = weighed.select("doc_id", "log_weight", (F.col("log_weight") + F.col("noise")).alias("sampled"))
    limit = _limit(written(weighed, "weighed"), labels)
    return docs if limit is None else docs.filter(log_weight(ratios) + gumbel() >= limit)

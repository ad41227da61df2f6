"""Ranked lexical search: the best documents for each item of a query set, by summed impacts.

One pass over the texts writes a forward index: each document's number of terms, and its counts of
the terms that the items ask for. Tasks then take that index in shards (ranges of documents in
order of id). A shard inverts to posting lists; each list gets a sparse table, which answers in
two look-ups which of its postings in any range of documents has the highest impact.

An item is searched best first. An interval of documents is bounded by the sum of its terms' range
maxima. The interval of highest bound is split at a document of maximum impact: this one is
scored, and the parts left and right of it get bounds of their own. The search ends where no bound
reaches the score of the last document kept. Several of the best intervals are split at a time, so
that numpy works on arrays. Scores kept from a task's earlier shards serve as the limit of its
later ones; a last ranking merges what the tasks kept. Nothing is approximate, and no document is left out.

Terms are runs of 0-9, A-Z, a-z and all characters beyond ASCII, with A-Z lower-cased. A null text
has none. Items are taken in blocks of at most ``ITEM_BYTES`` of text (an item is never divided),
so what is sent to all tasks is bounded; documents are read once a block. Rows that share an
item_id are ranked each for itself; equal scores go by ascending doc_id, null first. Rows that
share a doc_id are documents of their own. Without documents or without terms there are no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dumptables.llm.common import written

ITEM_BYTES = 16 << 20
SHARD_ROWS = 16_384
SHARD_POSTINGS = 1_000_000
FEW, MANY = 32, 512  # intervals split at a time, at first and at most
NO_ID = -(1 << 63)

# Bytes of UTF-8 text to bytes of terms: all of a character beyond ASCII is above 127.
TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TERM_BYTES).split()


def index_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id``, ``n`` (terms in the document), and number and count of each term known."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            n, terms, counts = [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                words = terms_of(text)
                tf = Counter(words)
                met = sorted((vocabulary[term], tf[term]) for term in tf.keys() & known)
                n.append(len(words))
                terms.append([t for t, _ in met])
                counts.append([c for _, c in met])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind}, n bigint, terms array<int>, counts array<int>"
    )


class Shard:
    """Posting lists of some documents (ordered by id) and a sparse table over each list.

    Lists stand one after another; a table entry ``best[j][i]`` is the place of the highest
    impact among the ``2**j`` postings from place ``i`` on.
    """

    def __init__(self, ids, sizes, terms, counts, n_terms: int, weight, m):
        self.ids = ids
        order = np.lexsort((np.repeat(np.arange(len(ids)), sizes), terms))
        self.doc = np.repeat(np.arange(len(ids)), sizes)[order]
        self.term = terms[order].astype(np.int64)
        tf = counts[order].astype(np.int64)
        self.impact = weight[self.term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[self.doc]))
        every = np.arange(n_terms)
        self.start = np.searchsorted(self.term, every)
        self.end = np.searchsorted(self.term, every, side="right")
        self.key = self.term * len(ids) + self.doc
        width, longest = len(self.doc), int((self.end - self.start).max(initial=1))
        levels = longest.bit_length()
        self.best = np.zeros((levels, width), np.int32)
        self.best[0] = np.arange(width)
        for j in range(1, levels):
            half = 1 << (j - 1)
            a, b = self.best[j - 1, : width - 2 * half + 1], self.best[j - 1, half : width - half + 1]
            self.best[j, : len(a)] = np.where(self.impact[a] >= self.impact[b], a, b)
        self.log = np.zeros(longest + 1, np.int64)
        for i in range(2, longest + 1):
            self.log[i] = self.log[i >> 1] + 1

    def highest(self, a, b):
        """Impact and place of the highest posting in each range of places [a, b); 0 if empty."""
        some = b > a
        level = self.log[np.where(some, b - a, 0)]
        x = self.best[level, np.where(some, a, 0)]
        y = self.best[level, np.where(some, b - (1 << level), 0)]
        at_x, at_y = self.impact[x], self.impact[y]
        return np.where(some, np.maximum(at_x, at_y), 0), np.where(at_x >= at_y, x, y)

    def search(self, terms, times, kept: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
        """The ``k`` best of ``kept`` and this shard's documents, as (-score, id), in order."""
        there = self.end[terms] > self.start[terms]
        terms, times = terms[there], times[there]
        a, b = self.start[terms][None], self.end[terms][None]
        low = np.zeros(1, np.int64)  # the first document of each interval
        value, place = self.highest(a, b)
        size = FEW
        while len(low) and len(terms):
            bound = (value * times).sum(1)
            if len(kept) < k:
                live = bound > 0
            else:
                score, last = -kept[-1][0], kept[-1][1]
                first = self.ids[np.minimum(low, len(self.ids) - 1)]
                live = (bound > score) | ((bound == score) & (first <= last))
            a, b, low, value, place, bound = (x[live] for x in (a, b, low, value, place, bound))
            rest = np.zeros(len(bound), bool)
            if len(bound) > size:
                rest[np.argpartition(-bound, size)[size:]] = True
            now = ~rest
            a1, b1, low1 = a[now], b[now], low[now]
            if not len(low1):
                break
            most = (value[now] * times).argmax(1)
            doc = self.doc[place[now][np.arange(len(most)), most]]
            key = terms * len(self.ids) + doc[:, None]
            cut = np.searchsorted(self.key, key)
            held = np.minimum(cut, len(self.key) - 1)
            hit = self.key[held] == key
            scores = (np.where(hit, self.impact[held], 0) * times).sum(1)
            found = zip((-scores).tolist(), self.ids[doc].tolist(), strict=True)
            kept = sorted([*kept, *found])[:k]
            a2, b2 = np.concatenate([a1, cut + hit]), np.concatenate([cut, b1])
            value2, place2 = self.highest(a2, b2)
            a, b = np.concatenate([a[rest], a2]), np.concatenate([b[rest], b2])
            low = np.concatenate([low[rest], low1, doc + 1])
            value = np.concatenate([value[rest], value2])
            place = np.concatenate([place[rest], place2])
            size = min(2 * size, MANY)
        return kept


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Index rows as arrays (ids, n, sizes, terms, counts), in pieces of bounded size."""
    held, rows, postings = [], 0, 0

    def joined():
        ids, n, sizes, terms, counts = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(ids, kind="stable")
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        moved = sizes[order]
        at = np.repeat(starts[order] - np.concatenate([[0], np.cumsum(moved)])[:-1], moved)
        at = at + np.arange(len(terms))
        return ids[order], n[order], moved, terms[at], counts[at]

    for batch in batches:
        ids = batch.column(0).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
        n = batch.column(1).to_numpy(zero_copy_only=False)
        sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        terms = batch.column(2).flatten().to_numpy(zero_copy_only=False)
        counts = batch.column(3).flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(ids):
            done = ends[at - 1] if at else 0
            room = np.searchsorted(ends, done + SHARD_POSTINGS - postings, side="right")
            to = int(min(max(room, at + (not rows)), at + SHARD_ROWS - rows, len(ids)))
            if to > at:
                part = slice(done, ends[to - 1])
                held.append((ids[at:to], n[at:to], sizes[at:to], terms[part], counts[part]))
                rows, postings = rows + to - at, postings + int(ends[to - 1] - done)
            if to < len(ids):
                yield joined()
                held, rows, postings = [], 0, 0
            at = to
    if held:
        yield joined()


def _best_of(index: DataFrame, items: list[tuple], n_terms: int, weight, n_docs: int, length: int, k: int):
    """The ``k`` best documents of each task for each item, by the item's place in the list."""
    asked = []
    for times in items:
        numbers = np.array(sorted(times), np.int64)
        asked.append((numbers, np.array([times[t] for t in numbers.tolist()], np.int64)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list] = [[] for _ in asked]
        for ids, n, sizes, terms, counts in _shards(batches):
            m = 100 - 75 + (75 * n * n_docs) // length
            shard = Shard(ids, sizes, terms, counts, n_terms, weight, m)
            if len(shard.doc):
                kept = [shard.search(*item, best, k) for item, best in zip(asked, kept, strict=True)]
        rows = [(q, doc, -score) for q, best in enumerate(kept) for score, doc in best]
        q, doc, score = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(q, pa.int32()),
                pa.array([None if d == NO_ID else d for d in doc], pa.int64()),
                pa.array(score, pa.int64()),
            ],
            ["item", "doc_id", "score"],
        )

    return index.mapInArrow(search, "item int, doc_id bigint, score bigint")


def _search_block(docs: DataFrame, items: DataFrame, k: int, name: str) -> DataFrame:
    spark = docs.sparkSession
    rows = items.toArrow()
    texts = [Counter(terms_of(t)) for t in rows.column("text").cast(pa.binary()).to_pylist()]
    vocabulary = {term: i for i, term in enumerate(sorted(set().union(*texts)))}
    index = written(index_terms(docs, vocabulary), name)
    n_docs, length = index.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
    # As many counts as the items have terms.
    counted = index.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    df = np.zeros(len(vocabulary), np.int64)
    df[counted.column("term").to_numpy()] = counted.column("count").to_numpy()
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    asked = [{vocabulary[term]: times for term, times in text.items()} for text in texts]
    found = _best_of(index, asked, len(vocabulary), weight, n_docs, max(length or 0, 1), k)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    numbers = rows.select(["item_id"]).append_column("item", pa.array(range(len(rows)), pa.int32()))
    ids = spark.createDataFrame(numbers)
    return ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item its ``k`` best documents, scores above 0."""
    asked = items.select("item_id", "text")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = size // ITEM_BYTES + 1
    dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    parts = [
        _search_block(docs, asked.filter(dealt == block), k, f"lexical_{block}")
        for block in range(blocks)
    ]
    return reduce(DataFrame.unionByName, parts)

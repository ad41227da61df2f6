"""Repeated passages by sparse suffix arrays.

Suffixes are kept at content-selected places only: where an m-gram has the smallest hash of all
in some ``SPAN`` words. Every passage of ``PASSAGE`` words holds such a place within its first
``SPAN - GRAM + 1`` words, the same in all its copies, so it shows as two suffixes that agree on
``AHEAD`` words at least. The hash of these words tells which suffixes are worth keeping: a
bitmap of those that several documents have, sized by their count, goes to all tasks.

Kept suffixes, with the words just before them, are combined when equal, word for word, and
sorted. The words that neighbours have in common, to the right from the place on and to the left
before it, say which passages of ``PASSAGE`` words around the place they share; of the documents
that share one, all but that of smallest doc_id lose it. Every passage lies in the words kept
with its suffix, so no match is missed.

Suffixes of one key (that hash) are sorted in one task, up to ``CROWD`` different ones. A key with
more, such as a phrase that many documents have in ever other surroundings, is dealt by the
passages around it instead; the matches are the same.

No word goes that does not stand in such a passage of a document of smaller doc_id, so one copy
of everything stays.

Nulls and ties: as for super-k-mers. A null text has no words; rows with a null doc_id neither
change nor count; rows that share a doc_id are told apart by their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dumptables.llm.common import written
from dumptables.llm.passages import (
    SEED, Bits, kept_words, rows_of, run_hashes, sliding, sliding_min, texts, word_hashes,
)
from dumptables.llm.sieve import bits_for, local_bitmap
from dumptables.session import small_side

PASSAGE = 50
GRAM = 8
SPAN = 40
BEHIND = SPAN - GRAM
AHEAD = PASSAGE - BEHIND
TOGETHER = 1 << 15  # words hashed at a time, unless one text has more
CROWD = 10_000  # some 5 MB of words, 50 MB as Python holds them


def places(texts: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text the selected places and the hash of the AHEAD words from each on.

    Texts are hashed many at a time, end to end; no run of words reaches from one into the next.
    """
    at = 0
    while at < len(texts):
        end, n = at + 1, len(texts[at])
        while end < len(texts) and n + len(texts[end]) <= TOGETHER:
            n += len(texts[end])
            end += 1
        yield from _places(texts[at:end])
        at = end


def _places(texts: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    sizes = np.array([len(words) for words in texts])
    sizes[sizes < PASSAGE] = 0
    each = word_hashes([w for words, n in zip(texts, sizes.tolist(), strict=True) if n for w in words])
    stops = np.cumsum(sizes)
    if not len(each):
        found = hashes = np.zeros(0, np.int64)
        hashes = hashes.view(np.uint64)
    else:
        own = np.repeat(np.arange(len(texts)), sizes)
        # No gram is 0, which stands for windows that reach into the next text.
        grams = np.maximum(run_hashes(each, GRAM), np.uint64(1))
        width = SPAN - GRAM + 1
        least = sliding_min(grams, width)
        least = np.where(own[: len(least)] == own[SPAN - 1 :], least, np.uint64(0))
        # A gram is the smallest of some window if it is the largest of those of all its windows.
        room = np.zeros(width - 1, np.uint64)
        chosen = sliding(np.maximum, np.concatenate([room, least, room]), width) == grams
        ahead = run_hashes(each, AHEAD)
        chosen = chosen[: len(ahead)] & (own[: len(ahead)] == own[AHEAD - 1 :])
        found = np.flatnonzero(chosen)
        hashes = ahead[found]
    cut = np.searchsorted(found, np.concatenate([[0], stops])).tolist()
    for start, first, last in zip((stops - sizes).tolist(), cut, cut[1:], strict=False):
        yield found[first:last] - start, hashes[first:last]


def cuts(docs: DataFrame) -> DataFrame:
    """doc_id, row, n_words, sha256 of the words, keys (without repeats) of every row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            sizes, digests, keys = [], [], []
            split = [(text or b"").split() for text in batch.column(2).to_pylist()]
            for words, (_, hashes) in zip(split, places(split), strict=True):
                sizes.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).digest())
                keys.append(np.unique(hashes).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "row", "n_words", "sha256", "keys"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(
        make, f"doc_id {kind}, row bigint, n_words bigint, sha256 binary, keys array<bigint>"
    )


def kept_suffixes(docs: DataFrame, raw: bytes) -> DataFrame:
    """key, name, ahead, behind (backwards), doc_id, row, place of suffixes in the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = Bits(shared.value)
        for batch in rows_of(batches):
            taken, at, keys, names, ahead, behind = [], [], [], [], [], []
            split = [(text or b"").split() for text in batch.column(2).to_pylist()]
            for k, (words, (found, hashes)) in enumerate(zip(split, places(split), strict=True)):
                for i in np.flatnonzero(bits.has(hashes)).tolist():
                    p = int(found[i])
                    right = b" ".join(words[p : p + PASSAGE])
                    left = b" ".join(words[max(p - BEHIND, 0) : p][::-1])
                    taken.append(k)
                    at.append(p)
                    keys.append(hashes[i])
                    names.append(xxhash.xxh64_intdigest(left + b"\n" + right, SEED))
                    ahead.append(right)
                    behind.append(left)
            rows = pa.array(taken, pa.int32())
            signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [signed(keys), signed(names), pa.array(ahead, pa.binary()),
                 pa.array(behind, pa.binary()), batch.column(0).take(rows),
                 batch.column(1).take(rows), pa.array(at, pa.int32())],
                ["key", "name", "ahead", "behind", "doc_id", "row", "place"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(
        make,
        "key bigint, name bigint, ahead binary, behind binary, "
        f"doc_id {kind}, row bigint, place int",
    )


def _agree(a: list[bytes], b: list[bytes]) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


class _Suffix:
    """A distinct suffix: its words to both sides, and the smallest and largest doc_id with it."""

    __slots__ = ("key", "name", "ahead", "behind", "low", "high")

    def __init__(self, key, name, ahead, behind, low, high):
        self.key, self.name, self.low, self.high = key, name, low, high
        self.ahead, self.behind = ahead.split(), behind.split()

    def extensions(self) -> range:
        """How many words to the left a passage that holds this place may begin."""
        return range(max(0, PASSAGE - len(self.ahead)), len(self.behind) + 1)


def _spans(extensions: list[int]) -> Iterator[tuple[int, int]]:
    """Words to the left and right of runs of passages; ``extensions`` ascend."""
    start = before = extensions[0]
    for e in extensions[1:]:
        if e != before + 1:
            yield before, PASSAGE - start
            start = e
        before = e
    yield before, PASSAGE - start


def _sorted_matches(group: list[_Suffix]) -> Iterator[tuple]:
    """key, name, left, right, first of the suffixes of one key, which come sorted.

    The common words of neighbours say which suffixes agree on so many words to the right: they
    stand in one run. Of a run, those with the same words to the left have the passage that begins
    there in common; the smallest doc_id among them stays.
    """
    if len(group) == 1:
        own = group[0]
        if own.low < own.high and (held := list(own.extensions())):
            yield own.key, own.name, held[-1], PASSAGE - held[0], own.low
        return
    common = [_agree(x.ahead, y.ahead) for x, y in zip(group, group[1:], strict=False)]
    found: list[dict[int, list[int]]] = [{} for _ in group]
    for e in range(BEHIND + 1):
        at = 0
        while at < len(group):
            end = at + 1
            while end < len(group) and common[end - 1] >= PASSAGE - e:
                end += 1
            having = [i for i in range(at, end) if e in group[i].extensions()]
            lows: dict[tuple, int] = {}
            for i in having:
                left = tuple(group[i].behind[:e])
                lows[left] = min(lows.get(left, group[i].low), group[i].low)
            for i in having:
                first = lows[tuple(group[i].behind[:e])]
                if first < group[i].high:
                    found[i].setdefault(first, []).append(e)
            at = end
    for own, firsts in zip(group, found, strict=True):
        for first, extensions in firsts.items():
            for left, right in _spans(extensions):
                yield own.key, own.name, left, right, first


_MATCHES = "key bigint, name bigint, `left` int, `right` int, first bigint"
_MATCH_NAMES = ["key", "name", "left", "right", "first"]
_MATCH_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
_WORDS = ["key", "name", "ahead", "behind", "low", "high"]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in rows_of(batches, 1024):
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, 5000)):
        columns = zip(*part, strict=True)
        arrays = [pa.array(c, t) for c, t in zip(columns, _MATCH_TYPES, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, _MATCH_NAMES)


def compare_neighbours(contexts: DataFrame) -> DataFrame:
    """Matches of suffixes that stand together in sorted order; at most ``CROWD`` a key."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = groupby((_Suffix(*row) for row in _rows(batches)), lambda own: own.key)
        yield from _batches(m for _, group in groups for m in _sorted_matches(list(group)))

    # The window asks for what the function needs: keys in one place, sorted by words.
    order = Window.partitionBy("key").orderBy("ahead", "behind", "name")
    dealt = contexts.select(*_WORDS, F.row_number().over(order).alias("n")).filter("n > 0")
    return dealt.select(_WORDS).mapInArrow(make, _MATCHES)


def compare_crowded(contexts: DataFrame) -> DataFrame:
    """The same matches for keys with any number of suffixes, which no task could hold.

    Each suffix is named once for every extension to the left, by a 128-bit hash of the words of
    the passage that begins there. Suffixes with equal ones are nominated together with the one
    of smallest doc_id among them, and then compared with it word by word.
    """

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            taken, hashes, extensions = [], [], []
            for k, row in enumerate(zip(*batch.columns, strict=True)):
                own = _Suffix(*(value.as_py() for value in row))
                run = own.behind[::-1] + own.ahead
                for e in own.extensions():
                    at = len(own.behind) - e
                    taken.append(k)
                    hashes.append(xxhash.xxh128_digest(b" ".join(run[at : at + PASSAGE]), SEED))
                    extensions.append(e)
            rows = pa.array(taken, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.binary()), pa.array(extensions, pa.int32()),
                 *(batch.column(i).take(rows) for i in (0, 1, 4, 5))],
                ["window", "e", "key", "name", "low", "high"],
            )

    dealt = contexts.select(_WORDS).mapInArrow(
        passages, "window binary, e int, key bigint, name bigint, low bigint, high bigint"
    )
    dealt = written(dealt, "windows", "zstd")
    # A passage may hold several places; each is compared among suffixes of its own key.
    same = ["window", "key", "e"]
    runs = dealt.groupBy(same).agg(
        F.min(F.struct("low", "name")).alias("f"), F.max("high").alias("last")
    )
    due = dealt.join(runs.filter("f.low < last").select(*same, "f"), same)
    due = due.filter("f.low < high").groupBy("key", "name", "f").agg(F.collect_set("e").alias("e"))
    words = contexts.select("key", "name", "ahead", "behind")
    first = words.select("key", *(F.col(c).alias(f"f_{c}") for c in words.columns[1:]))
    pairs = due.select("key", "name", "e", F.col("f.low").alias("first"), F.col("f.name").alias("f_name"))
    pairs = pairs.join(words, ["key", "name"]).join(first, ["key", "f_name"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def matches() -> Iterator[tuple]:
            for key, name, first, nominated, *sides in _rows(batches):
                ahead, behind, f_ahead, f_behind = (side.split() for side in sides)
                left, right = _agree(behind, f_behind), _agree(ahead, f_ahead)
                agreed = sorted(e for e in nominated if e <= left and PASSAGE - e <= right)
                if agreed:
                    yield from ((key, name, *span, first) for span in _spans(agreed))

        return _batches(matches())

    return pairs.select(
        "key", "name", "first", "e", "ahead", "behind", "f_ahead", "f_behind"
    ).mapInArrow(compare, _MATCHES)


def repeated_spans(docs: DataFrame, cut: DataFrame) -> DataFrame:
    """doc_id, row, starts, stops of the passages that a document of smaller doc_id has too."""
    known = docs.filter("doc_id IS NOT NULL")
    seen = cut.filter("doc_id IS NOT NULL").select("doc_id", F.explode("keys").alias("hash"))
    shared = seen.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = written(shared.filter("low < high").select("hash"), "shared")
    raw = local_bitmap(shared, bits_for(shared.count()))
    kept = written(kept_suffixes(known, raw), "suffixes", "zstd")
    contexts = kept.groupBy("key", "name", "ahead", "behind").agg(
        F.min("doc_id").cast("bigint").alias("low"), F.max("doc_id").cast("bigint").alias("high")
    )
    contexts = written(contexts, "contexts", "zstd")
    groups = contexts.groupBy("key").agg(
        F.count("*").alias("n"), F.min("low").alias("a"), F.max("high").alias("b")
    )
    groups = written(groups.filter("a < b").select("key", "n"), "groups")
    crowded = written(groups.filter(F.col("n") > CROWD).select("key"), "crowded")
    some = contexts.join(small_side(crowded), "key", "left_anti")
    some = some.join(groups.select("key"), "key", "left_semi")
    matches = compare_neighbours(some)
    if not crowded.isEmpty():
        many = written(contexts.join(small_side(crowded), "key", "left_semi"), "many", "zstd")
        matches = matches.union(compare_crowded(many))
    matches = written(matches, "matches")
    at = kept.select("key", "name", "doc_id", "row", "place")
    hits = at.join(matches, ["key", "name"]).filter("first < doc_id").select(
        "doc_id", "row", F.expr("place - `left`").alias("start"), F.expr("place + `right`").alias("stop")
    )
    return hits.groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "stop")).alias("s")).select(
        "doc_id", "row", F.col("s.start").alias("starts"), F.col("s.stop").alias("stops")
    )


def dedup_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of ``docs``."""
    cut = written(cuts(docs), "cuts")
    spans = written(repeated_spans(docs, cut), "spans")
    changed = kept_words(docs, spans).select(
        "doc_id", "row", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
    return cut.join(written(changed, "changed"), ["doc_id", "row"], "left").select(
        "doc_id", "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("kept_sha256", F.lower(F.hex("sha256"))).alias("kept_sha256"),
    )

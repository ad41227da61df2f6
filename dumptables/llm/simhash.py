"""SimHash near-duplicates with pigeonring filtering.

Fingerprints are made in Arrow batches, one text at a time. Texts with one fingerprint are one
class; links are sought between classes only.

Pigeonring: cut into m segments, two fingerprints within t bits have a segment from which on
the differences of every chain of l consecutive segments (around the ring) add up to at most
l*t/m. With t = 2 and m = 3 the first segment of that chain is equal and the second differs in
one bit at most, so one of its halves is equal too: both together, some 32 bits, are the join
key, six for each fingerprint, and no link is lost. What meets under a key must pass the whole
chain before the full distance is taken.

Keys that many fingerprints share (large groups of near copies) are not paired: two
fingerprints within two bits have a common neighbour within one bit, so each states its
neighbours and all that share one are linked to the smallest of them. A point has 65
neighbours, so this grows in step with the fingerprints and no group is ever large.

``one_of_each`` keeps one document of each group so linked.

``near_groups`` serves similarities for which no key is certain to agree: wider fingerprints of
the set of shingles, several fixed orders of their bits, and segments of each order as keys,
chains and distance checked as above. As bits alone miss about one pair in six at Jaccard 0.8,
runs of minima of the set under seeded orders (MinHash) are keys too. All this only nominates:
a link is a pair whose sets of shingle hashes, made again for nominated classes, have the
Jaccard similarity asked for. A class is one set of shingles. Under a key with many members
one of them, then all that are not yet in its component, are compared with every member. It
finds a pair when any of its keys agrees: at Jaccard 0.8 all but some 7 in 100,000.

Nulls, empty and long texts: a null text is empty; a text without words has fingerprint zero
and is linked like any other; a text with fewer words than a shingle is one shingle. Long texts
are hashed in blocks. Rows with a null doc_id get the component of their class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dumptables.llm.common import let, small_batches, written
from dumptables.llm.components import components
from dumptables.llm.passages import rows_of, text_key, texts
from dumptables.llm.sieve import bitmap, passes, without

SEED = 42
BLOCK = 1 << 15
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words. Bytes are lower-cased and split as ASCII."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    body = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(body, SEED)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(sizes + 1) - 1
    starts = (stops - sizes).tolist()
    ends = stops[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    found = [digest(body[a:b], SEED) for a, b in zip(starts, ends, strict=False)]
    return np.array(found, np.uint64)


def _lanes(hashes: np.ndarray, lanes: int) -> np.ndarray:
    """Each hash as ``lanes`` words of 64 bits; the first is the hash itself."""
    out = np.empty((len(hashes), lanes), np.uint64)
    out[:, 0] = hashes
    for k in range(1, lanes):
        x = hashes * np.uint64(_MIX[k]) + np.uint64(_MIX[k - 1])
        x ^= x >> np.uint64(29)
        x *= np.uint64(_MIX[0])
        out[:, k] = x ^ (x >> np.uint64(32))
    return out


def fingerprint(text: bytes, size: int, lanes: int = 1) -> np.ndarray:
    """``lanes`` words of 64 bits; a bit is set if it is in more than half of the hashes."""
    return _majority(shingle_hashes(text, size), lanes)


def _majority(hashes: np.ndarray, lanes: int) -> np.ndarray:
    counts = np.zeros(64 * lanes, np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = _lanes(hashes[at : at + BLOCK], lanes).astype(">u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), -1), axis=1)
        counts += bits.sum(0, dtype=np.int64)
    return np.packbits(2 * counts > len(hashes)).view(">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, size: int, lanes: int = 1) -> DataFrame:
    """doc_id, row (the text's key) and f0, f1, ... (bigint, the bits of 64-bit words) of every
    row."""
    names = [f"f{k}" for k in range(lanes)]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.empty((batch.num_rows, lanes), np.uint64)
            for i, text in enumerate(batch.column(2)):
                found[i] = fingerprint(text.as_py() or b"", size, lanes)
            columns = [pa.array(found[:, k].view(np.int64)) for k in range(lanes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *columns], ["doc_id", "row", *names]
            )

    rows = texts(small_batches(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(make, f"doc_id {kind}, row bigint, " + ", ".join(f"{n} bigint" for n in names))


def within_chain(differences: list[Column], limit: int) -> Column:
    """Whether from some segment on every chain keeps its share of ``limit``."""
    m = len(differences)
    any_start = F.lit(False)
    for i in range(m):
        total, keeps = F.lit(0), F.lit(True)
        for length in range(1, m + 1):
            total = total + differences[(i + length - 1) % m]
            keeps = keeps & (total <= length * limit // m)
        any_start = any_start | keeps
    return any_start


# --- 64 bits, at most two of them different: exact -------------------------------------

LIMIT = 2
_SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRED = 64  # keys of more fingerprints than this are linked by neighbours instead of pairs


def _bits(value: Column, at: int, width: int) -> Column:
    return F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << width) - 1))


def _ring_keys(value: Column) -> Column:
    """The six join keys of a fingerprint: a segment and one half of the next."""
    keys = []
    for i, (at, width) in enumerate(_SEGMENTS):
        next_at, next_width = _SEGMENTS[(i + 1) % 3]
        half = next_width // 2
        for j, (h_at, h_width) in enumerate(((next_at, half), (next_at + half, next_width - half))):
            joined = F.shiftleft(_bits(value, at, width), h_width).bitwiseOR(
                _bits(value, h_at, h_width)
            )
            keys.append(F.shiftleft(F.lit(2 * i + j).cast("bigint"), 40).bitwiseOR(joined))
    return F.array(*keys)


def _within_two(a: Column, b: Column) -> Column:
    x = a.bitwiseXOR(b)
    apart = [F.bit_count(_bits(x, at, width)) for at, width in _SEGMENTS]
    return within_chain(apart, LIMIT) & (F.bit_count(x) <= LIMIT)


def close_links(classes: DataFrame) -> DataFrame:
    """(a, b): links that connect all fingerprints ``f0`` within two bits of each other.

    ``classes`` has each fingerprint once. Every link returned is one; of the links under
    crowded keys enough are returned to connect what they connect.
    """
    keyed = written(classes.select("f0", F.explode(_ring_keys(F.col("f0"))).alias("key")), "keyed")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = written(keyed.join(sizes, "key"), "shared_keys")
    few = shared.filter(F.col("n") <= PAIRED).groupBy("key").agg(F.collect_list("f0").alias("fs"))
    pairs = F.flatten(
        F.transform(
            "fs",
            lambda x, i: F.transform(
                F.filter(
                    F.slice("fs", i + 2, F.lit(PAIRED)), lambda y: _within_two(x, y)
                ),
                lambda y: F.struct(x.alias("a"), y.alias("b")),
            ),
        )
    )
    links = few.select(F.explode(pairs).alias("p")).select("p.a", "p.b")
    crowded = shared.filter(F.col("n") > PAIRED).select("f0").distinct()
    near = F.expr("concat(array(f0), transform(sequence(0, 63), i -> f0 ^ shiftleft(1L, i)))")
    points = crowded.select("f0", F.explode(near).alias("point"))
    hubs = points.groupBy("point").agg(F.min("f0").alias("hub"), F.count("*").alias("n"))
    stars = points.join(hubs.filter("n > 1").select("point", "hub"), "point")
    stars = stars.filter("f0 <> hub").select(F.col("f0").alias("a"), F.col("hub").alias("b"))
    return links.union(stars).distinct()


def close_rows(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, row (the text's key), f0, component (one of its fingerprints) and component_id of
    every row: the smallest doc_id it reaches over links of at most two differing bits."""
    rows = written(fingerprints(docs, size), "fingerprints")
    classes = written(rows.groupBy("f0").agg(F.min("doc_id").alias("first")), "classes")
    parts = components(close_links(classes))
    placed = classes.join(parts, classes["f0"] == parts["node"], "left").select(
        "f0", "first", F.coalesce("component", "f0").alias("component")
    )
    placed = written(placed, "placed")
    heads = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    named = placed.join(heads, "component").select("f0", "component", "component_id")
    return rows.join(named, "f0").select("doc_id", "row", "f0", "component", "component_id")


def close_groups(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, f0, component_id of ``close_rows``."""
    return close_rows(docs, size).select("doc_id", "f0", "component_id")


def one_of_each(docs: DataFrame, size: int = 3) -> DataFrame:
    """The rows of ``docs`` without those linked, directly or over others, to a row of smaller
    doc_id; all columns unchanged. Of texts under one doc_id that are linked the one of smallest
    key stays, unrelated ones all do; equal rows are one document. Rows with a null doc_id stay."""
    groups = written(close_rows(docs.filter("doc_id IS NOT NULL"), size), "close_rows")
    heads = groups.filter("doc_id = component_id").groupBy("component").agg(F.min("row").alias("head"))
    met = groups.join(heads, "component")
    gone = met.filter((F.col("doc_id") != F.col("component_id")) | (F.col("row") != F.col("head")))
    gone = written(gone.select("doc_id", "row"), "close_copies")
    return without(docs, [F.col("doc_id"), text_key()], gone)


# --- wide fingerprints, any similarity ---------------------------------------------------

LANES = 4
ORDERS = 6
KEY_BITS = 20
WIDE_LIMIT = 80  # of 256 bits; at Jaccard 0.8 texts differ in 39, those of five shingles in 48
SIMILARITY = 0.8
BANDS, MINIMA = 24, 5  # keys of so many minima each


def _segment_keys(orders: int, key_bits: int) -> np.ndarray:
    """(keys, key_bits): the bits of each key, consecutive segments of seeded orders."""
    dealt = np.random.default_rng(SEED)
    rows = []
    for _ in range(orders):
        order = dealt.permutation(64 * LANES)
        rows += [order[a : a + key_bits] for a in range(0, len(order) - key_bits + 1, key_bits)]
    return np.array(rows)


def _minima_keys(hashes: np.ndarray) -> np.ndarray:
    """BANDS keys, each of the smallest hashes under MINIMA seeded orders."""
    dealt = np.random.default_rng(SEED)
    odd = dealt.integers(0, 1 << 63, BANDS * MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(len(odd), np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 1024):
        np.minimum(least, (odd[:, None] * hashes[at : at + 1024]).min(1), out=least)
    least ^= least >> np.uint64(31)
    keys = np.arange(BANDS, dtype=np.uint64)
    for k in range(MINIMA):
        keys = (keys ^ least[k::MINIMA]) * np.uint64(_MIX[0])
        keys ^= keys >> np.uint64(29)
    return keys


def _set_of(text: bytes, size: int) -> tuple[int, np.ndarray]:
    """The different shingle hashes of a text in order, and a name for them."""
    hashes = np.unique(shingle_hashes(text, size))
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED), hashes


def set_fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, row (the text's key), node (the set of shingles), its f0, f1, ... and its minima's
    keys of every row."""
    names = [f"f{k}" for k in range(LANES)]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = np.empty(batch.num_rows, np.uint64)
            found = np.empty((batch.num_rows, LANES), np.uint64)
            bands = np.empty((batch.num_rows, BANDS), np.uint64)
            for i, text in enumerate(batch.column(2)):
                nodes[i], hashes = _set_of(text.as_py() or b"", size)
                found[i], bands[i] = _majority(hashes, LANES), _minima_keys(hashes)
            stops = pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nodes.view(np.int64)),
                 *(pa.array(found[:, k].view(np.int64)) for k in range(LANES)),
                 pa.ListArray.from_arrays(stops, pa.array(bands.ravel().view(np.int64)))],
                ["doc_id", "row", "node", *names, "bands"],
            )

    rows = texts(small_batches(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    words = ", ".join(f"{n} bigint" for n in names)
    return rows.mapInArrow(make, f"doc_id {kind}, row bigint, node bigint, {words}, bands array<bigint>")


def _wide_keys(classes: DataFrame, orders: int, key_bits: int) -> DataFrame:
    """(node, key) for every key of every class, those of its bits and those of its minima."""
    names = [f"f{k}" for k in range(LANES)]
    places = _segment_keys(orders, key_bits)
    weights = 1 << np.arange(key_bits, dtype=np.int64)
    tags = np.arange(len(places), dtype=np.int64) << key_bits

    def make(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                lanes = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:-1]], 1)
                raw = np.ascontiguousarray(lanes.view(np.uint64).astype(">u8")).view(np.uint8)
                bits = np.unpackbits(raw.reshape(len(lanes), -1), axis=1)
                keys = bits[:, places].astype(np.int64) @ weights + tags
                minima = batch.column(len(names) + 1).flatten().to_numpy(zero_copy_only=False)
                keys = np.hstack([keys, minima.reshape(len(keys), BANDS)])
                nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), keys.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes), pa.array(keys.ravel())], ["node", "key"]
                )

    return classes.select("node", *names, "bands").mapInArrow(make, "node bigint, key bigint")


def _apart(a: Column, b: Column) -> list[Column]:
    return [F.bit_count(a[f"f{k}"].bitwiseXOR(b[f"f{k}"])) for k in range(LANES)]


def _linked(a: Column, b: Column, limit: int) -> Column:
    return let(
        F.array(*_apart(a, b)),
        lambda d: within_chain([d[k] for k in range(LANES)], limit)
        & (d[0] + d[1] + d[2] + d[3] <= limit),
    )


PIVOTS = 32
SET_BITS = 22  # 512 KiB


def _links_to(members: DataFrame, pivots: DataFrame, limit: int) -> DataFrame:
    """Links of all members of a key to its pivots (node, f); at most PIVOTS of them a key."""
    gathered = pivots.groupBy("key").agg(F.collect_list(F.struct("node", "f")).alias("pivots"))
    met = members.join(gathered, "key")
    near = F.filter(
        "pivots",
        lambda p: (p["node"] != F.col("node")) & _linked(p["f"], F.col("f"), limit),
    )
    found = met.select("node", F.explode(F.transform(near, lambda p: p["node"])).alias("other"))
    return found.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))


def _shingle_sets(docs: DataFrame, size: int, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the classes ``wanted`` (node, first: a doc_id that has it)."""
    bits = bitmap(wanted.select(F.xxhash64("first").alias("hash")), SET_BITS)
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), bits.alias("bits"))
    rows = rows.filter(passes(F.col("bits"), SET_BITS)(F.xxhash64("doc_id")))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            sets = [_set_of(text.as_py() or b"", size) for text in batch.column(1)]
            nodes = np.array([n for n, _ in sets], np.uint64).view(np.int64)
            shingles = pa.array([h.tobytes() for _, h in sets], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes), shingles], ["first", "node", "shingles"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = rows.select("doc_id", "text").mapInArrow(
        make, f"first {kind}, node bigint, shingles binary"
    )
    return made.join(wanted, ["first", "node"]).select("node", "shingles").dropDuplicates(["node"])


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets have the Jaccard similarity."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(z.as_py(), np.uint64) for z in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= similarity * (len(x) + len(y) - common) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    met = pairs.join(sets.toDF("b", "y"), "b").join(sets.toDF("a", "x"), "a")
    return met.select("a", "b", "x", "y").mapInArrow(make, "a bigint, b bigint")


def _confirmed(
    nominated: DataFrame, classes: DataFrame, docs: DataFrame, size: int, similarity: float
) -> DataFrame:
    """Links of similar pairs, enough of them to connect all similar pairs that are nominated.

    Each class first meets one other; pairs that this connects need no comparison.
    """
    pairs = written(nominated.distinct(), "nominated")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = written(classes.select("node", "first").join(nodes, "node", "left_semi"), "wanted")
    sets = written(_shingle_sets(docs, size, wanted), "shingle_sets")
    once = written(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "once")
    links = written(_similar(once, sets, similarity), "links")
    parts = components(links)
    rest = pairs.join(once, ["a", "b"], "left_anti")
    rest = rest.join(parts.toDF("a", "part_a"), "a", "left").join(parts.toDF("b", "part_b"), "b", "left")
    apart = F.coalesce("part_a", "a") != F.coalesce("part_b", "b")
    rest = written(rest.filter(apart).select("a", "b"), "rest")
    return links.union(written(_similar(rest, sets, similarity), "links"))


def near_links(
    classes: DataFrame, docs: DataFrame, size: int, limit: int = WIDE_LIMIT,
    similarity: float = SIMILARITY, orders: int = ORDERS, key_bits: int = KEY_BITS,
) -> DataFrame:
    """(a, b): links of similar classes (node, first, f0, f1, ..., bands) that share a key and
    are within ``limit`` bits, enough of them to connect all that they connect."""
    confirmed = lambda pairs: _confirmed(pairs, classes, docs, size, similarity)
    keyed = written(_wide_keys(classes, orders, key_bits), "keyed")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = keyed.join(sizes, "key")
    lanes = classes.select("node", F.struct(*(f"f{k}" for k in range(LANES))).alias("f"))
    members = written(shared.join(lanes, "node"), "members")
    few, many = members.filter(F.col("n") <= PIVOTS), members.filter(F.col("n") > PIVOTS)
    heads = many.groupBy("key").agg(F.min("node").alias("node"))
    heads = heads.join(many.select("key", "node", "f"), ["key", "node"])
    links = confirmed(_links_to(few, few, limit).union(_links_to(many, heads, limit)))
    if many.isEmpty():
        return links
    # Those outside the largest component under their key meet all members, some at a time.
    parts = components(links)
    placed = many.join(parts, "node", "left").select(
        "key", "node", "f", F.coalesce("component", "node").alias("part")
    )
    placed = written(placed, "placed")
    largest = (
        placed.groupBy("key", "part").agg(F.count("*").alias("c"))
        .groupBy("key").agg(F.max(F.struct("c", "part")).alias("top"))
        .select("key", F.col("top.part").alias("top"))
    )
    outside = placed.join(largest, "key").filter("part <> top")
    ranked = outside.select(
        "key", "node", "f", F.row_number().over(Window.partitionBy("key").orderBy("node")).alias("r")
    )
    ranked = written(ranked, "outside")
    turns = ranked.agg(F.max("r")).first()[0] or 0
    for turn in range(0, turns, PIVOTS):
        some = ranked.filter(F.col("r").between(turn + 1, turn + PIVOTS))
        links = links.union(confirmed(_links_to(many, some, limit)))
    return links


def near_rows(docs: DataFrame, size: int = 5, limit: int = WIDE_LIMIT) -> DataFrame:
    """(doc_id, row, component_id, component_row) of the rows that have a near copy with another
    set of shingles or the same one. The component is named by the smallest doc_id reachable and
    the smallest key of a text that it has there. Rows of one doc_id but different texts are
    documents of their own; equal rows are one document."""
    docs = docs.filter("doc_id IS NOT NULL")
    rows = written(set_fingerprints(docs, size), "fingerprints")
    names = [f"f{k}" for k in range(LANES)]
    classes = written(
        rows.groupBy("node").agg(
            F.min("doc_id").alias("first"), F.count("*").alias("n"),
            F.min(F.struct("doc_id", "row")).alias("head"),
            *(F.first(c).alias(c) for c in [*names, "bands"]),
        ),
        "classes",
    )
    parts = components(near_links(classes, docs, size, limit))
    placed = classes.join(parts, "node", "left").filter("n > 1 OR component IS NOT NULL")
    placed = placed.select("node", "head", F.coalesce("component", "node").alias("component"))
    placed = written(placed, "placed")
    heads = placed.groupBy("component").agg(F.min("head").alias("head"))
    named = placed.drop("head").join(heads, "component").select(
        "node",
        F.col("head.doc_id").alias("component_id"),
        F.col("head.row").alias("component_row"),
    )
    found = rows.select("doc_id", "row", "node").join(named, "node")
    return found.select("doc_id", "row", "component_id", "component_row")


def near_groups(docs: DataFrame, size: int = 5, limit: int = WIDE_LIMIT) -> DataFrame:
    """(doc_id, component_id) of ``near_rows``."""
    return near_rows(docs, size, limit).select("doc_id", "component_id")


def one_of_similar(docs: DataFrame, size: int = 5, limit: int = WIDE_LIMIT) -> DataFrame:
    """The rows of ``docs`` without those that have a near copy of smaller doc_id; all columns
    unchanged. Rows with a null doc_id stay, and so do unrelated texts under one doc_id."""
    groups = near_rows(docs, size, limit)
    first = F.struct("doc_id", "row") == F.struct("component_id", "component_row")
    gone = groups.filter(~first).select("doc_id", "row")
    return without(docs, [F.col("doc_id"), text_key()], written(gone, "near_copies"))

"""Benchmark decontamination by winnowing.

Of the hashes of all k-grams in every window of ``span - k + 1`` consecutive k-grams the
smallest are kept as fingerprints, on both sides, so any ``span`` words that a document shares
with a test item share a kept fingerprint at the same place. Fingerprints are joined, and each
hit is extended word by word to both sides, so that only runs of ``span`` equal words count.

A bitmap of the test fingerprints, of fixed size, sifts the documents' k-grams before anything
leaves the row: what moves is a small part of the text, with just the words around it. As a
benchmark grows the bitmap fills and sifts less, and the result stays the same.

A test item of fewer than ``span`` words is one window itself and is looked up by its own
length; lengths below ``span`` are few, so they are constants of the plan.

Nulls and ties: a null text has no words; a null item id is counted as an item like any other
id; rows that share a doc_id, or have none, are told apart by their text, each with its own hits,
and equal rows are one document. An empty table on either side gives no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumptables.llm.common import ascii_lower, let, written
from dumptables.llm.passages import text_key
from dumptables.llm.sieve import bitmap, passes, without

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = 13
GRAM = 5
BITS = 20  # 2**20 bits are 128 KiB


def words_of(text: str = "text") -> Column:
    lowered = ascii_lower(F.coalesce(text, F.lit("")))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _gram_hashes(words: Column, size: int) -> Column:
    """Hash of the ``size`` words from each position on; none if there are fewer words."""
    last = F.size(words) - size
    return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(words, i + 1, F.lit(size)))
        )
    )


def _is_fingerprint(hashes: Column, i: Column, window: int) -> Column:
    """Whether the hash at ``i`` is the smallest of some ``window`` consecutive ones.

    Equal hashes are all kept. Fewer hashes than a window count as one window.
    """
    own = F.get(hashes, i)
    start = F.greatest(i - (window - 1), F.lit(0))
    left = F.slice(hashes, start + 1, i - start)
    right = F.slice(hashes, i + 2, F.lit(window - 1))

    def reach(side: Column) -> Column:
        smaller = F.array_position(F.transform(side, lambda h: h < own), True)
        return F.when(smaller == 0, F.size(side)).otherwise(smaller - 1)

    whole = F.least(F.lit(window), F.size(hashes))
    return reach(F.reverse(left)) + reach(right) + 1 >= whole


def _around(words: Column, i: Column, gram: int, span: int) -> Column:
    """The words that a run of ``span`` through the gram at ``i`` can hold, and where it begins."""
    start = F.greatest(i - (span - gram), F.lit(0))
    return F.struct(
        (i - start).cast("int").alias("before"),
        F.slice(words, start + 1, i - start + span).alias("words"),
    )


def _fingerprints(words: Column, gram: int, span: int, sift) -> Column:
    """array<struct<hash, at, context>> of one text."""

    def body(pair: Column) -> Column:
        hashes, text = pair["h"], pair["w"]
        places = F.filter(
            F.when(F.size(hashes) == 0, F.array().cast("array<int>")).otherwise(
                F.sequence(F.lit(0), F.size(hashes) - 1)
            ),
            lambda i: sift(F.get(hashes, i)) & _is_fingerprint(hashes, i, span - gram + 1),
        )
        return F.transform(
            places,
            lambda i: F.struct(
                F.get(hashes, i).alias("hash"),
                i.alias("at"),
                _around(text, i, gram, span).alias("context"),
            ),
        )

    return let(
        words, lambda w: let(F.struct(_gram_hashes(w, gram).alias("h"), w.alias("w")), body)
    )


def _short_windows(words: Column, sizes: list[int], sift) -> Column:
    """array<struct<hash, at, window>> of all windows as long as some short item."""

    def of(size: int, w: Column) -> Column:
        hit = F.filter(
            F.transform(_gram_hashes(w, size), lambda h, i: F.struct(h.alias("hash"), i.alias("at"))),
            lambda x: sift(x["hash"]),
        )
        return F.transform(
            hit,
            lambda x: F.struct(
                x["hash"].alias("hash"),
                x["at"].alias("at"),
                F.slice(w, x["at"] + 1, F.lit(size)).alias("window"),
            ),
        )

    if not sizes:
        return F.array().cast("array<struct<hash: bigint, at: int, window: array<string>>>")
    return let(words, lambda w: F.flatten(F.array(*(of(n, w) for n in sizes))))


def _equal_run(mine: Column, theirs: Column) -> Column:
    """How many words agree from the front on."""
    differs = F.array_position(
        F.zip_with(mine, theirs, lambda a, b: F.coalesce(a == b, F.lit(False))), False
    )
    shorter = F.least(F.size(mine), F.size(theirs))
    return F.when(differs == 0, shorter).otherwise(F.least(differs - 1, shorter)).cast("int")


def _before(context: Column) -> Column:
    return F.reverse(F.slice(context["words"], F.lit(1), context["before"]))


def _after(context: Column, gram: int) -> Column:
    return F.slice(context["words"], context["before"] + gram + 1, F.lit(1 << 20))


def _always(value: Column) -> Column:
    return value.isNotNull()


def item_windows(benchmark: DataFrame, gram: int, span: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of long items, and short items as one window each."""
    items = benchmark.select("item_id", words_of().alias("words")).filter("size(words) > 0")
    long = items.filter(F.size("words") >= span).select(
        "item_id", F.explode(_fingerprints(F.col("words"), gram, span, _always)).alias("f")
    )
    short = items.filter(F.size("words") < span).select(
        "item_id", F.xxhash64("words").alias("hash"), F.col("words").alias("window")
    )
    return (
        written(long.select("item_id", "f.*").withColumn("has", F.lit(True)), "long_items"),
        written(short, "short_items"),
    )


def contamination_spans(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM, bits: int = BITS
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row, n_words) of every row, and (doc_id, row, item_id, start, stop) of all equal
    runs; ``row`` is the text's key."""
    long, short = item_windows(benchmark, gram, span)
    sizes = [r[0] for r in short.select(F.size("window")).distinct().collect()]  # below span
    text = docs.select(
        "doc_id",
        text_key().alias("row"),
        words_of().alias("words"),
        bitmap(long.select("hash"), bits).alias("long_bits"),
        bitmap(short.select("hash"), bits).alias("short_bits"),
    )
    found = text.select(
        "doc_id",
        "row",
        F.size("words").cast("bigint").alias("n_words"),
        _fingerprints(F.col("words"), gram, span, passes(F.col("long_bits"), bits)).alias("long"),
        _short_windows(
            F.col("words"), sorted(sizes), passes(F.col("short_bits"), bits)
        ).alias("short"),
    )
    found = written(found, "doc_fingerprints")
    theirs = long.select("item_id", "hash", F.col("context").alias("item_context"))
    pairs = found.select("doc_id", "row", F.explode("long").alias("f"))
    pairs = pairs.select("doc_id", "row", "f.*").join(theirs, "hash")
    grown = pairs.select(
        "doc_id", "row", "item_id", "at",
        _equal_run(_before(F.col("context")), _before(F.col("item_context"))).alias("left"),
        # The gram itself is compared too: hashes may collide.
        _equal_run(_after(F.col("context"), 0), _after(F.col("item_context"), 0)).alias("right"),
    )
    long_runs = grown.filter((F.col("left") + F.col("right") >= span) & (F.col("right") >= gram)).select(
        "doc_id", "row", "item_id",
        (F.col("at") - F.col("left")).alias("start"), (F.col("at") + F.col("right")).alias("stop"),
    )
    short_hits = found.select("doc_id", "row", F.explode("short").alias("f"))
    short_hits = short_hits.select("doc_id", "row", "f.*")
    short_runs = short_hits.join(short, ["hash", "window"]).select(
        "doc_id", "row", "item_id",
        F.col("at").alias("start"), (F.col("at") + F.size("window")).alias("stop"),
    )
    return found.select("doc_id", "row", "n_words"), long_runs.union(short_runs)


def covered(spans: Column) -> Column:
    """Words inside the union of sorted array<struct<start, stop>>."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        spans,
        zero,
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["stop"]).alias("end"),
            (acc["n"] + F.greatest(s["stop"] - F.greatest(s["start"], acc["end"]), F.lit(0))).alias("n"),
        ),
        lambda acc: acc["n"],
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM, bits: int = BITS
) -> DataFrame:
    """doc_id, row (the text's key), n_words, n_hit, items (sorted as strings), spans of every
    row of ``docs``."""
    rows, runs = contamination_spans(docs, benchmark, span, gram, bits)
    # Sets combine within tasks first: a passage shared by many documents, or many items, is
    # spread over its documents here.
    hits = runs.groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).agg(
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"),
        F.array_sort(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("")))).alias("items"),
    )
    same_row = rows["doc_id"].eqNullSafe(hits["__id"]) & (rows["row"] == hits["__row"])
    return rows.join(hits, same_row, "left").select(
        "doc_id", "row", "n_words",
        F.coalesce(covered(F.col("spans")), F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        "spans",
    )


def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    """At least a twentieth of the words, and one."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * 20 >= F.col(n_words))


def clean_of(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns unchanged."""
    bad = contamination(docs, benchmark).filter(is_contaminated()).select("doc_id", "row")
    return without(docs, [F.col("doc_id"), text_key()], written(bad, "contaminated"))

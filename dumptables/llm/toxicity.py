"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Learnt from labelled documents of the training folds only, at most ``SAMPLE`` of them, chosen
and split by hashes of doc_id: one part gives the lexicon (words and word beginnings that stand
out in toxic documents), one the trees, one the calibration. Features of a text: densities of
lexicon words, of lexicon beginnings and of both after undoing look-alike signs, lexicon words
close to second-person words, capitals, exclamation and other punctuation, repeated letters,
words that mix letters with digits or signs, and length. Every text is scored whole; labels,
language, source and doc_id are no inputs.

Nulls and edges: a null text is empty; empty texts get the calibrated score of their features
like any other. Without labels of both kinds in the training folds every score is the base rate
(0 without labels). Rows that share a doc_id are scored one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumptables.llm.common import written
from dumptables.llm.passages import rows_of

SAMPLE = 24_000
FOLDS, HELD_OUT = 3, 1
TERMS = 3_000  # words, and as many beginnings
TREES, DEPTH = 30, 4
THRESHOLD = 0.7
NEAR = 5
FEATURES = (
    "words_hit", "starts_hit", "plain_hit", "near_you", "any_hit", "capitals", "exclaims", "signs",
    "stretched", "mixed", "length",
)
# Second-person words of the four languages of the corpus.
YOU = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split()
)
_WORD = re.compile(r"\S+")
_EDGE = ".,;:!?\"'()[]{}|*-_"
_ALIKE = str.maketrans("0134578@$!", "oieastbasi")
_STRETCHED = re.compile(r"(.)\1\1")
_PART = 1 << 20


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == HELD_OUT


def terms_of(word: str) -> tuple[str, ...]:
    """A word and its beginnings, as the lexicon holds them."""
    return (word, "^" + word[:4], "^" + word[:5])


def features(text: str, words: frozenset[str], starts: frozenset[str]) -> list[float]:
    n = hit = start = plain = near = mixed = stretched = 0
    last_you = last_hit = -NEAR - 1
    for match in _WORD.finditer(text):
        raw = match.group()
        word = raw.lower().strip(_EDGE)
        n += 1
        if word in YOU:
            last_you = n
            near += n - last_hit <= NEAR
        if not word.isalpha():
            clear = raw.lower().strip(".,;:?\"'()[]{}|-_").translate(_ALIKE)
            clear = "".join(c for c in clear if c.isalpha())
            inner = word and any(c.isalpha() for c in word)
            mixed += bool(inner)
            if inner and (clear in words or clear[:5] in starts):
                plain += 1
        if word in words:
            hit += 1
            last_hit = n
            near += n - last_you <= NEAR
        if word[:4] in starts or word[:5] in starts:
            start += 1
        stretched += len(word) > 3 and _STRETCHED.search(word) is not None
    size, count = max(len(text), 1), max(n, 1)
    capitals = sum(map(str.isupper, text)) if not text.islower() else 0
    signs = len(text) - sum(map(str.isalnum, text)) - sum(map(str.isspace, text))
    return [
        hit / count, start / count, plain / count, near / count, float(np.log1p(hit + start + plain)),
        capitals / size, text.count("!") / size, signs / size, stretched / count, mixed / count,
        float(np.log1p(n)),
    ]


def featured(docs: DataFrame, lexicon: tuple[frozenset[str], frozenset[str]], *keep: str) -> DataFrame:
    """``keep`` and the features of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # at most 2 * TERMS entries
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, starts = shared.value
        for batch in rows_of(batches):
            found = np.array(
                [
                    features((t.as_py() or b"").decode(errors="replace"), words, starts)
                    for t in batch.column(len(keep))
                ]
            ).reshape(-1, len(FEATURES))
            columns = [pa.array(found[:, k]) for k in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], *columns], [*keep, *FEATURES]
            )

    rows = docs.select(*keep, F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(make, f"{kinds}, " + ", ".join(f"{f} double" for f in FEATURES))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """doc_id, text, toxic, part (0 lexicon, 1 trees, 2 calibration) of training documents."""
    known = labels.filter(~held_out() & F.col("toxic").isin(0, 1))
    some = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    slot = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(20))
    part = F.when(slot < 9, 0).when(slot < 16, 1).otherwise(2)
    some = some.select(F.col("doc_id").alias("__id"), "toxic", part.alias("part"))
    plain = docs.select("doc_id", "text")
    joined = plain.join(F.broadcast(some), F.col("doc_id") == F.col("__id"))
    return joined.select("doc_id", "text", "toxic", "part")


def learn_lexicon(sample: DataFrame, most: int = TERMS) -> tuple[frozenset[str], frozenset[str]]:
    """Terms that far more toxic than other documents have."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            terms, toxic = [], []
            for text, label in zip(*batch.columns, strict=True):
                body = (text.as_py() or b"").decode(errors="replace")
                own = {
                    term
                    for m in _WORD.finditer(body)
                    for term in terms_of(m.group().lower().strip(_EDGE))
                }
                terms += own
                toxic += [label.as_py()] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array(toxic, pa.int32())], ["term", "toxic"]
            )

    texts = sample.select(F.col("text").cast("binary").alias("text"), "toxic")
    seen = texts.mapInArrow(make, "term string, toxic int").groupBy("term").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")
    )
    bad, good = texts.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    seen = seen.filter("bad >= 4").withColumn("odds", odds).filter("odds > 2.0")
    strength = (F.col("odds") * F.sqrt("bad")).desc()
    words = seen.filter("NOT startswith(term, '^') AND length(term) > 2").orderBy(strength, "term").limit(most)
    starts = seen.filter("startswith(term, '^') AND length(term) > 4").orderBy(strength, "term").limit(most)
    return (
        frozenset(r.term for r in words.collect()),
        frozenset(r.term[1:] for r in starts.collect()),
    )


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    held = F.coalesce(held_out(), F.lit(False)).alias("held_out")
    sample = written(labelled_sample(docs, labels), "sample")
    counts = {(r.part, r.toxic): r.n for r in sample.groupBy("part", "toxic").agg(F.count("*").alias("n")).collect()}
    if any(not counts.get((part, toxic)) for part in range(3) for toxic in range(2)):
        known = sum(counts.values())
        rate = sum(n for (_, toxic), n in counts.items() if toxic) / known if known else 0.0
        return docs.select("doc_id", held, F.lit(float(rate)).alias("score")).withColumn(
            "predicted", (F.col("score") >= THRESHOLD).cast("int")
        )
    lexicon = learn_lexicon(sample.filter("part = 0"))
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    fit = written(featured(sample.filter("part > 0"), lexicon, "toxic", "part").coalesce(4), "fit")
    trees = GBTClassifier(
        labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=42, maxBins=64
    ).fit(assemble.transform(fit.filter("part = 1")).select("features", "toxic"))

    def margin(rows: DataFrame) -> DataFrame:
        scored = trees.transform(assemble.transform(rows))
        return scored.withColumn("margin", vector_to_array("probability")[1])

    calibration = margin(fit.filter("part = 2")).select("margin", F.col("toxic").cast("double").alias("label"))
    curve = IsotonicRegression(featuresCol="margin").fit(calibration)
    scored = curve.transform(margin(featured(docs, lexicon, "doc_id")).select("doc_id", "margin"))
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction")))
    return scored.select("doc_id", held, bounded.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )

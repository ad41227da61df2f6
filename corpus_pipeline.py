"""A training corpus from ``documents``: quality, exact copies, near copies, benchmarks, tokens.

Each stage takes all that the one before kept, its decisions take effect, and all but the last
return the columns of ``documents``. A stage's result is written and read again as the next
one's input, so a lost executor never costs more than tasks of one stage. All stages define
nulls, ties and empty input as their operators do: a null text counts as an empty one, and rows
with a null doc_id are kept by the near-copy stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumptables.llm import decontaminate, exact_dedup, importance, pieces, simhash
from dumptables.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling selects."""
    return importance.selected_of(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one of smallest doc_id."""
    return exact_dedup.exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by SimHash (three-word shingles, two bits at most) the smallest doc_id."""
    return simhash.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of a benchmark item."""
    return decontaminate.clean_of(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digest of the text that the ids decode to."""
    return pieces.round_trip(docs).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("text", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("benchmark decontamination", benchmark),
    ("SentencePiece", tokens),
]

# Sampling by hashed models, SimHash and Viterbi are beyond SQL; tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs

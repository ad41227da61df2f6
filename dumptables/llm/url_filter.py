"""URL rules by a sort-merge range join over reversed hosts.

A host written label by label from the right, each label closed by a mark, makes a rule's host
and all its subdomains one interval of keys: everything that starts with the rule's key. The
boundaries of all rules cut the key space into segments; a sweep over the sorted boundaries
gives each segment the stack of rules that are open in it, nested ones included. URLs are
sorted among the segment starts, and each takes the last segment before it.

The sweep over URLs needs no order between far rows, so URLs are dealt evenly over ``slices``
(any number gives the same result) and each slice is sorted with all segments: no host, however
frequent, meets in one task. Segments are at most twice the rules, times ``slices``.

Nulls and ties: a null url, or one without ``://``, has empty host and path and no rule. Among
fitting rules the longest (host and path together) wins, then the longer host; two rules with
the same host and path: the block wins. No rules: every url gets the default verdict.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dumptables.llm.common import LOWER, UPPER

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_MARK, _AFTER = "\x01", "\x02"


def split_urls(pages: DataFrame) -> DataFrame:
    """page_id, host, path of every url."""
    url = F.coalesce("url", F.lit(""))
    return pages.select(
        "page_id",
        F.translate(F.regexp_extract(url, _URL, 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(url, _URL, 2).alias("path"),
    )


def _key(host):
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), _MARK), F.lit(_MARK))


def segments(rules: DataFrame) -> DataFrame:
    """(key, stack): from ``key`` on, up to the next, the rules in ``stack`` are open.

    Intervals nest, so the rules open at a boundary are those whose own key is one of its
    prefixes of whole labels: the stack is looked up by these, a few for each boundary.
    """
    ranges = rules.filter("host IS NOT NULL").select(
        _key(F.col("host")).alias("low"),
        F.struct("host", F.coalesce("path", F.lit("")).alias("path"), "verdict").alias("rule"),
    )
    close = F.expr(f"concat(substr(low, 1, length(low) - 1), '{_AFTER}')")
    bounds = ranges.select(F.col("low").alias("key")).union(ranges.select(close)).distinct()
    labels = F.split("key", _MARK)
    outer = F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda i: F.concat(F.array_join(F.slice(labels, F.lit(1), i), _MARK), F.lit(_MARK)),
    )
    chain = bounds.filter(F.size(labels) > 1).select("key", F.explode(outer).alias("low"))
    stacks = chain.join(ranges, "low").groupBy("key").agg(F.collect_list("rule").alias("stack"))
    none = F.array().cast("array<struct<host: string, path: string, verdict: string>>")
    return bounds.join(stacks, "key", "left").select(
        "key", F.coalesce("stack", none).alias("stack")
    )


def judge(
    pages: DataFrame, rules: DataFrame, default: str = "allow", slices: int = 0
) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages``.

    ``rules`` has host, path, verdict.
    """
    spark = pages.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    urls = split_urls(pages)
    none = F.lit(None)
    marks = segments(rules).select(
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
        "key", F.lit(0).alias("kind"), "stack",
        none.cast(pages.schema["page_id"].dataType).alias("page_id"),
        none.cast("string").alias("host"), none.cast("string").alias("path"),
    )
    points = urls.select(
        F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(slices)).cast("int").alias("slice"),
        _key(F.col("host")).alias("key"), F.lit(1).alias("kind"),
        none.cast(marks.schema["stack"].dataType).alias("stack"),
        "page_id", "host", "path",
    )
    sweep = Window.partitionBy("slice").orderBy("key", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    swept = points.unionByName(marks).withColumn("open", F.last("stack", True).over(sweep))
    fits = F.filter(
        F.col("open"),
        lambda r: F.startswith(F.col("path"), r["path"])
        & ((F.col("host") == r["host"]) | F.endswith(F.col("host"), F.concat(F.lit("."), r["host"]))),
    )
    ranked = F.transform(
        fits,
        lambda r: F.struct(
            (F.length(r["host"]) + F.length(r["path"])).alias("size"),
            F.length(r["host"]).alias("host_size"),
            r["verdict"].alias("verdict"),
            F.concat(r["host"], r["path"]).alias("rule"),
        ),
    )
    best = swept.filter("kind = 1").withColumn("best", F.array_max(ranked))
    return best.select(
        "page_id", "host", "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )

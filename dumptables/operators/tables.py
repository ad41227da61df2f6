"""The five tables as typed rows.

Every builder returns all rows it found: the table's columns, where the row stood
(:data:`POSITION`), ``raw`` for the reject list, and ``reason``, NULL for a valid row.
:func:`valid` and :func:`rejected` take the two sides apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumptables.functions import strict_short
from dumptables.operators.files import PLACE, scan_part
from dumptables.operators.rules import (
    CONTRIBUTOR_RULES,
    NAMESPACE_RULES,
    PAGE_RULES,
    REVISION_RULES,
    Rule,
    first_reason,
)
from dumptables.schemas import POSITION, REJECTS, TABLES


def valid(rows: DataFrame, table: str) -> DataFrame:
    """Rows fit for the table, in its columns."""
    return rows.filter("reason IS NULL").select(TABLES[table].columns)


def rejected(rows: DataFrame, table: str) -> DataFrame:
    """Rows set aside, in the columns of the reject list."""
    return (
        rows.filter("reason IS NOT NULL")
        .withColumn("table", F.lit(table))
        .select(REJECTS.fieldNames())
    )


# Rules that were tried when the piece was parsed.
NAMED_FAULTS: list[Rule] = [(name, f"fault = '{name}'") for name, _ in REVISION_RULES]
NO_DBNAME: Rule = ("no_dbname", "dbname IS NULL")
MALFORMED: Rule = ("malformed_xml", "malformed")
# The row's source is the unfinished end of an incomplete file.
CUT_OFF: Rule = ("truncated", "NOT complete AND struct(block_start, row_id, seg) = end")
# The row is the last page of an incomplete file.
CUT_PAGE: Rule = ("truncated", "NOT complete AND page_seq = page_starts")


def _stamp(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Give each row its place and its file's wiki name and end. ``marks`` has a row for each split;
    the caller says how it comes to the rows."""
    known = [c for c in ("file_path", "block_start", "file_no") if c in rows.columns]
    return rows.drop(*known).join(marks, ["scan_part", "split_key"], "left")


def _as_json(*names: str) -> str:
    return f"to_json(struct({', '.join(f'`{name}`' for name in names)}))"


def siteinfo_rows(files: DataFrame) -> DataFrame:
    return files.select(
        "file_path",
        "end.*",
        *TABLES["siteinfo"].columns,
        F.col("siteinfo").alias("raw"),
        first_reason(NO_DBNAME).alias("reason"),
    )


def namespace_rows(files: DataFrame) -> DataFrame:
    """One row per namespace; ``seg`` is its place in the header."""
    found = files.selectExpr(
        "file_path",
        "end.block_start",
        "end.row_id",
        "dbname",
        "posexplode(namespaces) AS (seg, namespace)",
    ).selectExpr(
        *POSITION,
        "dbname",
        "namespace._key AS raw_key",
        "namespace._case AS `case`",
        "nullif(namespace._VALUE, '') AS name",
    )
    return found.select(
        *POSITION,
        strict_short("raw_key").alias("key"),
        "dbname",
        "case",
        "name",
        F.expr(_as_json("raw_key", "dbname", "case", "name")).alias("raw"),
        first_reason(NO_DBNAME, *NAMESPACE_RULES).alias("reason"),
    )


def contributor_rows(stage: DataFrame, marks: DataFrame) -> DataFrame:
    """One row per named or numbered author of a revision; addresses and hidden authors have neither."""
    authors = stage.filter("size(authors) > 0").select(
        "scan_part", "split_key", "row_id", "seg", F.posexplode("authors").alias("nth", "author")
    )
    authors = authors.select(
        "scan_part", "split_key", "row_id", "seg", "nth", F.col("author.id").alias("contributor_id"),
        F.col("author.username").alias("username"), F.col("author.number").alias("id"),
    )
    return _stamp(authors, marks).select(
        "scan_part",
        *POSITION,
        "nth",
        F.expr(PLACE).alias("place"),
        "id",
        "dbname",
        "username",
        F.expr(_as_json("contributor_id", "dbname", "username")).alias("raw"),
        first_reason(CUT_OFF, NO_DBNAME, *CONTRIBUTOR_RULES).alias("reason"),
    )


def revision_rows(stage: DataFrame, marks: DataFrame) -> DataFrame:
    fields = _as_json(
        "id", "dbname", "parentid", "timestamp", "comment", "model", "format",
        "bytes", "sha1", "contributor_id",
    )
    rows = _stamp(stage.filter("has_revision"), marks).withColumnRenamed("revision_id", "id")
    return rows.select(
        "scan_part",
        *POSITION,
        *TABLES["revision"].columns,
        F.expr(f"coalesce(raw, {fields})").alias("raw"),
        first_reason(CUT_OFF, MALFORMED, NO_DBNAME, *NAMED_FAULTS).alias("reason"),
    )


def page_rows(pages: DataFrame, marks: DataFrame, zero_defaults: bool = False) -> DataFrame:
    """Typed pages from assembled ones.

    zero_defaults: store 0 instead of NULL for a missing namespace or current revision.
    """
    ns, revision_id = F.col("ns"), F.col("revision_id")
    if zero_defaults:
        zero = F.lit(0).cast("smallint")
        ns, revision_id = F.coalesce(ns, zero), F.coalesce(revision_id, zero)
    fields = _as_json("page_id", "dbname", "ns", "title", "redirect", "revision_id")
    pages = pages.withColumn("scan_part", scan_part())
    return _stamp(pages, marks).select(
        "scan_part",
        *POSITION,
        F.col("page_id").alias("id"),
        "dbname",
        ns.alias("ns"),
        "title",
        "redirect",
        revision_id.alias("revision_id"),
        F.expr(f"coalesce(raw, {fields})").alias("raw"),
        first_reason(CUT_PAGE, MALFORMED, NO_DBNAME, *PAGE_RULES).alias("reason"),
    )

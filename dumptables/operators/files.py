"""One row per dump file: its header, where it ends, its pages, and the splits it was read in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumptables.schemas import SITEINFO_XML, XML_OPTIONS

# Bits of a place that tell rows of one split apart; the others number 16 million splits.
PLACE_BITS = 39


def scan_part() -> Column:
    """The scan task that read a row: the upper bits of its ``row_id``."""
    return F.shiftright("row_id", 33).cast("int")


# Document order within all files as one number, for rows with the marks of their split.
PLACE = f"(shiftleft(split, {PLACE_BITS}) + (row_id - first_row))"


# A split as one number. Within a scan task no two may share it, see :func:`check_keys`.
SPLIT_KEY = "xxhash64(file_path, block_start)"


class SplitKeyClash(ValueError):
    """Two splits of one scan task have the same key (one chance in 2**64 for each pair)."""


def check_keys(marks: DataFrame) -> DataFrame:
    """The marks, if no two splits share a key within their scan task."""
    if not marks.groupBy("scan_part", "split_key").count().filter("count > 1").isEmpty():
        raise SplitKeyClash("two splits have one key: read the files with another split size")
    return marks


def file_marks(files: DataFrame) -> DataFrame:
    """What rows need to know of their file and split, once for each split. ``file_no`` is the number
    of the file's first split."""
    return files.selectExpr(
        "file_path", "dbname", "complete", "end", "page_starts", "splits[0].split AS file_no", "inline(splits)"
    ).selectExpr("*", f"{SPLIT_KEY} AS split_key")


# Per-split facts. All of them are numbers, and rows of a split lie in one bucket of the stage:
# hashed where they lie, nothing is sorted or moved.
SPLITS = """
    SELECT scan_part, file_path, block_start, min(row_id) AS first_row, max(row_id) AS row_id,
           max_by(seg, row_id) AS seg, max_by(may_end_file, row_id) AS ends,
           sum(CAST(starts_page AS BIGINT)) AS starts
    FROM {stage} GROUP BY scan_part, file_path, block_start
"""

# Splits are numbered in document order (files by path) by a running sum over one narrow row per
# file.
FILES = f"""
    WITH found AS (
        SELECT file_path, max_by(ends, block_start) AS complete,
               max(struct(block_start, row_id, seg)) AS end, sum(starts) AS page_starts,
               sort_array(collect_list(struct(block_start, scan_part, first_row, earlier, nth)))
                   AS splits
        FROM (SELECT *, coalesce(sum(starts) OVER (
                            PARTITION BY file_path ORDER BY block_start
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier,
                     row_number() OVER (PARTITION BY file_path ORDER BY block_start) AS nth
              FROM ({SPLITS}))
        GROUP BY file_path
    ),
    headers AS (
        SELECT file_path, min_by(siteinfo, struct(block_start, row_id)) AS siteinfo
        FROM {{stage}} WHERE siteinfo IS NOT NULL GROUP BY file_path
    ),
    numbers AS (
        SELECT file_path, coalesce(sum(size(splits)) OVER (
                   ORDER BY file_path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                   AS splits_before
        FROM found
    )
    SELECT file_path, complete, end, page_starts, siteinfo,
           transform(splits, s -> struct(
               s.block_start AS block_start, s.scan_part AS scan_part, s.first_row AS first_row,
               s.earlier AS earlier, splits_before + s.nth - 1 AS split)) AS splits
    FROM found LEFT JOIN headers USING (file_path) JOIN numbers USING (file_path)
"""


# The same facts of splits, and headers, as single rows.
PIECES = f"""
    SELECT *, CAST(NULL AS STRING) AS siteinfo, {SPLIT_KEY} AS split_key FROM ({SPLITS})
    UNION ALL
    SELECT scan_part, file_path, block_start, row_id, row_id, seg, false, 0, siteinfo, 0
    FROM {{stage}} WHERE siteinfo IS NOT NULL
"""


def few_files(stage: DataFrame) -> DataFrame:
    """The facts of :func:`dump_files` for a stage of few splits: these come to the driver, which
    puts them together by file and holds the result."""
    spark = stage.sparkSession
    splits: dict[str, list] = {}
    headers: dict[str, tuple] = {}
    keys: list[tuple] = []
    for row in spark.sql(PIECES, stage=stage).collect():
        if row.siteinfo is None:
            splits.setdefault(row.file_path, []).append(row)
            keys.append((row.scan_part, row.split_key))
        else:
            here = (row.block_start, row.row_id, row.siteinfo)
            headers[row.file_path] = min(headers.get(row.file_path, here), here)
    if len(set(keys)) < len(keys):
        raise SplitKeyClash("two splits have one key: read the files with another split size")
    facts, number = [], 0
    for path in sorted(splits, key=str.encode):
        own, begun, listed = sorted(splits[path], key=lambda r: r.block_start), 0, []
        for row in own:
            listed.append((row.block_start, row.scan_part, row.first_row, begun, number))
            begun, number = begun + row.starts, number + 1
        last = own[-1]
        end = (last.block_start, last.row_id, last.seg)
        facts.append((path, last.ends, end, begun, headers.get(path, (None,))[-1], listed))
    found = spark.createDataFrame(
        facts,
        "file_path STRING, complete BOOLEAN, end STRUCT<block_start: BIGINT, row_id: BIGINT, "
        "seg: INT>, page_starts BIGINT, siteinfo STRING, splits ARRAY<STRUCT<block_start: BIGINT, "
        "scan_part: INT, first_row: BIGINT, earlier: BIGINT, split: BIGINT>>",
    )
    return _with_header(found)


def dump_files(stage: DataFrame) -> DataFrame:
    """Per-file facts of a stage.

    The first header of a file names the wiki of all its rows. ``complete`` is false when
    the file stops before its closing tag; then ``end`` points at the piece that was cut.
    ``splits`` lists, for each split of the file, its scan task, its number among all splits,
    its first row, and the pages begun ``earlier`` in the file.
    """
    return _with_header(stage.sparkSession.sql(FILES, stage=stage))


def _with_header(found: DataFrame) -> DataFrame:
    header = F.from_xml("siteinfo", SITEINFO_XML, XML_OPTIONS).alias("header")
    filled = lambda name: f"try_element_at(array_remove(header.{name}, ''), -1) AS `{name}`"
    return (
        found.select("*", header)
        .selectExpr(
            "file_path", "complete", "end", "page_starts", "siteinfo", "splits",
            "CASE WHEN header._corrupt IS NULL THEN header END AS header",
        )
        .selectExpr(
            "file_path", "complete", "end", "page_starts", "siteinfo",
            *[filled(name) for name in ("dbname", "sitename", "base", "generator", "case")],
            "header.namespaces.namespace AS namespaces",
            "splits",
        )
    )

"""Putting pages together again from their segments.

A page may span any number of records, splits and tasks, so its rows meet in an
aggregation on the page's running number within its file. That aggregation is hashed, with
partial results in every task: it holds numbers only, among them the rows at which the page's
texts stand. Titles and the source of faulty pages are then fetched from these rows, which
stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from dumptables.functions import number_sql
from dumptables.operators.files import PLACE

# A running count of page starts per split (bounded by ``spark.sql.files.maxPartitionBytes``),
# taken in the bucket of the stage that the split lies in, plus the pages started in earlier
# splits of the file.
NUMBERED = f"""
    SELECT m.file_no, s.split_key, s.row_id, s.seg, s.malformed,
           s.has_id, s.page_id, s.has_ns, s.ns, s.has_revision_id, s.revision_id,
           s.has_title, s.has_redirect, s.has_raw,
           m.earlier + s.nth AS page_seq, {PLACE} AS place
    FROM (
        SELECT scan_part, split_key, row_id, seg, malformed,
               page_id IS NOT NULL AS has_id, {number_sql('page_id', 'BIGINT')} AS page_id,
               ns IS NOT NULL AS has_ns, {number_sql('ns', 'SMALLINT')} AS ns,
               coalesce(revision_id IS NOT NULL OR fault = 'bad_id', false) AS has_revision_id,
               revision_id,
               title IS NOT NULL AS has_title, redirect IS NOT NULL AS has_redirect,
               raw IS NOT NULL AS has_raw,
               sum(CAST(starts_page AS BIGINT)) OVER (
                   PARTITION BY scan_part, split_key ORDER BY row_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nth
        FROM {{stage}}
        WHERE starts_page OR has_revision OR page_id IS NOT NULL OR ns IS NOT NULL
              OR title IS NOT NULL OR redirect IS NOT NULL OR malformed
    ) s JOIN {{marks}} m USING (scan_part, split_key)
"""

# The current revision is the last one in document order that has an id, not the one with the
# highest id or latest time. ``has_id``, ``has_ns`` and ``has_revision_id`` tell a missing value
# from one that is no number.
PAGES = f"""
    SELECT file_no, page_seq,
           min_by(row_id, place) AS row_id, min_by(split_key, place) AS split_key,
           min_by(seg, place) AS seg, max(malformed) AS malformed,
           max(has_id) AS has_id, max_by(page_id, IF(has_id, place, NULL)) AS page_id,
           max(has_ns) AS has_ns, max_by(ns, IF(has_ns, place, NULL)) AS ns,
           max(has_revision_id) AS has_revision_id,
           max_by(revision_id, IF(has_revision_id, place, NULL)) AS revision_id,
           max_by(row_id, IF(has_title, place, NULL)) AS title_row,
           max_by(row_id, IF(has_redirect, place, NULL)) AS redirect_row,
           min_by(row_id, IF(has_raw, place, NULL)) AS raw_row
    FROM ({NUMBERED}) WHERE page_seq > 0 GROUP BY file_no, page_seq
"""

# A page's title and redirect nearly always stand in one row. What stands elsewhere, as all
# sources of faulty pages do, is looked up apart, for the few pages that need it.
ASSEMBLED = f"""
    WITH page AS ({PAGES}),
    asked AS (
        SELECT file_no, page_seq, at.redirects, at.row_id,
               CAST(shiftright(at.row_id, 33) AS INT) AS scan_part
        FROM (SELECT file_no, page_seq, explode(array(
                         struct(true AS redirects,
                                IF(redirect_row <> title_row, redirect_row, NULL) AS row_id),
                         struct(false AS redirects, raw_row AS row_id))) AS at
              FROM page WHERE redirect_row <> title_row OR raw_row IS NOT NULL)
        WHERE at.row_id IS NOT NULL
    ),
    apart AS (
        SELECT asked.file_no, page_seq, max(IF(redirects, redirect, NULL)) AS redirect,
               max(IF(redirects, NULL, raw)) AS raw
        FROM asked JOIN {{stage}} USING (scan_part, row_id)
        WHERE raw IS NOT NULL OR redirect IS NOT NULL
        GROUP BY asked.file_no, page_seq
    ),
    head AS (
        SELECT scan_part, row_id, title, redirect FROM {{stage}}
        WHERE title IS NOT NULL OR redirect IS NOT NULL
    ),
    placed AS (
        SELECT *, coalesce(title_row, redirect_row) AS head_row,
               CAST(shiftright(coalesce(title_row, redirect_row), 33) AS INT) AS head_part
        FROM page
    )
    SELECT /*+ SHUFFLE_HASH(h) */
           p.file_no, p.split_key, p.row_id, p.seg, p.page_seq, p.has_id, p.page_id,
           p.has_ns, p.ns, h.title,
           CASE WHEN redirect_row IS NULL THEN NULL WHEN redirect_row <> title_row THEN a.redirect
                ELSE h.redirect END AS redirect,
           p.has_revision_id, p.revision_id, p.malformed, a.raw
    FROM placed p LEFT JOIN head h ON h.scan_part = p.head_part AND h.row_id = p.head_row
    LEFT JOIN apart a ON a.file_no = p.file_no AND a.page_seq = p.page_seq
"""

# The same where no piece is at fault and all titles and redirects stand where pages begin.
TIDY = f"""
    SELECT /*+ SHUFFLE_HASH(h) */
           p.file_no, p.split_key, p.row_id, p.seg, p.page_seq, p.has_id, p.page_id,
           p.has_ns, p.ns, h.title, h.redirect, p.has_revision_id, p.revision_id, p.malformed,
           CAST(NULL AS STRING) AS raw
    FROM (SELECT *, CAST(shiftright(row_id, 33) AS INT) AS head_part FROM ({PAGES})) p
    LEFT JOIN (SELECT scan_part, row_id, title, redirect FROM {{stage}} WHERE starts_page) h
    ON h.scan_part = p.head_part AND h.row_id = p.row_id
"""


def assemble_pages(stage: DataFrame, marks: DataFrame, tidy: bool = False) -> DataFrame:
    """One row per page: head values and the id of its current revision. ``marks`` tell of the
    splits. ``tidy``: no piece is at fault and no title stands elsewhere than at its page's start,
    so there is nothing to look up apart."""
    return stage.sparkSession.sql(TIDY if tidy else ASSEMBLED, stage=stage, marks=marks)

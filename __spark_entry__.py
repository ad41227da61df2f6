"""Entry points: a flagship query, all queries, and the SQL each is checked against.

The dumps the queries read are rendered from the given tables by Spark, whole, once per
session (see ``fixtures``).
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from functools import lru_cache

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from dumptables import (  # noqa: E402
    TABLES,
    CatalogSink,
    LoadOptions,
    ParquetSink,
    load_dump,
    load_in_turns,
    verify_tables,
)
from dumptables import operators as op  # noqa: E402
from dumptables.schemas import POSITION, ForeignKey  # noqa: E402
from dumptables.session import work_folder  # noqa: E402
from fixtures.render import PAGES_PER_FILE, TURNS  # noqa: E402
from fixtures.shared import EVERY_FOLDER, dump, loaded, staged  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from dumptables.llm import queries as text_queries  # noqa: E402
except ImportError:  # a copy without the text operators
    corpus_pipeline = text_queries = None

SMALL = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Pages of a full-history dump with their current revision."""
    return page_current_revision(spark, SMALL)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- the five tables, straight from the stage -----------------------------------------


def _first_authors(spark, sf_dir, name: str) -> DataFrame:
    """Contributors with the name that their first revision gives."""
    found, key = staged(spark, sf_dir, name), TABLES["contributor"].key
    rows = found.rows("contributor").filter("reason IS NULL")
    first = op.first_places(rows, key, None)
    columns = [*TABLES["contributor"].columns, "scan_part", "row_id", "nth"]
    return op.first_writers(rows.select(*columns), first, key).select(*TABLES["contributor"].columns)


def _first_rows(rows: DataFrame, name: str) -> DataFrame:
    spec = TABLES[name]
    kept = rows.filter("reason IS NULL").select(*spec.columns, *POSITION)
    return op.keep_first(kept, spec.key, POSITION).select(*spec.columns)


def siteinfo(spark, sf_dir):
    return _first_rows(staged(spark, sf_dir, "documents").rows("siteinfo"), "siteinfo")


def namespaces(spark, sf_dir):
    return _first_rows(staged(spark, sf_dir, "documents").rows("namespaces"), "namespaces")


def page(spark, sf_dir):
    return op.valid(staged(spark, sf_dir, "documents").rows("page"), "page")


def revision(spark, sf_dir):
    return op.valid(staged(spark, sf_dir, "documents").rows("revision"), "revision")


def contributor_first_writer(spark, sf_dir):
    return _first_authors(spark, sf_dir, "documents")


def multistream_page(spark, sf_dir):
    """Pages of files that consist of many bz2 streams and are read in many splits each."""
    return op.valid(staged(spark, sf_dir, "multistream").rows("page"), "page")


def multistream_revision(spark, sf_dir):
    return op.valid(staged(spark, sf_dir, "multistream").rows("revision"), "revision")


def multistream_load(spark, sf_dir):
    """The same files loaded whole: every page with the author and length of its current revision."""
    tables = loaded(spark, sf_dir, "multistream")[0]
    current = tables.read("revision").select(
        F.col("id").alias("revision_id"), "dbname", "bytes", "contributor_id"
    )
    pages = tables.read("page").select("id", "dbname", "title", "revision_id")
    authors = tables.read("contributor").select(
        F.col("id").alias("contributor_id"), "dbname", "username"
    )
    return (
        pages.join(current, ["revision_id", "dbname"])
        .join(authors, ["contributor_id", "dbname"], "left")
        .select("id", "dbname", "title", "revision_id", "bytes", "contributor_id", "username")
    )


def page_current_revision(spark, sf_dir):
    pages = op.valid(staged(spark, sf_dir, "conversations").rows("page"), "page")
    return pages.select("id", "dbname", "ns", "title", "revision_id")


def revision_history(spark, sf_dir):
    rows = op.valid(staged(spark, sf_dir, "conversations").rows("revision"), "revision")
    return rows.select("id", "dbname", "text", "bytes", "contributor_id")


def contributor_history(spark, sf_dir):
    return _first_authors(spark, sf_dir, "conversations")


def order_page(spark, sf_dir):
    """Many short revisions in one wiki."""
    pages = op.valid(staged(spark, sf_dir, "orders").rows("page"), "page")
    return pages.select("id", "dbname", "title", "revision_id")


def order_contributor(spark, sf_dir):
    return _first_authors(spark, sf_dir, "orders")


def page_zero_defaults(spark, sf_dir):
    rows = staged(spark, sf_dir, "documents").rows("page", zero_defaults=True)
    return op.valid(rows, "page").select("id", "dbname", "ns", "revision_id")


# --- counts ---------------------------------------------------------------------------


def pages_per_file(spark, sf_dir):
    counts = op.pages_per_file(staged(spark, sf_dir, "documents").files)
    place = lambda group: F.regexp_extract("file_path", "wiki=([^/]+)/part=([0-9]+)/", group)
    return counts.select(
        place(1).alias("dbname"), place(2).cast("bigint").alias("part"), "pages"
    )


def load_totals(spark, sf_dir):
    return op.load_totals(staged(spark, sf_dir, "documents").files)


# --- whole loads ----------------------------------------------------------------------


def _row_counts(tables) -> DataFrame:
    counts = [
        tables.read(name).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name in TABLES
    ]
    total = counts[0]
    for more in counts[1:]:
        total = total.unionByName(more)
    return total


def load_counts(spark, sf_dir):
    return _row_counts(loaded(spark, sf_dir, "documents")[0])


def load_again(spark, sf_dir):
    """Documents, then documents and conversations together: only the latter are new."""
    work = work_folder(spark)
    sink = ParquetSink(spark, f"{work}/tables")
    first, second = dump(spark, sf_dir, "documents"), dump(spark, sf_dir, "conversations")
    load_dump(spark, first, sink, work=f"{work}/1", source=EVERY_FOLDER)
    load_dump(spark, [first, second], sink, work=f"{work}/2", source=EVERY_FOLDER)
    return _row_counts(sink)


def order_revision(spark, sf_dir):
    """A load in which many revision ids occur twice or more."""
    rows = loaded(spark, sf_dir, "orders")[0].read("revision")
    return rows.select("id", "dbname", "text", "bytes", "contributor_id")


def order_rejects(spark, sf_dir):
    found = loaded(spark, sf_dir, "orders")[1].rejects.filter("table <> 'namespaces'")
    return found.groupBy(F.col("table").alias("table_name"), "reason").agg(
        F.count("*").alias("n")
    )


def rejects(spark, sf_dir):
    found = loaded(spark, sf_dir, "faulty")[1].rejects
    return found.groupBy(F.col("table").alias("table_name"), "reason").agg(
        F.count("*").alias("n")
    )


def faulty_page(spark, sf_dir):
    return loaded(spark, sf_dir, "faulty")[0].read("page")


def faulty_revision(spark, sf_dir):
    return loaded(spark, sf_dir, "faulty")[0].read("revision")


def faulty_pages_per_wiki(spark, sf_dir):
    report = loaded(spark, sf_dir, "faulty")[1]
    wiki = F.regexp_extract("file_path", "wiki=([^/]+)/", 1).alias("wiki")
    return report.pages_per_file.groupBy(wiki).agg(F.sum("pages").alias("pages"))


def verify(spark, sf_dir):
    """Key checks over tables that were loaded without any."""
    work = work_folder(spark)
    sink = ParquetSink(spark, f"{work}/tables")
    load_dump(
        spark, dump(spark, sf_dir, "faulty"), sink, work=f"{work}/work", source=EVERY_FOLDER,
        options=LoadOptions(foreign_keys=False),
    )
    return verify_tables(sink.read).withColumnRenamed("table", "table_name").withColumnRenamed(
        "check", "check_name"
    )


def _unique_database() -> str:
    return f"wiki_{uuid.uuid4().hex}"


def lookup_layout(spark, sf_dir):
    """Tables bucketed and sorted for lookups; every page with its revision's author."""
    sink = CatalogSink(spark, _unique_database(), buckets=8, location=f"{work_folder(spark)}/db")
    load_dump(
        spark, dump(spark, sf_dir, "documents"), sink,
        work=work_folder(spark), source=EVERY_FOLDER,
    )
    authors = sink.read("revision").select(
        F.col("id").alias("revision_id"), "dbname", "contributor_id"
    )
    return (
        sink.read("page")
        .join(authors, ["revision_id", "dbname"])
        .select("title", "dbname", "redirect", "contributor_id")
    )


@lru_cache(maxsize=None)
def _lookup_tables(spark, sf_dir) -> CatalogSink:
    """The documents loaded into tables bucketed and sorted for lookups."""
    sink = CatalogSink(spark, _unique_database(), buckets=8, location=f"{work_folder(spark)}/db")
    load_dump(
        spark, dump(spark, sf_dir, "documents"), sink,
        work=work_folder(spark), source=EVERY_FOLDER,
    )
    return sink


def lookup_by_title(spark, sf_dir):
    """The page each redirect of the corpus leads to, in its own wiki. Pages are bucketed by
    title, so only the titles looked up are moved."""
    pages = _lookup_tables(spark, sf_dir).read("page")
    wanted = pages.filter("redirect IS NOT NULL").select(
        F.col("redirect").alias("title"), F.col("dbname").alias("from_wiki")
    )
    return op.look_up(pages, wanted, "title").select("title", "from_wiki", "dbname", "id", "revision_id")


def lookup_by_username(spark, sf_dir):
    """Ids of the authors named after a document."""
    authors = _lookup_tables(spark, sf_dir).read("contributor")
    wanted = _table(spark, sf_dir, "documents").select(
        F.concat(F.lit("u"), F.col("doc_id").cast("string")).alias("username")
    )
    return op.look_up(authors, wanted, "username").select("username", "dbname", "id")


def added_columns(spark, sf_dir):
    """A load into a catalog whose page table lacks columns."""
    database, place = _unique_database(), f"{work_folder(spark)}/db"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{place}'")
    old = "id BIGINT, dbname STRING, ns SMALLINT, title STRING"
    spark.createDataFrame([], old).write.option("path", f"{place}/page").saveAsTable(
        f"{database}.page"
    )
    sink = CatalogSink(spark, database, location=place)
    load_dump(
        spark, dump(spark, sf_dir, "documents"), sink,
        work=work_folder(spark), source=EVERY_FOLDER,
    )
    return sink.read("page")


# --- turns ----------------------------------------------------------------------------


def _load_in_turns(spark, sf_dir) -> tuple[ParquetSink, DataFrame]:
    work = work_folder(spark)
    sink = ParquetSink(spark, f"{work}/tables")
    progress = load_in_turns(
        spark, dump(spark, sf_dir, "documents"), sink,
        work=f"{work}/work", files_per_turn=3, source=EVERY_FOLDER,
    )
    return sink, progress


def stream_page(spark, sf_dir):
    return _load_in_turns(spark, sf_dir)[0].read("page")


def stream_progress(spark, sf_dir):
    progress = _load_in_turns(spark, sf_dir)[1]
    return progress.select("batch_id", "files", "total_files").unionByName(
        progress.agg(
            F.lit(-1).cast("bigint").alias("batch_id"),
            F.max("total_pages").alias("files"),
            F.max("total_files").alias("total_files"),
        )
    )


# --- key operators on tables of other shapes ------------------------------------------


def insert_absent(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return op.insert_absent(docs, _table(spark, sf_dir, "labels"), ["doc_id"])


def duplicate_keys(spark, sf_dir):
    return op.duplicate_keys(_table(spark, sf_dir, "events").select("user_id"), ["user_id"])


def keep_first(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    return op.keep_first(events, ["user_id", "event_type"], ["ts", "event_id"])


LABEL_FK = ForeignKey(("doc_id",), "labels", ("doc_id",))
PART_FK = ForeignKey(("l_suppkey", "l_linenumber"), "supplier", ("s_suppkey", "s_nationkey"))


def _label_references(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = _table(spark, sf_dir, "labels")
    return docs, op.fk_missing_keys(docs, labels, LABEL_FK)


def fk_violations(spark, sf_dir):
    docs, missing = _label_references(spark, sf_dir)
    return op.fk_violations(docs, missing, LABEL_FK)


def fk_accepted(spark, sf_dir):
    docs, missing = _label_references(spark, sf_dir)
    return op.fk_accepted(docs, missing, LABEL_FK)


def fk_missing_keys(spark, sf_dir):
    """Composite keys, used many times each."""
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.col("l_linenumber").cast("int").alias("l_linenumber")
    )
    suppliers = _table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_nationkey").cast("int").alias("s_nationkey")
    )
    return op.fk_missing_keys(lines, suppliers, PART_FK)


def fk_page_namespaces(spark, sf_dir):
    """Namespace references of loose pages; a page without namespace refers to nothing."""
    found = staged(spark, sf_dir, "faulty")
    pages = op.valid(found.rows("page"), "page")
    spaces = op.valid(found.rows("namespaces"), "namespaces")
    fk = TABLES["page"].foreign_keys[0]
    missing = op.fk_missing_keys(pages, spaces, fk)
    return op.fk_violations(pages, missing, fk).select("id", "dbname", "ns")


QUERIES = (
    siteinfo, namespaces, page, revision, contributor_first_writer,
    multistream_page, multistream_revision, multistream_load,
    page_current_revision, revision_history, contributor_history, page_zero_defaults,
    order_page, order_contributor, order_revision, order_rejects,
    pages_per_file, load_totals,
    load_counts, load_again, rejects, faulty_page, faulty_revision, faulty_pages_per_wiki,
    verify,
    lookup_layout, lookup_by_title, lookup_by_username, added_columns,
    stream_page, stream_progress,
    insert_absent, duplicate_keys, keep_first,
    fk_violations, fk_accepted, fk_missing_keys, fk_page_namespaces,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {query.__name__: query for query in QUERIES}
    if text_queries is not None:
        found |= text_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


# --- the same in SQL on the given tables ----------------------------------------------

_REVISION = """
    SELECT doc_id + 1000000 AS id, lang || 'wiki' AS dbname,
           CASE WHEN doc_id % 4 <> 0 THEN doc_id + 999999 END AS parentid,
           TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL 1 SECOND AS "timestamp",
           CASE WHEN doc_id % 5 <> 0 THEN 'c & d ' || doc_id END AS comment,
           'wikitext' AS model, 'text/x-wiki' AS format, text,
           CAST(strlen(text) AS BIGINT) AS bytes, md5(text) AS sha1,
           CASE WHEN doc_id % 5 > 1 THEN doc_id % 37 END AS contributor_id
    FROM documents
"""

_PAGE = """
    SELECT doc_id AS id, lang || 'wiki' AS dbname,
           CASE WHEN doc_id % 13 = 0 THEN NULL
                ELSE CAST(CASE doc_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 4 END AS SMALLINT)
           END AS ns,
           'Doc ' || doc_id AS title,
           CASE WHEN doc_id % 10 = 0 THEN 'Doc ' || (doc_id + 1) END AS redirect,
           doc_id + 1000000 AS revision_id
    FROM documents
"""

_AUTHORS = "documents WHERE doc_id % 5 > 1"

_LOAD_COUNTS = f"""
    SELECT 'siteinfo' AS table_name, count(DISTINCT lang) AS n FROM documents
    UNION ALL SELECT 'namespaces', 4 * count(DISTINCT lang) FROM documents
    UNION ALL SELECT 'contributor', count(*) FROM (SELECT DISTINCT lang, doc_id % 37 FROM {_AUTHORS})
    UNION ALL SELECT 'revision', count(*) FROM documents
    UNION ALL SELECT 'page', count(*) FROM documents
"""

_CONVERSATION_COUNTS = """
    SELECT 'siteinfo' AS table_name, 1 AS n
    UNION ALL SELECT 'namespaces', 4
    UNION ALL SELECT 'contributor', count(DISTINCT role) FROM conversations WHERE role <> 'system'
    UNION ALL SELECT 'revision', count(*) FROM conversations
    UNION ALL SELECT 'page', count(DISTINCT conv_id) FROM conversations
"""

_FILES = f"(SELECT DISTINCT lang, doc_id // {PAGES_PER_FILE} AS part FROM documents)"


def oracle_sql() -> dict[str, str]:
    found = dict(SQL)
    if text_queries is not None:
        found |= text_queries.SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


SQL = {
    "siteinfo": """
        SELECT DISTINCT lang || 'wiki' AS dbname, 'Wiki ' || lang AS sitename,
               'https://' || lang || '.example/wiki/Main' AS base,
               'fixture 1' AS generator, 'first-letter' AS "case"
        FROM documents
    """,
    "namespaces": """
        SELECT CAST(k AS SMALLINT) AS "key", dbname, 'first-letter' AS "case", name
        FROM (SELECT DISTINCT lang || 'wiki' AS dbname FROM documents),
             (VALUES (-2, 'Media'), (0, NULL), (1, 'Talk'), (4, 'Project')) AS s(k, name)
    """,
    "page": _PAGE,
    "revision": _REVISION,
    "contributor_first_writer": f"""
        SELECT doc_id % 37 AS id, lang || 'wiki' AS dbname, 'u' || min(doc_id) AS username
        FROM {_AUTHORS} GROUP BY 1, 2
    """,
    "multistream_page": _PAGE,
    "multistream_revision": _REVISION,
    "multistream_load": f"""
        SELECT r.id - 1000000 AS id, dbname, 'Doc ' || (r.id - 1000000) AS title,
               r.id AS revision_id, bytes, contributor_id, username
        FROM ({_REVISION}) r LEFT JOIN (
            SELECT doc_id % 37 AS contributor_id, lang || 'wiki' AS dbname,
                   'u' || min(doc_id) AS username
            FROM {_AUTHORS} GROUP BY 1, 2) USING (contributor_id, dbname)
    """,
    "page_current_revision": f"""
        SELECT conv_id AS id, 'convwiki' AS dbname, CAST(0 AS SMALLINT) AS ns,
               'Conv ' || conv_id AS title, conv_id * {TURNS} + min(turn) + 1 AS revision_id
        FROM conversations GROUP BY conv_id
    """,
    "revision_history": f"""
        SELECT conv_id * {TURNS} + turn + 1 AS id, 'convwiki' AS dbname, text,
               CAST(strlen(text) AS BIGINT) AS bytes,
               CAST(CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 END AS BIGINT)
                   AS contributor_id
        FROM conversations
    """,
    "contributor_history": """
        SELECT DISTINCT CAST(CASE role WHEN 'user' THEN 1 ELSE 2 END AS BIGINT) AS id,
               'convwiki' AS dbname, role AS username
        FROM conversations WHERE role <> 'system'
    """,
    "order_page": """
        SELECT l_orderkey AS id, 'orderwiki' AS dbname, 'Order ' || l_orderkey AS title,
               l_orderkey * 10 + min(l_linenumber) AS revision_id
        FROM lineitem GROUP BY l_orderkey
    """,
    "order_contributor": """
        SELECT DISTINCT l_suppkey AS id, 'orderwiki' AS dbname, 's' || l_suppkey AS username
        FROM lineitem
    """,
    "order_revision": """
        SELECT l_orderkey * 10 + l_linenumber AS id, 'orderwiki' AS dbname, text,
               CAST(strlen(text) AS BIGINT) AS bytes, l_suppkey AS contributor_id
        FROM (SELECT *, 'part ' || l_partkey || ' quantity ' || CAST(l_quantity AS BIGINT) AS text
              FROM lineitem)
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_partkey, l_suppkey, l_quantity) = 1
    """,
    "order_rejects": """
        SELECT 'revision' AS table_name, 'duplicate_key' AS reason,
               count(*) - count(DISTINCT l_orderkey * 10 + l_linenumber) AS n
        FROM lineitem
    """,
    "page_zero_defaults": f"""
        SELECT id, dbname, CAST(coalesce(ns, 0) AS SMALLINT) AS ns, revision_id
        FROM ({_PAGE})
    """,
    "pages_per_file": f"""
        SELECT lang || 'wiki' AS dbname, doc_id // {PAGES_PER_FILE} AS part, count(*) AS pages
        FROM documents GROUP BY 1, 2
    """,
    "load_totals": f"""
        SELECT count(*) AS pages, (SELECT count(*) FROM {_FILES}) AS files FROM documents
    """,
    "load_counts": _LOAD_COUNTS,
    "load_again": f"""
        SELECT table_name, CAST(sum(n) AS BIGINT) AS n
        FROM ({_LOAD_COUNTS} UNION ALL {_CONVERSATION_COUNTS}) GROUP BY table_name
    """,
    "rejects": f"""
        WITH doc AS (SELECT lang, doc_id % 16 AS kind FROM documents),
        known AS (SELECT kind FROM doc WHERE lang <> 'fr'),
        file AS (SELECT lang FROM {_FILES}),
        found AS (
            SELECT 'page' AS table_name,
                   CASE kind WHEN 3 THEN 'bad_ns' WHEN 4 THEN 'bad_id' WHEN 5 THEN 'no_id'
                        WHEN 6 THEN 'fk_revision' WHEN 7 THEN 'malformed_xml'
                        ELSE 'fk_namespaces' END AS reason
            FROM known WHERE kind IN (3, 4, 5, 6, 7, 14)
            UNION ALL
            SELECT 'revision', CASE kind WHEN 6 THEN 'bad_timestamp' WHEN 7 THEN 'malformed_xml'
                                    ELSE 'no_id' END
            FROM known WHERE kind IN (6, 7, 10)
            UNION ALL
            SELECT 'page', CASE kind WHEN 7 THEN 'malformed_xml' ELSE 'no_dbname' END
            FROM doc WHERE lang = 'fr'
            UNION ALL
            SELECT 'revision', CASE kind WHEN 7 THEN 'malformed_xml' ELSE 'no_dbname' END
            FROM doc WHERE lang = 'fr' AND kind <> 13
            UNION ALL
            SELECT 'revision', 'no_dbname' FROM doc WHERE lang = 'fr' AND kind = 10
            UNION ALL
            SELECT 'contributor', 'no_dbname' FROM doc
            WHERE lang = 'fr' AND kind NOT IN (7, 13)
            UNION ALL
            SELECT t, 'truncated' FROM file, (VALUES ('page'), ('revision')) AS v(t)
            WHERE lang = 'es'
            UNION ALL SELECT 'siteinfo', 'no_dbname' FROM file WHERE lang = 'fr'
            UNION ALL
            SELECT 'namespaces', 'no_dbname' FROM file, range(5) WHERE lang = 'fr'
            UNION ALL SELECT 'namespaces', 'no_key' FROM file WHERE lang <> 'fr'
        )
        SELECT table_name, reason, count(*) AS n FROM found GROUP BY 1, 2
    """,
    "faulty_page": """
        SELECT doc_id AS id, lang || 'wiki' AS dbname, CAST(0 AS SMALLINT) AS ns,
               CASE WHEN doc_id % 16 <> 0 THEN 'Doc ' || doc_id END AS title,
               CAST(NULL AS VARCHAR) AS redirect,
               CASE WHEN doc_id % 16 <> 13 THEN doc_id + 1000000 END AS revision_id
        FROM documents
        WHERE lang <> 'fr' AND doc_id % 16 NOT IN (3, 4, 5, 6, 7, 14)
    """,
    "faulty_revision": """
        SELECT doc_id + 1000000 AS id, lang || 'wiki' AS dbname,
               CAST(NULL AS BIGINT) AS parentid,
               TIMESTAMP '2024-01-01 00:00:00' AS "timestamp",
               CASE WHEN doc_id % 16 <> 0 THEN 'c' END AS comment,
               'wikitext' AS model, 'text/x-wiki' AS format,
               CASE doc_id % 16 WHEN 1 THEN NULL WHEN 15 THEN ' '
                    WHEN 8 THEN 'a </page> b </revision> ' || text ELSE text END AS text,
               CAST(CASE doc_id % 16 WHEN 1 THEN 3 WHEN 15 THEN 1 ELSE strlen(text) END
                    AS BIGINT) AS bytes,
               CAST(NULL AS VARCHAR) AS sha1,
               CASE doc_id % 16 WHEN 2 THEN doc_id + 1000 ELSE doc_id % 37 END
                   AS contributor_id
        FROM documents WHERE lang <> 'fr' AND doc_id % 16 NOT IN (6, 7, 13)
    """,
    "faulty_pages_per_wiki": """
        SELECT lang || 'wiki' AS wiki, count(*) AS pages FROM documents GROUP BY 1
    """,
    "verify": """
        WITH broken AS (
            SELECT 'page' AS table_name,
                   CASE doc_id % 16 WHEN 14 THEN 'fk_namespaces' ELSE 'fk_revision' END
                       AS check_name,
                   CASE doc_id % 16 WHEN 14 THEN 0 ELSE doc_id END AS id, lang
            FROM documents WHERE lang <> 'fr' AND doc_id % 16 IN (6, 14)
        ),
        checks(table_name, check_name) AS (
            VALUES ('siteinfo', 'primary_key'), ('namespaces', 'primary_key'),
                   ('namespaces', 'fk_siteinfo'), ('contributor', 'primary_key'),
                   ('contributor', 'fk_siteinfo'), ('revision', 'primary_key'),
                   ('revision', 'fk_contributor'), ('revision', 'fk_siteinfo'),
                   ('page', 'primary_key'), ('page', 'fk_namespaces'),
                   ('page', 'fk_revision'), ('page', 'fk_siteinfo')
        )
        SELECT table_name, check_name, count(DISTINCT lang || id) AS broken_keys,
               count(lang) AS "rows"
        FROM checks LEFT JOIN broken USING (table_name, check_name) GROUP BY 1, 2
    """,
    "lookup_layout": """
        SELECT 'Doc ' || doc_id AS title, lang || 'wiki' AS dbname,
               CASE WHEN doc_id % 10 = 0 THEN 'Doc ' || (doc_id + 1) END AS redirect,
               CASE WHEN doc_id % 5 > 1 THEN doc_id % 37 END AS contributor_id
        FROM documents
    """,
    "lookup_by_title": """
        SELECT 'Doc ' || p.doc_id AS title, d.lang || 'wiki' AS from_wiki,
               p.lang || 'wiki' AS dbname, p.doc_id AS id, p.doc_id + 1000000 AS revision_id
        FROM documents d JOIN documents p ON p.doc_id = d.doc_id + 1
        WHERE d.doc_id % 10 = 0
    """,
    "lookup_by_username": """
        SELECT 'u' || doc_id AS username, lang || 'wiki' AS dbname, doc_id % 37 AS id
        FROM documents WHERE doc_id % 5 > 1
        QUALIFY row_number() OVER (PARTITION BY doc_id % 37, lang ORDER BY doc_id) = 1
    """,
    "added_columns": _PAGE,
    "stream_page": _PAGE,
    "stream_progress": f"""
        WITH total AS (SELECT count(*) AS files FROM {_FILES})
        SELECT i AS batch_id, least(3, files - 3 * i) AS files,
               least(files, 3 * (i + 1)) AS total_files
        FROM total, range(CAST((SELECT files FROM total) AS BIGINT)) AS r(i) WHERE 3 * i < files
        UNION ALL
        SELECT -1, (SELECT count(*) FROM documents), files FROM total
    """,
    "insert_absent": """
        SELECT doc_id, lang, source FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """,
    "duplicate_keys": """
        SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 1
    """,
    "keep_first": """
        SELECT user_id, event_type, ts, event_id FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1
    """,
    "fk_violations": """
        SELECT doc_id, lang FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
    """,
    "fk_accepted": """
        SELECT doc_id, lang FROM documents d
        WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
    """,
    "fk_missing_keys": """
        SELECT l_suppkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, count(*) AS n
        FROM lineitem
        WHERE NOT EXISTS (SELECT 1 FROM supplier
                          WHERE s_suppkey = l_suppkey AND s_nationkey = l_linenumber)
        GROUP BY 1, 2
    """,
    "fk_page_namespaces": """
        SELECT doc_id AS id, lang || 'wiki' AS dbname, CAST(99 AS SMALLINT) AS ns
        FROM documents WHERE lang <> 'fr' AND doc_id % 16 = 14
    """,
}

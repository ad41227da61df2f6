"""Fixed schemas: the five target tables, their keys, and the raw XML shapes.

Column names, types, keys and foreign keys are fixed values; everything else in
the package derives from them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]

    @property
    def reason(self) -> str:
        return "fk_" + self.parent


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    key: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    lookup: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_TO_SITE = ForeignKey(("dbname",), "siteinfo", ("dbname",))

SITEINFO = TableSpec(
    "siteinfo",
    _schema(
        ("dbname", T.StringType()),
        ("sitename", T.StringType()),
        ("base", T.StringType()),
        ("generator", T.StringType()),
        ("case", T.StringType()),
    ),
    key=("dbname",),
    lookup=("sitename", "dbname", "base"),
)

NAMESPACES = TableSpec(
    "namespaces",
    _schema(
        ("key", T.ShortType()),
        ("dbname", T.StringType()),
        ("case", T.StringType()),
        ("name", T.StringType()),
    ),
    key=("key", "dbname"),
    foreign_keys=(_TO_SITE,),
    lookup=("name",),
)

PAGE = TableSpec(
    "page",
    _schema(
        ("id", T.LongType()),
        ("dbname", T.StringType()),
        ("ns", T.ShortType()),
        ("title", T.StringType()),
        ("redirect", T.StringType()),
        ("revision_id", T.LongType()),
    ),
    key=("id", "dbname"),
    foreign_keys=(
        ForeignKey(("ns", "dbname"), "namespaces", ("key", "dbname")),
        ForeignKey(("revision_id", "dbname"), "revision", ("id", "dbname")),
        _TO_SITE,
    ),
    lookup=("title", "redirect"),
)

REVISION = TableSpec(
    "revision",
    _schema(
        ("id", T.LongType()),
        ("dbname", T.StringType()),
        ("parentid", T.LongType()),
        ("timestamp", T.TimestampNTZType()),
        ("comment", T.StringType()),
        ("model", T.StringType()),
        ("format", T.StringType()),
        ("text", T.StringType()),
        ("bytes", T.LongType()),
        ("sha1", T.StringType()),
        ("contributor_id", T.LongType()),
    ),
    key=("id", "dbname"),
    foreign_keys=(
        ForeignKey(("contributor_id", "dbname"), "contributor", ("id", "dbname")),
        _TO_SITE,
    ),
    lookup=("id", "parentid"),
)

CONTRIBUTOR = TableSpec(
    "contributor",
    _schema(
        ("id", T.LongType()),
        ("dbname", T.StringType()),
        ("username", T.StringType()),
    ),
    key=("id", "dbname"),
    foreign_keys=(_TO_SITE,),
    lookup=("username",),
)

# Parents precede children, so a table's foreign keys can be checked when its turn comes.
LOAD_ORDER = (SITEINFO, NAMESPACES, CONTRIBUTOR, REVISION, PAGE)
TABLES = {spec.name: spec for spec in LOAD_ORDER}

# Where a row stood in its dump: document order within one file, files by path.
POSITION = ("file_path", "block_start", "row_id", "seg")

REJECTS = _schema(
    ("table", T.StringType()),
    ("reason", T.StringType()),
    ("file_path", T.StringType()),
    ("block_start", T.LongType()),
    ("row_id", T.LongType()),
    ("seg", T.IntegerType()),
    ("raw", T.StringType()),
)

# --- raw XML shapes -------------------------------------------------------------
# Leaves stay strings, so that a bad number rejects one row by name instead of
# leaving it half filled. Tags are arrays because a repeated tag counts by its last
# non-empty value, field by field where it has several. Tags not listed here are never materialised.

XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "ignoreSurroundingSpaces": "false",
    "columnNameOfCorruptRecord": "_corrupt",
}

PAGE_XML = """
    id ARRAY<STRING>, ns ARRAY<STRING>, title ARRAY<STRING>,
    redirect ARRAY<STRUCT<_title: STRING>>,
    revision STRUCT<
        id: ARRAY<STRING>, parentid: ARRAY<STRING>, timestamp: ARRAY<STRING>,
        comment: ARRAY<STRING>, model: ARRAY<STRING>, format: ARRAY<STRING>,
        sha1: ARRAY<STRING>, text: ARRAY<STRUCT<_VALUE: STRING, _bytes: STRING>>,
        content: ARRAY<STRUCT<
            model: STRING, format: STRING,
            text: STRUCT<_VALUE: STRING, _bytes: STRING>>>,
        contributor: ARRAY<STRUCT<id: ARRAY<STRING>, username: ARRAY<STRING>>>>,
    _corrupt STRING
"""

SITEINFO_XML = """
    sitename ARRAY<STRING>, dbname ARRAY<STRING>, base ARRAY<STRING>,
    generator ARRAY<STRING>, case ARRAY<STRING>,
    namespaces STRUCT<namespace: ARRAY<STRUCT<_key: STRING, _case: STRING, _VALUE: STRING>>>,
    _corrupt STRING
"""

# One row per piece of a dump: a page head with its first revision, a further
# revision, or a page end. Values of the page as found in the XML, those of the revision typed;
# ``fault`` names the first rule that a revision breaks.
# ``scan_part`` is the scan task that read the piece; the stage is bucketed by it. ``split_key`` is
# short for file and block, so that rows meet what is known of their split by numbers.
SEGMENTS = _schema(
    ("scan_part", T.IntegerType()),
    ("file_path", T.StringType()),
    ("block_start", T.LongType()),
    ("split_key", T.LongType()),
    ("row_id", T.LongType()),
    ("seg", T.IntegerType()),
    ("starts_page", T.BooleanType()),
    ("has_revision", T.BooleanType()),
    ("may_end_file", T.BooleanType()),
    ("siteinfo", T.StringType()),
    ("malformed", T.BooleanType()),
    ("fault", T.StringType()),
    ("raw", T.StringType()),
    ("page_id", T.StringType()),
    ("ns", T.StringType()),
    ("title", T.StringType()),
    ("redirect", T.StringType()),
    ("revision_id", T.LongType()),
    ("parentid", T.LongType()),
    ("timestamp", T.TimestampNTZType()),
    ("comment", T.StringType()),
    ("model", T.StringType()),
    ("format", T.StringType()),
    ("text", T.StringType()),
    ("bytes", T.LongType()),
    ("sha1", T.StringType()),
    ("contributor_id", T.LongType()),
    (
        "authors",
        T.ArrayType(
            _schema(("id", T.StringType()), ("username", T.StringType()), ("number", T.LongType()))
        ),
    ),
)

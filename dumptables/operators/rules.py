"""The value rules a row must pass, by reject reason, in the order they are tried.

Conditions are SQL over the text columns of a segment or page.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dumptables.functions import number_sql

Rule = tuple[str, str]


def _unread(name: str, converted: str) -> str:
    """A value is there but cannot be converted."""
    return f"{name} IS NOT NULL AND {converted} IS NULL"


def _no_long(name: str) -> str:
    return _unread(name, number_sql(name, "BIGINT"))


def _no_short(name: str) -> str:
    return _unread(name, number_sql(name, "SMALLINT"))


PAGE_VALUE_RULES: list[Rule] = [
    ("bad_id", _no_long("page_id")),
    ("bad_ns", _no_short("ns")),
]

# Pages put together hold numbers, and whether there was anything to make one of.
PAGE_RULES: list[Rule] = [
    ("no_id", "NOT has_id"),
    ("bad_id", "page_id IS NULL"),
    ("bad_ns", "has_ns AND ns IS NULL"),
    ("bad_revision_id", "has_revision_id AND revision_id IS NULL"),
]

# ``<column>_read`` is what the text of a column was converted to.
REVISION_RULES: list[Rule] = [
    ("no_id", "revision_id IS NULL"),
    ("bad_id", _unread("revision_id", "revision_id_read")),
    ("bad_parentid", _unread("parentid", "parentid_read")),
    ("bad_timestamp", _unread("timestamp", "timestamp_read")),
    ("bad_bytes", _unread("bytes", "bytes_read")),
    ("bad_contributor_id", _unread("contributor_id", "contributor_id_read")),
]

CONTRIBUTOR_RULES: list[Rule] = [
    ("no_id", "contributor_id IS NULL"),
    ("bad_id", "id IS NULL"),
]

NAMESPACE_RULES: list[Rule] = [
    ("no_key", "raw_key IS NULL"),
    ("bad_key", _no_short("raw_key")),
]


def first_reason(*rules: Rule) -> Column:
    """Name of the first rule whose condition holds, else NULL."""
    cases = " ".join(f"WHEN {condition} THEN '{name}'" for name, condition in rules)
    return F.expr(f"CASE {cases} END")


def any_broken(rules: list[Rule]) -> str:
    """SQL condition: at least one rule is broken."""
    return "(" + " OR ".join(f"({condition})" for _, condition in rules) + ")"

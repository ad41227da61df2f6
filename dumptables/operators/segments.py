"""From raw records to segments: cut, close, parse and flatten the XML of one piece."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dumptables.functions import instant_seconds, last_filled, number_sql, strict_long
from dumptables.operators.files import SPLIT_KEY, scan_part
from dumptables.operators.rules import PAGE_VALUE_RULES, REVISION_RULES, any_broken, first_reason
from dumptables.schemas import PAGE_XML, SEGMENTS, XML_OPTIONS
from dumptables.session import TASK_BYTES, TASKS_PER_CORE, settings

# The tags a dump is cut at.
PAGE_END = "</page>"
FILE_END = "</mediawiki>"
PAGE_START = "<page[ \\t\\r\\n>]"

MOST_BUCKETS = 100_000  # what Spark allows unless told otherwise


def cut(records: DataFrame) -> DataFrame:
    """Split each record at its page ends into segments of one revision or less.

    ``row_id`` numbers the segments straight on the scan, so within one file and block it
    follows document order. The last segment of a record ran up to the end of a revision; the
    others ran up to the end of a page.
    """
    parts = (
        records.withColumn("parts", F.split("value", PAGE_END))
        .select(
            "file_path",
            "block_start",
            F.expr(SPLIT_KEY).alias("split_key"),
            F.size("parts").alias("n_parts"),
            F.posexplode_outer("parts").alias("seg", "body"),
        )
        .withColumn("row_id", F.monotonically_increasing_id())
        .withColumn("scan_part", scan_part())
    )
    last = F.col("seg") == F.col("n_parts") - 1
    flagged = parts.withColumn("last", last).selectExpr(
        "scan_part",
        "file_path",
        "block_start",
        "split_key",
        "row_id",
        "seg",
        "body",
        "last",
        f"contains(body, '<page') AND body RLIKE '{PAGE_START}' AS starts_page",
        "contains(body, '<revision') AS has_revision",
        "NOT body RLIKE '[^ \\t\\r\\n]' AS blank",
        f"""last AND (contains(body, '{FILE_END}')
                      OR (n_parts > 1 AND NOT body RLIKE '[^ \\t\\r\\n]')) AS may_end_file""",
    )
    # The last segment is always kept: it tells whether the file was complete.
    return flagged.filter("last OR starts_page OR NOT blank")


def _xml() -> Column:
    """The segment as one well-formed ``<page>``, or NULL when it holds no part of a page."""
    start = F.when(
        F.col("starts_page"),
        F.regexp_extract("body", f"(?s){PAGE_START}.*", 0),
    ).otherwise(F.concat(F.lit("<page>"), F.col("body")))
    end = F.when(F.col("last"), F.lit("</revision></page>")).otherwise(F.lit(PAGE_END))
    holds_page = F.col("starts_page") | F.col("has_revision") | ~F.col("last")
    return F.when(holds_page, F.concat(start, end))


def _filled(values: str) -> str:
    """Last value of an array that is neither missing nor empty."""
    return f"try_element_at(array_remove(array_compact({values}), ''), -1)"


# Body of <text>; the parser drops a body of blanks only, so that is read by pattern.
FLAT_TEXT = rf"""coalesce(
    {_filled('page.revision.text._VALUE')},
    CASE WHEN page.revision.text IS NOT NULL
         THEN nullif(regexp_extract(xml, r'<text\b[^<>]*>(\s+)</text>', 1), '') END)"""

# Every author named in the revision, each with its own last filled values.
AUTHORS = f"""transform(filter(
    transform(page.revision.contributor,
              c -> struct({_filled('c.id')} AS id, {_filled('c.username')} AS username)),
    c -> c.id IS NOT NULL OR c.username IS NOT NULL),
    c -> struct(c.id AS id, c.username AS username, {number_sql('c.id', 'BIGINT')} AS number))"""

# --- plain pieces ---------------------------------------------------------------------
# A piece that is nothing but the usual tags in the usual order, without attributes, comments, CDATA
# or characters that XML does not allow or changes, has its values read by one pattern; the XML
# parser, which takes several times as long, sees all others. A value begins with no blank, as the
# parser drops some values of blanks, and holds no carriage return, which it changes.
# Characters are listed one by one: that is a look into a table, where ranges are compared.
_LISTED = "".join(f"\\x{n:02X}" for n in range(0x21, 0x7F) if chr(n) not in "<>&\"")
_OTHER = r"[\xA0-\uD7FF\uE000-\uFFFC\x{10000}-\x{10FFFF}]"
_VALUE = rf"[{_LISTED}][{_LISTED} ]*"
_ESCAPED = rf"(?![\t\n ])(?:[{_LISTED}\"\t\n ]+|{_OTHER}+|&(?:amp|lt|gt|quot);)++"
_LINE = rf"[{_LISTED}](?:[{_LISTED} ]|{_OTHER}){{0,999}}+"
_GAP = r"[ \t\n]*+"
_SEPARATOR = "\x01"


def _leaf(tag: str, value: str = _VALUE) -> str:
    return f"<{tag}>({value})</{tag}>{_GAP}"


def _perhaps(pattern: str) -> str:
    return f"(?:{pattern})?+"


PLAIN = "".join(
    [
        rf"\A{_GAP}",
        _perhaps(
            f"<page>{_GAP}"
            + f"<title>({_ESCAPED})?+</title>{_GAP}"
            + _perhaps(_leaf("ns")) + _leaf("id")
            + _perhaps(f'<redirect title="({_LINE})" ?+/>{_GAP}')
        ),
        f"<revision>{_GAP}",
        _leaf("id") + _perhaps(_leaf("parentid")) + _perhaps(_leaf("timestamp")),
        _perhaps(
            f"<contributor>{_GAP}(?:<(ip)>{_VALUE}</ip>{_GAP}|"
            + f"{_leaf('username', _ESCAPED)}{_leaf('id')})</contributor>{_GAP}"
        ),
        _perhaps(f"<minor ?+/>{_GAP}"),
        _perhaps(f"<comment>({_ESCAPED})?+</comment>{_GAP}"),
        _perhaps(f"<origin>{_VALUE}</origin>{_GAP}"),
        _perhaps(_leaf("model") + _leaf("format")),
        _perhaps(
            f'<text(?: bytes="({_LINE})")?+(?: sha1="{_LINE}")?+(?: xml:space="preserve")?+>'
            + f"({_ESCAPED})</text>{_GAP}"
        ),
        _perhaps(_leaf("sha1")),
        r"\z",
    ]
)
# Its groups, in this order. ``address``: the author is one.
PLAIN_FIELDS = (
    "title", "ns", "page_id", "redirect", "revision_id", "parentid", "timestamp", "address",
    "username", "contributor_id", "comment", "model", "format", "bytes", "text", "sha1",
)


def with_fields(cuts: DataFrame) -> DataFrame:
    """Segments with the values of the plain ones among them in ``fields``, in the order of
    :data:`PLAIN_FIELDS` after an empty one; a missing value is empty. NULL for other segments."""
    ended = F.when(F.col("last") & F.col("has_revision"), F.col("body"))
    groups = "".join(f"{_SEPARATOR}${n}" for n in range(1, len(PLAIN_FIELDS) + 1))
    found = cuts.withColumn("found", F.regexp_replace(ended, F.lit(PLAIN), F.lit(groups)))
    # What is not plain stays as it was, with its tags.
    fields = F.when(~F.contains("found", F.lit("<")), F.split("found", _SEPARATOR))
    return found.withColumn("fields", fields).drop("found")


def _plain(name: str) -> str:
    """SQL: a value of a plain piece, NULL when missing or the piece is not plain."""
    value = f"nullif(fields[{PLAIN_FIELDS.index(name) + 1}], '')"
    if name not in ("title", "username", "comment", "text"):
        return value
    decoded = value
    for escaped, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        decoded = f"replace({decoded}, '{escaped}', '{char}')"
    return f"IF(contains({value}, '&'), {decoded}, {value})"


PLAIN_AUTHORS = f"""CASE
    WHEN {_plain('contributor_id')} IS NOT NULL THEN array(struct(
        {_plain('contributor_id')} AS id, {_plain('username')} AS username,
        {number_sql(_plain('contributor_id'), 'BIGINT')} AS number))
    WHEN {_plain('address')} IS NOT NULL THEN filter(array(struct(
        CAST(NULL AS STRING) AS id, CAST(NULL AS STRING) AS username,
        CAST(NULL AS BIGINT) AS number)), c -> false) END"""


def _either(name: str, parsed: Column | str) -> Column:
    """A value of a plain piece, or else the parsed one."""
    parsed = F.expr(parsed) if isinstance(parsed, str) else parsed
    return F.coalesce(F.expr(_plain(name)), parsed).alias(name)


def _tag(name: str) -> Column:
    return _either(name, last_filled(f"page.revision.{name}"))


def _wrapped(name: str, flat: str) -> str:
    """A value from the ``<content>`` wrapper of newer dumps, which follows the flat ones,
    or else the flat one."""
    return f"coalesce({_filled(f'page.revision.content.{name}')}, {flat})"


def parse(cuts: DataFrame) -> DataFrame:
    """Segments with every wanted tag as a flat column (:data:`SEGMENTS`).

    Values of a revision are converted and judged here, once for all uses. Pieces that are no XML are ``malformed``; no value is taken from them. Any piece at
    fault keeps its source in ``raw``, so the reject list never has to read the texts.
    """
    flags = [
        "scan_part", "file_path", "block_start", "split_key", "row_id", "seg", "starts_page", "has_revision",
        "may_end_file",
    ]
    parsed = (
        with_fields(cuts)
        .withColumn("xml", _xml())
        .withColumn("page", F.from_xml(F.expr("IF(fields IS NULL, xml, NULL)"), PAGE_XML, XML_OPTIONS))
    )
    checked = parsed.selectExpr(
        *flags,
        r"""CASE WHEN contains(body, '<siteinfo')
            THEN regexp_extract(body, r'(?s)<siteinfo[\s>].*?</siteinfo\s*>', 0) END AS siteinfo""",
        "page._corrupt IS NOT NULL AS malformed",
        "xml",
        "fields",
        "CASE WHEN page._corrupt IS NULL THEN page END AS page",
    )
    flat = checked.select(
        *flags,
        F.expr("nullif(siteinfo, '')").alias("siteinfo"),
        "malformed",
        "xml",
        _either("page_id", last_filled("page.id")),
        _either("ns", last_filled("page.ns")),
        _either("title", last_filled("page.title")),
        # An attribute counts when it is there; an empty one too.
        _either("redirect", "try_element_at(array_compact(page.redirect._title), -1)"),
        _either("revision_id", last_filled("page.revision.id")),
        _tag("parentid"),
        _tag("timestamp"),
        _tag("comment"),
        _either("model", _wrapped("model", "try_element_at(array_remove(page.revision.model, ''), -1)")),
        _either("format", _wrapped("format", "try_element_at(array_remove(page.revision.format, ''), -1)")),
        _either("text", _wrapped("text._VALUE", FLAT_TEXT)),
        _either("bytes", _wrapped("text._bytes", _filled("page.revision.text._bytes"))),
        _tag("sha1"),
        _either("contributor_id", _filled("flatten(array_compact(page.revision.contributor.id))")),
        F.expr(f"CASE WHEN fields IS NOT NULL THEN {PLAIN_AUTHORS} ELSE {AUTHORS} END").alias("authors"),
    )
    typed = {name: strict_long(name) for name in ("revision_id", "parentid", "bytes", "contributor_id")}
    typed["timestamp"] = instant_seconds("timestamp")
    read = flat.withColumns({f"{name}_read": value for name, value in typed.items()})
    fault = F.when(F.col("has_revision"), first_reason(*REVISION_RULES))
    faulty = f"""malformed OR fault IS NOT NULL OR {any_broken(PAGE_VALUE_RULES)}
        OR (starts_page AND page_id IS NULL)"""
    raw = F.expr(f"CASE WHEN {faulty} THEN xml END")
    judged = read.withColumn("fault", fault).withColumn("raw", raw)
    return judged.select(
        *[F.col(f"{name}_read").alias(name) if name in typed else name for name in SEGMENTS.fieldNames()]
    )


def to_segments(records: DataFrame) -> DataFrame:
    """Cut and parse scanned records."""
    return parse(cut(records))


def stage_metrics() -> list[Column]:
    """What is to be known of a stage as a whole, for :meth:`DataFrame.observe` or an aggregation:
    about how many splits were read, pieces at fault, titles that do not stand where their page
    begins, pieces with an author that has no number, and the bounds of the ids that rows have or
    refer to."""
    number = lambda name: f"array({number_sql(name, 'BIGINT')})"
    ids = {
        "page": number("page_id"),
        "revision": "array(revision_id)",
        "contributor": "concat(array(contributor_id), authors.number)",
    }
    return [
        F.expr("approx_count_distinct(struct(file_path, block_start)) AS splits"),
        F.expr("count_if(raw IS NOT NULL) AS faulty"),
        F.expr("count_if(NOT starts_page AND (title IS NOT NULL OR redirect IS NOT NULL)) AS astray"),
        F.expr("count_if(exists(authors, a -> a.number IS NULL)) AS unnumbered"),
        *[F.expr(f"min(array_min({values})) AS {name}_low") for name, values in ids.items()],
        *[F.expr(f"max(array_max({values})) AS {name}_high") for name, values in ids.items()],
    ]


def scan_tasks(records: DataFrame) -> int:
    """How many tasks read the records."""
    return min(max(records.rdd.getNumPartitions(), 1), MOST_BUCKETS)


def gathered(records: DataFrame) -> DataFrame:
    """Records of small splits with several splits to a task.

    Every scan task leaves a file, which each later pass reads in a task of its own, so what a load
    costs beside its data would grow with the number of splits. Splits are not moved or joined up:
    each keeps its rows together and in order.
    """
    spark = records.sparkSession
    tasks = records.rdd.getNumPartitions()
    split = min(int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()), TASK_BYTES)
    fewest = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    wanted = max(-(-tasks * split // TASK_BYTES), fewest)
    return records.coalesce(wanted) if wanted < tasks else records


def stage_table(spark: SparkSession, path: str, name: str, tasks: int) -> DataFrame:
    """A stage written before, which this session may not know of."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SEGMENTS.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (scan_part) INTO {tasks} BUCKETS LOCATION '{path}/{name}'"
    )
    return spark.table(name)


def stage_segments(
    records: DataFrame,
    path: str,
    name: str | None = None,
    tasks: int | None = None,
    seen: Observation | None = None,
) -> DataFrame:
    """Decompress and parse once, keep the result as Parquet, and read from there.

    Five tables are built from it, each reading only its own columns. A lost executor
    costs the tasks it ran, never the parse of the whole dump. Sorted by nothing and
    shuffled by nothing: every scan task writes its own file. As that file is a bucket of
    its own, later joins on the scan task leave the texts where they are.

    ``name`` is an entry of the session catalog, new by default; the files lie at ``path``.
    ``tasks`` is the number of scan tasks, if known. ``seen`` observes the rows as they are written.
    """
    spark = records.sparkSession
    tasks = tasks or scan_tasks(records)
    name = name or f"stage_{uuid.uuid4().hex}"
    segments = to_segments(records)
    if seen is not None:
        segments = segments.observe(seen, *stage_metrics())
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "4"}):  # no sort by bucket
        (
            segments
            .write.format("parquet")
            .bucketBy(tasks, "scan_part")
            .option("path", f"{path}/{name}")
            .saveAsTable(name)
        )
    return spark.table(name)

"""A whole load: scan and parse once, then five tables, their rejects and counts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from dumptables import session
from dumptables.operators.files import check_keys, dump_files, few_files, file_marks
from dumptables.operators.integrity import (
    at,
    claims,
    first_claims,
    first_places,
    first_writers,
    fk_violations,
    insert_absent,
    keep_first,
    lost_claims,
    not_at,
    places,
)
from dumptables.operators.keys import (
    CONTESTED,
    MISSING,
    REPEATING,
    key_uses,
    keys_of,
    settle_keys,
    stored_form,
    summary,
)
from dumptables.operators.metrics import load_totals, pages_per_file
from dumptables.operators.pages import assemble_pages
from dumptables.operators.segments import gathered, scan_tasks, stage_metrics, stage_segments
from dumptables.operators.tables import (
    contributor_rows,
    namespace_rows,
    page_rows,
    rejected,
    revision_rows,
    siteinfo_rows,
)
from dumptables.schemas import LOAD_ORDER, POSITION, REJECTS, TABLES, ForeignKey, TableSpec
from dumptables.session import (
    SAME_TASK,
    beside,
    delete_folder,
    full_splits,
    settings,
    small_side,
    together,
    wide_splits,
    work_folder,
)
from dumptables.sinks.base import CallableSink, Sink
from dumptables.sinks.keyindex import Bounds
from dumptables.sources.dump import DumpOptions, scan_records


class RejectedRows(ValueError):
    """A load in mode FAILFAST met a row it would have to set aside."""


@dataclass(frozen=True)
class LoadOptions:
    """zero_defaults: store 0 for a missing page namespace or current revision.
    mode: PERMISSIVE sets faulty rows aside; FAILFAST raises before any table is written,
        whatever the reason: values, repeated keys or missing parents.
    foreign_keys: refuse rows that refer to a missing parent.
    """

    zero_defaults: bool = False
    mode: str = "PERMISSIVE"
    foreign_keys: bool = True

    def __post_init__(self) -> None:
        if self.mode not in ("PERMISSIVE", "FAILFAST"):
            raise ValueError(f"mode must be PERMISSIVE or FAILFAST, not {self.mode!r}")


# Splits whose facts are held by the driver: for each some numbers and a header of some kB at most.
FEW_SPLITS = 500


class Staged:
    """The parsed dump as written to the work folder, read back from there.

    ``seen`` holds what was observed while it was written; without it (a stage found again
    after a crash) the same is read from the stage. ``files`` and ``pages`` are made on first use.
    """

    def __init__(
        self,
        segments: DataFrame,
        work: str,
        name: str,
        tasks: int,
        seen: Observation | None = None,
    ):
        self.spark = segments.sparkSession
        self.tasks = tasks
        self.segments = segments
        self.work = work
        self.name = name
        self._seen = seen

    @cached_property
    def facts(self) -> dict[str, int]:
        """Counts and bounds over the whole stage."""
        if self._seen is not None:
            return self._seen.get
        return self.segments.agg(*stage_metrics()).first().asDict()

    @cached_property
    def _are_few(self) -> bool:
        return self.facts["splits"] <= min(FEW_SPLITS, session.BROADCAST_ROWS)

    @cached_property
    def files(self) -> DataFrame:
        """One row per file: held by the driver if they are few, else a written table."""
        if self._are_few:
            return few_files(self.segments)
        return _kept(dump_files(self.segments), f"{self.work}/files")

    @cached_property
    def marks(self) -> DataFrame:
        """What rows must know of their file, hinted to come to them."""
        marks = file_marks(self.files)
        if self._are_few:
            return F.broadcast(marks)
        return beside(check_keys(_kept(marks, f"{self.work}/marks")))

    @cached_property
    def pages(self) -> DataFrame:
        tidy = not self.facts["faulty"] and not self.facts["astray"]
        return _kept(assemble_pages(self.segments, self.marks, tidy), f"{self.work}/pages")

    @cached_property
    def _is_sound(self) -> bool:
        """No piece is at fault, all files are complete and name their wiki."""
        odd = "NOT complete OR dbname IS NULL"
        return not self.facts["faulty"] and self.files.filter(odd).isEmpty()

    def may_reject(self, table: str) -> bool:
        """Whether a table may have rows that cannot be stored for what they hold."""
        if table == "contributor":
            return not self._is_sound or self.facts["unnumbered"] > 0
        return table not in ("revision", "page") or not self._is_sound

    def discard(self) -> None:
        """Give up the parsed dump and all other intermediate tables of the load."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_folder(self.spark, self.work)

    def rows(self, table: str, zero_defaults: bool = False) -> DataFrame:
        """All rows of a table, typed, valid or not."""
        if table == "siteinfo":
            return siteinfo_rows(self.files)
        if table == "namespaces":
            return namespace_rows(self.files)
        if table == "contributor":
            return contributor_rows(self.segments, self.marks)
        if table == "revision":
            return revision_rows(self.segments, self.marks)
        return page_rows(self.pages, self.marks, zero_defaults)

    def authors_at(self, places: DataFrame) -> DataFrame:
        """The contributor rows that stand at some places (``scan_part, row_id``)."""
        rows = places.select("scan_part", "row_id").distinct()
        met = self.segments.join(beside(rows), ["scan_part", "row_id"], "left_semi")
        return contributor_rows(met, self.marks)

    def bounds(self, zero_defaults: bool = False) -> Bounds:
        """Least and greatest id that rows have or refer to, by table."""
        found: Bounds = {"siteinfo": (0, 0), "namespaces": (-(2**15), 2**15 - 1)}
        for name in ("page", "revision", "contributor"):
            low, high = self.facts[f"{name}_low"], self.facts[f"{name}_high"]
            if name == "revision" and zero_defaults:
                low, high = min(low or 0, 0), max(high or 0, 0)
            if low is not None:
                found[name] = (low, high)
        return found


@dataclass(frozen=True)
class LoadReport:
    """What a load did. ``rejects`` reads a table of the work folder, the others small ones."""

    staged: Staged
    rejects: DataFrame

    @property
    def pages_per_file(self) -> DataFrame:
        return pages_per_file(self.staged.files)

    @property
    def totals(self) -> DataFrame:
        return load_totals(self.staged.files)


def _kept(df: DataFrame, path: str) -> DataFrame:
    """Write once, then read from there: later uses neither repeat the work nor depend on it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(records: DataFrame, work: str, name: str | None = None) -> Staged:
    """Parse records into the work folder."""
    name = name or f"stage_{uuid.uuid4().hex}"
    with settings(records.sparkSession, full_splits(records.sparkSession)):
        records = gathered(records.select("*"))  # planned anew, with these settings
        seen, tasks = Observation(), scan_tasks(records)
        segments = stage_segments(records, f"{work}/segments", name, tasks, seen)
    return Staged(segments, work, name, tasks, seen)


class _TableLoad:
    """One table on its way from the stage to the sink."""

    def __init__(self, spec: TableSpec, staged: Staged, sink: Sink, work: str, options: LoadOptions):
        rows = staged.rows(spec.name, options.zero_defaults)
        self.spec = spec
        self.staged = staged
        self.sink = sink
        self.work = f"{work}/keys/{spec.name}"
        self.rejects = [rejected(rows, spec.name)] if staged.may_reject(spec.name) else []
        self.rows = rows.filter("reason IS NULL")
        self.references = [
            fk for fk in spec.foreign_keys if options.foreign_keys and fk.parent != "siteinfo"
        ]

    def uses(self) -> DataFrame:
        return key_uses(self.rows, self.spec, self.references)

    def refuse_orphans(self, fk: ForeignKey, missing: DataFrame) -> None:
        """Refuse rows that refer to one of the missing keys (in the parent's columns)."""
        wanted = missing.select(
            *[F.col(p).alias(c) for c, p in zip(fk.columns, fk.parent_columns, strict=True)]
        )
        orphans = fk_violations(self.rows.select(*fk.columns, *POSITION), small_side(wanted), fk)
        orphans = _kept(orphans.select(*POSITION), f"{self.work}/orphans_{fk.parent}")
        self._refuse(orphans, fk.reason)
        self.rows = not_at(self.rows, beside(places(orphans)))

    def _refuse(self, positions: DataFrame, reason: str) -> None:
        refused = at(self.rows, beside(places(positions))).withColumn("reason", F.lit(reason))
        self.rejects.append(rejected(refused, self.spec.name))

    def keep_winners(self, contested: DataFrame, repeated: bool) -> None:
        """Leave one row per key that is not stored yet, for keys that should not repeat.

        The places of the losers go to the wide rows, never the other way round. Where no key is
        ``repeated``, these are all rows of stored keys.
        """
        narrow = self.rows.select(*self.spec.key, *POSITION)
        key = self.spec.key
        claimed = _kept(claims(narrow, small_side(contested), key), f"{self.work}/claimed")
        if not repeated:
            self.rows = not_at(self.rows, beside(places(claimed)))
            return
        first = _kept(first_claims(claimed, key), f"{self.work}/first")
        lost = _kept(lost_claims(claimed, small_side(first), key), f"{self.work}/lost")
        repeated = lost.filter("repeated")
        if not repeated.isEmpty():
            self._refuse(repeated, "duplicate_key")
        self.rows = not_at(self.rows, beside(places(lost)))

    def keep_first(self, stored: DataFrame | None) -> None:
        """The same for short rows whose keys are expected to repeat: every revision names
        its author again, every file its wiki. Nothing is reported."""
        key = self.spec.key
        if self.spec.name == "contributor":
            # Values are fetched for the first places only; all else stays unread.
            first = _kept(first_places(self.rows, key, stored), f"{self.work}/first")
            authors = self.staged.authors_at(first).filter("reason IS NULL")
            columns = [*self.spec.columns, "scan_part", "row_id", "nth"]
            self.rows = first_writers(authors.select(*columns), beside(first), key)
            return
        first = keep_first(self.rows.select(*self.spec.columns, *POSITION), key, POSITION)
        self.rows = first if stored is None else insert_absent(first, stored, key)

    def write(self) -> None:
        self.sink.append(self.spec, self.rows.select(self.spec.columns))


def _stored_keys(sink: Sink, spark: SparkSession, bounds: Bounds) -> DataFrame | None:
    """Stored keys of all tables within the bounds, from a sink that has them at hand or else
    from its tables one by one."""
    if hasattr(sink, "stored_keys"):
        return sink.stored_keys(bounds)
    found = []
    for name, (low, high) in bounds.items():
        spec = TABLES[name]
        number = [f for f in spec.schema.fields if f.name == spec.key[0] and len(spec.key) > 1]
        ends = spark.range(2).select(
            *[F.when(F.col("id") == 0, low).otherwise(high).cast(f.dataType).alias(f.name) for f in number]
        )
        stored = sink.keys(spec, ends)
        if stored is not None:
            found.append(stored_form(stored, spec))
    return reduce(DataFrame.unionByName, found) if found else None


def _load_tables(
    staged: Staged, sink: Sink, work: str, options: LoadOptions, aside: str
) -> None:
    """Write the five tables, and what was set aside into the folder ``aside``.

    One pass over the keys of all tables finds those that are stored, repeated or missing; most
    loads have none to care for. Where parents lost rows by their references, those of their
    children are looked up once more. A row's wiki name comes from the very header loaded as
    siteinfo, so those references hold by construction; the other three are checked.
    """
    spark = staged.spark
    load = {spec.name: _TableLoad(spec, staged, sink, work, options) for spec in LOAD_ORDER}
    bounds = staged.bounds(options.zero_defaults)

    def settle(tables: Iterable[_TableLoad], label: str) -> tuple[DataFrame, dict[str, int]]:
        uses = reduce(DataFrame.unionByName, [t.uses() for t in tables])
        seen = Observation()
        found = settle_keys(uses, _stored_keys(sink, spark, bounds)).observe(seen, *summary())
        kept = _kept(found.filter(f"{CONTESTED} OR {MISSING}"), f"{work}/keys/{label}")
        return kept, {name: count or 0 for name, count in seen.get.items()}

    def is_idle(name: str) -> bool:
        """The table has nothing to add and need not be made."""
        none = not counts[f"{name}_new"] and hasattr(sink, "holds")
        return none and sink.holds(load[name].spec)

    settled, counts = settle(load.values(), "all")
    for name in ("revision", "page"):
        table = load[name]
        orphaned = [fk for fk in table.references if counts[f"{fk.parent}_missing"]]
        for fk in orphaned:
            table.refuse_orphans(fk, keys_of(settled, fk.parent, MISSING))
        if orphaned:
            # Fewer rows have keys now, and so fewer of these may be repeated or referred to.
            settled, more = settle(load.values(), f"after_{name}")
            counts |= {k: n for k, n in more.items() if not k.endswith("_new")}
        repeated = counts[f"{name}_repeated"] > 0
        if repeated or (counts[f"{name}_contested"] and not is_idle(name)):
            table.keep_winners(keys_of(settled, name, CONTESTED), repeated)

    def write(name: str) -> None:
        if is_idle(name):
            return
        if name in REPEATING:
            stored = keys_of(settled, name, "stored") if counts[f"{name}_contested"] else None
            load[name].keep_first(stored)
        load[name].write()

    def write_rejects() -> None:
        found = [rows for table in load.values() for rows in table.rejects]
        reduce(DataFrame.unionByName, found).write.mode("overwrite").parquet(aside)

    every = {name: lambda name=name: write(name) for name in load}
    if getattr(sink, "enforces_keys", True):
        every["siteinfo"]()
        together(spark, every["namespaces"], every["contributor"])
        every["revision"]()
        together(spark, every["page"], write_rejects)
    else:
        together(spark, *every.values(), write_rejects)


class _Rehearsal:
    """A sink that knows what is stored in another, and to which nothing is added: the keys of a
    load are settled from its own rows and from what was stored before."""

    def __init__(self, sink: Sink):
        self.sink = sink

    def stored_keys(self, bounds: Bounds) -> DataFrame | None:
        return _stored_keys(self.sink, SparkSession.active(), bounds)

    def append(self, spec: TableSpec, rows: DataFrame) -> None:
        pass


def _fail_on_rejects(staged: Staged, sink: Sink, work: str, options: LoadOptions) -> None:
    """Raise on the first reject: faulty values first, table by table, then all other checks of
    a load, done without writing to the sink."""

    def fail(found: Row | None) -> None:
        if found is not None:
            raise RejectedRows(
                f"{found['table']}: {found['reason']} at {found['file_path']}: {found['raw']}"
            )

    for spec in LOAD_ORDER:
        fail(rejected(staged.rows(spec.name, options.zero_defaults), spec.name).first())
    _load_tables(staged, _Rehearsal(sink), work, options, f"{work}/rejects")
    fail(staged.spark.read.schema(REJECTS).parquet(f"{work}/rejects").first())


def prepare(records: DataFrame, sink: Sink, work: str, name: str | None = None) -> Staged:
    """The part of a load that does not depend on what is stored: parse, put pages together.
    Meanwhile the sink gets ready."""
    spark = records.sparkSession
    with settings(spark, SAME_TASK):
        ready = [sink.get_ready] if hasattr(sink, "get_ready") else []
        staged = together(spark, lambda: stage(records, work, name), *ready)[0]
    with settings(spark, SAME_TASK | wide_splits(spark)):
        staged.pages  # noqa: B018  made now
    return staged


def load_staged(
    staged: Staged, sink: Sink, options: LoadOptions = LoadOptions(), aside: str | None = None
) -> LoadReport:
    """The other part: settle keys and write the tables. A repeated or half-done load adds only
    what is missing. Rejects go to the folder ``aside``, by default one in the work folder."""
    work = staged.work
    aside = aside or f"{work}/rejects"
    with settings(staged.spark, SAME_TASK | wide_splits(staged.spark)):
        if options.mode == "FAILFAST":
            _fail_on_rejects(staged, sink, f"{work}/rehearsal", options)
        _load_tables(staged, sink, work, options, aside)
    return LoadReport(staged, staged.spark.read.schema(REJECTS).parquet(aside))


def load_records(
    records: DataFrame, sink: Sink, work: str, options: LoadOptions = LoadOptions()
) -> LoadReport:
    """Load scanned records. Each use needs a work folder of its own, or that of the very
    load it repeats; a repeated or half-done load then adds only what is missing."""
    sink.ensure()
    return load_staged(prepare(records, sink, work), sink, options)


def load_dump(
    spark: SparkSession,
    path: str | list[str],
    sink: Sink | Callable[[str, DataFrame], None],
    *,
    work: str | None = None,
    source: DumpOptions = DumpOptions(),
    options: LoadOptions = LoadOptions(),
) -> LoadReport:
    """Load all dump files of a folder as one batch.

    sink: where the tables go, or a function called with each table's name and new rows.
    work: folder for intermediate tables that all executors can reach; by default a new
        one under ``spark.checkpoint.dir``. The caller may delete it once the report has
        been read.
    """
    if not hasattr(sink, "append"):
        sink = CallableSink(sink)
    return load_records(
        scan_records(spark, path, source), sink, work or work_folder(spark), options
    )

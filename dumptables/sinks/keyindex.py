"""A copy of all stored keys, bucketed by key, beside tables that are plain Parquet folders.

Looking keys up in it moves the keys looked up, never those stored: a join on :data:`KEY` finds
the index dealt out already, and the bounds of what is looked up skip its row groups, which are
sorted by table and id.

The index follows the tables: it remembers the data files whose keys it holds, and before each
use reads the keys of files that came since. A load that broke off anywhere leaves at most keys
that are added twice, which lookups allow for. When a file it knows has gone, or when it has
become many small files, it is written anew as its next generation; the newest complete one
counts.
"""

from __future__ import annotations

from functools import reduce
from hashlib import md5
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from dumptables.operators.keys import KEY, KEY_TYPES, KINDS, stored_form
from dumptables.schemas import LOAD_ORDER
from dumptables.session import delete_folder, names_in, put_note

KEYS_PER_BUCKET = 4_000_000
LEAST_BUCKETS = 8
MOST_ADDITIONS = 64  # then the index is written anew in one file per bucket

Bounds = dict[str, tuple[int, int]]


class KeyIndex:
    """Keys of the tables in ``<path>/<table>``, kept in ``<path>/_keys``. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self.root = f"{path}/_keys"
        self._generation: int | None = None
        self._known: set[str] = set()
        self._additions = 0
        self._buckets = LEAST_BUCKETS
        self._turn = Lock()

    # -- files --------------------------------------------------------------------

    def _names(self, folder: str, pattern: str) -> list[str]:
        return names_in(self.spark, folder, pattern)

    def _note(self, generation: int, files: set[str], buckets: int) -> None:
        """Remember that the keys of these files are in the index."""
        folder = f"{self.root}/{generation}/covered"
        number = len(self._names(folder, r"\d+"))
        put_note(self.spark, f"{folder}/{number}", "\n".join([str(buckets), *sorted(files)]))

    def _recall(self) -> None:
        """Find the newest complete generation, when the index is used for the first time."""
        if self._generation is not None:
            return
        self._generation = -1
        for generation in sorted(map(int, self._names(self.root, r"\d+")), reverse=True):
            notes = self._names(f"{self.root}/{generation}/covered", r"\d+")
            if notes:
                lines = [
                    r.value.split("\n")
                    for r in self.spark.read.option("wholetext", True)
                    .text([f"{self.root}/{generation}/covered/{note}" for note in notes])
                    .collect()  # names of data files, as a listing of the tables has them
                ]
                self._generation, self._additions = generation, len(notes)
                self._buckets = int(lines[0][0])
                self._known = {name for line in lines for name in line[1:]}
                return

    # -- content ------------------------------------------------------------------

    def _table(self, generation: int, buckets: int) -> str:
        place = f"{self.root}/{generation}/data"
        name = f"keys_{md5(place.encode()).hexdigest()}"
        key = ", ".join(KEY)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({KEY_TYPES}) USING parquet "
            f"CLUSTERED BY ({key}) SORTED BY (kind, id) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        return name

    def _add(self, rows: DataFrame, generation: int, buckets: int) -> None:
        name = self._table(generation, buckets)
        rows.repartition(buckets, *KEY).write.insertInto(name)

    def _keys_in(self, files: set[str]) -> DataFrame:
        """Keys of data files, given as ``<table>/<file>``."""
        parts = []
        for spec in LOAD_ORDER:
            own = [f"{self.path}/{f}" for f in sorted(files) if f.startswith(f"{spec.name}/")]
            if own:
                parts.append(stored_form(self.spark.read.schema(spec.schema).parquet(*own), spec))
        return reduce(DataFrame.unionByName, parts)

    def catch_up(self) -> bool:
        """Take in the keys of data files that came since; false when nothing is stored."""
        with self._turn:
            return self._catch_up()

    def _catch_up(self) -> bool:
        self._recall()
        present = {
            f"{spec.name}/{file}"
            for spec in LOAD_ORDER
            for file in self._names(f"{self.path}/{spec.name}", r"part-[^/]*?\.parquet")
        }
        if not present:
            return False
        if self._generation < 0 or self._known - present or self._additions >= MOST_ADDITIONS:
            self._write_anew(present)
        elif new := present - self._known:
            self._add(self._keys_in(new), self._generation, self._buckets)
            self._note(self._generation, new, self._buckets)
            self._known |= new
            self._additions += 1
        return True

    def knows(self, table: str) -> bool:
        """Whether the table had data files when the index was last brought up to date."""
        return any(file.startswith(f"{table}/") for file in self._known)

    def _write_anew(self, present: set[str]) -> None:
        rows = self._keys_in(present)
        buckets = max(LEAST_BUCKETS, rows.count() // KEYS_PER_BUCKET)  # counts are in the footers
        last = max([self._generation, *map(int, self._names(self.root, r"\d+"))])
        self._add(rows, last + 1, buckets)
        self._note(last + 1, present, buckets)
        if self._generation >= 0:
            old = f"keys_{md5(f'{self.root}/{self._generation}/data'.encode()).hexdigest()}"
            self.spark.sql(f"DROP TABLE IF EXISTS {old}")
            delete_folder(self.spark, f"{self.root}/{self._generation}")
        self._generation, self._known = last + 1, set(present)
        self._additions, self._buckets = 1, buckets

    def read(self, bounds: Bounds) -> DataFrame:
        """Stored keys in columns :data:`KEY`, of each table within its bounds of ids."""
        rows = self.spark.table(self._table(self._generation, self._buckets))
        within = [
            f"(kind = {KINDS[name]} AND id BETWEEN {low} AND {high})"
            for name, (low, high) in bounds.items()
        ]
        return rows.filter(" OR ".join(within))

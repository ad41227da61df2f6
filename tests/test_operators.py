"""Column functions, key operators, sinks' own logic and session helpers."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from dumptables import TABLES, JdbcOptions
from dumptables import operators as op
from dumptables.functions import instant_seconds, last_filled, strict_long, strict_short
from dumptables.schemas import ForeignKey
from dumptables.session import small_side, work_folder
from dumptables.sinks import conform, foreign_key_ddl, table_ddl


@pytest.mark.parametrize(
    "convert, values",
    [
        (strict_long, {"7": 7, "+7": 7, "-7": -7, " 7": None, "7.0": None, "": None, "x": None,
                       "9223372036854775807": 2**63 - 1, "9223372036854775808": None}),
        (strict_short, {"32767": 32767, "-32768": -32768, "32768": None, "1e3": None}),
        (instant_seconds, {"2024-02-29T01:02:03Z": "2024-02-29 01:02:03",
                           "2024-02-29T01:02:03.999Z": "2024-02-29 01:02:03",
                           "2023-02-29T01:02:03Z": None, "2024-02-29 01:02:03Z": None,
                           "2024-02-29T01:02:03": None, "2024-02-29": None}),
    ],
)
def test_conversions(spark, convert, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    found = df.select("v", convert("v").cast("string").alias("r")).collect()
    assert {r.v: r.r for r in found} == {
        k: None if v is None else str(v) for k, v in values.items()
    }


def test_time_zone_does_not_matter(spark):
    df = spark.createDataFrame([("2024-07-01T12:00:00Z",)], "v string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert str(df.select(instant_seconds("v")).first()[0]) == "2024-07-01 12:00:00"
    finally:
        spark.conf.unset("spark.sql.session.timeZone")


def test_last_filled(spark):
    df = spark.createDataFrame([(["a", "b", ""],), ([""],), (None,)], "v array<string>")
    assert [r[0] for r in df.select(last_filled("v")).collect()] == ["b", None, None]


def test_keep_first_on_a_hot_key(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        (F.lit(5000) - F.col("id")).alias("o"),
        F.when(F.col("id") != 2997, F.col("id")).alias("v"),
    )
    kept = op.keep_first(rows, ["k"], ["o"])
    assert kept.columns == ["k", "o", "v"]
    assert kept.count() == 2001
    assert tuple(kept.filter("k = 0").first()) == (0, 2003, None)


def test_null_keys(spark):
    """A key with a NULL part neither conflicts nor refers to anything."""
    child = spark.createDataFrame(
        [(1, "a"), (1, "b"), (None, "b"), (2, None), (3, "c"), (3, "c")], "k int, w string"
    )
    parent = spark.createDataFrame([(1, "a"), (None, "b")], "id int, w string")
    fk = ForeignKey(("k", "w"), "parent", ("id", "w"))
    missing = op.fk_missing_keys(child, parent, fk)
    assert rows_of(missing) == [(1, "b", 1), (3, "c", 2)]
    assert rows_of(op.fk_violations(child, missing, fk)) == [(1, "b"), (3, "c"), (3, "c")]
    assert rows_of(op.fk_accepted(child, missing, fk)) == [(1, "a"), (2, None), (None, "b")]
    stored = parent.withColumnRenamed("id", "k")
    assert rows_of(op.insert_absent(child, stored, ["k", "w"])) == [
        (1, "b"), (2, None), (3, "c"), (3, "c"), (None, "b")
    ]
    assert rows_of(op.duplicate_keys(child, ["k", "w"])) == [(3, "c", 2)]


def test_conform(spark):
    df = spark.createDataFrame([("5", "w", "extra")], "key string, dbname string, other string")
    found = conform(df, TABLES["namespaces"].schema)
    assert found.schema == TABLES["namespaces"].schema
    assert rows_of(found) == [(5, "w", None, None)]


def test_small_side(spark):
    plan = lambda rows: spark.range(100).join(
        small_side(spark.range(50).repartition(2), rows), "id"
    )._jdf.queryExecution().toString()
    assert "strategy=broadcast" in plan(50)
    assert "strategy=broadcast" not in plan(49)


def test_work_folder_is_shared(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark), work_folder(spark)
    assert first.startswith(shared) and second.startswith(shared) and first != second


def test_jdbc_settings():
    options = JdbcOptions(name="wiki", user="me", password="secret", port=1234)
    assert options.url == "jdbc:postgresql://localhost:1234/wiki"
    assert "secret" not in options.url and "secret" not in repr(options)
    assert options.properties() == {"user": "me", "password": "secret"}
    with pytest.raises(TypeError):
        JdbcOptions(name="wiki")


def test_ddl():
    assert table_ddl(TABLES["page"]) == [
        'create table if not exists page ("id" bigint not null, "dbname" text not null, '
        '"ns" smallint, "title" text, "redirect" text, "revision_id" bigint, '
        'primary key ("id", "dbname"))',
        'create index if not exists title_redirect_idx on page ("title", "redirect")',
    ]
    assert foreign_key_ddl(TABLES["revision"]) == [
        'alter table revision add constraint contributor_id_fk foreign key '
        '("contributor_id", "dbname") references contributor ("id", "dbname")',
        'alter table revision add constraint dbname_fk foreign key ("dbname") '
        'references siteinfo ("dbname")',
    ]


def test_numbers_and_instants_end_where_their_text_does(spark):
    from dumptables.functions import instant_seconds, strict_long, strict_short

    texts = [("7\n", "2024-01-01T00:00:00Z\n"), ("7 ", "2024-01-01T24:00:00Z"), ("7", "2024-01-01T00:00:00Z")]
    found = spark.createDataFrame(texts, "n string, t string").select(
        strict_long("n"), strict_short("n"), instant_seconds("t")
    ).collect()
    assert [tuple(r) for r in found[:2]] == [(None, None, None)] * 2
    assert None not in tuple(found[2])


def test_jdbc_statements(spark):
    from dumptables import JdbcSink
    from dumptables.sinks.jdbc import SQL_TYPES, MissingTables, column_ddl

    class Fake(JdbcSink):
        stored: dict = {}
        written: list = []

        def _stored_columns(self, spec):
            return self.stored.get(spec.name, set())

        def append(self, spec, rows):
            self.written.append((spec.name, rows.columns))

    sink = Fake(spark, JdbcOptions(name="wiki", user="me", password="secret"))
    page = TABLES["page"]
    assert "createTableColumnTypes" not in sink.writer_options(page)
    assert "current_schema()" in sink.columns_query(page)
    statements = sink.statements()
    assert len(statements) == 5 * 2 + sum(len(t.foreign_keys) for t in TABLES.values())
    assert all(s.startswith("alter") for s in statements[10:])
    sink.ensure()
    assert [name for name, _ in sink.written] == list(TABLES)
    sink.stored = {t.name: set(t.columns) for t in TABLES.values()} | {"page": {"id", "dbname"}}
    assert sink.statements() == column_ddl(page, {"id", "dbname"})
    assert 'add column "title" text' in "; ".join(sink.statements())
    with pytest.raises(MissingTables):
        sink.ensure()
    # The dialect maps Spark's types to those stated in the statements.
    dialects = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get("jdbc:postgresql://h/d")
    for kind, name in SQL_TYPES.items():
        parsed = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(kind.json())
        mapped = dialects.getJDBCType(parsed)
        if mapped.isDefined():
            assert mapped.get().databaseTypeDefinition().lower().startswith(name)

"""Whole loads: repeats, duplicates, references, modes, sinks and turns."""

import pytest
from pyspark.errors import AnalysisException
from conftest import END, header, rows_of

from dumptables import (
    TABLES,
    CatalogSink,
    LoadOptions,
    ParquetSink,
    RejectedRows,
    load_dump,
    load_in_turns,
    rejects_of_turns,
)
from dumptables.session import work_folder


def revision(number, author=None, text="t"):
    author = author if author is not None else "<username>u</username><id>7</id>"
    return (
        f"<revision><id>{number}</id><timestamp>2024-01-01T00:00:00Z</timestamp>"
        f"<contributor>{author}</contributor><text>{text}</text></revision>"
    )


def page(number, *revisions, ns=0, title=None):
    title = title or f"T{number}"
    return f"<page><title>{title}</title><ns>{ns}</ns><id>{number}</id>{''.join(revisions)}</page>\n"


def tables(sink):
    return {name: rows_of(sink.read(name)) for name in TABLES}


def reasons(report):
    return rows_of(report.rejects.filter("table <> 'namespaces'"), "table", "reason")


@pytest.fixture
def sink(spark, tmp_path):
    return ParquetSink(spark, str(tmp_path / "tables"))


def test_faulty_and_repeated_rows(spark, write_dump, sink):
    """First writer by file and position wins; orphans and second rows are reported."""
    author = "<username>{}</username><id>{}</id>"
    path = write_dump(
        a=[
            header("wa"),
            page(1, revision(11, author.format("first", 7)), revision(12, author.format("later", 7))),
            page(2, revision(13, author.format("x", "bad"))),
            page(3, revision(14), ns=99),
            page(4, revision(15, text="kept")),
            END,
        ],
        b=[
            header("wa"),
            page(4, revision(15, text="lost"), title="second"),
            page(5, revision(16, author.format("other", 7))),
            END,
        ],
        c=[header("wc"), page(1, revision(11)), END],
        d=["<mediawiki><siteinfo><sitename>S</sitename></siteinfo>", page(1, revision(11)), END],
    )
    report = load_dump(spark, path, sink)
    assert rows_of(sink.read("page"), "dbname", "id", "title", "revision_id") == [
        ("wa", 1, "T1", 12), ("wa", 4, "T4", 15), ("wa", 5, "T5", 16), ("wc", 1, "T1", 11),
    ]
    assert rows_of(sink.read("revision"), "dbname", "id", "text") == [
        ("wa", 11, "t"), ("wa", 12, "t"), ("wa", 14, "t"), ("wa", 15, "kept"), ("wa", 16, "t"),
        ("wc", 11, "t"),
    ]
    assert rows_of(sink.read("contributor"), "dbname", "id", "username") == [
        ("wa", 7, "first"), ("wc", 7, "u")
    ]
    assert rows_of(sink.read("siteinfo"), "dbname") == [("wa",), ("wc",)]
    assert reasons(report) == [
        ("contributor", "bad_id"),
        ("contributor", "no_dbname"),
        ("page", "duplicate_key"),
        ("page", "fk_namespaces"),
        ("page", "fk_revision"),
        ("page", "no_dbname"),
        ("revision", "bad_contributor_id"),
        ("revision", "duplicate_key"),
        ("revision", "no_dbname"),
        ("siteinfo", "no_dbname"),
    ]
    assert tuple(report.totals.first()) == (8, 4)

    # Once more changes nothing.
    before = tables(sink)
    load_dump(spark, path, sink)
    assert tables(sink) == before


def test_zero_defaults_and_unchecked_references(spark, write_dump, sink):
    """A missing revision stored as 0 refers to nothing, so checked loads refuse it."""
    path = write_dump(a=[header("wa"), page(1), page(2, revision(21)), END])
    zero = LoadOptions(zero_defaults=True)
    report = load_dump(spark, path, sink, options=zero)
    assert rows_of(sink.read("page"), "id", "revision_id") == [(2, 21)]
    assert reasons(report) == [("page", "fk_revision")]
    load_dump(spark, path, sink, options=LoadOptions(zero_defaults=True, foreign_keys=False))
    assert rows_of(sink.read("page"), "id", "revision_id") == [(1, 0), (2, 21)]


def test_failfast_writes_nothing(spark, write_dump, sink):
    path = write_dump(a=[header("wa").replace("<namespace case", '<namespace key="5" case'),
                         page(1, revision(11)), page(2, revision("x")), END])
    with pytest.raises(RejectedRows, match="bad_id"):
        load_dump(spark, path, sink, options=LoadOptions(mode="FAILFAST"))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        sink.read("page")
    with pytest.raises(ValueError):
        LoadOptions(mode="strict")


def test_large_losing_side(spark, write_dump, sink, monkeypatch):
    """Beyond the broadcast bound the exact result comes by the other way."""
    monkeypatch.setattr("dumptables.session.is_bounded", lambda df, rows=0: df.count() <= 2)
    body = [page(i, revision(100 + i)) for i in range(1, 11)]
    path = write_dump(a=[header("wa"), *body, END], b=[header("wa"), *body, END])
    report = load_dump(spark, path, sink)
    assert rows_of(sink.read("page"), "id", "revision_id") == sorted(
        [(i, 100 + i) for i in range(1, 11)], key=repr
    )
    assert sink.read("revision").count() == 10
    assert report.rejects.filter("reason = 'duplicate_key'").count() == 20
    before = tables(sink)
    load_dump(spark, path, sink)
    assert tables(sink) == before


def test_function_as_sink(spark, write_dump):
    seen = {}
    path = write_dump(a=[header("wa"), page(1, revision(11)), page(2, revision(12), ns=99), END])
    load_dump(spark, path, lambda name, rows: seen.update({name: rows.count()}))
    assert seen == {"siteinfo": 1, "namespaces": 2, "contributor": 1, "revision": 2, "page": 1}


def test_catalog_tables(spark, write_dump, tmp_path):
    """Created when absent, completed when columns lack, bucketed on request, appended to."""
    first = write_dump("one", a=[header("wa"), page(1, revision(11)), END])
    second = write_dump("two", a=[header("wb"), page(1, revision(11)), END])
    spark.sql("CREATE DATABASE old_db")
    spark.sql("CREATE TABLE old_db.siteinfo (dbname STRING, sitename STRING) USING parquet")
    sink = CatalogSink(spark, "old_db", buckets=2, location=str(tmp_path / "db"))
    load_dump(spark, first, sink)
    load_dump(spark, second, sink)
    load_dump(spark, first, sink)
    assert rows_of(sink.read("siteinfo")) == [
        (w, "Site", "http://x/", "g", "first-letter") for w in ("wa", "wb")
    ]
    assert rows_of(sink.read("page"), "dbname", "revision_id") == [("wa", 11), ("wb", 11)]
    assert spark.table("old_db.revision").schema["timestamp"].dataType.typeName() == "timestamp_ntz"
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED old_db.page").collect()}
    assert described["Num Buckets"] == "2"
    assert described["Sort Columns"] == "[`title`, `redirect`]"


def test_turns_equal_one_batch(spark, write_dump, sink, tmp_path):
    """At most n files per turn; stopping and going on later loads only what is new."""
    files = {
        f"f{i}": [header(f"w{i % 2}"), page(i, revision(100 + i)), page(50, revision(500 + i)), END]
        for i in range(4)
    }
    path = write_dump("turns", **files)
    work = work_folder(spark)
    progress = load_in_turns(spark, path, sink, work=work, files_per_turn=2)
    assert rows_of(progress) == [(0, 4, 2, 4, 2), (1, 4, 2, 8, 4)]
    write_dump("turns", g=[header("w9"), page(9, revision(109)), END])
    progress = load_in_turns(spark, path, sink, work=work, files_per_turn=2)
    assert rows_of(progress)[-1] == (2, 1, 1, 9, 5)

    batch = ParquetSink(spark, str(tmp_path / "batch"))
    load_dump(spark, path, batch)
    turned, whole = tables(sink), tables(batch)
    for name in ("siteinfo", "namespaces", "contributor", "revision"):
        assert turned[name] == whole[name]
    # Page 50 occurs twice per wiki; which one is first depends on the order of turns.
    assert [r for r in turned["page"] if r[0] != 50] == [r for r in whole["page"] if r[0] != 50]
    assert len(turned["page"]) == len(whole["page"])
    assert rejects_of_turns(spark, work).filter("table = 'namespaces'").count() == 5


def exchanged_columns(df):
    """Names of the columns that each shuffle of a plan moves."""
    found = []

    def walk(node):
        if node.nodeName() == "Exchange":
            attributes = node.output()
            found.append({attributes.apply(i).name() for i in range(attributes.size())})
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    walk(plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)
    return found


def test_texts_stay_where_they_are(spark, tmp_path, write_dump, monkeypatch):
    """Beyond every bound, stamps and lost places come to the texts by the scan task."""
    from dumptables import session
    from dumptables.operators.integrity import at, not_at, places
    from dumptables.plans import load
    from dumptables.sources import scan_records

    pages = [
        f"<page><title>P{i}</title><ns>0</ns><id>{i}</id><revision><id>{i}</id>"
        f"<text>text {i}</text></revision></page>\n"
        for i in range(40)
    ]
    files = {f"f{k}": [header(), *pages[k * 10 : k * 10 + 10], END] for k in range(4)}
    monkeypatch.setattr(session, "BROADCAST_ROWS", -1)
    with session.settings(
        spark, {**session.SAME_TASK, "spark.sql.autoBroadcastJoinThreshold": "-1"}
    ):
        staged = load.stage(scan_records(spark, write_dump(**files)), f"{tmp_path}/work")
        rows = staged.rows("revision")
        lost = places(rows.filter("id % 3 = 0").select("row_id", "seg"))
        lost.write.parquet(f"{tmp_path}/lost")
        lost = session.beside(spark.read.parquet(f"{tmp_path}/lost"))
        for kept, wanted in ((not_at(rows, lost), 26), (at(rows, lost), 14)):
            moved = exchanged_columns(kept)
            assert moved and not any("text" in columns for columns in moved)
            assert kept.count() == wanted
            assert kept.filter("dbname = 'testwiki' AND text = concat('text ', id)").count() == wanted


def revision_dump(*ids, author=""):
    pages = [
        f"<page><title>P</title><ns>0</ns><id>{n}</id><revision><id>{i}</id>{author}"
        f"<text>t{n}</text></revision></page>\n"
        for n, i in enumerate(ids)
    ]
    return [header(), *pages, END]


class Recording:
    """A sink in memory of the names of the tables written, which may break once."""

    def __init__(self, sink, break_after=None):
        self.sink, self.break_after, self.names = sink, break_after, []

    def ensure(self):
        self.sink.ensure()

    def keys(self, spec, new):
        return self.sink.keys(spec, new)

    def append(self, spec, rows):
        self.sink.append(spec, rows)
        self.names.append(spec.name)
        if spec.name == self.break_after:
            self.break_after = None
            raise OSError("the sink broke")


def test_tables_follow_those_they_refer_to(spark, write_dump, tmp_path):
    sink = Recording(ParquetSink(spark, f"{tmp_path}/tables"))
    load_dump(spark, write_dump(a=revision_dump(1, 2)), sink)
    assert sink.names[0] == "siteinfo" and sorted(sink.names[1:3]) == ["contributor", "namespaces"]
    assert sink.names[3:] == ["revision", "page"]


def test_repeated_keys_are_reported_after_a_crash(spark, write_dump, tmp_path):
    dump = write_dump(a=revision_dump(1, 2, 2, 3, 3, 3))
    undisturbed = load_dump(spark, dump, ParquetSink(spark, f"{tmp_path}/one")).rejects
    sink = Recording(ParquetSink(spark, f"{tmp_path}/two"), break_after="revision")
    with pytest.raises(OSError):
        load_dump(spark, dump, sink, work=f"{tmp_path}/work")
    replayed = load_dump(spark, dump, sink, work=f"{tmp_path}/work").rejects
    columns = ["table", "reason", "row_id", "seg"]
    assert rows_of(replayed, *columns) == rows_of(undisturbed, *columns)
    assert replayed.filter("reason = 'duplicate_key'").count() == 3


@pytest.mark.parametrize(
    "pages", [revision_dump(1, 1), revision_dump(1, author="<contributor><id>x</id></contributor>")]
)
def test_failfast_raises_before_anything_is_written(spark, write_dump, tmp_path, pages):
    sink = Recording(ParquetSink(spark, f"{tmp_path}/tables"))
    with pytest.raises(RejectedRows):
        load_dump(spark, write_dump(a=pages), sink, options=LoadOptions(mode="FAILFAST"))
    assert sink.names == []


def test_repeated_structured_tags(spark, write_dump, tmp_path):
    page = (
        '<page><title>P</title><ns>0</ns><id>1</id><redirect title="A"/><redirect/><revision><id>5</id>'
        "<contributor><username>n</username><id>7</id></contributor>"
        "<contributor><username>other</username></contributor>"
        '<text bytes="3">abc</text><text/></revision></page>\n'
    )
    sink = ParquetSink(spark, f"{tmp_path}/tables")
    report = load_dump(spark, write_dump(a=[header(), page, END]), sink)
    assert rows_of(sink.read("page"), "redirect") == [("A",)]
    assert rows_of(sink.read("revision"), "contributor_id", "text", "bytes") == [(7, "abc", 3)]
    assert rows_of(sink.read("contributor"), "id", "username") == [(7, "n")]
    assert rows_of(report.rejects.filter("table = 'contributor'"), "reason") == [("no_id",)]


def test_lookups_read_one_bucket_and_move_no_table(spark, write_dump, tmp_path):
    from dumptables.operators import look_up
    from dumptables.session import settings

    sink = CatalogSink(spark, "lookups", buckets=4, location=f"{tmp_path}/db")
    load_dump(spark, write_dump(a=revision_dump(*range(1, 30))), sink)
    pages = sink.read("page")
    # Buckets are skipped in any case; a plan says so only where it also counts on buckets.
    with settings(spark, {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}):
        plan = pages.filter("title = 'P'")._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 1 out of 4" in plan
    wanted = spark.createDataFrame([("P", 1), ("none", 2)], "title string, n int")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        found = look_up(pages, wanted, "title")
        assert exchanged_columns(found) == [{"title", "n"}]
        assert found.count() == 29


def test_turns_leave_no_copy_of_the_dump(spark, write_dump, tmp_path):
    sink = ParquetSink(spark, f"{tmp_path}/tables")
    load_in_turns(spark, write_dump(a=revision_dump(1), b=revision_dump(2)), sink, work=f"{tmp_path}/work", files_per_turn=1)
    assert sink.read("revision").count() == 2
    assert not list((tmp_path / "work" / "turns").iterdir())

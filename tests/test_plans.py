"""Plans one wants at any scale: what is hashed, what stays where it is, what is asked first."""

import pytest
from conftest import END, header, rows_of
from pyspark.sql import functions as F

from dumptables import ParquetSink, load_dump
from dumptables.operators import files, fk_missing_keys, first_places
from dumptables.operators.files import dump_files, few_files
from dumptables.operators.keys import KEY, key_uses, settle_keys
from dumptables.operators.pages import assemble_pages
from dumptables.plans import load, stage
from dumptables.schemas import TABLES, ForeignKey
from dumptables.session import SAME_TASK, settings
from dumptables.sources import scan_records

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", **SAME_TASK}


def plan_of(df):
    plan = df._jdf.queryExecution().executedPlan()
    return plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan


def nodes(plan, below=False):
    """Every node with whether an exchange stands above it."""
    yield plan, below
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i), below or plan.nodeName() == "Exchange")


def moved(df):
    out = set()
    for node, _ in nodes(plan_of(df)):
        if node.nodeName() == "Exchange":
            out |= {node.output().apply(i).name() for i in range(node.output().size())}
    return out


def page(i, *more):
    return (
        f"<page><title>P{i}</title><ns>0</ns><id>{i}</id>{''.join(more)}<revision><id>{100 + i}</id>"
        f"<contributor><username>u{i}</username><id>{i % 3}</id></contributor><text>t</text></revision></page>\n"
    )


@pytest.fixture
def staged(spark, write_dump, tmp_path):
    files = {f"f{k}": [header(), *[page(k * 10 + i) for i in range(10)], END] for k in range(3)}
    with settings(spark, SAME_TASK):
        return stage(scan_records(spark, write_dump(**files)), f"{tmp_path}/work")


def test_pages_meet_as_numbers(spark, staged):
    """No title, text or source is moved, and no aggregation sorts."""
    with settings(spark, NO_BROADCAST):
        pages = assemble_pages(staged.segments, staged.marks, tidy=True)
        assert not moved(pages) & {"title", "redirect", "raw", "text", "siteinfo"}
        names = [n.nodeName() for n, _ in nodes(plan_of(pages))]
        assert "HashAggregate" in names and "SortAggregate" not in names
        assert pages.count() == 30


def test_first_writers_are_found_by_numbers(spark, staged):
    rows = staged.rows("contributor").filter("reason IS NULL")
    with settings(spark, NO_BROADCAST):
        first = first_places(rows, TABLES["contributor"].key, None)
        names = [n.nodeName() for n, _ in nodes(plan_of(first))]
        assert "HashAggregate" in names and "SortAggregate" not in names
        assert "username" not in moved(first) and first.count() == 3


def test_tidy_pages_equal_others(spark, staged):
    both = [assemble_pages(staged.segments, staged.marks, tidy) for tidy in (True, False)]
    assert rows_of(both[0]) == rows_of(both[1])


def test_titles_astray(spark, write_dump, tmp_path):
    """Titles and redirects that stand behind a revision, in one row or two."""
    late = "<page><ns>0</ns><id>{0}</id><revision><id>{0}</id><text>t</text></revision>{1}</page>\n"
    rows = [
        late.format(1, "<title>A</title><redirect title='B'/>"),
        late.format(2, "<title>C</title>").replace("<ns>", "<redirect title='D'/><ns>"),
        late.format(3, "<redirect title='E'/>").replace("<ns>", "<title>F</title><ns>"),
        late.format(4, "<title>H</title>").replace("<ns>", "<title>G</title><redirect title='I'/><ns>"),
        late.format(5, ""),
    ]
    found = stage(scan_records(spark, write_dump(a=[header(), *rows, END])), f"{tmp_path}/work")
    assert rows_of(found.rows("page"), "id", "title", "redirect") == [
        (1, "A", "B"), (2, "C", "D"), (3, "F", "E"), (4, "H", "I"), (5, None, None),
    ]


def test_few_files_equal_many(spark, staged, write_dump, tmp_path, monkeypatch):
    """The driver puts together what Spark would; headers too where a file has none."""
    files = {"a": [header("wa"), page(1), END], "b": [page(2), page(3)], "c": [header("wc")]}
    odd = stage(scan_records(spark, write_dump("odd", **files)), f"{tmp_path}/odd")
    for found in (staged, odd):
        assert rows_of(few_files(found.segments)) == rows_of(dump_files(found.segments))
    monkeypatch.setattr(load, "FEW_SPLITS", -1)
    many = stage(scan_records(spark, write_dump("odd", **files)), f"{tmp_path}/many")
    columns = ("id", "dbname", "title", "reason")
    assert rows_of(many.rows("page"), *columns) == rows_of(odd.rows("page"), *columns)


def test_stored_keys_are_not_moved(spark, write_dump, tmp_path):
    """Looked up in an index beside the tables, which lies in buckets of the key."""
    sink = ParquetSink(spark, f"{tmp_path}/tables")
    load_dump(spark, write_dump(a=[header(), *[page(i) for i in range(40)], END]), sink)
    new = spark.createDataFrame([(1, "testwiki"), (41, "testwiki")], "id bigint, dbname string")
    uses = key_uses(new.selectExpr("*", "CAST(id % 3 AS BIGINT) AS contributor_id"),
                    TABLES["revision"], TABLES["revision"].foreign_keys[:1])
    bounds = {"revision": (0, 500), "contributor": (0, 5)}
    with settings(spark, NO_BROADCAST):
        found = settle_keys(uses, sink.stored_keys(bounds))
        plan = plan_of(found)
        scans = [below for n, below in nodes(plan) if "keys_" in n.simpleString(200)]
        assert scans and not any(scans)
        assert "SortMergeJoin" in [n.nodeName() for n, _ in nodes(plan)]
        settled = {(r.kind, r.id): (r.n, r.refers, r.stored) for r in found.collect()}
    contributor, revision = 2, 3
    assert settled == {
        (revision, 1): (1, False, False), (revision, 41): (1, False, False),
        (contributor, 1): (0, True, True), (contributor, 2): (0, True, True),
    }
    assert sink.stored_keys({"revision": (100, 110)}).count() == 11


def test_key_index_follows_the_tables(spark, write_dump, tmp_path, monkeypatch):
    """Files that came by other ways, files that went, many additions, another session's sink."""
    from dumptables.sinks import keyindex

    sink = ParquetSink(spark, f"{tmp_path}/tables")
    every = {name: (-(2**40), 2**40) for name in TABLES}
    stored = lambda s: rows_of(s.stored_keys(every).select(*KEY).distinct())
    load_dump(spark, write_dump("one", a=[header(), page(1), END]), sink)
    first = stored(sink)
    assert (4, 1, "testwiki") in first and (3, 101, "testwiki") in first
    spark.sql("SELECT 7L AS id, 'w' AS dbname").write.mode("append").parquet(f"{tmp_path}/tables/page")
    assert stored(sink) == sorted([*first, (4, 7, "w")], key=repr)
    assert stored(ParquetSink(spark, f"{tmp_path}/tables")) == stored(sink)
    monkeypatch.setattr(keyindex, "MOST_ADDITIONS", 1)
    load_dump(spark, write_dump("two", b=[header(), page(2), END]), sink)
    assert (4, 2, "testwiki") in stored(sink) and sink.index._generation > 0
    for file in (tmp_path / "tables" / "page").glob("*.parquet"):
        if spark.read.parquet(str(file)).filter("id = 7").count():
            file.unlink()
    assert (4, 7, "w") not in stored(sink) and (4, 1, "testwiki") in stored(sink)


@pytest.mark.parametrize("room", [1, 1_000_000])
def test_a_bloom_filter_stands_in_the_scan_of_the_parents(spark, tmp_path, room):
    """Below the exchange of the parents; a full one changes no result."""
    spark.range(20_000).selectExpr("id AS p", "CAST(id % 7 AS STRING) AS q").write.parquet(f"{tmp_path}/p")
    parents = spark.read.parquet(f"{tmp_path}/p")
    children = spark.range(19_990, 20_010).selectExpr("id AS a", "CAST(id % 7 AS STRING) AS b")
    fk = ForeignKey(("a", "b"), "p", ("p", "q"))
    with settings(spark, NO_BROADCAST):
        missing = fk_missing_keys(children, parents, fk, room)
        asked = [below for n, below in nodes(plan_of(missing)) if "getbit" in n.simpleString(2000)]
        assert asked and all(asked)
        assert [r.a for r in missing.orderBy("a").collect()] == list(range(20_000, 20_010))
    plain = fk_missing_keys(children, parents, fk)
    assert "getbit" not in plain._jdf.queryExecution().toString()


def test_a_turn_that_was_parsed_only_is_loaded_first(spark, write_dump, tmp_path, monkeypatch):
    """The load of a turn breaks; the next run goes on from its stage."""
    from dumptables import load_in_turns
    from dumptables.streaming import turns

    path = write_dump(**{f"f{k}": [header(), page(k), END] for k in range(3)})
    sink, work = ParquetSink(spark, f"{tmp_path}/tables"), f"{tmp_path}/work"
    real, calls = turns.load_staged, []

    def breaks(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("the sink broke")
        return real(*args)

    monkeypatch.setattr(turns, "load_staged", breaks)
    with pytest.raises(Exception, match="the sink broke"):
        load_in_turns(spark, path, sink, work=work, files_per_turn=1)
    monkeypatch.setattr(turns, "load_staged", real)
    progress = load_in_turns(spark, path, sink, work=work, files_per_turn=1)
    assert rows_of(progress) == [(0, 1, 1, 1, 1), (1, 1, 1, 2, 2), (2, 1, 1, 3, 3)]
    assert rows_of(sink.read("page"), "id") == [(0,), (1,), (2,)]
    assert not list((tmp_path / "work" / "turns").iterdir())


def test_sound_loads_look_for_no_rejects(spark, write_dump, tmp_path):
    """Tables without a row at fault are not read for rejects; any fault is found as before."""
    author = "<revision><id>{0}</id><contributor><username>u</username><id>{1}</id></contributor><text>t</text></revision>"
    whole = [header(), page(1), page(2), END]
    dumps = {
        "sound": (whole, set()),
        "author": ([header(), page(1, author.format(7, "x")), END], {"contributor", "revision"}),
        "unnumbered": ([header(), page(1).replace("<id>1</id></contributor>", "</contributor>"), END], {"contributor"}),
        "cut": ([header(), page(1), page(2)[:-8]], {"page", "contributor", "revision"}),
        "unnamed": ([header().replace("<dbname>testwiki</dbname>", ""), page(1), END], {"page", "contributor", "revision"}),
        "bad_ns": ([header(), page(1).replace("<ns>0</ns>", "<ns>x</ns>"), END], {"page"}),
    }
    for name, (chunks, wanted) in dumps.items():
        found = stage(scan_records(spark, write_dump(name, a=chunks)), f"{tmp_path}/work_{name}")
        tables = ("page", "contributor", "revision")
        assert {t for t in tables if not found.rows(t).filter("reason IS NOT NULL").isEmpty()} <= wanted
        assert wanted <= {t for t in tables if found.may_reject(t)}, name
        assert name != "sound" or not any(found.may_reject(t) for t in tables)
    sink = ParquetSink(spark, f"{tmp_path}/tables")
    report = load_dump(spark, f"{tmp_path}/unnumbered", sink)
    kinds = {r.table for r in report.rejects.collect()}
    assert "contributor" in kinds and not kinds & {"page", "revision"}


def test_splits_are_known_by_numbers(spark, staged, monkeypatch):
    """Rows meet the marks of their split by numbers; two splits with one key are not mixed up."""
    for table in ("revision", "contributor"):
        plan = plan_of(staged.rows(table))
        scans = [n for n, _ in nodes(plan) if n.nodeName().startswith("Scan parquet")]
        read = {n.output().apply(i).name() for n in scans for i in range(n.output().size())}
        assert "split_key" in read and "file_path" not in read
    twice = staged.marks.unionByName(staged.marks)
    with pytest.raises(files.SplitKeyClash):
        files.check_keys(twice)
    assert files.check_keys(staged.marks).count() == 3
    monkeypatch.setattr(files, "PIECES", files.PIECES.replace(files.SPLIT_KEY, "CAST(scan_part AS BIGINT) * 0"))
    with pytest.raises(files.SplitKeyClash):
        few_files(staged.segments.withColumn("scan_part", F.lit(0)))

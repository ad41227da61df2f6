"""What must not grow with the number of splits, files or turns."""

import bz2

from conftest import END, header, rows_of

from dumptables import DumpOptions, ParquetSink, load_dump, load_in_turns
from dumptables.plans import stage
from dumptables.session import settings, wide_splits, work_folder
from dumptables.sources import scan_records

# Every file is read in a split of its own, and more of them where it is longer.
SMALL_SPLITS = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0"}


def page(number):
    return (
        f"<page><title>T{number}</title><ns>0</ns><id>{number}</id><revision><id>{100 + number}</id>"
        f"<contributor><username>u</username><id>1</id></contributor><text>a</text></revision></page>\n"
    )


def test_small_splits_share_tasks(spark, write_dump):
    """Before, each split was a task, a file and a bucket of the stage."""
    path = write_dump(**{f"f{k:02}": [header(f"w{k % 3}"), page(k), END] for k in range(60)})
    with settings(spark, SMALL_SPLITS):
        records = scan_records(spark, path)
        assert records.rdd.getNumPartitions() >= 60
        staged = stage(records, work_folder(spark))
        assert wide_splits(spark) == {"spark.sql.files.maxPartitionBytes": str(16 << 20)}
    few = 4 * spark.sparkContext.defaultParallelism
    assert staged.tasks <= few
    assert len({row.scan_part for row in staged.segments.select("scan_part").distinct().collect()}) <= few
    assert sorted(r.id for r in staged.rows("page").collect()) == list(range(60))


def test_small_files_share_tasks(spark, write_dump):
    """Before, a file counted as 4 MB however small, so four filled a task: 80 tasks here."""
    path = write_dump(**{f"f{k:03}": [header(f"w{k % 3}"), page(k), END] for k in range(320)})
    with settings(spark, {"spark.sql.files.maxPartitionBytes": str(16 << 20)}):
        staged = stage(scan_records(spark, path), work_folder(spark))
    assert staged.tasks <= 4 * spark.sparkContext.defaultParallelism + 1
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None
    assert sorted(r.id for r in staged.rows("page").collect()) == list(range(320))


def test_folders_share_listing_tasks(spark, tmp_path):
    """Before, each of many folders was listed by a task of its own."""
    for k in range(80):
        folder = tmp_path / "dump" / f"part={k}"
        folder.mkdir(parents=True)
        (folder / "a.bz2").write_bytes(bz2.compress("".join([header(), page(k), END]).encode()))
    tracker, key = spark.sparkContext.statusTracker(), "listing test"
    spark.sparkContext.setJobGroup(key, key)
    try:
        records = scan_records(spark, str(tmp_path / "dump"), DumpOptions(recursive=True))
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(key)]
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    tasks = [tracker.getStageInfo(s).numTasks for job in jobs for s in job.stageIds]
    assert tasks and max(tasks) <= 4 * spark.sparkContext.defaultParallelism
    assert records.count() == 160  # a revision and the rest of the file


def test_small_splits_load_the_same(spark, write_dump, tmp_path):
    path = write_dump(**{f"f{k:02}": [header("w"), page(k), page(k // 2), END] for k in range(40)})
    found = []
    for values in ({}, SMALL_SPLITS):
        sink = ParquetSink(spark, f"{tmp_path}/{len(found)}")
        with settings(spark, values):
            report = load_dump(spark, path, sink)
        tables = [rows_of(sink.read(name)) for name in ("page", "revision", "contributor", "namespaces")]
        found.append([*tables, rows_of(report.rejects, "table", "reason", "raw")])
    assert found[0] == found[1]


def test_many_small_turns_are_loaded_together(spark, write_dump, tmp_path, monkeypatch):
    """Before, each turn was a load of its own. Every turn still has its line in the progress."""
    from dumptables.streaming import turns

    real, calls = turns.load_staged, []

    def counts(*args):
        calls.append(args)
        return real(*args)

    monkeypatch.setattr(turns, "load_staged", counts)
    path = write_dump(**{f"f{k:02}": [header(f"w{k % 2}"), page(k), END] for k in range(32)})
    sink, work = ParquetSink(spark, f"{tmp_path}/tables"), f"{tmp_path}/work"
    progress = load_in_turns(spark, path, sink, work=work, files_per_turn=2)
    assert len(calls) == 8  # of 16 turns
    assert rows_of(progress) == sorted(((k, 2, 2, 2 * k + 2, 2 * k + 2) for k in range(16)), key=repr)
    assert sorted(r.id for r in sink.read("page").collect()) == list(range(32))
    write_dump(**{f"g{k}": [header(), page(90 + k), END] for k in range(3)})
    progress = load_in_turns(spark, path, sink, work=work, files_per_turn=2)
    assert len(calls) == 9  # two turns
    assert progress.orderBy("batch_id").collect()[-1][:] == (17, 1, 1, 35, 35)
    assert sink.read("page").count() == 35


def test_turns_together_are_bounded():
    from dumptables.streaming.turns import turns_at_once

    assert turns_at_once(3, 1000.0, 1) == 1
    assert turns_at_once(80, 100_000.0, 3) == 3
    assert turns_at_once(10**6, 1000.0, 2) == 1000
    assert turns_at_once(10**6, 10e6, 2) == 3
    assert turns_at_once(10**6, 10e9, 2) == 1
    assert turns_at_once(0, float("inf"), 3) == 1


def test_rendered_files_hold_their_rows_in_order(spark, tmp_path):
    """As Spark's own writer left them: a null is an empty line, folders have the names Spark gives."""
    from pyspark.sql import functions as F

    from fixtures.render import write_dump

    rows = [(w, p, w, s, x) for w, p in (("a", 1), ("a", None), (None, 2), ("x/y=", 3)) for s, x in ((2, "<c/>"), (1, "<b/>"))]
    rows.append(("a", 1, "a", 3, None))
    pages = spark.createDataFrame(rows, "wiki string, part long, site string, seq long, xml string")
    write_dump(pages, f"{tmp_path}/dump", F.lit("<a>"), F.lit("</a>"))
    found = {
        str(p.parent.relative_to(tmp_path / "dump")): bz2.decompress(p.read_bytes()).decode()
        for p in (tmp_path / "dump").rglob("*.bz2")
    }
    usual, none = "<a>\n<b/>\n<c/>\n</a>\n", "__HIVE_DEFAULT_PARTITION__"
    assert found == {
        "wiki=a/part=1": "<a>\n<b/>\n<c/>\n\n</a>\n",
        f"wiki=a/part={none}": usual,
        f"wiki={none}/part=2": usual,
        "wiki=x%2Fy%3D/part=3": usual,
    }

"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import os
import random

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dumptables.llm import (
    decontaminate, exact_dedup, importance, line_dedup, pieces, simhash, suffixes, superkmers,
    toxicity, url_filter,
)

from . import brute

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"
ITEMS = "item_id bigint, text string"
random.seed(5)
LONG = " ".join(f"w{random.randrange(500)}" for _ in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
TEXTS = [
    (1, "One two three.\nFour five six."), (2, "One two  three.\nFour five six."),
    (3, None), (4, ""), (5, "   \n\t "), (None, "One two three.\nFour five six."), (None, None),
    (6, "short"), (6, "short"), (6, "other text under one id"), (7, LONG), (8, LONG + " end"),
    (9, "a a a a " * 40), (10, f"before {PASSAGE} after"), (11, f"{PASSAGE}\nelse"),
    (12, "été ÀÉ Zoë\u2003x"), (13, PASSAGE + " " + PASSAGE), (14, "a\nb\nc"), (15, "a\nb\nc"),
]
# Names that the operators use inside.
CLASHING = ("row", "hash", "key", "bits", "node", "n", "digest", "words", "component", "toxic", "f0")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None, None) for i, t in TEXTS]
    plain = spark.createDataFrame(rows, DOCS)
    return plain.withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, None), (None, 1, 1), (9, None, 1)], LABELS)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "p3 p4 p5 p6 p7 p8 p9 p10 p11 p12 p13 p14 p15"), (2, "SHORT"), (3, None), (None, "a a")]
    return spark.createDataFrame(rows, ITEMS)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def same_rows(df, docs):
    """All input rows, each once, by doc_id."""
    return rows_of(df, "doc_id") == rows_of(docs, "doc_id")


def test_line_dedup(docs):
    found = line_dedup.dedup(docs)
    assert same_rows(found, docs)
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[3].n_lines == 0 and by_id[4].n_lines == 1
    assert by_id[14].n_removed == 0
    assert by_id[15].n_removed in (0, 2, 3)


def test_line_dedup_finds_a_shifted_block(spark):
    block = "\n".join(f"shared line number {i}" for i in range(40))
    rows = [(1, f"x\n{block}\ny"), (2, f"q\nr\ns\n{block}"), (3, "alone\n" + "\n".join("abcdefgh"))]
    found = {r.doc_id: r for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert found[1].n_removed == found[3].n_removed == 0
    assert found[2].n_removed > 20


def test_importance(docs, labels):
    found = importance.resample(docs, labels)
    assert same_rows(found, docs)
    weights = {r.doc_id: r.log_weight for r in found.collect() if r.doc_id in (3, 4, 5)}
    assert set(weights.values()) == {0.0}
    kept = importance.selected_of(docs, labels)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id") == rows_of(found.filter("selected"), "doc_id")


def test_importance_without_labels(docs, labels, spark):
    empty = spark.createDataFrame([], LABELS)
    assert importance.resample(docs, empty).filter("NOT selected").isEmpty()
    assert importance.selected_of(docs, empty).count() == len(TEXTS)


@pytest.mark.parametrize("report", [superkmers.dedup_report, suffixes.dedup_report])
def test_repeated_passages(docs, report):
    assert rows_of(report(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(
        brute.substring_report(TEXTS), key=repr
    )


def test_pieces(docs):
    found = pieces.decode(pieces.encode(docs))
    assert rows_of(found, "doc_id", "text") == sorted(
        [(i, t or "") for i, t in TEXTS], key=repr
    )
    assert found.filter("size(ids) > 0").count() == sum(bool(t) for _, t in TEXTS)


@pytest.mark.parametrize(
    "operator",
    [
        lambda docs, labels: importance.selected_of(docs, labels),
        lambda docs, labels: simhash.fingerprints(docs, 3),
        lambda docs, labels: pieces.round_trip(docs),
    ],
)
def test_few_texts_go_to_python_at_a_time(spark, labels, operator):
    def size_of(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        rows = [(i, f"some text {i}", "en", None, None) for i in range(1000)]
        many = spark.createDataFrame(rows, DOCS).coalesce(1)
        made = operator(many, labels)
        sizes = many.select("doc_id").mapInArrow(size_of, "n bigint").collect()
        assert made.count() and sum(r.n for r in sizes) == 1000
        assert max(r.n for r in sizes) <= 256
    finally:
        spark.conf.set(key, before)


def test_simhash(docs):
    found = simhash.close_groups(docs)
    assert same_rows(found, docs)
    got = {(r.doc_id, r.f0 % 2**64) for r in found.collect()}
    assert got == {(i, brute.simhash(t)) for i, t in TEXTS}
    component = {r.doc_id: r.component_id for r in found.collect()}
    assert component[3] == component[4] == component[5] == 3
    assert component[2] == 1


@pytest.mark.parametrize("keep", [simhash.one_of_each, simhash.one_of_similar])
def test_near_copies(docs, keep):
    kept = keep(docs)
    assert kept.columns == docs.columns
    ids = rows_of(kept, "doc_id")
    assert (8,) not in ids and (7,) in ids and ids.count((None,)) == 2


def test_close_copies_go_by_row(spark):
    """Texts of one fingerprint; unrelated ones under the same id, or under none, stay."""
    rows = [
        (1, "a b c d e f g"), (2, "A B c  d e f g"), (2, "something else altogether here"), (2, None), (3, ""),
        (None, "a b c d e f g"), (4, "p q r s t"), (4, "P q r s t"), (5, "u v w x"), (5, "u v w x"),
    ]
    kept = rows_of(simhash.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")), "doc_id", "text")
    fours = [r for r in kept if r[0] == 4]
    assert len(fours) == 1
    stay = [rows[0], rows[2], rows[3], rows[5], rows[8], rows[9]]
    assert [r for r in kept if r[0] != 4] == sorted(stay, key=repr)


def test_toxicity(docs, labels):
    found = toxicity.score(docs, labels)
    assert same_rows(found, docs)
    assert found.filter("score < 0 OR score > 1 OR score IS NULL").isEmpty()


def test_exact_dedup(docs):
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({brute.SPACE.sub(" ", t or "") for _, t in TEXTS})
    assert rows_of(kept.filter("text LIKE 'One%'"), "doc_id") == [(1,)]
    assert rows_of(kept.filter("text IS NULL OR text = ''"), "doc_id") == [(3,)]


def test_exact_dedup_leaves_no_state_open(spark, docs):
    """A store of keyed state lies in a folder of its own until it is closed."""
    exact_dedup.exact_dedup(docs)
    top = spark._jvm.org.apache.spark.util.Utils.getLocalDir(spark._jsc.sc().conf())
    folders = [name for _, names, _ in os.walk(top) for name in names]
    assert not [name for name in folders if name.startswith("StateStoreId")]


def test_contamination(docs, items):
    found = decontaminate.contamination(docs, items)
    wanted = brute.contamination(TEXTS, [(r.item_id, r.text) for r in items.collect()])
    # A null item id is written as the empty string.
    wanted = [(i, n, hit, sorted("" if x == "None" else x for x in got)) for i, n, hit, got in wanted]
    got = [(r.doc_id, r.n_words, r.n_hit, sorted(r["items"])) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    clean = decontaminate.clean_of(docs, items)
    assert clean.columns == docs.columns
    stay = [(i, t) for (i, t), (_, n, hit, _) in zip(TEXTS, wanted, strict=True) if not (hit and 20 * hit >= n)]
    assert rows_of(clean, "doc_id", "text") == sorted(stay, key=repr)


def test_rows_without_id_are_judged_on_their_own(spark, items):
    """Several null ids, and one id with unrelated texts: only the contaminated rows go."""
    item = items.first().text
    rows = [(None, item), (None, "four clean words here"), (None, None), (2, f"x {item}"), (2, "other words"), (2, "other words")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    clean = decontaminate.clean_of(docs, items)
    assert rows_of(clean, "doc_id", "text") == sorted(
        [(None, "four clean words here"), (None, None), (2, "other words"), (2, "other words")], key=repr
    )


def test_unrelated_texts_under_one_id_are_no_near_copies(spark):
    base = [f"w{i}" for i in range(100)]
    near = " ".join(base[:50] + ["changed"] + base[51:])
    rows = [
        (1, " ".join(base)), (2, near), (2, "something else altogether under the same id"), (2, None),
        (3, "short"), (3, near + " end"), (None, near), (4, "p q r s t u v w x y z"), (4, "p q r s t u v w x y z"),
    ]
    kept = simhash.one_of_similar(spark.createDataFrame(rows, "doc_id bigint, text string"))
    # Equal rows are one document; without a doc_id a row is no copy.
    assert rows_of(kept, "doc_id", "text") == sorted(
        [rows[0], rows[2], rows[3], rows[4], rows[6], rows[7], rows[8]], key=repr
    )


def test_url_filter(spark):
    rules = spark.createDataFrame(
        [("net", "/", "block"), ("a.net", "/", "allow"), ("a.net", "/x/", "block"), ("b.a.net", "/", "allow"),
         (None, "/", "block"), ("com", None, "block")],
        "host string, path string, verdict string",
    )
    urls = [
        None, "", "no scheme", "http://net", "http://net/", "http://NET/y?z", "http://a.net/", "http://ba.net/",
        "http://a.net/x/1", "http://q.a.net/x/", "http://b.a.net/x/", "ftp://x.com", "http://xcom/#/",
        "http://a://b", "http://a.net./", "http://ANÉ.net/",
    ]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id int, url string, host string")
    found = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, rules, slices=3).collect()}
    assert len(found) == len(urls)
    expected = {
        4: "net/", 5: "net/", 6: "a.net/", 7: "net/", 8: "a.net/x/", 9: "a.net/x/", 10: "b.a.net/",
        11: "com", 15: "net/",
    }
    assert {i: rule for i, (rule, _) in found.items() if rule} == expected
    assert found[8][1] == found[11][1] == "block" and found[10][1] == found[0][1] == "allow"


def test_empty_tables(spark, none, labels, items):
    assert line_dedup.dedup(none).isEmpty()
    assert importance.resample(none, labels).isEmpty()
    assert importance.selected_of(none, labels).isEmpty()
    assert superkmers.dedup_report(none).isEmpty()
    assert suffixes.dedup_report(none).isEmpty()
    assert pieces.decode(pieces.encode(none)).isEmpty()
    assert simhash.close_groups(none).isEmpty()
    assert simhash.one_of_each(none).isEmpty()
    assert simhash.one_of_similar(none).isEmpty()
    assert toxicity.score(none, labels).isEmpty()
    assert exact_dedup.exact_dedup(none).isEmpty()
    assert decontaminate.contamination(none, items).isEmpty()
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a/b")], "page_id int, url string")
    assert url_filter.judge(pages, rules).first().verdict == "allow"
    assert url_filter.judge(pages.limit(0), rules).isEmpty()


def test_no_benchmark(spark, docs):
    found = decontaminate.contamination(docs, spark.createDataFrame([], ITEMS))
    assert found.filter("n_hit > 0").isEmpty() and found.count() == len(TEXTS)


def test_stages(spark, docs, labels, items, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    assert not found.isEmpty()
    for empty_name, empty in (("documents", docs), ("labels", labels), ("benchmark", items)):
        empty.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/{empty_name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()

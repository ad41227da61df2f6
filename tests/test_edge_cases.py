"""Hand-written XML, one case per rule, taken through scan, parse and typing."""

import random

import pytest
from conftest import END, header, rows_of

from dumptables.operators import valid
from dumptables.plans import stage
from dumptables.session import work_folder
from dumptables.sources import DumpOptions, scan_records

REVISION = (
    "<revision><id>{id}</id><timestamp>2024-01-01T00:00:00Z</timestamp>"
    "<contributor><username>u</username><id>7</id></contributor>"
    '<text bytes="1">t</text></revision>'
)


def page(page_id, inner="", revision=None):
    revision = REVISION.format(id=page_id + 100) if revision is None else revision
    return f"<page><title>T{page_id}</title><ns>0</ns><id>{page_id}</id>{inner}{revision}</page>\n"


CASES = [
    # 1: empty tags are missing values
    "<page><title/><ns>0</ns><id>1</id><revision><id>101</id><comment></comment></revision></page>",
    # 2: hidden text; blanks are text
    page(2, revision='<revision><id>102</id><text deleted="deleted" bytes="3"/></revision>'
                     '<revision><id>152</id><text bytes="1"> </text><comment> </comment></revision>'),
    # 3: author without name
    page(3, revision="<revision><id>103</id><contributor><username/><id>9</id></contributor></revision>"),
    # 4, 5, 6: numbers that are none or do not fit
    "<page><title>T4</title><ns>70000</ns><id>4</id></page>",
    "<page><title>T5</title><ns>0</ns><id>x5</id></page>",
    "<page><title>T6</title><ns>0</ns><id> 6 </id></page>",
    # 7: page without id
    "<page><title>T7</title><ns>0</ns></page>",
    # 8: bad timestamp, 9: bad bytes, 10: bad parent
    page(8, revision="<revision><id>108</id><timestamp>nope</timestamp></revision>"),
    page(9, revision='<revision><id>109</id><text bytes="-">t</text></revision>'),
    page(10, revision="<revision><id>110</id><parentid>p</parentid></revision>"),
    # 11: unclosed revision, neighbours unharmed
    "<page><id>11</id><revision></page>\n",
    # 12: escaped tags in text, entities, several lines, a text that says null
    page(12, revision="<revision><id>112</id><text>&lt;/page&gt; &lt;/revision&gt;\n&amp;amp; &#233;"
                      "</text><comment>null</comment></revision>"),
    # 13: ids of other elements do not count
    page(13, inner="<upload><contributor><id>99</id></contributor></upload>"),
    # 14: last revision without id
    page(14, revision=REVISION.format(id=114) + "<revision><timestamp>2024-01-01T00:00:00Z</timestamp></revision>"),
    # 15: a repeated tag counts by its last non-empty value
    "<page><title>a</title><title>b</title><title/><ns>0</ns><id>15</id>"
    "<revision><id>115</id><comment>x</comment><comment></comment></revision></page>",
    # 16: content wrapper
    page(16, revision="<revision><id>116</id><content><model>m</model><format>f</format>"
                      '<text bytes="2">cc</text></content></revision>'),
    # 17: no revision; 18: self-closed revision
    "<page><title>T17</title><ns>0</ns><id>17</id></page>",
    page(18, revision="<revision/>"),
    # 19: redirect, seconds cut, author by address
    page(19, inner='<redirect title="A &amp; B" />',
         revision="<revision><id>119</id><timestamp>1969-12-31T23:59:59.987Z</timestamp>"
                  "<contributor><ip>1.2.3.4</ip></contributor></revision>"),
    # 20: attributes on the page tag, blanks in values kept
    '<page xml:lang="x"><title> T20 </title><ns>0</ns><id>20</id></page>',
    # 21: revisions in an order that is not by id; the last one counts
    page(21, revision="".join(REVISION.format(id=i) for i in (300, 200, 250))),
    # 22: largest and signed numbers
    "<page><title>T22</title><ns>-2</ns><id>9223372036854775807</id></page>",
    "<page><title>T23</title><ns>0</ns><id>9223372036854775808</id></page>",
]


@pytest.fixture(scope="module")
def cases(spark, tmp_path_factory):
    from conftest import bz2_streams

    path = tmp_path_factory.mktemp("cases")
    chunks = [header(), *["".join(CASES[i : i + 3]) for i in range(0, len(CASES), 3)], END]
    (path / "a.xml.bz2").write_bytes(bz2_streams(*chunks))
    return stage(scan_records(spark, str(path)), work_folder(spark))


def test_pages(cases):
    pages = rows_of(valid(cases.rows("page"), "page"), "id", "ns", "title", "redirect", "revision_id")
    assert pages == sorted(
        [
            (1, 0, None, None, 101),
            (2, 0, "T2", None, 152),
            (3, 0, "T3", None, 103),
            (8, 0, "T8", None, 108),
            (9, 0, "T9", None, 109),
            (10, 0, "T10", None, 110),
            (12, 0, "T12", None, 112),
            (13, 0, "T13", None, 113),
            (14, 0, "T14", None, 114),
            (15, 0, "b", None, 115),
            (16, 0, "T16", None, 116),
            (17, 0, "T17", None, None),
            (18, 0, "T18", None, None),
            (19, 0, "T19", "A & B", 119),
            (20, 0, " T20 ", None, None),
            (21, 0, "T21", None, 250),
            (9223372036854775807, -2, "T22", None, None),
        ],
        key=repr,
    )


def test_revisions(cases):
    rows = valid(cases.rows("revision"), "revision")
    found = {r.id: r for r in rows.collect()}
    assert set(found) == {101, 102, 152, 103, 112, 113, 114, 115, 116, 119, 200, 250, 300}
    assert found[101].comment is None
    assert (found[102].text, found[102].bytes) == (None, 3)
    assert (found[152].text, found[152].comment) == (" ", " ")
    assert found[103].contributor_id == 9
    assert found[112].text == "</page> </revision>\n&amp; é"
    assert found[112].comment == "null"
    assert found[115].comment == "x"
    assert (found[116].model, found[116].format, found[116].text, found[116].bytes) == ("m", "f", "cc", 2)
    assert str(found[119].timestamp) == "1969-12-31 23:59:59"
    assert found[119].contributor_id is None


def test_authors_without_a_number_are_no_contributors(cases):
    rows = valid(cases.rows("contributor"), "contributor").distinct()
    assert rows_of(rows, "id", "username") == [(7, "u"), (9, None)]


def test_rejects_name_the_rule_and_keep_the_source(cases):
    rejected = cases.rows("page").filter("reason IS NOT NULL")
    assert rows_of(rejected, "reason") == [
        ("bad_id",), ("bad_id",), ("bad_id",), ("bad_ns",), ("malformed_xml",), ("no_id",)
    ]
    raw = {r.reason: r.raw for r in rejected.collect()}
    assert raw["malformed_xml"] == "<page><id>11</id><revision></page>"
    assert "70000" in raw["bad_ns"]
    rejected = cases.rows("revision").filter("reason IS NOT NULL")
    assert rows_of(rejected, "reason") == [
        ("bad_bytes",), ("bad_parentid",), ("bad_timestamp",), ("malformed_xml",), ("no_id",), ("no_id",)
    ]


def test_zero_defaults(cases):
    pages = valid(cases.rows("page", zero_defaults=True), "page").filter("id IN (17, 20)")
    assert rows_of(pages, "id", "revision_id") == [(17, 0), (20, 0)]


def test_every_page_is_counted(cases):
    from dumptables.operators import load_totals

    assert load_totals(cases.files).first().pages == len(CASES)


def test_namespaces_and_siteinfo(cases):
    spaces = cases.rows("namespaces")
    assert rows_of(valid(spaces, "namespaces")) == [
        (0, "testwiki", "first-letter", None), (1, "testwiki", "first-letter", "Talk")
    ]
    assert rows_of(spaces.filter("reason IS NOT NULL"), "reason") == [("no_key",)]
    assert rows_of(valid(cases.rows("siteinfo"), "siteinfo")) == [
        ("testwiki", "Site", "http://x/", "g", "first-letter")
    ]


def _staged(spark, path, **options):
    return stage(scan_records(spark, path, DumpOptions(**options)), work_folder(spark))


def test_incomplete_files(spark, write_dump):
    """The cut page and revision are set aside, whole revisions before the cut are kept."""
    cut = "<page><title>C</title><ns>0</ns><id>50</id>" + REVISION.format(id=51) + "\n"
    path = write_dump(
        whole=[header("wa"), page(1), END],
        open_root=[header("wb"), page(1)],
        in_revision=[header("wc"), page(1), cut + "<revision><id>52</id><text>a"],
        between=[header("wd"), page(1), cut],
        in_head=[header("we"), page(1) + "<page><title>C</ti"],
        no_pages=[header("wf"), END],
    )
    found = _staged(spark, path)
    pages = found.rows("page")
    assert rows_of(pages.filter("reason IS NULL"), "dbname", "id") == [
        (f"w{w}", 1) for w in "abcde"
    ]
    assert rows_of(pages.filter("reason IS NOT NULL"), "dbname", "reason") == [
        ("wc", "truncated"), ("wd", "truncated"), ("we", "truncated")
    ]
    revisions = found.rows("revision")
    assert rows_of(revisions.filter("reason IS NULL AND id < 100"), "dbname", "id") == [
        ("wc", 51), ("wd", 51)
    ]
    assert rows_of(revisions.filter("reason IS NOT NULL"), "dbname", "reason") == [("wc", "truncated")]
    from dumptables.operators import pages_per_file

    counts = {r.file_path.split("/")[-1].split(".")[0]: r.pages for r in pages_per_file(found.files).collect()}
    assert counts == {
        "whole": 1, "open_root": 1, "in_revision": 1, "between": 1, "in_head": 1, "no_pages": 0
    }


def test_damaged_file(spark, write_dump, tmp_path):
    """Fails by default; with the skip option the streams before the damage are kept."""
    rng = random.Random(1)
    noise = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(20_000))
    big = page(3, revision=f"<revision><id>103</id><text>{noise}</text></revision>")
    path = write_dump(a=[header(), page(1), page(2), big, END])
    file = tmp_path / "dump" / "a.xml.bz2"
    file.write_bytes(file.read_bytes()[:-5_000])
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        _staged(spark, path)
    kept = _staged(spark, path, skip_corrupt=True).rows("page").filter("reason IS NULL")
    assert (1,) in rows_of(kept, "id")
    assert (3,) not in rows_of(kept, "id")


def test_layouts_of_one_dump_agree(spark, write_dump, tmp_path):
    """Several streams, a single one, gz and plain text give the same tables."""
    import gzip

    chunks = [header(), "".join(page(i) for i in range(1, 30)), page(30), END]
    multi = write_dump("multi", a=chunks)
    single = write_dump("single", a=["".join(chunks)])
    plain, gz = tmp_path / "plain", tmp_path / "gz"
    plain.mkdir(), gz.mkdir()
    (plain / "a.xml").write_text("".join(chunks))
    (gz / "a.xml.gz").write_bytes(gzip.compress("".join(chunks).encode()))
    results = [
        rows_of(valid(_staged(spark, str(p)).rows("page"), "page")) for p in (multi, single, plain, gz)
    ]
    assert len(results[0]) == 30
    assert all(r == results[0] for r in results)


def test_file_choice(spark, write_dump, tmp_path):
    write_dump(a=[header("wa"), page(1), END], b=[header("wb"), page(2), END])
    write_dump("dump/deep", c=[header("wc"), page(3), END])
    path = str(tmp_path / "dump")
    count = lambda **o: scan_records(spark, path, DumpOptions(**o)).select("file_path").distinct().count()
    assert count() == 2
    assert count(glob="a*") == 1
    assert count(recursive=True) == 3

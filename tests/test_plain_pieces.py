"""Plain pieces, whose values are read by a pattern, give what the XML parser gives."""

import random

from pyspark.sql import functions as F

from dumptables.operators import segments
from dumptables.schemas import SEGMENTS

VALUES = [
    "7", "007", "+5", "-1", "99999999999999999999", "x", "a b", "a ", " a", " ", "", "\n a", "a\n", "a\tb",
    "a &amp; b", "&lt;b&gt;", "&amp;lt;", "&quot;q&quot;", "&#65;", "&apos;", "&nbsp;", "&", "a\rb", "a\r\nb", "]]>",
    "a>b", 'a"b', "a'b", "é", " x", "　", " x", "\U0001f600", "�", "￾", "\x01", "\x7f",
    "\x85y", "<!-- c -->a", "<![CDATA[a]]>", "<b>a</b>", "$1", "\\", "2024-01-01T00:00:00Z",
    "2024-01-01T00:00:00.987Z", "2024-13-01T00:00:00Z", "192.0.2.7", "a &amp;amp; &gt;&lt; é&quot; b" * 9,
]
PAGE = ("title", "ns", "id", "redirect")
REVISION = (
    "id", "parentid", "timestamp", "contributor", "minor", "comment", "origin", "model", "format", "text", "sha1",
)


def pieces(count: int, seed: int) -> list[str]:
    """Pieces that differ from a usual one in some ways, if any."""
    draw = random.Random(seed)

    def value(usual: str) -> str:
        return usual if draw.random() < 0.95 else draw.choice(VALUES)

    def gap() -> str:
        return draw.choice(["", "", "\n    ", " ", "\t", "\r\n", "a", "&amp;", "<!-- -->"][: 5 if draw.random() < 0.995 else 9])

    def tag(name: str, usual: str = "7") -> str:
        if name == "redirect":
            return f'<redirect title="{value("Doc 8")}" />'
        if name == "minor":
            return draw.choice(["<minor />", "<minor/>"])
        if name == "contributor":
            author = [f"<username>{value('u')}</username>", gap(), f"<id>{value('3')}</id>", gap()]
            special = ["<ip>192.0.2.7</ip>", "", f"<id>{value('3')}</id>", "".join(author * 2)]
            inside = "".join(author) if draw.random() < 0.8 else draw.choice(special)
            return draw.choice([f"<contributor>{gap()}{inside}</contributor>"] * 9 + ['<contributor deleted="deleted" />'])
        if name == "text":
            start = draw.choice([""] * 6 + [f' bytes="{value("12")}"', ' bytes="12" xml:space="preserve"', ' bytes="1" sha1="ab"',
                                 ' xml:space="preserve" bytes="1"', ' deleted="deleted"', " bytes='3'", ' bytes="1" bytes="2"'])
            return draw.choice([f"<text{start}>{value('a b')}</text>"] * 9 + [f"<text{start} />"])
        if name == "timestamp":
            usual = "2024-01-01T00:00:00Z"
        return draw.choice([f"<{name}>{value(usual)}</{name}>"] * 59 + [f"<{name} />"])

    def some(names: tuple[str, ...]) -> list[str]:
        found = [n for n in names if n == "id" or draw.random() < 0.7]
        if draw.random() < 0.05:
            draw.shuffle(found)
        if draw.random() < 0.05:
            found.append(draw.choice(names))
        return found

    bodies = []
    for _ in range(count):
        revision = "".join(tag(n) + gap() for n in some(REVISION))
        head = "<page>" + gap() + "".join(tag(n) + gap() for n in some(PAGE)) if draw.random() < 0.5 else ""
        whole = f"{gap()}{head}<revision>{gap()}{revision}"
        if draw.random() < 0.05:
            whole = draw.choice([whole + "</page>", whole + "<revision>", whole[:-9], "</page>\n" + whole, whole + "<content/>"])
        bodies.append(whole)
    return bodies


def segments_of(spark, bodies):
    rows = [(body, f"file {i:06}", 0) for i, body in enumerate(bodies)]
    found = spark.createDataFrame(rows, "value string, file_path string, block_start bigint").repartition(8)
    return found, segments.to_segments(found)


def test_the_pattern_gives_what_the_parser_gives(spark, monkeypatch):
    columns = [c for c in SEGMENTS.fieldNames() if c not in ("scan_part", "row_id")]
    bodies = pieces(20_000, 1)
    records, by_pattern = segments_of(spark, bodies)
    found = {(r.file_path, r.seg): r for r in by_pattern.select(columns).collect()}
    plain = segments.with_fields(segments.cut(records)).filter(F.col("fields").isNotNull()).count()
    assert 2500 < plain < 10_000
    monkeypatch.setattr(segments, "PLAIN", r"\A\z")
    wanted = {(r.file_path, r.seg): r for r in segments_of(spark, bodies)[1].select(columns).collect()}
    assert found.keys() == wanted.keys()
    differ = [(bodies[int(k[0][5:])], found[k], wanted[k]) for k in wanted if found[k] != wanted[k]]
    assert not differ, differ[:3]


def test_usual_pieces_are_plain(spark):
    """Those of published dumps, with a head and without."""
    head = "\n  <page>\n    <title>A &amp; B</title>\n    <ns>0</ns>\n    <id>7</id>\n    <redirect title=\"Café\" />\n"
    revision = """    <revision>
      <id>9</id>
      <parentid>8</parentid>
      <timestamp>2024-01-01T00:00:00Z</timestamp>
      <contributor>
        <username>Zoë</username>
        <id>3</id>
      </contributor>
      <minor />
      <comment>c &quot;d&quot;</comment>
      <origin>9</origin>
      <model>wikitext</model>
      <format>text/x-wiki</format>
      <text bytes="25" sha1="ab" xml:space="preserve">'''A''' &lt;b&gt;\n\n[[é]]
 end\n</text>
      <sha1>ab</sha1>\n    """
    long = revision.replace("end", "&lt;br&gt; é " * 100_000)
    records, _ = segments_of(spark, [head + revision, revision, long])
    rows = segments.with_fields(segments.cut(records)).select("fields").collect()
    assert [r.fields is not None for r in rows] == [True, True, True]


def test_numbers_are_digits_alone(spark):
    texts = ["7", "007", "+7", "-7", "-0", "7 ", " 7", "7\n", "7.0", "1e3", "", "٧", "9223372036854775807",
             "9223372036854775808", "7L", "0x7", "\x007", "- 7", "+", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = rows.select("t", segments.strict_long("t").alias("n")).collect()
    digits = lambda t: t is not None and t[:1] + "0" != "0" and t.lstrip("+-").isascii() and t.lstrip("+-").isdigit()
    fits = lambda t: digits(t) and -(2**63) <= int(t) < 2**63
    assert [r.n for r in found] == [int(r.t) if fits(r.t) else None for r in found]

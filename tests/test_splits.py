"""Reading in many splits gives what reading the whole file gives."""

import random
import xml.etree.ElementTree as ET

import pytest
from conftest import END, bz2_streams, header, rows_of

from dumptables.operators import load_totals, valid
from dumptables.plans import stage
from dumptables.session import work_folder
from dumptables.sources import scan_records


def make_chunks(seed):
    """Pages of one to many revisions; one page holds a third of all of them."""
    rng = random.Random(seed)
    pages, next_id = [], 1
    for page_id in range(1, 401):
        n = 400 if page_id == 200 else rng.choice([0, 1, 1, 1, 2, 5])
        revisions = ""
        for _ in range(n):
            body = "".join(rng.choice("abc de&<\n") for _ in range(rng.randint(1, 400)))
            body = body.replace("&", "&amp;").replace("<", "&lt;")
            number = rng.randint(1, 10**9) * 1000 + next_id % 1000
            head = f"<id>{number}</id>" if rng.random() > 0.05 else ""
            revisions += f"<revision>{head}<text>{body}</text></revision>\n"
            next_id += 1
        late = "<upload><timestamp>x</timestamp></upload>" if rng.random() < 0.1 else ""
        pages.append(f"<page><title>T{page_id}</title><id>{page_id}</id>{revisions}{late}</page>\n")
    return [header(), *["".join(pages[i : i + 20]) for i in range(0, len(pages), 20)], END]


def expected(chunks):
    root = ET.fromstring("".join(chunks))
    links, texts = [], []
    for page in root.iter("page"):
        ids = [int(r.find("id").text) for r in page.iter("revision") if r.find("id") is not None]
        links.append((int(page.find("id").text), ids[-1] if ids else None))
        texts += [
            (int(r.find("id").text), r.find("text").text)
            for r in page.iter("revision")
            if r.find("id") is not None
        ]
    return sorted(links, key=repr), sorted(texts, key=repr)


@pytest.mark.parametrize("layout", ["multi", "single", "plain"])
def test_any_split_size(spark, tmp_path, layout):
    chunks = make_chunks(7)
    links, texts = expected(chunks)
    if layout == "plain":
        (tmp_path / "a.xml").write_text("".join(chunks))
    else:
        parts = chunks if layout == "multi" else ["".join(chunks)]
        (tmp_path / "a.xml.bz2").write_bytes(bz2_streams(*parts))
    sizes = {"multi": (3_000, 20_000), "single": (40_000,), "plain": (5_000,)}[layout]
    for size in sizes:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            records = scan_records(spark, str(tmp_path))
            found = stage(records, work_folder(spark))
            splits = found.segments.select("block_start").distinct().count()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        if layout != "single":
            assert splits > 5
        assert rows_of(valid(found.rows("page"), "page"), "id", "revision_id") == links
        assert rows_of(valid(found.rows("revision"), "revision"), "id", "text") == texts
        assert load_totals(found.files).first().pages == 400

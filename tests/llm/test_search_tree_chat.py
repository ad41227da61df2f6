"""Lexical search, the Merkle manifest and chat formatting against plain restatements."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dumptables.llm import chat_format, lexical, merkle

random.seed(11)
DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string"
CLASHING = ("row", "n", "pos", "tree", "digest", "terms", "counts", "item", "rank", "score", "part")


def with_clashes(df):
    return df.withColumns({c: F.lit("x") for c in CLASHING})


# --- search -----------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, k=10):
    """(item_id, rank, doc_id, score) of every item, by scoring everything."""
    split = [(i, terms(t)) for i, t in docs]
    n_docs, length = sum(1 for _, t in split if t), sum(len(t) for _, t in split)
    df = Counter(x for _, t in split for x in set(t))
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, t in split:
            tf = Counter(t)
            m = 25 + 75 * len(t) * n_docs // max(length, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                * (1000000000 * tf[x] // (1000 * tf[x] + 8 * m))
                for x in terms(text) if tf[x]
            )
            if score > 0:
                scores.append((-score, (0, 0) if doc_id is None else (1, doc_id), doc_id))
        out += [(item_id, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def search(spark, docs, items, **more):
    rows = with_clashes(spark.createDataFrame(docs, "doc_id bigint, text string"))
    asked = with_clashes(spark.createDataFrame(items, "item_id bigint, text string"))
    found = lexical.search(rows, asked, **more).select("item_id", "rank", "doc_id", "score")
    return sorted((tuple(r) for r in found.collect()), key=repr)


def invented(n):
    return [f"w{int(random.paretovariate(0.4)) % 300}" for _ in range(n)]


@pytest.mark.parametrize("rows, postings", [(16_384, 10**6), (7, 10**6), (50, 30)])
def test_search_equals_scoring_everything(spark, monkeypatch, rows, postings):
    """Any size of shard, copies with equal scores, and a third of all rows alike."""
    monkeypatch.setattr(lexical, "SHARD_ROWS", rows)
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", postings)
    docs = [(i, " ".join(invented(random.randrange(1, 60)))) for i in range(120)]
    docs += [(1000 + i, docs[5][1]) for i in range(60)]
    random.shuffle(docs)
    items = [(i, " ".join(invented(12))) for i in range(15)] + [(99, docs[5][1])]
    assert search(spark, docs, items) == ranked(docs, items)


def test_search_edges(spark):
    """Null and empty texts and ids, repeated rows and ids, long texts, unknown terms."""
    docs = [
        (1, None), (2, ""), (3, " ,;\n"), (4, "Été ÀB naïve"), (4, "Été ÀB naïve"),
        (None, "one two"), (None, "one two"), (5, "one two"), (6, "ONE " * 30_000 + "two"),
    ]
    items = [(1, "one two one"), (1, "two"), (2, None), (3, ""), (None, "naïve ÉTÉ"), (4, "zzz")]
    found = search(spark, docs, items)
    assert found == ranked(docs, items) and len(found) > 8
    assert search(spark, docs, items, k=2) == ranked(docs, items, 2)
    assert search(spark, [], items) == [] and search(spark, docs, []) == []


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_BYTES", 40)
    docs = [(i, " ".join(invented(20))) for i in range(40)]
    items = [(i, " ".join(invented(6))) for i in range(10)]
    assert search(spark, docs, items) == ranked(docs, items)


def test_intervals_are_left_unsplit():
    """The search scores few documents where one stands out."""
    n = 4000
    sizes = [2] * n
    given = [[0, 1]] * n
    given[1234], sizes[1234] = [0, 1, 2], 3
    shard_terms = lexical.np.array([t for x in given for t in x], lexical.np.int32)
    counts = lexical.np.ones(len(shard_terms), lexical.np.int32)
    ids = lexical.np.arange(n)
    shard = lexical.Shard(
        ids, lexical.np.array(sizes), shard_terms, counts, 3, lexical.np.array([1, 1, 5000]),
        lexical.np.full(n, 100),
    )
    looked_up = []
    highest = shard.highest
    shard.highest = lambda a, b: looked_up.append(len(a)) or highest(a, b)
    query = lexical.np.array([0, 1, 2]), lexical.np.array([1, 1, 1])
    assert shard.search(*query, [], 1)[0][1] == 1234
    assert sum(looked_up) < 10


# --- manifest ---------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves):
    """Root, and for each leaf the siblings on its way as (left, right)."""
    ways, nodes = [[] for _ in leaves], [(x, [i]) for i, x in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for i in range(0, len(nodes), 2):
            pair = nodes[i : i + 2]
            for j, (_, below) in enumerate(pair):
                other = pair[1 - j][0] if len(pair) == 2 else ""
                for leaf in below:
                    ways[leaf].append((other, "") if j else ("", other))
            above.append((sha("".join(x for x, _ in pair)), [y for _, b in pair for y in b]))
        nodes = above
    return nodes[0][0], ways


def fold(leaf, way):
    for left, right in way:
        leaf = sha(left + leaf + right)
    return leaf


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def plain_manifest(docs, touched):
    by_lang = {}
    for doc_id, source, lang, n_chars, text in docs:
        leaf = sha("".join(map(field, (doc_id, source, lang, n_chars, text))))
        new = None
        if touched(doc_id):
            more = None if n_chars is None else n_chars + 1
            new = sha("".join(map(field, (doc_id, source, lang, more, text))))
        key = (lang is not None, (lang or "").encode())
        by_lang.setdefault(key, []).append(((doc_id is not None, doc_id or 0), leaf, new, doc_id))
    langs = sorted(by_lang)
    parts = {k: sorted(by_lang[k], key=lambda r: r[:2]) for k in langs}
    trees = {k: tree([r[1] for r in parts[k]]) for k in langs}
    root, over = tree([trees[k][0] for k in langs]) if langs else ("", [])
    out = []
    for i, k in enumerate(langs):
        for (_, leaf, new, doc_id), way in zip(parts[k], trees[k][1], strict=True):
            whole = way + over[i]
            proof = sha("".join(x + y for x, y in whole))
            out.append((doc_id, leaf, trees[k][0], root, proof, fold(new or leaf, whole)))
    return sorted(out, key=repr)


def made_manifest(spark, docs, bits):
    rows = with_clashes(spark.createDataFrame(docs, DOCS))
    touched = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    found = merkle.manifest(rows, {"n_chars": F.col("n_chars") + 1}, touched, bits)
    return [
        (r.doc_id, r.leaf, r.subroot, r.root, sha("".join(x + y for x, y in r.path)), r.version[-1])
        for r in found.collect()
    ]


def tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


@pytest.mark.parametrize("bits", [1, 2, 8])
def test_manifest(spark, bits):
    """Blocks of any size; null and odd languages, null fields, ties, repeated rows, long texts."""
    docs = [(i, "s", "en", i, f"text {i}") for i in range(37)]
    docs += [(i, None, "de", None, None) for i in range(100, 109)]
    docs += [(200, "s", None, 3, "abc"), (201, "s", None, 3, ""), (None, "s", "fr", 1, "x")]
    docs += [(300, "s", "Été", 1, "é"), (7, "s", "en", 1, "same id"), (8, "s", "en", 8, "text 8")]
    docs += [(301, "s", "-", 1, "word " * 50_000), (302, "s", "", 0, "empty name")]
    found = made_manifest(spark, docs, bits)
    assert sorted(found, key=repr) == plain_manifest(docs, tampered)
    verified = {r[0]: r[5] == r[3] for r in found}
    assert not any(verified[i] for i in range(37) if tampered(i))
    assert all(ok for i, ok in verified.items() if not tampered(i) or 100 <= (i or 0) < 109)


def test_manifest_of_little(spark):
    assert made_manifest(spark, [], 8) == []
    docs = [(21, "s", "en", 1, "x")]
    assert made_manifest(spark, docs, 8) == plain_manifest(docs, tampered)


def test_versions_share_all_but_ancestors(spark):
    """A version holds its leaf and one node for each level above it."""
    docs = [(i, "s", "en", i, f"text {i}") for i in range(20)]
    rows = spark.createDataFrame(docs, DOCS)
    found = merkle.manifest(rows, {"text": F.lit("forged")}, F.col("doc_id") == 3, 2).collect()
    assert {len(r.version) for r in found} == {6}
    plain = {x for r in found if r.doc_id != 3 for x in r.version}
    forged = next(r for r in found if r.doc_id == 3)
    assert not plain & set(forged.version) and forged.version[-1] != forged.root


# --- chats ------------------------------------------------------------------------------

SAID = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"),
    (2, 0, "user", "</s>[INST] ok [/INST]"), (2, 1, "assistant", "\\e \\b \\ [TEXT]<s>[/ROLE]\\"),
    (3, 0, "assistant", "first"), (3, 1, "assistant", ""), (3, 2, "user", None),
    (4, 0, "[TEXT] tool\\", "a [ROLE] [TEXT] b"), (4, 1, None, "no name"), (4, 2, "", "  "),
    (None, 5, "user", "nobody's"), (5, None, "user", "x"), (5, 1, "assistant", "\n[/INST]\n</s>"),
    (6, 0, "user", "same"), (6, 0, "user", "same"), (6, 0, "assistant", "tie"),
    (7, 0, "user", "wort " * 60_000 + "[INST]"), (7, 1, "assistant", "été 😀 [/SYS"),
    (8, 0, "user", "ends in ["), (8, 1, "assistant", "/INST] <"), (8, 2, "user", "/s> <</s>>"),
]
CHATS = "conv_id bigint, turn bigint, role string, text string"


def chats(spark, said):
    rows = with_clashes(spark.createDataFrame(said, CHATS))
    made = chat_format.format_chats(rows)
    made = made.withColumn("turns", chat_format.read_back(F.col("formatted")))
    made = made.withColumn("learnt", chat_format.learnt_text(F.col("segments")))
    return {r.conv_id: r for r in made.collect()}


def test_chats_round_trip(spark):
    found = chats(spark, SAID)
    assert len(found) == 9
    for conv_id, row in found.items():
        own = [(t is not None, t or 0, r or "", x or "") for c, t, r, x in SAID if c == conv_id]
        wanted = [(r, x) for _, _, r, x in sorted(own)]
        assert [tuple(t) for t in row.turns] == wanted
        assert row.learnt == "".join(x for r, x in wanted if r == "assistant")
        assert "".join(s.text for s in row.segments) == row.formatted
        for control in chat_format.INSTRUCT.controls:
            assert all(control not in s.text for s in row.segments[2::3])
        assert [s.loss for s in row.segments[2::3]] == [r == "assistant" for r, _ in wanted]


def test_order_of_turns(spark):
    found = chats(spark, SAID)
    state = {c: (r.valid, r.complete, r.end_state) for c, r in found.items()}
    assert state[1] == state[2] == state[5] == (True, True, "answered")
    assert state[3] == state[4] == state[6] == (False, False, "stuck")
    assert state[8] == state[None] == (True, False, "asked")


def test_no_chats(spark):
    assert chats(spark, []) == {}


def test_templates_that_cannot_be_read_back():
    same = chat_format.Role("a", "[A] ", "[Z]"), chat_format.Role("b", "[B] ", "[Z]")
    nested = (chat_format.Role("a", "[A] ", "[[A]"),)
    for roles in (same, nested):
        with pytest.raises(ValueError, match="mark|control"):
            chat_format.Template("<s>", roles, ("[R]", "[T]", "[/R]"), (), "start", ())


# --- pieces -----------------------------------------------------------------------------


def test_one_pass_equals_two(spark, monkeypatch):
    """Also where words are forgotten all the time."""
    from dumptables.llm import pieces

    texts = [None, "", "  ", "two words", "été 😀\n\nx", "w" * 3000, " ".join(map(str, range(4000)))]
    docs = with_clashes(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    two = sorted(tuple(r) for r in pieces.decode(pieces.encode(docs)).collect())
    monkeypatch.setattr(pieces, "CACHED", 1000)
    assert sorted(tuple(r) for r in pieces.round_trip(docs).collect()) == two
    assert [t for _, _, t in two] == [t or "" for t in texts]


def test_what_an_encoder_remembers_is_bounded(monkeypatch):
    from dumptables.llm import pieces

    monkeypatch.setattr(pieces, "CACHED", 200_000)
    encoder = pieces.Encoder(pieces.load(pieces.MODEL))
    for k in range(60):
        list(encoder.encode([" ".join(f"w{k}x{i}" for i in range(500)).encode()]))
        assert encoder.size < 200_000 + 500 * 400

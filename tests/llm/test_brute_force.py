"""Operators that SQL cannot state, against plain restatements or held-out labels."""

import math
import os
import random
import re
import zlib

import corpus_pipeline
import pytest
import sentencepiece
from pyspark.sql import functions as F

from dumptables.llm import exact_dedup, importance, passages, pieces, queries, simhash, suffixes, superkmers
from dumptables.llm.components import components

from . import brute

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")


def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return [tuple(r) for r in rows.collect()]


@needs_tables
def test_simhash_query(spark):
    found = {r.doc_id: r for r in queries.op5_simhash(spark, SMALL).collect()}
    docs = texts(spark, SMALL)
    bits = {i: brute.simhash(t) for i, t in docs}
    ids = sorted(bits)
    close = [(a, b) for a in ids for b in ids if a < b and (bits[a] ^ bits[b]).bit_count() <= 2]
    component = brute.groups_of(ids, close)
    assert {i: r.fingerprint for i, r in found.items()} == {i: f"{b:016x}" for i, b in bits.items()}
    assert {i: r.component_id for i, r in found.items()} == component


@pytest.mark.parametrize("paired", [64, 2])
def test_crowded_fingerprints_lose_no_link(spark, paired, monkeypatch):
    """Pairs and neighbours connect alike."""
    monkeypatch.setattr(simhash, "PAIRED", paired)
    random.seed(3)
    base = [random.getrandbits(64) for _ in range(5)]
    values = {b ^ sum(1 << i for i in random.sample(range(64), k)) for b in base for k in (0, 1, 1, 2, 3) for _ in range(12)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    classes = spark.createDataFrame([(v,) for v in signed], "f0 bigint")
    links = [tuple(r) for r in simhash.close_links(classes).collect()]
    near = lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 2
    assert all(near(a, b) for a, b in links)
    every = [(a, b) for a in signed for b in signed if a < b and near(a, b)]
    assert brute.groups_of(signed, links) == brute.groups_of(signed, every)


@pytest.mark.parametrize("pivots", [32, 3])
def test_near_copies_in_large_groups(spark, pivots, monkeypatch):
    """Forty near copies of one text and twenty unrelated texts."""
    monkeypatch.setattr(simhash, "PIVOTS", pivots)
    random.seed(4)
    word = lambda: f"w{random.randrange(10**6)}"
    base = [word() for _ in range(400)]
    rows = []
    for i in range(40):
        copy = list(base)
        for at in random.sample(range(400), 3):
            copy[at] = word()
        rows.append((i, " ".join(copy)))
    rows += [(100 + i, " ".join(word() for _ in range(300))) for i in range(20)]
    kept = simhash.one_of_similar(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [0, *range(100, 120)]


def test_components(spark):
    random.seed(5)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(200)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(60)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    ids = {x for a, b in links if a != b for x in (a, b)}
    assert found == brute.groups_of(ids, [(a, b) for a, b in links if a != b])


@needs_tables
def test_suffix_query(spark):
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op6_suffix_array_dedup(spark, SMALL).collect()}
    assert found == {
        i: (n, gone, sha) for i, n, gone, sha in brute.substring_report(texts(spark, SMALL))
    }


def test_dealt_windows_equal_sorted_ones(spark, monkeypatch):
    random.seed(6)
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(i, " ".join(f"w{random.randrange(999)}" for _ in range(30)) + f" {passage} end{i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    wanted = sorted(brute.substring_report(rows))
    for crowded in (100_000, 1):
        monkeypatch.setattr(superkmers, "CROWDED", crowded)
        found = superkmers.dedup_report(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
        assert sorted(tuple(r) for r in found.collect()) == wanted


def test_windows_under_one_hash_are_told_apart(monkeypatch):
    strings = [(b"a b c", 1, 1), (b"b c d", 2, 2), (b"x b c", 3, 3)]
    true = superkmers._first_documents(strings, 2)
    monkeypatch.setattr(superkmers.xxhash, "xxh64_intdigest", lambda *_: 7)
    assert superkmers._first_documents(strings, 2) == true == [[None, 1], [1, None], [None, 1]]


@pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="the vocabulary is not here")
def test_pieces_are_the_best_of_the_lattice():
    """Words against the library, with the model read as a unigram one."""
    vocabulary = pieces.load()
    with open(pieces.MODEL, "rb") as file:
        model = file.read() + bytes([0x12, 2, 0x18, 1])  # trainer_spec.model_type = UNIGRAM
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    random.seed(7)
    words = ["".join(random.choice("theinrsa éü語🎉.") for _ in range(random.randint(1, 9))).strip() for _ in range(400)]
    words = [w for w in words if w]
    found = list(pieces.Encoder(vocabulary).encode(w.encode() for w in words))
    score = lambda ids: sum(library.get_score(int(i)) for i in ids if not library.is_byte(int(i)))
    for word, ids in zip(words, found, strict=True):
        best = library.nbest_encode_as_ids(word, 2)[0]
        assert ids.tolist() == best or score(ids) == score(best), word
        assert pieces.decode_ids(ids.tolist(), vocabulary).decode() == word


@needs_tables
def test_pieces_round_trip(spark):
    found = queries.op4_sentencepiece(spark, SMALL)
    wanted = {(i, brute.sha((t or "").replace("▁", " "))) for i, t in texts(spark, SMALL)}
    assert {(r.doc_id, r.decoded_sha256) for r in found.collect()} == wanted


def test_parts_of_long_texts_encode_like_the_whole(monkeypatch):
    vocabulary = pieces.load()
    text = ("some words  with   blanks\nand lines " * 300).encode()
    whole = next(pieces.Encoder(vocabulary).encode([text])).tolist()
    monkeypatch.setattr(pieces, "PART", 100)
    assert next(pieces.Encoder(vocabulary).encode([text])).tolist() == whole


def plain_ngrams(text, buckets):
    tokens = [zlib.crc32(t.encode()) for t in re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+|[^\sA-Za-z0-9\u0080-\U0010ffff]+", re.sub("[0-9]+", "0", text), re.ASCII)]
    for a in tokens:
        yield a % buckets
    for a, b in zip(tokens, tokens[1:], strict=False):
        mixed = (a * 0x9E3779B97F4A7C15 + b) % 2**64
        yield 0 if a == b else (mixed ^ (mixed >> 31)) % buckets


def plain_choice(weights, labels, held_out):
    """The cut between labelled bad documents and good ones that are no target text."""
    good = {weights[i] for i, q in labels.items() if q == 1 and i in weights and i in held_out}
    bad = {weights[i] for i, q in labels.items() if q == 0 and i in weights}
    both = sorted(good | bad)
    gain = lambda c: sum(w < c for w in bad) / len(bad) - sum(w < c for w in good) / len(good)
    best = max(both, key=lambda c: (round(gain(c), 9), -c))
    return (best + max(w for w in both if w < best)) / 2


@needs_tables
def test_importance_query(spark):
    """Weights and choice, from counts made in plain Python."""
    docs = texts(spark, SMALL)
    table = spark.read.parquet(f"{SMALL}/labels.parquet")
    labels = {r.doc_id: r.quality for r in table.collect()}
    held_out = {r.doc_id for r in table.filter(importance.held_out()).collect()}
    assert 0 < len(held_out) < len(labels) / 2
    raw, target = [0] * importance.BUCKETS, [0] * importance.BUCKETS
    grams, wanted = {}, {}
    for i, text in docs:
        grams[i] = list(plain_ngrams(text, importance.BUCKETS))
        wanted[text] = wanted.get(text, False) or (labels.get(i) == 1 and i not in held_out)
    for text, chosen in wanted.items():
        for g in plain_ngrams(text, importance.BUCKETS):
            raw[g] += 1
            target[g] += chosen
    share = lambda counts: [math.log((c + 1) / (sum(counts) + len(counts))) for c in counts]
    ratio = [a - b for a, b in zip(share(target), share(raw), strict=True)]
    found = queries.op2_importance_resampling(spark, SMALL).collect()
    for r in found:
        assert math.isclose(r.log_weight, sum(ratio[g] for g in grams[r.doc_id]), abs_tol=1e-6)
    weights = {r.doc_id: r.log_weight for r in found}
    cut = plain_choice(weights, labels, held_out)
    k = sum(w >= cut for w in weights.values())
    ranked = sorted((r.sampled for r in found), reverse=True)
    assert {r.doc_id for r in found if r.selected} == {r.doc_id for r in found if r.sampled >= ranked[k - 1]}


@needs_tables
def test_copies_do_not_shift_the_quality_model(spark):
    """One clean document copied until a third of all rows: no copy goes, the bad ones do."""
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    good = docs.join(labels.filter("quality = 1"), "doc_id").filter("length(text) > 500")
    text = good.orderBy("doc_id").first().text
    copies = spark.range(10**6, 10**6 + docs.count() // 2).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    plain = {r.doc_id: r.log_weight for r in importance.resample(docs, labels).collect()}
    found = importance.resample(docs.union(copies), labels).collect()
    assert all(r.selected for r in found if r.doc_id >= 10**6)
    assert all(math.isclose(r.log_weight, plain[r.doc_id], abs_tol=1e-6) for r in found if r.doc_id in plain)
    kept = {r.doc_id for r in found if r.selected}
    bad, clean = ({r.doc_id for r in labels.collect() if r.quality == q} & set(plain) for q in (0, 1))
    assert len(bad - kept) >= 0.9 * len(bad)
    assert len(clean & kept) >= 0.97 * len(clean)
    stay = importance.selected_of(docs.union(copies), labels)
    assert sorted(r.doc_id for r in stay.collect()) == sorted(kept)


def test_buckets_grow_with_the_texts():
    sizes = [importance.buckets_for(n) for n in (0, 1000, 10**5, 10**8, 10**11)]
    assert sizes[0] == sizes[1] == importance.BUCKETS
    assert sizes[1] < sizes[2] < sizes[3] < sizes[4] < 5 * 10**6


def test_kth_largest(spark):
    random.seed(8)
    values = [random.choice([random.gauss(0, 1), 0.5, -1e6]) for _ in range(3000)]
    table = spark.createDataFrame([(v,) for v in values], "v double")
    ranked = sorted(values, reverse=True)
    for k in (1, 7, 1500, 2999, 3000, 4000):
        assert importance.kth_largest(table, "v", k, few=20) == ranked[min(k, 3000) - 1]


@needs_tables
def test_toxicity_on_held_out_documents(spark):
    found = {r.doc_id: r for r in queries.op7_toxicity(spark, MIDDLE).collect()}
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    held = [(found[r.doc_id].score, r.toxic) for r in labels if found[r.doc_id].held_out]
    bad, good = [s for s, t in held if t], [s for s, t in held if not t]
    ahead = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert ahead > 0.6  # some thirty toxic documents to learn from; over 0.95 at full size


def test_state_goes_on_with_later_documents(spark, tmp_path):
    """A second run on the same state finds copies of what the first one saw."""
    first, second = f"{tmp_path}/in/1.parquet", f"{tmp_path}/in/2.parquet"
    schema = "doc_id bigint, text string"
    spark.createDataFrame([(5, "a  b"), (6, "c")], schema).coalesce(1).write.parquet(first)
    stream = lambda: exact_dedup.arrivals(
        spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    )
    state, hits = f"{tmp_path}/state", f"{tmp_path}/hits"
    exact_dedup.register(stream(), state, hits)
    spark.createDataFrame([(4, "a b"), (7, "d")], schema).coalesce(1).write.parquet(second)
    exact_dedup.register(stream(), state, hits)
    found = exact_dedup.read_hits(spark, hits, "bigint").collect()
    assert [(r.keep_id, r.n, r.digest.hex()) for r in found] == [(4, 2, brute.sha("a b"))]
    assert "2.parquet" in found[0].keep_locator.file_path


def test_sliding_min():
    import numpy as np

    values = np.random.default_rng(1).integers(0, 99, 200).astype(np.uint64)
    for width in (1, 2, 3, 18, 43, 200):
        wanted = [min(values[i : i + width]) for i in range(200 - width + 1)]
        assert passages.sliding_min(values, width).tolist() == wanted


@needs_tables
def test_pipeline(spark):
    """Each stage against its promise on what it was given."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        before = kept[-1][1]
        after = corpus_pipeline.written(stage(spark, before, SMALL), "out")
        if name != "SentencePiece":
            assert after.schema == before.schema
            assert after.exceptAll(before).isEmpty()
        kept.append((name, after))
    rows = {name: {r.doc_id: r for r in df.collect()} for name, df in kept}
    selected = queries.op2_importance_resampling(spark, SMALL).filter("selected").collect()
    assert set(rows["quality classifier"]) == {r.doc_id for r in selected}
    smallest = {}
    for i, r in sorted(rows["quality classifier"].items()):
        smallest.setdefault(brute.SPACE.sub(" ", r.text), i)
    assert set(rows["exact dedup"]) == set(smallest.values())
    bits = {i: brute.simhash(r.text) for i, r in rows["exact dedup"].items()}
    close = [(a, b) for a in bits for b in bits if a < b and (bits[a] ^ bits[b]).bit_count() <= 2]
    left = sorted(set(brute.groups_of(sorted(bits), close).values()))
    assert sorted(rows["SimHash near-dedup"]) == left
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    report = brute.contamination([(i, rows["exact dedup"][i].text) for i in left], items)
    clean = {i for i, n, hit, _ in report if not (hit and 20 * hit >= n)}
    assert set(rows["benchmark decontamination"]) == clean == set(rows["SentencePiece"])
    assert corpus_pipeline.run(spark, SMALL).select(F.count("*")).first()[0] == len(clean)


def test_near_copies_are_those_of_the_similarity(spark):
    """Pairs just over Jaccard 0.8 lose one, long and short; pairs at 0.6 to 0.79 keep both."""
    random.seed(12)
    word = lambda: f"w{random.randrange(10**6)}"
    shingles = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    rows, near = [], {}
    for i in range(400):
        n = random.choice([9, 12, 40, 150])
        lowest, highest = (0.8, 0.84) if i % 2 else (0.6, 0.8)
        base = [word() for _ in range(n)]
        while True:
            copy = list(base)
            for at in random.sample(range(n), random.randint(0, max(1, n // 20))):
                copy[at] = word()
            copy += [word() for _ in range(random.randint(0, max(1, n // 6)))]
            a, b = shingles(base), shingles(copy)
            similarity = len(a & b) / len(a | b)
            if lowest <= similarity < highest:
                break
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
        near[2 * i + 1] = similarity >= 0.8
    # One shingle fills most of these texts and decides all bits of a fingerprint that counts it.
    rows += [(1000 + i, "a " * 60 + " ".join(word() for _ in range(30))) for i in range(4)]
    kept = simhash.one_of_similar(spark.createDataFrame(rows, "doc_id bigint, text string"))
    gone = {i for i, _ in rows} - {r.doc_id for r in kept.collect()}
    assert gone == {i for i, close in near.items() if close}


@pytest.mark.parametrize("crowd", [1000, 60, 1])
def test_suffixes_with_a_hot_core(spark, monkeypatch, crowd):
    """Pairs that share 10 + 49 words, of which all documents share the 49."""
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    random.seed(13)
    word = lambda: f"w{random.randrange(10**6)}"
    core = [f"c{i}" for i in range(49)]
    rows = []
    for i in range(100):
        lead = [word() for _ in range(10)]
        for k in range(2):
            before, after = ([word() for _ in range(20)] for _ in range(2))
            rows.append((i + 100 * k, " ".join(before + lead + core + after)))
    random.shuffle(rows)
    found = suffixes.dedup_report(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = found.select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(tuple(r) for r in found.collect()) == sorted(brute.substring_report(rows))


@pytest.mark.parametrize("crowd", [1000, 1])
def test_suffixes_of_edited_copies(spark, monkeypatch, crowd):
    """Few different words, so that places tie, and copies with words changed, lost and added."""
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    random.seed(17)
    base = [[f"b{random.randrange(40)}" for _ in range(160)] for _ in range(4)]
    rows = []
    for i in range(60):
        words = list(random.choice(base))[random.randrange(30) :]
        for _ in range(random.randrange(4)):
            words[random.randrange(len(words))] = f"x{random.randrange(3)}"
        del words[random.randrange(60, 120)]
        rows.append((i % 50, " ".join(words)))
    rows += [(90, "same " * 400), (91, "same " * 49), (92, "same " * 50), (93, None)]
    found = suffixes.dedup_report(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = found.select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(tuple(r) for r in found.collect()) == sorted(brute.substring_report(rows))

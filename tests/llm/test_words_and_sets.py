"""Word hashes, near copies, substring dedup and quality counts against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bazaarlake.llm import bytewords, jaccard_join, quality_rules, substring_dedup
from bazaarlake.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, sig long, n int, row string, text_key string, hit_id long"


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def some_texts(seed, n=60, vocabulary=400):
    """Texts with exact copies, near copies, shared passages, repeated words, nothing and odd white space."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdeéßx") + str(rng.randrange(vocabulary))
    passage = [word() for _ in range(40)]
    texts = [None, "", "   \n\t ", "one", "one", "One two three", "a b c\x0bd\x1ce", "z " * 300, "word " * 30]
    while len(texts) < n:
        kind = rng.random()
        if kind < 0.4 or len(texts) < 14:
            words = [word() for _ in range(rng.randrange(1, 120))]
        elif kind < 0.6:
            words = (rng.choice(texts[9:]) or "").split()
            for _ in range(rng.randrange(0, 4)):
                if words:
                    words[rng.randrange(len(words))] = word()
        elif kind < 0.8:
            words = [word() for _ in range(rng.randrange(0, 30))] + passage + [word() for _ in range(rng.randrange(0, 30))]
        else:
            words = (rng.choice(texts[9:]) or "x").split()
        texts.append(rng.choice([" ", "  ", "\n"]).join(words))
    return texts


def frame(spark, texts, ids=None):
    ids = ids if ids is not None else range(len(texts))
    return spark.createDataFrame([(i, t, 1, 2, "x", "y", 3) for i, t in zip(ids, texts, strict=True)], SCHEMA)


def test_word_hashes_tell_words_apart():
    texts = some_texts(1)
    w = bytewords.words(pa.array(texts), lower=True)
    expected = [WORD.findall(ascii_lower(t)) for t in texts]
    assert w.count.tolist() == [len(x) for x in expected]
    of = defaultdict(set)
    for word, h in zip((x for words in expected for x in words), w.hashes().tolist(), strict=True):
        of[word].add(h)
    assert all(len(x) == 1 for x in of.values()) and len({min(x) for x in of.values()}) == len(of)


def twins(n):
    """A Thue-Morse word of n bytes and its complement: equal under any polynomial hash modulo 2^64 from 1024 bytes on."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [8, 16, 64, 65, 1024, 2048])
def test_word_hashes_tell_twins_apart(n):
    a, b = twins(n)
    w = bytewords.words(pa.array([f"{a} {b} {a}", b, "x" * 63 + " " + "x" * 64, "x" * 65]))
    for which in (0, 1):
        h = w.hashes(which).tolist()
        assert h[0] == h[2] and h[1] == h[3] and len(set(h)) == 5
    assert not set(w.hashes(0).tolist()) & set(w.hashes(1).tolist())


def test_twin_words_are_different_words(spark):
    a, b = twins(2048)
    rest = [f"w{i}" for i in range(12)]
    texts = [" ".join([a, *rest]), " ".join([b, *rest])]
    removed = substring_dedup.substring_dedup(frame(spark, texts)).select("doc_id", "n_removed").collect()
    assert sorted(map(tuple, removed)) == [(0, 0), (1, 0)]
    few = [" ".join([a, "b", "c", "d", "e", "f"]), " ".join([b, "b", "c", "d", "e", "f"])]
    linked = jaccard_join.jaccard_join(frame(spark, few)).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, linked)) == [(0, 0), (1, 1)]
    repeats = " ".join([a, "x", "y", b, "x", "y"])
    counted = quality_rules.quality_rules(frame(spark, [repeats]), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert counted.select("n_repeat_words").first()[0] == 0


def test_windows_stay_in_their_text():
    texts = some_texts(2)
    w = bytewords.words(pa.array(texts))
    begin, key = bytewords.windows(w, w.hashes(), 3)
    flat = [x for t in texts for x in WORD.findall(t or "")]
    assert len(begin) == sum(max(0, n - 2) for n in w.count)
    assert len(set(key.tolist())) == len({tuple(flat[b : b + 3]) for b in begin})


def test_slices_hold_every_row():
    batch = pa.record_batch([pa.array(["a" * 5, None, "b" * 50, "", "c"])], ["text"])
    parts = list(bytewords.slices(batch, limit=10))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist() and len(parts) > 1


def shingles_of(text):
    words = WORD.findall(ascii_lower(text))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def roots(n, links):
    above = list(range(n))

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for i, j in links:
        x, y = sorted((root(i), root(j)))
        above[y] = x
    return [root(i) for i in range(n)]


def brute_components(texts):
    sets = [shingles_of(t) for t in texts]
    links = [
        (i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a and b and 100 * len(a & b) >= 80 * len(a | b)
    ]
    return [(i, len(s), r) for i, (s, r) in enumerate(zip(sets, roots(len(sets), links), strict=True))]


@pytest.mark.parametrize(("seed", "block"), [(3, 4_000_000), (4, 150)])
def test_near_copies_equal_brute_force(spark, seed, block):
    """A small block size makes the search cut its blocks and search what is left against all chunks."""
    texts = some_texts(seed, n=90, vocabulary=60)
    found = jaccard_join.jaccard_join(frame(spark, texts), block)
    rows = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())
    assert rows == brute_components(texts)


def test_a_cut_block_of_near_copies_is_one_component(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for _ in range(60):
        words = list(base)
        words[rng.randrange(80)] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    found = jaccard_join.jaccard_join(frame(spark, texts), 600)
    assert [r.component_id for r in found.orderBy("doc_id").collect()] == [x[2] for x in brute_components(texts)]


def test_a_cut_block_of_unlinked_sets_is_searched_in_bounded_parts(spark, monkeypatch):
    """A passage common to all makes one block; hardly any of its sets are linked, so nearly all ask."""
    rng = random.Random(12)
    passage = [f"p{i}" for i in range(40)]
    texts = [" ".join(passage + [f"v{rng.randrange(10**6)}" for _ in range(40)]) for _ in range(100)]
    texts += [f"{t} end" for t in texts[:20]]
    block, largest, search = 1500, [], jaccard_join.searched

    def watched(rows):
        place = [c for c in rows.columns if c in ("block", "chunk", "slice")]
        held = Counter()
        for r in rows.select(*place, "text").collect():
            held[tuple(r[c] for c in place)] += len(shingles_of(r.text))
        largest.append(max(held.values()))
        return search(rows)

    monkeypatch.setattr(jaccard_join, "searched", watched)
    found = jaccard_join.jaccard_join(frame(spark, texts), block)
    rows = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())
    assert rows == brute_components(texts)
    # chunk and slice are dealt by hash, so either may be somewhat above the block size
    assert len(largest) == 2 and max(largest) < 4 * block < sum(len(shingles_of(t)) for t in texts)


def test_divide_skip_finds_what_brute_force_finds():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))) for _ in range(80)]
    sets += [np.setdiff1d(s, s[:1]) if len(s) > 1 else s for s in sets[:30]]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                links.append((i, j))
    found = jaccard_join.divide_skip(sets, np.ones(len(sets), bool))
    assert {tuple(sorted(x)) for x in found} <= {tuple(sorted(x)) for x in links}
    assert roots(len(sets), found) == roots(len(sets), links)


def test_near_copies_with_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(20))
    docs = frame(spark, [text, text, text, None, "", text], [7, 7, None, 3, None, 5])
    rows = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(docs).collect()}
    assert rows == {(7, 16, 5), (None, 16, 5), (5, 16, 5), (3, 0, 3), (None, 0, None)}
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in kept.collect()) == [(False, 0, ""), (True, 3, ""), (True, 5, text)]


def test_one_of_each_keeps_one_of_repeated_rows(spark):
    docs = frame(spark, ["a b c d e f", "a b c d e f", "x", "x", None, None], [1, 1, 2, 3, 4, 4])
    assert sorted(r.doc_id for r in jaccard_join.one_of_each(docs).collect()) == [1, 2, 4]


def test_empty_tables(spark):
    none = frame(spark, [])
    assert jaccard_join.jaccard_join(none).count() == 0
    assert jaccard_join.one_of_each(none).columns == none.columns
    assert substring_dedup.substring_dedup(none).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.quality_rules(none, labels).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(5, 5), (200, 201), (201, 200)]
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[i] == 100 for i in range(100, 130))
    assert found[201] == found[200] == 200


def brute_dedup(texts, ids, k=13):
    words = [WORD.findall(t or "") for t in texts]
    first = {}
    for i, w in zip(ids, words, strict=True):
        if i is not None:
            for p in range(len(w) - k + 1):
                s = tuple(w[p : p + k])
                first[s] = min(first.get(s, i), i)
    out = []
    for i, w in zip(ids, words, strict=True):
        gone = set()
        if i is not None:
            for p in range(len(w) - k + 1):
                if first[tuple(w[p : p + k])] < i:
                    gone.update(range(p, p + k))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def deduplicated(docs, **options):
    found = substring_dedup.substring_dedup(docs, **options)
    return [tuple(r) for r in found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()]


@pytest.mark.parametrize("seed", [7, 8])
def test_substring_dedup_equals_brute_force(spark, seed):
    texts = some_texts(seed, n=70, vocabulary=50)
    ids = [(i * 37) % 101 for i in range(len(texts))]
    assert sorted(deduplicated(frame(spark, texts, ids))) == sorted(brute_dedup(texts, ids))


@pytest.mark.parametrize("segment, chunk_bytes", [(1 << 10, 300), (1 << 6, 5000)])
def test_substring_dedup_over_many_segments_and_chunks(spark, segment, chunk_bytes):
    """Hundreds of pieces of the sketch, chunks of a text or two: same result, in as many passes."""
    texts = some_texts(9, n=60, vocabulary=40)
    found = deduplicated(frame(spark, texts), segment=segment, chunk_bytes=chunk_bytes)
    assert sorted(found) == sorted(brute_dedup(texts, range(len(texts))))


def test_substring_dedup_reads_and_shuffles_the_text_once(spark, tmp_path):
    """Three uses of the chunks, one exchange; nothing of the sketch is broadcast."""
    frame(spark, some_texts(9, n=60, vocabulary=40)).write.parquet(str(tmp_path / "docs"))
    found = substring_dedup.substring_dedup(spark.read.parquet(str(tmp_path / "docs")))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and plan.count("ReusedExchange") == 2 and "Broadcast" not in plan


def test_substring_dedup_with_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(20))
    other = " ".join(f"v{i}" for i in range(14))
    rows = deduplicated(frame(spark, [text, text, f"{text} {other}", None, text], [4, 4, 4, 9, None]))
    assert sorted((r[0] or 0, r[1], r[2]) for r in rows) == [(0, 20, 0), (4, 20, 0), (4, 20, 0), (4, 34, 0), (9, 0, 0)]
    later = deduplicated(frame(spark, [f"{other} {text}", f"{text} end"], [1, 2]))
    assert sorted((r[0], r[2]) for r in later) == [(1, 0), (2, 20)]


def test_sketch_pieces_survive_packing():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 1000, 200_000):
        places = np.unique(rng.integers(0, substring_dedup.SEGMENT, n))
        assert (substring_dedup.unpacked(substring_dedup.packed(places)) == places).all()


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeat = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in range(i, i + 3)}
    failed = len(words) < 50 or 100 * len(repeat) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat), failed)


def test_quality_counts_and_scores_equal_brute_force(spark):
    rng = random.Random(10)
    clean = [" ".join(rng.choice(["the", "sea", "wind", "é", "harbour", "light"]) + str(rng.randrange(90)) for _ in range(80)) for _ in range(40)]
    junk = [" ".join(f"{rng.choice('ABC')}{rng.randrange(999)}!!&&&" for _ in range(80)) for _ in range(40)]
    texts = clean + junk + some_texts(11, n=40) + ["line one\nline one\n\n \nline one\nx"]
    labels = spark.createDataFrame([(i, int(i < 40), 0) for i in range(80)], "doc_id long, quality int, toxic int")
    docs = frame(spark, texts)
    model = quality_rules.fit(docs.select("doc_id", "text"), labels)
    rows = {r.doc_id: r for r in quality_rules.quality_rules(docs, labels, model).collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_counts(text), i
        assert r.kept == (not r.base_failed and r.score >= model.threshold)
    # the model in plain Python
    bucket = lambda g: (int.from_bytes(g, "big") * 2654435769 % 2**32) >> 16
    byte_grams = [[bucket((t or "").encode()[i : i + 3]) for i in range(len((t or "").encode()) - 2)] for t in texts]
    hash_of = lambda t: (bytewords.words(pa.array([t or ""])).hashes() >> np.uint64(46)).tolist()
    word_grams = [hash_of(t) for t in texts]
    sample = {r.doc_id: r for r in quality_rules.labelled_sample(labels).collect()}
    expected = [0.0] * len(texts)
    for grams in (byte_grams, word_grams):
        raw = Counter(g for x in grams for g in x)
        target = Counter(g for i, x in enumerate(grams) if i in sample and sample[i].good and sample[i].fit for g in x)
        share = sum(target.values()) / sum(raw.values())
        for i, x in enumerate(grams):
            own = [round(math.log((target[g] + 4) / (raw[g] * share + 4)) * 65536) for g in x]
            expected[i] += sum(own) / max(1, len(own)) / 65536
    for i in (0, 5, 41, 85, 100):
        assert rows[i].score == pytest.approx(expected[i], abs=1e-6)
    assert all(rows[i].kept for i in range(40)) and not any(rows[i].kept for i in range(40, 80))
    kept = quality_rules.keep_good(docs, labels, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.kept}


def test_quality_without_labels_and_with_odd_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame(spark, ["w " + " ".join(str(i) for i in range(60)), None, ""], [None, 1, 1])
    rows = sorted((r.doc_id or 0, r.n_words, r.score, r.kept) for r in quality_rules.quality_rules(docs, labels).collect())
    assert rows == [(0, 61, 0.0, True), (1, 0, 0.0, False), (1, 0, 0.0, False)]


def test_quality_on_held_out_labels(spark):
    """Documents that are neither in the target nor used for the threshold: half of the labels are kept from the model."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    seen = F.xxhash64("doc_id", F.lit("held out")) % 2 == 0
    model = quality_rules.fit(docs, labels.where(seen))
    judged = quality_rules.quality_rules(docs.join(labels.where(~seen).select("doc_id"), "doc_id", "left_semi"), labels, model)
    found = judged.where("not base_failed").join(labels, "doc_id").groupBy("quality", "toxic").agg(F.avg(F.col("kept").cast("double")).alias("kept"), F.count("*").alias("n"))
    kept = {(r.quality, r.toxic): r.kept for r in found.collect()}
    print({(r.quality, r.toxic): (r.kept, r.n) for r in found.collect()})
    assert kept[1, 0] > 0.98 and kept[0, 0] < 0.1 and kept[0, 1] < 0.1 and kept[1, 1] < 0.5


def test_contradicting_labels_count_as_bad(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, None), (3, None, 0), (None, 1, 0), (4, 1, 1)], "doc_id long, quality int, toxic int")
    assert {(r.doc_id, r.good) for r in quality_rules.labelled_sample(labels).collect()} == {(1, False), (2, True), (4, False)}


def test_all_labels_reach_target_and_threshold(spark):
    """More labels than any bound of the past (20,000): all are there, and one beyond it changes the model."""
    labels = spark.range(30_000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality", "0 AS toxic")
    halves = {r.fit: r["count"] for r in quality_rules.labelled(labels).groupBy("fit").count().collect()}
    assert sum(halves.values()) == 30_000 and min(halves.values()) > 14_000
    fit_ids = [r.doc_id for r in quality_rules.labelled(labels).where("fit").collect()]
    hash_of = F.xxhash64(F.col("doc_id").cast("long"))
    last = labels.where(hash_of % 2 == 0).orderBy(hash_of.desc()).first().doc_id
    docs = spark.createDataFrame([(last, "far away lies the light harbour " * 9)] + [(i, f"w{i} " * 3) for i in fit_ids[:9]], "doc_id int, text string")
    good = labels.withColumn("quality", F.lit(1))
    weights = lambda some: quality_rules.fit(docs, some).weights
    assert (weights(good) != weights(good.where(F.col("doc_id") != last))).any()

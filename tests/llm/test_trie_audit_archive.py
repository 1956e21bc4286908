"""The prefix trie, the audit of filter orders and the web archive against plain Python, and their odd inputs."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlake.llm import filter_audit, prefix_trie, warc_archive
from bazaarlake.session import scratch_path

TURNS = "conv_id long, turn long, role string, text string, node string, depth int, kind int, family string, rank int"
NODE_COLUMNS = [c.split()[0] for c in prefix_trie.NODES.split(", ")]


def turn_key(role, text):
    return hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()[:16]


def in_order(rows, conv):
    own = [r for r in rows if r[0] == conv]
    return [(r[2] or "", r[3] or "") for r in sorted(own, key=lambda r: (r[1] is not None, r[1] or 0, turn_key(r[2], r[3])))]


def truncated(c):
    return c - int(np.fmod(c, 5))


def rebuilt_by_hand(rows):
    out = {}
    for c in {r[0] for r in rows if r[0] is not None}:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = in_order(rows, truncated(c))[:h] + in_order(rows, c)[h:]
    return out


def trie_by_hand(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes)]
        saved = sum((len(nodes[p]) - 1) * (len(p[-1][1].encode()) if p else 0) for p in below)
        ends = ",".join(map(str, sorted(c for c in members if len(convs[c]) == len(path))))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def odd_conversations():
    pick = random.Random(5)
    rows = []
    for c in [*range(-7, 30), 2**62, -(2**63)]:
        for t in range(pick.randrange(1, 12)):
            rows.append((c, t if pick.random() < 0.9 else None, pick.choice(["user", "assistant", None]), pick.choice(["a", "b", "é😀", None, ""])))
    for c in range(100, 140):  # a large group of copies, and a long one
        rows += [(c, t, "user", "the same") for t in range(4)]
    rows += [(200, t, "user", "x" * 50) for t in range(300)]
    rows += [(5, 0, "user", "a")] * 2 + [(None, 0, "user", "a"), (None, None, None, None)]
    return rows


def trie(spark, rows, **bounds):
    conversations = spark.createDataFrame([(*r, "n", 1, 2, "f", 3) for r in rows], TURNS).repartition(3)
    base, shared = F.expr("conv_id - conv_id % 5"), F.expr("crc32(cast(cast(conv_id AS string) AS binary)) % 9")
    found = prefix_trie.prefix_trie(prefix_trie.sequences(conversations, base, shared, 8), **bounds)
    assert found.columns == NODE_COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("bounds", [{}, {"most": 1}, {"most": 40, "shard_rows": 50}])
def test_trie_equals_brute_force_at_any_cut(spark, bounds):
    rows = odd_conversations()
    assert trie(spark, rows, **bounds) == trie_by_hand(rebuilt_by_hand(rows))


def test_trie_of_plain_conversations_and_of_none(spark):
    rows = odd_conversations()
    conversations = spark.createDataFrame([(*r, "n", 1, 2, "f", 3) for r in rows], TURNS)
    plain = prefix_trie.prefix_trie(prefix_trie.sequences(conversations))
    by_hand = {c: in_order(rows, c) for c in {r[0] for r in rows if r[0] is not None}}
    assert sorted((tuple(r) for r in plain.collect()), key=str) == trie_by_hand(by_hand)
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "user", "a")]) == []


def test_conversation_without_turns_is_a_member_of_the_root(spark):
    c = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    (root,) = trie(spark, [(c, 0, "user", "only")])
    assert root == (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())


def test_top_ends_are_hashed_in_numerical_order_over_pieces(spark):
    ids = random.Random(1).sample(range(-50_000, 50_000), 3000)
    rows = spark.createDataFrame([(prefix_trie.ROOT, i) for i in ids], "node binary, conv_id long").repartition(5)
    (found,) = prefix_trie._top_ends(rows).collect()
    assert found.sha == hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


def test_slots_are_minimal_perfect_and_verified():
    rng = np.random.default_rng(3)
    high, low = rng.integers(0, 1 << 63, 20_000, np.uint64), rng.integers(0, 1 << 63, 20_000, np.uint64)
    high[:5000] = high[0]  # halves may repeat
    table = prefix_trie.SlotTable(high, low)
    assert sorted(table.find(high, low).tolist()) == list(range(20_000))
    assert (table.find(low, high) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.SlotTable(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


DOCS = "doc_id long, text string, lang string, mask int, part string, h long, words string, segment int, digest int, n int"


def audit_by_hand(docs, labels):
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", t)

    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    judged = []
    for i, text, lang in docs:
        t = text or ""
        w = words(t)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and i > first[t],
        }
        good = any(j == i and q == 1 for j, q, _ in labels if j is not None)
        toxic = any(j == i and x == 1 for j, _, x in labels if j is not None)
        judged.append((lang or "", {f for f, v in fails.items() if v}, good, toxic))
    out = []
    for part in {d[0] for d in judged}:
        mine = [d for d in judged if d[0] == part]
        rows = []
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                here = [d for d in mine if not d[1] & set(order[:k])]
                gone = [d for d in here if f in d[1]]
                rows.append([
                    part, "".join(order), k + 1, len(here) - len(gone), len(gone),
                    sum(f in d[1] for d in mine) - len(gone), sum(d[1] == {f} for d in mine),
                    sum(d[2] for d in gone), sum(d[3] for d in gone),
                ])
        shapley = {f: sum(r[4] for r in rows if r[1][r[2] - 1] == f) for f in "ABCDE"}
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in rows]
    return sorted(out)


def odd_documents():
    pick = random.Random(2)
    texts = [None, "", " \t\n", "A", "x # y", "Ünï cÖde 😀 " * 3, "plain words here", "w " * 300, " ".join(f"w{i}" for i in range(250))]
    texts += [" ".join(f"v{i}" for i in range(220)) + s for s in ("", " $", " " + "ABC" * 30)]
    docs = [(i, pick.choice(texts), pick.choice(["en", "de", None, ""])) for i in range(-20, 180)]
    docs += [(1000 + i, f"only {i}", "en") for i in range(50)] + [(2000 + i, "one text of very many", "fr") for i in range(300)]
    docs += [(7, "same id", "en"), (7, "same id", "en"), (7, "another text", "en"), (9, "same id", "de"), (None, "same id", "de"), (None, None, None)]
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 1, None])) for i in range(-20, 1020, 3)] + [(7, 0, 1), (7, 1, 0), (None, 1, 1)]
    return docs, labels


def audited(spark, docs, labels, **bounds):
    frame = spark.createDataFrame([(*d, 1, "p", 2, "w", 3, 4, 5) for d in docs], DOCS).repartition(4)
    counts = filter_audit.mask_counts(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), **bounds)
    return sorted(tuple(r) for r in filter_audit.audit(counts).collect())


@pytest.mark.parametrize("bounds", [{}, {"most_cells": 1 << 14}])
def test_audit_equals_brute_force(spark, bounds):
    docs, labels = odd_documents()
    assert audited(spark, docs, labels, **bounds) == audit_by_hand(docs, labels)


def test_audit_of_no_documents_and_no_labels(spark):
    assert audited(spark, [], [(1, 1, 1)]) == []
    docs, _ = odd_documents()
    assert audited(spark, docs[:30], []) == audit_by_hand(docs[:30], [])


def test_sketch_loses_no_repeat_and_clears_most_others(spark):
    rows = [(f"text {i}",) for i in range(5000)] + [(f"text {i}",) for i in range(0, 5000, 50)]
    texts = spark.createDataFrame(rows, "text string").repartition(6)
    for segments in (filter_audit.segments_for(len(rows)), 1):
        sketch = filter_audit.crowded_cells(texts, segments)
        possible = {r.text for r in filter_audit.with_possible(texts, sketch, segments).where("possible").collect()}
        assert {f"text {i}" for i in range(0, 5000, 50)} <= possible
        if segments > 1:
            assert len(possible) < 250
    assert filter_audit.segments_for(10**11) * (1 << filter_audit.SEGMENT_BITS) == filter_audit.MOST_CELLS


PAGES = "page_id long, url string, html string, address string, payload string, header int, sha1 string, last_id int"
LONG = "<p>é " + "z" * 1000


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "a", "p", 1, "s", 2) for r in rows], PAGES).repartition(3)


ODD_PAGES = [
    (1, "http://a/x", LONG), (2, "http://a/y\r\nWARC-Type: x", LONG), (9, None, LONG), (3, "http://b/%41é", "<p>short"),
    (4, "http://b/", "<p>short"), (5, "http://c", None), (6, "http://c", ""), (7, "u", "WARC/1.1\r\n\r\n" + "😀" * 400), (7, "u", "WARC/1.1\r\n\r\n" + "😀" * 400),
    (8, "u", "b" * 999), (10, "u", "b" * 999), (11, "u", "b" * 1000), (12, "u", "b" * 1000), (None, "n", LONG), (None, "m", "c" * 2000),
    (13, "big", "d" * 300_000),
]


def archive_by_hand(rows):
    out = []
    for page, url, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        last = max(same, default=None)
        again = len(payload) >= 1000 and page != last
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", last if again else None))
    return sorted(out, key=str)


def test_archive_equals_brute_force_and_gives_back_every_record(spark):
    path = scratch_path(spark, "test-warc")
    warc_archive.write_archive(pages_of(spark, ODD_PAGES), path)
    archive = warc_archive.read_archive(spark, path)
    found = archive.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in found), key=str) == archive_by_hand(ODD_PAGES)
    payloads = [bytes(r.payload) for r in spark.read.parquet(f"{path}/payloads").collect()]
    assert len(payloads) == len(set(payloads)) == len({h or "" for _, _, h in ODD_PAGES})
    back = [(r.page_id, bytes(r.payload).decode()) for r in archive.collect()]
    assert sorted(back, key=str) == sorted(((p, h or "") for p, _, h in ODD_PAGES), key=str)
    urls = {(r.page_id, r.url) for r in archive.collect()}
    assert (2, "http://a/y%0D%0AWARC-Type: x") in urls and (9, None) in urls and (3, "http://b/%41é") in urls

    for record in warc_archive.records(archive).collect():
        head, _, rest = bytes(record.record).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        body = rest[: int(fields["Content-Length"])]
        assert lines[0] == "WARC/1.1" and rest[len(body) :] == b"\r\n\r\n"
        if fields["WARC-Type"] == "response":
            assert fields["WARC-Payload-Digest"] == f"sha1:{hashlib.sha1(body).hexdigest()}"
        else:
            assert not body and fields["WARC-Refers-To"] in ("<urn:page:9>", "<urn:page:12>")


def test_damaged_and_empty_archives(spark):
    path = scratch_path(spark, "test-warc")
    warc_archive.write_archive(pages_of(spark, []), path)
    assert warc_archive.read_archive(spark, path).count() == 0
    path = scratch_path(spark, "test-warc")
    warc_archive.write_archive(pages_of(spark, ODD_PAGES), path)
    other = scratch_path(spark, "test-warc")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{other}/headers")
    changed = F.when(F.col("n_bytes") == 1000, F.lit(b"changed")).otherwise(F.col("payload"))
    spark.read.parquet(f"{path}/payloads").withColumn("payload", changed).write.parquet(f"{other}/payloads")
    with pytest.raises(Exception, match="damaged record"):
        warc_archive.read_archive(spark, other).collect()

"""Token files, packing, page text and the pipeline against tokenizers, brute force and held-out pages."""

import random
import time
import unicodedata
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SMALL
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from bazaarlake.llm import html_blocks, html_extract, jaccard_join, packing, token_files, tokens
from bazaarlake.llm.catalogue import ORACLES, QUERIES
from tools.compare import compare, connect

ODD_TEXTS = [
    None, "", " ", "  ", "a  b", "a \nb", "a\n b", "\n\n\nb", " a", "a ", "a  ", "a\n", "<|endoftext|> x", "don't  I'll\tgo x  y",
    "a\x00b c", "x\n\ny", "x \n\n y", "１２ 3é́ ÀÉ İ ΑΣ ΣΑΣ", "word, word. (word) word's x²y a_b", " x y", "😀 ok",
]


def texts():
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall()
    return ODD_TEXTS + [t for _, t in rows]


def frame(spark, texts, ids=None):
    ids = ids if ids is not None else range(len(texts))
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, start long, part int, ids string")


def plain_ids(vocabulary, text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def all_plain_ids(vocabulary, some):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in some], add_special_tokens=False)]


@pytest.mark.parametrize(("vocabulary", "white"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_equal_the_tokenizer(vocabulary, white):
    some = texts()
    ids, edges = tokens.Encoder(vocabulary, white).encode(pa.array(some))
    for i, expected in enumerate(all_plain_ids(vocabulary, some)):
        assert ids[edges[i] : edges[i + 1]].tolist() == expected, some[i]


DECOMPOSED = ["cafe\u0301 noir", "man\u0303ana, n\u0303!", "か\u3099き\u3099 は\u309aん", "Vie\u0323\u0302t a\u0301\u0301b e\u20dd", "x\u0338=\u0338y =\u0338", "ᄒ\u1161\u11ab글", "i\u0307 I\u0307\u0301", " \u0301a\n\u0301b", "ক\u09c7\u09be"]


@pytest.mark.parametrize(("vocabulary", "white"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_of_decomposed_letters_equal_the_tokenizer(vocabulary, white):
    ids, edges = tokens.Encoder(vocabulary, white).encode(pa.array(DECOMPOSED))
    for i, expected in enumerate(all_plain_ids(vocabulary, DECOMPOSED)):
        assert ids[edges[i] : edges[i + 1]].tolist() == expected, DECOMPOSED[i]


def marked_letters():
    """Letters whose normal form by the tokenizer ends in a mark."""
    normal = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).normalizer
    letters = [chr(c) for c in range(0x80, 0x2FA20) if unicodedata.category(chr(c))[0] == "L"]
    forms = normal.normalize_str(" ".join(letters)).split(" ")
    return [c for c, form in zip(letters, forms, strict=True) if unicodedata.category(form[-1])[0] == "M"]


def fuzzed():
    marked, pick = marked_letters(), random.Random(4)
    assert "\u0130" in marked and "\u0958" in marked
    pool = [*marked, *"aZé'.,;!-I ßΣσ\n $…1", "😀", "\u0301", "\u0307", "\u093c", "ALİ'nin", "I\u093c\u0307"]
    some = ["".join(pick.choice(pool) for _ in range(pick.randrange(1, 14))) for _ in range(4000)]
    return ["TBMM ve ALİ'nin evi; BELLİ.", *[c + sign for c in marked for sign in "'.$"], *some]


@pytest.mark.parametrize(("vocabulary", "white"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_of_letters_that_end_in_marks_equal_the_tokenizer(vocabulary, white):
    some = fuzzed()
    ids, edges = tokens.Encoder(vocabulary, white).encode(pa.array(some))
    for i, expected in enumerate(all_plain_ids(vocabulary, some)):
        assert ids[edges[i] : edges[i + 1]].tolist() == expected, ascii(some[i])


SPECIAL = ["one<|endoftext|>two", "<|endoftext|>", "a <|startoftext|> b\tc", "<|ENDOFTEXT|> x", "x\x00y<|endoftext|>\x00", "plain, text", None]


def library_ids(vocabulary, text):
    return Tokenizer.from_file(public_tokenizers.path(vocabulary)).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("vocabulary", "white"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_special_tokens_have_their_ids(vocabulary, white):
    ids, edges = tokens.Encoder(vocabulary, white, special_ids=True).encode(pa.array(SPECIAL + texts()))
    for i, text in enumerate(SPECIAL + texts()[:60]):
        assert ids[edges[i] : edges[i + 1]].tolist() == library_ids(vocabulary, text), text


@pytest.mark.parametrize(("query", "vocabulary", "end"), [("op2_token_files", "byte_bpe_50k.json", 0), ("op8_packing", "word_bpe_49k.json", 1), ("packed", "word_bpe_49k.json", 1)])
def test_queries_give_special_tokens_their_ids(spark, tmp_path, query, vocabulary, end):
    some = SPECIAL + DECOMPOSED + fuzzed()[:400]
    docs = frame(spark, some)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    run = dict(corpus_pipeline.STAGES).get(query)
    found = run(spark, docs, str(tmp_path)) if run else QUERIES[query](spark, str(tmp_path))
    rows = sorted((r.doc_id, r.ids_crc32) for r in found.collect())
    by_doc = [[*library_ids(vocabulary, t), end] for t in some]
    if query == "op2_token_files":
        assert rows == [(i, zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in enumerate(by_doc)]
    else:
        for r in found.collect():
            piece = by_doc[r.doc_id][r.start : r.start + r.length]
            assert r.doc_tokens == len(by_doc[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())


def test_store_of_pieces_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "STORE", 3)
    encoder = tokens.Encoder("byte_bpe_50k.json", True)
    for text in ("one two three", "four five six", "one two four"):
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == plain_ids("byte_bpe_50k.json", text)


def test_store_of_pieces_holds_few_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "STORE_BYTES", 5000)
    encoder = tokens.Encoder("byte_bpe_50k.json", True)
    for i in range(20):  # a tab makes one piece of a text
        text = f"{i}\t" + "some words " * 100
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == plain_ids("byte_bpe_50k.json", text)
    assert encoder.pieces.nbytes < 5000 + 2 * 1200


def test_a_worker_merges_a_piece_once(monkeypatch):
    monkeypatch.setattr(tokens, "STORE", 500)
    tokens.shared_encoder.cache_clear()
    merged, texts = [], ["one two three", "three four\nfünf", "one two four"]
    kept = tokens.Encoder.merged
    monkeypatch.setattr(tokens.Encoder, "merged", lambda self, words: merged.extend(words) or kept(self, words))
    for text in texts:  # a task each
        batch = pa.record_batch([pa.array([text])], ["text"])
        ((_, ids, _),) = tokens.encoded(iter([batch]), "byte_bpe_50k.json", True, 0)
        assert ids.tolist() == [*plain_ids("byte_bpe_50k.json", text), 0]
    assert merged == ["one", "Ġtwo", "Ġthree", "three", "Ġfour", "fÃ¼nf"]
    tokens.shared_encoder.cache_clear()


def test_pairs_are_replaced_also_where_buckets_are_shared(monkeypatch):
    monkeypatch.setattr(token_files, "BUCKET_BITS", 4)
    monkeypatch.setattr(token_files, "CANDIDATES", 2)
    ids = np.tile(np.random.default_rng(3).integers(0, 50257, 700).astype(np.uint32), 20)
    grammar = token_files.compress(ids, token_files.FIRST_SYMBOL)
    assert (grammar.expand(grammar.symbols) == ids).all()
    pairs = np.unique(np.stack([grammar.symbols[:-1], grammar.symbols[1:]]), axis=1, return_counts=True)[1]
    assert pairs.max() < 2 * token_files.LEAST_COUNT and len(grammar.to_bytes()) < 15 * 700


def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    cases = [np.zeros(0), [7], [5] * 1001, [1, 2] * 500, [1, 1, 2] * 400, rng.integers(0, 4, 5000), rng.integers(0, 50257, 3000)]
    for case in cases:
        ids = np.array(case, np.uint32)
        grammar = token_files.Grammar.from_bytes(token_files.compress(ids, token_files.FIRST_SYMBOL).to_bytes())
        assert (grammar.expand(grammar.symbols) == ids).all()
        for _ in range(30):
            begin, end = sorted(rng.integers(0, len(ids) + 1, 2))
            assert (grammar.read(begin, end) == ids[begin:end]).all()
    short = token_files.compress(np.array([1, 2] * 500, np.uint32), token_files.FIRST_SYMBOL)
    assert len(short.symbols) < 100
    with pytest.raises(ValueError, match="below"):
        token_files.compress(np.array([token_files.FIRST_SYMBOL], np.uint32), token_files.FIRST_SYMBOL)


def test_copies_shrink_until_no_pair_is_frequent():
    text = np.random.default_rng(2).integers(0, 50257, 700).astype(np.uint32)
    grammar = token_files.compress(np.tile(text, 1000), token_files.FIRST_SYMBOL)
    assert (grammar.expand(grammar.symbols) == np.tile(text, 1000)).all()
    pairs = np.unique(np.stack([grammar.symbols[:-1], grammar.symbols[1:]]), axis=1, return_counts=True)[1] if len(grammar.symbols) > 1 else np.zeros(1)
    assert pairs.max() < 2 * token_files.LEAST_COUNT and len(grammar.to_bytes()) < 15 * 700


def test_a_damaged_shard_is_an_error():
    raw = token_files.compress(np.arange(50, dtype=np.uint32), token_files.FIRST_SYMBOL).to_bytes()
    for bad in (raw[:-4], b"x" + raw[1:]):
        with pytest.raises(ValueError, match="shard"):
            token_files.Grammar.from_bytes(bad)


@pytest.mark.parametrize("shard", [2_000_000, 700])
def test_token_files_equal_the_tokenizer(spark, tmp_path, monkeypatch, shard):
    monkeypatch.setattr(token_files, "SHARD_IDS", shard)
    some = texts()[:80]
    ids = [(i * 29) % 83 for i in range(80)]
    token_files.write_files(frame(spark, some, ids), str(tmp_path / "f"))
    rows = {r.doc_id: r for r in token_files.read_files(spark, str(tmp_path / "f")).collect()}
    start = 0
    for i in sorted(ids):
        expected = [*plain_ids("byte_bpe_50k.json", some[ids.index(i)]), 0]
        assert (rows[i].start, rows[i].n_tokens) == (start, len(expected))
        assert bytes(rows[i].ids) == np.array(expected, "<u4").tobytes()
        start += len(expected)


def test_token_files_of_repeated_null_and_no_rows(spark, tmp_path):
    token_files.write_files(frame(spark, ["b", "a", None, "a"], [1, 1, None, 1]), str(tmp_path / "f"))
    rows = sorted((r.start, r.doc_id, r.n_tokens) for r in token_files.read_files(spark, str(tmp_path / "f")).collect())
    assert rows == [(0, None, 1), (1, 1, 2), (3, 1, 2), (5, 1, 2)]
    token_files.write_files(frame(spark, []), str(tmp_path / "none"))
    assert token_files.read_files(spark, str(tmp_path / "none")).count() == 0


def checked_sequences(rows, max_tokens, max_segments, max_loss):
    """Gapless sequences within the limits, unpadded: full or a power of two long."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for pieces in by.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and len(p.ids) == 4 * p.length > 0
            at += p.length
        assert at <= max_tokens and (at == max_tokens or at & (at - 1) == 0)
        assert len(pieces) <= max_segments and sum(p.loss for p in pieces) <= max_loss
    return by


@pytest.mark.parametrize(("limits", "loss"), [((2048, 128, 2048), None), ((256, 4, 256), None), ((256, 128, 64), "start")])
def test_packing_keeps_every_id_once_and_all_limits(spark, limits, loss):
    some = texts()
    rows = packing.pack(frame(spark, some), loss_from=loss, max_tokens=limits[0], max_segments=limits[1], max_loss=limits[2]).collect()
    checked_sequences(rows, *limits)
    of = defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
    for i, ids in enumerate(all_plain_ids("word_bpe_49k.json", some)):
        pieces = sorted(of[i], key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in pieces) == np.array([*ids, 1], "<u4").tobytes()
        assert all(p.doc_tokens == len(ids) + 1 for p in pieces)
        assert [p.start for p in pieces] == np.cumsum([0, *(p.length for p in pieces[:-1])]).tolist()


def test_packing_leaves_few_short_sequences(spark):
    rows = packing.pack(frame(spark, texts()).coalesce(1)).collect()
    lengths = [sum(p.length for p in pieces) for pieces in checked_sequences(rows, 2048, 128, 2048).values()]
    assert sum(n < 2048 for n in lengths) <= 11 + len([n for n in lengths if n < 2048]) // 50


def test_packing_of_repeated_null_and_no_rows(spark):
    rows = packing.pack(frame(spark, ["a", "a", None], [1, 1, None])).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 1), (1, 2), (1, 2)]
    assert packing.pack(frame(spark, [])).count() == 0


def test_page_text_on_held_out_pages():
    field = html_extract.trained(html_extract.labelled_pages())
    wrong = total = 0
    for html, labels in html_extract.labelled_pages(200, seed=99):
        got = field.labels(html_blocks.blocks_of(html))
        wrong += sum(a != b for a, b in zip(got, labels, strict=True))
        total += len(labels)
    assert wrong / total < 0.01
    page = "<html><body><nav><a href=x>Home</a></nav><div class='cookie-notice'>We use cookies, dear reader.</div><article><h1>A &amp; B</h1><p>First   line,<br>with&nbsp;more of it.</p><div class=ad>Buy now</div><p>Second &lt;line&gt; here, and more.</article><div class='comments'><p>I like this article a lot.</p></div><footer>&copy; me</footer>"
    assert field.text(page) == "A & B First line, with more of it. Second <line> here, and more."


def test_viterbi_finds_the_best_labels():
    rng = np.random.default_rng(2)
    for _ in range(30):
        blocks = [html_blocks.Block("x", [f"f{i}"]) for i in range(6)]
        weights = {f"f{i}": tuple(rng.normal(size=2)) for i in range(6)}
        change = rng.normal(size=(2, 2))
        score = lambda y: sum(weights[f"f{i}"][a] for i, a in enumerate(y)) + sum(change[a, b] for a, b in zip(y, y[1:]))  # noqa: B023, B905, E731
        best = max(np.ndindex(*[2] * 6), key=score)
        assert tuple(html_extract.Field(weights, change).labels(blocks)) == best


def test_blocks_of_broken_pages():
    text = lambda html: [b.text for b in html_blocks.blocks_of(html)]
    assert text("") == [] and text("<") == [] and text("a<b") == ["a"] and text("x < y") == ["x < y"]
    assert text("<p>a<b>b</b>c<p>d <script>var t='</p>'</script><style>p{}</style>e<!-- f --><a hre") == ["abc", "d e"]
    assert text("<td>1<td>2</td><li>x<li>y &am") == ["1", "2", "x", "y &am"]
    assert text("<title>t</title><p>&nbsp; \n</p>&#233;&eacute") == ["éé"]


DEEP = ["<div>x" * 20_000, "<b>" * 20_000 + "<p>x" * 20_000, "<i><div>" * 10_000 + "x" + "</b>" * 20_000, "".join(f"<t{i}>x" for i in range(20_000))]


@pytest.mark.parametrize("html", DEEP, ids=["blocks", "inline then blocks", "unmatched ends", "unknown names"])
def test_deep_pages_take_time_in_proportion(html):
    begun = time.process_time()
    blocks = html_blocks.blocks_of(html)
    assert time.process_time() - begun < 10
    assert "".join(b.text for b in blocks) == "x" * html.count("x")


def test_page_text_of_null_repeated_and_no_rows(spark):
    html = "<article><p>One sentence here, with words. And another one, quite long too.</p></article>"
    pages = spark.createDataFrame([(1, "u", html, "x"), (1, "u", html, "x"), (None, None, None, None), (2, "v", "", "y")], "page_id long, url string, html string, text string")
    rows = sorted(((r.page_id or 0), r.url or "", r.text, r.n_chars) for r in html_extract.html_extract(pages).collect())
    kept = "One sentence here, with words. And another one, quite long too."
    assert rows == [(0, "", "", 0), (1, "u", kept, 63), (1, "u", kept, 63), (2, "v", "", 0)]
    assert html_extract.html_extract(pages.limit(0)).count() == 0


def test_page_text_equals_the_articles(spark):
    """The given pages hold one article element each: its text is what is to be found."""
    found = {r.page_id: r.text for r in QUERIES["op10_html_extract"](spark, SMALL).collect()}
    for page_id, html in duckdb.sql(f"SELECT page_id, html FROM '{SMALL}/pages.parquet'").fetchall():
        inner = html[html.index("<article>") : (html + "</article>").index("</article>")]
        assert found[page_id] == " ".join(b.text for b in html_blocks.blocks_of(inner))


def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage on what the one before it kept: columns, what goes and what stays."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "benchmark_text", "secrets", "packed"]
    docs, kept = small_docs(spark), []
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs.collect())
        assert i == 4 or docs.columns == columns
    raw = {r.doc_id: r for r in small_docs(spark).collect()}
    verdicts = {r.doc_id: r.kept for r in QUERIES["op5_quality_rules"](spark, SMALL).collect()}
    assert {r.doc_id for r in kept[0]} == {i for i, good in verdicts.items() if good}
    # one of each group of near copies, over what is left
    left = spark.createDataFrame([(r.doc_id, r.text) for r in kept[0]], "doc_id long, text string")
    names = {r.component_id for r in jaccard_join.jaccard_join(left).collect()}
    assert {r.doc_id for r in kept[1]} == names
    hit = {r.doc_id for r in QUERIES["op9_decontamination"](spark, SMALL).collect() if r.contaminated}
    assert {r.doc_id for r in kept[2]} == names - hit
    marked = {r.doc_id for r in QUERIES["op7_secret_scan"](spark, SMALL).collect() if r.spans}
    for r in kept[3]:
        assert ("[secret]" in r.text) == (r.doc_id in marked) and (r.doc_id in marked or r.text == raw[r.doc_id].text)
    texts = {r.doc_id: r.text for r in kept[3]}
    by_doc = defaultdict(list)
    for r in kept[4]:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == set(texts)
    for i, ids in zip(texts, all_plain_ids("word_bpe_49k.json", list(texts.values())), strict=True):
        pieces, whole = sorted(by_doc[i], key=lambda p: p.start), [*ids, 1]
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(np.array(whole[p.start : p.start + p.length], "<u4").tobytes())
        assert sum(p.length for p in pieces) == len(whole)


def test_pipeline_run(spark):
    rows = entry.queries()["pipeline"](spark, SMALL)
    assert rows.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(rows.columns)


@pytest.fixture(scope="module")
def duck():
    connection = connect(SMALL)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", ORACLES)
def test_equals_sql(spark, duck, name):
    good, note = compare(spark, duck, name, SMALL)
    assert good, note


def test_one_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())

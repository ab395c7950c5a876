import base64
import os

import pytest

from quire.llm import tokens as K

DOCS = "doc_id bigint, text string, lang string, source string, genre string, tokens int, ids string, h string"
needs_vocabulary = pytest.mark.skipif(not os.path.exists(K.DEFAULT_RANKS), reason="no vocabulary here")
TEXTS = ["", " ", "Hello world", "  two\n\n spaces\t", "naïve café — ﬁn", "日本語テキスト🙂👩‍🔧", "<|endoftext|> x", "a" * 3000, "don't they'll 1234567", "\r\n\r\n", "x\x00y", "Δ² ½ мир"]


@needs_vocabulary
def test_ids_equal_the_public_library():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(K.DEFAULT_RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=K.WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = K.encoder()
    for t in TEXTS:
        assert own.encode(t) == enc.encode_ordinary(t), t[:20]
        assert own.decode(own.encode(t)) == t
    assert own.encode(None) == []


def test_merging_against_brute_force():
    import random

    rnd = random.Random(2)
    ranks = {bytes([b]): b for b in range(256)}
    for w in ("ab", "bc", "abc", "ca", "cab", "aa", "aaaa", "abab"):
        ranks[w.encode()] = 256 + len(ranks)
    enc = K.BytePairEncoder(ranks)
    for _ in range(300):
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 14))).encode()
        parts = [word[i : i + 1] for i in range(len(word))]
        if word in ranks:
            parts = [word]
        while True:
            pairs = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
            if not pairs:
                break
            _, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert enc.merge(word) == tuple(ranks[p] for p in parts)


@needs_vocabulary
def test_encode_table(spark):
    df = spark.createDataFrame([(1, None, None, None, None, 1, "x", "y"), (2, "", None, None, None, 1, "x", "y"), (None, "Hello world", None, None, None, 1, "x", "y")], DOCS)
    assert sorted((r.doc_id or 0, r.ids) for r in K.encode_ids(df).collect()) == [(0, [15496, 995]), (1, []), (2, [])]


BLOCKS = "block_uid bigint, book_id string, clean_text string, language string, block_type string, n int, genre string, ingested_at timestamp"
BOOKS = "book_id string, genre string, language string, origin string, updated_at timestamp"


@needs_vocabulary
def test_budget(spark):
    blocks = spark.createDataFrame([(1, "b", "Hello world", "EN", "Paragraph", 1, None, None), (1, "b", "Hello world", "EN", "Paragraph", 1, None, None), (2, "b", "Hello world", None, "paragraph", 1, None, None), (3, "x", None, "eng", None, 1, None, None), (None, "b", "z", None, None, 1, None, None)], BLOCKS)
    books = spark.createDataFrame([("b", "Text Book", "en-GB", "BOX-1", None)], BOOKS)
    docs = spark.createDataFrame([(1, "Hello world", "en", "A B", "text-book", 1, "", ""), (2, "Hello world", "eng", "a-b", "Textbook", 1, "", ""), (3, "", "spa", None, None, 1, "", "")], DOCS)
    got = {(r.part, r.source, r.language, r.genre, r.block_type): (r.n_records, r.n_texts, r.n_tokens) for r in K.budget(blocks, docs, books).collect()}
    assert got == {("blocks", "box-1", "en", "textbook", "paragraph"): (2, 1, 4), ("blocks", None, "en", None, None): (1, 0, 0), ("documents", "a-b", "en", "textbook", None): (2, 1, 4), ("documents", None, "es", None, None): (1, 1, 0)}
    assert K.budget(spark.createDataFrame([], BLOCKS), spark.createDataFrame([], DOCS), spark.createDataFrame([], BOOKS)).count() == 0


def test_bins_hold_their_capacity_and_fill_well():
    import random

    rnd = random.Random(1)
    bins, load = K.OpenBins(1000, 256), {}
    sizes = [min(1000, int(rnd.expovariate(1 / 180))) for _ in range(20_000)]
    for s in sizes:
        n = bins.put(s)
        load[n] = load.get(n, 0) + s
        assert load[n] <= 1000 and bins.count <= 256
    assert sum(sizes) / (1000 * len(load)) > 0.97
    assert len(load) == bins.made


@needs_vocabulary
def test_pack_table(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 9) if i % 7 else None, None, "s" if i % 3 else None, None, 1, "", "") for i in range(300)] + [(999, "word " * 100, None, "s", None, 1, "", "")], DOCS)
    cfg = spark.createDataFrame([(1, 20, False), (2, 20, True), (3, None, False), (4, 0, True)], "pack_id int, capacity_tokens int, per_source boolean")
    rows = K.pack(docs, cfg, open_bins=8, chunk=100).collect()
    assert {r.pack_id for r in rows} == {1, 2}
    load, source = {}, {}
    where = {r.doc_id: r.source for r in docs.collect()}
    for r in rows:
        load[r.pack_id, r.container] = load.get((r.pack_id, r.container), 0) + r.tokens
        if r.pack_id == 2:
            assert source.setdefault(r.container, where[r.doc_id]) == where[r.doc_id]
    assert max(load.values()) <= 20
    for p in (1, 2):
        mine = [r for r in rows if r.pack_id == p]
        assert {r.doc_id for r in mine} == set(where) and len(mine) == 300 + 6
        assert sum(r.tokens for r in mine) == sum(len(r.ids) for r in K.encode_ids(docs).collect())
    assert K.pack(docs.limit(0), cfg).count() == 0
    assert K.pack(docs, cfg.limit(0)).count() == 0

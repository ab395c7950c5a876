import random

from quire.llm import scans as S

BLOCKS = "block_uid bigint, book_id string, page_idx int, raw_text string, block_type string, titles string, raw string, id int"
SENT = ["The queue keeps the careful packet near the gate.", "Most readers assume that the market follows the river.", "A small train crossed the bridge before dawn.", "Nobody asked why the lantern stays under the table."]


def tables(spark, rows):
    pages = spark.createDataFrame([("b", 0, True), ("b", 0, True), ("b", 1, None), ("b", 2, False)], "book_id string, page_idx int, is_scanned boolean")
    books = spark.createDataFrame([("b", "The Quiet Signals: A Reader"), ("b", None)], "book_id string, title string")
    toc = spark.createDataFrame([("b", 0, "1 Slow Repairs ...... 12", 0, 0), ("b", 1, None, 0, None)], "book_id string, toc_ord int, title string, level int, page_idx int")
    return spark.createDataFrame(rows, BLOCKS), pages, books, toc


def test_lines():
    t = S.Titles("b", S.title_keys("b", "The Quiet Signals: A Reader") | S.title_keys("b", "1 Slow Repairs"))
    assert not S.is_header("The Quiet Signals", S.Titles("c", t.keys))
    for line in ("The Quiet Signals", "THE QUIET SIGNALS 34", "71 The Quiet Signals", "Slow Repairs | 137", "23   SLOW REPAIRS", "The Quiet Signals · Slow Repairs", "The Quict Signols"):
        assert S.is_header(line, t), line
    for line in ("All rights in this edition are kept.", "The quiet signals follow.", "Loud Signals"):
        assert not S.is_header(line, t), line
    for line in ("12", "[114]", "- 55 -", "— 60 —", "p. 101", "xxi", "VI"):
        assert S.is_page_number(line), line
    for line in ("12 marks", "mix it", "1.4 2.5", "-"):
        assert not S.is_page_number(line), line


def test_found_and_repaired(spark):
    rnd = random.Random(1)
    rows = [(i, "b", 2, " ".join(rnd.choice(SENT) for _ in range(4)), "paragraph", "", "", 0) for i in range(200)]
    noisy = {
        1000: ("The queue keeps the careful pac-\nket near the gate.", "paragraph", {"hyphen"}), 1001: ("Most readers assurne that fhe market follows the river.", "paragraph", {"char"}), 1002: ("The Quiet Signals 12", "furniture", {"header"}),
        1003: ("A small train\n12\ncrossed the bridge before dawn.", "paragraph", {"page_number"}), 1004: ("Slow Repairs", "heading", set()), 1005: ("12\n13\n14", "table", set()), 1006: ("12\n13\n14", None, set()),
        1007: ("Nobody asked why the lan‐\nSlow Repairs | 9\ntern stays under the tablc.", "paragraph", {"hyphen", "header", "char"}), 1008: (None, None, set()), 1009: ("", "paragraph", set()), 1010: ("x1 = 0;\nif (x1) {\n  y = 1;\n}", None, set()), 1011: (SENT[0], None, set()),
    }
    rows += [(u, "b", 0, t, k, "", "", 0) for u, (t, k, _) in noisy.items()] + [(1000, "b", 0, noisy[1000][0], "paragraph", "", "", 0), (2000, "b", 1, "12", "paragraph", "", "", 0), (2001, "zz", 0, "12", "paragraph", "", "", 0), (None, "b", 0, "12", "paragraph", "", "", 0)]
    args = tables(spark, rows)
    got: dict = {}
    for r in S.found(*args).collect():
        got.setdefault(r.block_uid, []).append(r.noise)
    assert {u: sorted(v) for u, v in got.items()} == {u: sorted(v) for u, (_, _, v) in noisy.items() if v}
    clean = {r.block_uid: r.clean_text for r in S.repaired(*args).collect()}
    assert clean[1000] == SENT[0] and clean[1001] == SENT[1] and clean[1003] == SENT[2] and clean[1007] == SENT[3] and clean[1002] == "" and clean[1005] == "12\n13\n14"


def test_empty(spark):
    args = tables(spark, [])
    assert S.found(*args).count() == 0 and S.repaired(*args).count() == 0


def test_confusions_against_brute_force():
    rnd = random.Random(2)
    for w in ("kettle", "minim", "hill", "würde", "wander", "clown", "сонный"):
        once = {w[:i] + a + w[i + len(b) :] for a, b in S.CONFUSIONS for i in range(len(w)) if w.startswith(b, i)}
        for v in sorted(once):
            assert S.read_form(v) == S.read_form(w) and len(S.confused(w, v)) == 1, (w, v)
        # two places of a word, each misread once
        twice = {a + w[i:j] + b + w[j + n :] for i in range(len(w)) for j in range(i + 2, len(w)) for a in [w[:i]] for b, n in [(x, len(y)) for x, y in S.CONFUSIONS if w.startswith(y, j)]}
        for v in rnd.sample(sorted(twice), min(20, len(twice))):
            both = v.replace("e", "c", 1) if "e" in v else v
            assert S.confused(w, both) is not None and len(S.confused(w, both)) <= 2, (w, both)
        assert S.confused(w, w + "z") is None and S.confused(w, w) == []


def test_misreadings_are_found_at_any_size_of_the_corpus(spark):
    for times in (1, 30):
        rows = [(i, "b", 2, " ".join(SENT * 3), "paragraph", "", "", 0) for i in range(60 * times)]
        rows += [(10_000 + i, "b", 0, "Nobody asked why fhe lantern stays under the tablc.", "paragraph", "", "", 0) for i in range(times)]
        got = S.found(*tables(spark, rows)).where("noise = 'char'").count()
        assert got == times, times


def test_chunks_of_any_size_give_the_same(spark, monkeypatch):
    from quire.llm import lookup

    rows = [(i, "b", 2, " ".join(SENT * 2), "paragraph", "", "", 0) for i in range(40)]
    rows += [(1000 + i, "b", 0, t, "paragraph", "", "", 0) for i, t in enumerate(["Most readers assurne that fhe market follows the river.", "A small train\n12\ncrossed the bridgc before dawn.", "Nobody askcd why the lan-\ntern stays."] * 4)]
    got = []
    for size in (4_000_000, 60):
        monkeypatch.setattr(lookup, "CHUNK", size)
        got.append(sorted(tuple(r) for r in S.found(*tables(spark, rows)).collect()))
    assert got[0] == got[1] and len(got[0]) == 4 * 5

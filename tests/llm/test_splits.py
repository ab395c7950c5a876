import random

from quire.llm import splits as S

BOOKS = "book_id string, authors array<string>, series string, origin string, genre string, language string, updated_at timestamp, label string, key string"
TOC = "book_id string, toc_ord int, title string, level int, page_idx int"


def book(b, authors=None, series=None, origin=None, genre="novel", language="en"):
    return (b, authors, series, origin, genre, language, None, "x", "y")


def test_author_forms():
    same = ["Jörg Müller", "MÜLLER, Jörg", " Jörg  Müller ", "Müller, Jörg"]
    assert {S.author_key(a) for a in same} == {"jörg müller"}
    assert [S.author_key(a) for a in (None, "", "-", "N.N.", "Unknown", "Müller", "various", ", Jörg")] == [None] * 8
    assert S.thing_key(" N/A ") is None and S.thing_key("BOX-1 ") == "box-1" and S.author_key("Jorg Muller") != S.author_key("Jörg Müller")


def brute(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for b, k in links:
        parent[find(("k", k))] = find(("b", b))
    groups = {}
    for b in {b for b, _ in links}:
        groups.setdefault(find(("b", b)), []).append(b)
    return {b: min(g) for g in groups.values() if len(g) > 1 for b in g}


def test_components_against_brute_force(spark):
    rnd = random.Random(3)
    links = {(f"b{rnd.randrange(120):03d}", f"k{rnd.randrange(90)}") for _ in range(150)} | {(f"c{i:03d}", f"chain{j}") for i in range(60) for j in (i, i + 1)}
    got = {r.book_id: r.group_id for r in S.components(spark.createDataFrame(sorted(links), "book_id string, key string")).collect()}
    assert got == brute(links)


def test_found_edges(spark):
    rows = [book("a", ["Jörg Müller", None]), book("a", ["Jörg Müller"]), book("b", ["MÜLLER, Jörg"], "S"), book("c", [], " s "), book("d", None, None, "-"), book("e", ["N.N."], "", "none"), book("f", ["N.N."], "", "none"), book(None, ["Jörg Müller"])]
    assert {r.book_id: r.group_id for r in S.found(spark.createDataFrame(rows, BOOKS)).collect()} == {"a": "a", "b": "a", "c": "a"}
    assert S.found(spark.createDataFrame([], BOOKS)).count() == 0


def test_labels_are_shared_out_one_by_one_and_by_place(spark, monkeypatch):
    rnd = random.Random(9)
    rows = [book(f"b{i:04d}", genre=rnd.choice(["novel"] * 8 + ["manual"] * 3 + ["atlas"]), language=rnd.choice(["en", "en", "de", "fr"])) for i in range(1800)]
    books = spark.createDataFrame(rows, BOOKS)
    genre = {r[0]: r[4] for r in rows}
    cfg = spark.createDataFrame([(1, "book", [0.7, 0.2, 0.1], 5)], "split_id int, by_key string, ratios array<double>, seed bigint")
    for giant, stretch in ((1e-6, 20_000), (1e-3, 300), (1e-3, 20_000)):
        monkeypatch.setattr(S, "GIANT", giant)
        monkeypatch.setattr(S, "STRETCH", stretch)
        got = S.assign(books, spark.createDataFrame([], TOC), cfg).collect()
        assert len(got) == 1800
        for g in ("novel", "manual", "atlas"):
            of = [r.split for r in got if genre[r.book_id] == g]
            for s, want in zip(S.SPLITS, (0.7, 0.2, 0.1)):
                assert abs(of.count(s) / len(of) - want) < 0.025, (giant, g, s)


def test_assignment(spark):
    rnd = random.Random(7)
    rows = [book(f"b{i:04d}", [f"Given{rnd.randrange(900)} Family"], None, None, rnd.choice(["novel", "manual", None]), rnd.choice(["en", "de"])) for i in range(1500)]
    rows += [book(f"z{i:04d}", ["One Author"]) for i in range(500)]
    books = spark.createDataFrame(rows, BOOKS)
    cfg = spark.createDataFrame([(1, "book", [0.8, 0.1, 0.1], 42), (2, "related", [0.6, 0.2, 0.2], 1), (3, "book", [0.9, 0.2, 0.1], 42), (4, None, None, None)], "split_id int, by_key string, ratios array<double>, seed bigint")
    got = S.assign(books, spark.createDataFrame([], TOC), cfg).collect()
    assert len(got) == 4 * 2000
    for split_id, want in ((1, [0.8, 0.1, 0.1]), (3, [0.75, 1 / 6, 1 / 12])):
        mine = [r for r in got if r.split_id == split_id]
        by_group = {}
        for r in mine:
            by_group.setdefault(r.group_id, set()).add(r.split)
        assert all(len(v) == 1 for v in by_group.values())
        for s, w in zip(S.SPLITS, want):
            assert abs(sum(r.split == s for r in mine) / 2000 - w) < 0.02, (split_id, s)
    assert {r.split for r in got if r.split_id == 4} == {"train"}
    again = {(r.split_id, r.book_id): r.split for r in S.assign(books, spark.createDataFrame([], TOC), cfg).collect()}
    assert again == {(r.split_id, r.book_id): r.split for r in got}
    assert S.assign(books.limit(0), spark.createDataFrame([], TOC), cfg).count() == 0

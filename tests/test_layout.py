from pyspark.sql import functions as F

from quire.operators import graph, layout
from quire.operators.compile import chatml, code, pretrain, rag, sft, training, with_boilerplate
from quire.operators.ordering import carry, running_count, with_neighbours, with_ordinal
from quire.operators.spans import assemble, lines, placed

RAW = "block_uid bigint, book_id string, page_idx int, blk_ord int, block_id string, bbox array<double>, raw_text string, block_type string, is_bold boolean, is_mono boolean, ingested_at timestamp"
PAGES = "book_id string, page_idx int, width double, height double, is_scanned boolean, char_count int, ingested_at timestamp"
TOC = "book_id string, toc_ord int, title string, level int, page_idx int"


def raw(spark, rows):
    return spark.createDataFrame([(i, b, p, o, f"p{p}_b{o}", box, t, k, bold, False, None) for i, (b, p, o, box, t, k, bold) in enumerate(rows)], RAW)


def page(spark, *keys):
    return spark.createDataFrame([(b, p, 530.0, 660.0, False, 1, None) for b, p in keys], PAGES)


def test_two_columns_are_read_left_then_right(spark):
    box = lambda x0, y, x1: [x0, y, x1, y + 12]
    rows = [("a", 0, 0, box(50.0, 60.0, 255.0), "l1", "paragraph", False), ("a", 0, 1, box(275.0, 60.0, 480.0), "r1", "paragraph", False), ("a", 0, 2, box(50.0, 100.0, 255.0), "l2", "paragraph", False),
            ("a", 0, 3, box(275.0, 100.0, 480.0), "r2", "paragraph", False), ("a", 0, 6, box(50.0, 140.0, 255.0), "l3", "paragraph", False), ("a", 0, 7, box(275.0, 140.0, 480.0), "r3", "paragraph", False),
            ("a", 0, 4, box(50.0, 50.0, 480.0), "top", "paragraph", False), ("a", 0, 5, box(50.0, 400.0, 480.0), "end", "paragraph", False)]
    b = layout.reading_order(layout.furniture(layout.blocks(raw(spark, rows)), page(spark, ("a", 0))))
    assert [r.raw_text for r in b.orderBy("rank").collect()] == ["top", "l1", "l2", "l3", "r1", "r2", "r3", "end"]
    assert b.where("two_col").count() == 8


def test_banner_moves_to_the_front(spark):
    box = lambda y: [50.0, y, 480.0, y + 12]
    rows = [("a", 0, 0, box(60.0), "intro", "paragraph", False), ("a", 0, 1, box(90.0), "C H A P T E R 4", "paragraph", False), ("a", 0, 2, box(300.0), "rest", "paragraph", False)]
    b = layout.reading_order(layout.furniture(layout.blocks(raw(spark, rows)), page(spark, ("a", 0))))
    assert [r.raw_text for r in b.orderBy("rank").collect()] == ["C H A P T E R 4", "intro", "rest"]


def test_furniture_by_form_and_frequency(spark):
    top, mid = [50.0, 5.0, 480.0, 17.0], [50.0, 300.0, 480.0, 312.0]
    rows = [("a", 0, 0, top, "The Book", "paragraph", False), ("a", 1, 0, top, "The Book", "paragraph", False), ("a", 2, 0, top, "Once", "paragraph", False), ("a", 3, 0, top, "xii", "paragraph", False),
            ("a", 3, 1, mid, "xii", "paragraph", False), ("a", 4, 0, mid, "see www.example.org", "paragraph", False), ("a", 5, 0, mid, None, None, None)]
    b = layout.furniture(layout.blocks(raw(spark, rows)), page(spark, *[("a", i) for i in range(6)]))
    assert {r.block_uid for r in b.where("block_type = 'furniture'").collect()} == {0, 1, 3, 5}


def test_redelivered_blocks_count_once(spark):
    r = raw(spark, [("a", 0, 0, [50.0, 60.0, 480.0, 72.0], "x", "paragraph", False)])
    assert layout.blocks(r.unionByName(r)).count() == 1


def test_first_toc_entry_wins(spark):
    box = [50.0, 100.0, 480.0, 112.0]
    b = layout.blocks(raw(spark, [("a", 0, 0, box, "1 Slow Repairs", "paragraph", False), ("a", 0, 1, box, "Plain", "heading", False), ("a", 0, 2, box, "Bold head", "heading", True)]))
    b = layout.reading_order(layout.furniture(b, page(spark, ("a", 0))))
    toc = spark.createDataFrame([("a", 1, "Slow Repairs and more", 1, 0), ("a", 0, "Slow Repairs", 0, 0), ("a", 2, "abc", 0, 0)], TOC)
    got = {r.block_uid: (r.block_type, r.level) for r in layout.structure(b, toc).collect()}
    assert got == {0: ("heading", 0), 1: ("paragraph", None), 2: ("heading", 2)}


def test_ordering_helpers_agree_with_plain_windows(spark, monkeypatch):
    from quire.operators import ordering

    monkeypatch.setattr(ordering, "ROWS_A_CHUNK", 8)
    monkeypatch.setattr(ordering, "PAGES_A_CHUNK", 2)
    rows = [(b, i // 3, i % 3, i if i % 5 == 0 else None) for b in "ab" for i in range(50)]
    df = with_ordinal(spark.createDataFrame(rows, "book_id string, page_idx int, o int, v int"), "n", "o")
    df = running_count(carry(df, "n", before=F.col("v")), "n", "k", F.col("v").isNotNull())
    df = with_neighbours(df, "n", 1, 7, {"ahead": (F.col("n"), 1, 7), "behind": (F.col("n"), -1, -1)})
    for r in df.collect():
        assert r.n == r.page_idx * 3 + r.o
        assert r.before == ((r.n - 1) // 5 * 5 if r.n else None)
        assert r.k == r.n // 5 + 1
        assert r.ahead == list(range(r.n + 1, min(50, r.n + 8))) and r.behind == ([r.n - 1] if r.n else [])


NODE = "book_id string, node_ord bigint, page_idx int, node_id string, node_type string, title string, text string, language string, parent_id string, breadcrumbs array<string>"


def test_boilerplate(spark):
    rows = [("a", 0, 4, "x", "paragraph", None, "Copyright 2020. All rights reserved.", None, "root", []), ("a", 1, 40, "y", "paragraph", None, "The stack grows down.", None, "root", []), ("a", 2, 370, "z", "section", "Index", "stack, 12, 13", None, "root", []), ("a", 3, 379, "w", "paragraph", None, "a, 1\nb, 2\nc, 3-4\nd, 5, 6", None, "root", [])]
    got = {r.node_id: r.boilerplate for r in with_boilerplate(spark.createDataFrame(rows, NODE)).collect()}
    assert got == {"x": True, "y": False, "z": True, "w": True}


def test_chunks_close_after_they_exceed(spark):
    text = " ".join(["w"] * 150)
    rows = [("a", i, 0, f"n{i}", "paragraph", None, text, None, "root", []) for i in range(7)]
    rows.insert(4, ("a", 99, 3, "h", "section", "Head", "Head", None, "root", []))
    rows = [(r[0], i, 3 if i >= 4 else 0, *r[3:]) for i, r in enumerate(rows)]
    got = rag(training(spark.createDataFrame(rows, NODE))).orderBy("chunk_id").collect()
    assert [len(r.content.split()) for r in got] == [450, 150, 450] and [r.page for r in got] == [1, 1, 4] and got[2].breadcrumbs == ["Head"]


def test_pairs_of_sections_code_and_exercises(spark):
    prose = " ".join(["word"] * 40)
    rows = [
        ("section", "Stacks", "Stacks", ["One"]), ("paragraph", None, prose, ["One", "Stacks"]), ("code", None, "mov eax, 1\nret", ["One", "Stacks"]), ("paragraph", None, prose, ["One", "Stacks"]),
        ("section", "Figure 3", "Figure 3", ["One"]), ("paragraph", None, prose, []), ("section", "Exercises", "Exercises:\n1. " + "do this one now please again " * 3 + "\n2. short\n3. " + "and then that one too today " * 3, []),
    ]
    n = spark.createDataFrame([("a", i, 40, f"n{i}", kind, title, text, None, "root", crumbs) for i, (kind, title, text, crumbs) in enumerate(rows)], NODE)
    got = sft(training(n)).orderBy("id").collect()
    assert [(r.id, r.category) for r in got] == [("sft_0001", "concept_qa"), ("sft_0002", "code_walkthrough"), ("sft_0003", "exercise"), ("sft_0004", "exercise")]
    assert got[0].instruction == "Explain the architecture and technical mechanics of Stacks in One in detail." and "```x86_asm" in got[0].output
    assert got[1].input == "```x86_asm\nmov eax, 1\nret\n```" and got[2].input.startswith("1. do")
    turns = chatml(sft(training(n))).orderBy("id").first().messages
    assert [t.role for t in turns] == ["system", "user", "assistant"]
    c = code(n).collect()
    assert [(r.code_id, r.language, r.line_count, r.surrounding_context) for r in c] == [("code_0001", "x86_asm", 2, f"{prose}\n\n{prose}")]


def test_documents_and_their_fallback(spark):
    long, short = " ".join(["w"] * 60), "few words"
    rows = [("a", "paragraph", None, long, 0), ("a", "chapter", "Chapter 1", "Chapter 1", 2), ("a", "section", "Part", "Part", 2), ("a", "paragraph", None, long, 4), ("a", "chapter", "About the Author", "About the Author", 5), ("a", "paragraph", None, long, 5), ("b", "paragraph", None, short, 3)]
    n = spark.createDataFrame([(b, i, p, f"n{i}", kind, title, text, None, "root", []) for i, (b, kind, title, text, p) in enumerate(rows)], NODE)
    books = spark.createDataFrame([("a", "Book A"), ("b", "Book B")], "book_id string, book_title string")
    got = {(r.book_id, r.doc_id): (r.chapter_title, r.page_start, r.page_end, r.word_count) for r in pretrain(training(n), books).collect()}
    assert got == {("a", "doc_000"): ("Book A", 1, 1, 60), ("a", "doc_001"): ("Chapter 1", 3, 5, 65), ("b", "doc_000"): ("Book B", 1, 4, 2)}


def test_empty_tables(spark):
    b = layout.blocks(spark.createDataFrame([], RAW))
    b = layout.typed(layout.structure(layout.reading_order(layout.furniture(b, layout.pages(spark.createDataFrame([], PAGES)))), spark.createDataFrame([], TOC)))
    n = graph.nodes(b)
    assert n.count() == 0 and rag(training(n)).count() == 0


SPAN = "book_id string, page_idx int, span_ord int, text string, x0 double, y0 double, x1 double, y1 double, font_size double, weight int, is_mono boolean"


def span(i, text, x0, x1, y, size=10.0, weight=400, mono=False, page=0):
    return ("b", page, i, text, float(x0), float(y), float(x1), float(y) + 10, size, weight, mono)


def test_lines_and_blocks_of_spans(spark):
    rows = [
        span(0, "defi", 0, 10, 0), span(1, "fi ned", 10, 30, 0), span(2, "word", 40, 60, 0), span(3, ",", 70, 72, 0), span(4, None, 0, 1, 0),
        span(0, "b", 50, 60, 1.0, page=1), span(1, "a", 0, 10, 3.0, page=1), span(2, "late", 70, 80, 4.2, page=1), span(3, "next", 0, 20, 14.0, page=1), span(4, "mov eax", 12, 40, 60.0, mono=True, page=1), span(5, "ret", 24, 40, 72.0, mono=True, page=1), span(6, " ", 0, 3, 90.0, page=1),
        span(0, "One Heading", 0, 60, 0, weight=700, page=2), span(1, "Another", 0, 60, 12, weight=700, page=2), span(2, "its text", 0, 60, 24, page=2), span(3, "- mark", 0, 60, 36, page=2), span(4, "far", 0, 60, 80, page=2), span(5, "; code", 0, 60, 92, page=2), span(6, "ab", 0, 10, 104, mono=True, page=2), span(7, "abc", 11, 20, 104, page=2),
    ]
    df = spark.createDataFrame(rows, SPAN)
    got = {}
    for r in lines(df).orderBy("page_idx", "line").collect():
        got.setdefault(r.page_idx, []).append(r.text)
    # 1.0 is not within 3.5 of 4.6, whatever lies between
    assert got == {0: ["defined word,"], 1: ["a b late", "next", "mov eax", "ret"], 2: ["One Heading", "Another", "its text", "- mark", "far", "; code", "ababc"]}
    out = [(r.page_idx, r.raw_text, r.block_type) for r in assemble(df).orderBy("page_idx", "blk_ord").collect()]
    assert out == [(0, "defined word,", "paragraph"), (1, "a b late next", "paragraph"), (1, "mov eax\n  ret", "code"), (2, "One Heading", "heading"), (2, "Another its text", "heading"), (2, "- mark", "list_item"), (2, "far ; code ababc", "paragraph")]
    assert assemble(df.limit(0)).count() == 0


def test_placed(spark):
    pages = spark.createDataFrame([("b", 0, 100.0, 200.0)], "book_id string, page_idx int, width double, height double")
    rows = [("b", 0, 0, "x", -3.0, 190.0, 120.0, 205.0, "Fira Code", None, None), ("b", 0, 1, "y", 1.0, 50.0, 9.0, 50.0, None, 9.0, 700), ("b", 0, 2, "", 1.0, 5.0, 9.0, 15.0, None, 9.0, 700)]
    o = spark.createDataFrame(rows, "book_id string, page_idx int, span_ord int, text string, left double, bottom double, right double, top double, font string, font_size double, weight int")
    got = [tuple(r) for r in placed(o, pages).orderBy("span_ord").select("x0", "y0", "x1", "y1", "font_size", "weight", "is_mono").collect()]
    assert got == [(0.0, 0.0, 100.0, 10.0, 10.0, 400, True), (1.0, 150.0, 9.0, 151.0, 9.0, 700, False)]

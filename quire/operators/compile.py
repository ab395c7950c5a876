"""From nodes to the five datasets: raw, pretraining, instruction, code and retrieval."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.ordering import running_count, with_neighbours, with_ordinal

#: Patterns and words of front matter, indexes and headings that make no question.
FRONT_MATTER = (
    r"(?i)\b(?:all\s+rights\s+reserved|isbn(?:-1[03])?:?|cataloging-in-publication|library\s+of\s+congress)\b",
    r"(?i)\b(?:published\s+by\s+john\s+wiley|wiley\s+publishing|o'reilly\s+media|packt\s+publishing)\b",
    r"(?i)\b(?:trademarks?:|no\s+part\s+of\s+this\s+publication\s+may\s+be\s+reproduced)\b",
    r"(?i)\b(?:printed\s+in\s+the\s+united\s+states\s+of\s+america)\b",
)
FRONT_TITLES = ("copyright", "disclaimer", "trademarks", "publisher", "isbn")
INDEX_LINE = r",\s*\d+(?:-\d+)?(?:,\s*\d+)*$"
INDEX_TITLES = ("index", "subject index", "author index")
OPENING_TITLES = ("author", "credit", "contents at a glance", "executive", "acknowledg")
NO_QUESTION_PREFIXES = ("figure", "table", "listing", "chart", "diagram", "note", "warning")
NO_QUESTION_TITLES = ("–", "—", "-", "*", "...")
NO_QUESTION_TERMS = ("author", "credit", "editor", "acknowledg", "contents", "engineering", "practical reverse", "glance")
ROLE = "You are an expert systems engineer and reverse engineering specialist. Provide detailed, technically rigorous explanations with code or disassembly where appropriate."
ASK_CODE = "Analyze the following code/disassembly snippet and explain what each instruction or construct does:"
ASK_EXERCISE = "Solve or answer the following technical problem:"
ASK_CONCEPT = ("Explain the architecture and technical mechanics of ", " in detail.")
ANSWER_EXERCISE = "Technical analysis and solution:\n\n"
CHUNK_WORDS = 400


def any_of(c: Column, terms: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | c.contains(t)
    return out


def book_pages(n: DataFrame) -> DataFrame:
    return n.groupBy("book_id").agg((F.max("page_idx") + 1).alias("total_pages"))


def with_boilerplate(n: DataFrame) -> DataFrame:
    """Nodes with ``total_pages`` and ``boilerplate``: front matter, and alphabetical indexes at the end."""
    n = n.join(book_pages(n), "book_id")
    text, title, pages = T.strip(F.col("text")), F.lower(T.strip(F.coalesce("title", F.lit("")))), F.col("total_pages")
    crumbs = F.transform("breadcrumbs", F.lower)
    front = F.lit(False)
    for p in FRONT_MATTER:
        front = front | text.rlike(p)
    front = (F.col("page_idx") < F.least(F.lit(15), F.greatest(F.lit(5), F.floor(pages * F.lit(0.05))))) & (front | any_of(title, FRONT_TITLES))
    named = title.contains("index") | F.exists(crumbs, lambda c: c.contains("index"))
    index = named & (title.isin(*INDEX_TITLES) | F.exists(crumbs, lambda c: c.isin("index", "subject index")))
    lines = T.full_lines(text)
    listed = F.size(F.filter(lines, lambda x: x.rlike(INDEX_LINE)))
    phone_book = (F.col("page_idx") > F.greatest(F.lit(20), pages - 30)) & (F.size(lines) >= 4) & (listed / F.size(lines) > 0.6)
    return n.withColumn("boilerplate", front | index | phone_book)


def training(n: DataFrame) -> DataFrame:
    """Nodes that aren't boilerplate, numbered anew as ``t``."""
    return with_ordinal(with_boilerplate(n).where("not boilerplate"), "t", "node_ord")


def raw(n: DataFrame) -> DataFrame:
    return n.where(T.strip(F.col("text")) != "").select("book_id", F.col("node_id").alias("id"), (F.col("page_idx") + 1).alias("page"), F.col("node_type").alias("type"), "text", "breadcrumbs")


def pretrain(train: DataFrame, books: DataFrame) -> DataFrame:
    """Documents of chapters in Markdown, with fenced code. ``books`` has (book_id, book_title).

    A chapter, or a section whose title starts with "chapter", opens a document; what comes before belongs to one with the
    book's title. Documents under 40 words and opening matter before page 25 are left out; a book without any document
    gets one of all its texts.
    """
    n = train.withColumns({"txt": T.strip(F.col("text")), "page": F.col("page_idx") + 1}).where("txt <> ''")
    opens = (F.col("node_type") == "chapter") | ((F.col("node_type") == "section") & F.lower(T.strip(F.col("title"))).startswith("chapter"))
    n = running_count(n, "t", "grp", opens)
    code = F.col("node_type") == "code"
    line = F.when(opens, F.concat(F.lit("# "), "title")).when(F.col("node_type") == "section", F.concat(F.lit("## "), "title")).when(code, T.fenced(F.col("txt"))).otherwise(F.col("txt"))
    plain = F.when(code, T.fenced(F.col("txt"))).otherwise(F.col("txt"))
    in_order = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("t", c.alias("x")))), lambda e: e["x"]), "\n\n")
    docs = n.groupBy("book_id", "grp").agg(
        T.strip(in_order(line)).alias("text"), F.min(F.when(opens, F.struct("t", "title", "page"))).alias("o"), F.max("page").alias("last"), F.first("total_pages").alias("total_pages")
    )
    docs = docs.join(books, "book_id").select(
        "book_id", "book_title", "grp", F.coalesce("o.title", "book_title").alias("chapter_title"), F.coalesce("o.page", F.lit(1)).alias("page_start"),
        F.when(F.col("o").isNull(), F.greatest(F.lit(1), "last")).otherwise(F.col("last")).alias("page_end"), T.word_count(F.col("text")).alias("word_count"), "text",
    )
    kept = docs.where("word_count >= 40").where(~((F.col("page_start") < 25) & any_of(F.lower("chapter_title"), OPENING_TITLES)))
    whole = n.groupBy("book_id").agg(in_order(plain).alias("text"), F.first("total_pages").alias("page_end")).join(kept.select("book_id").distinct(), "book_id", "left_anti").join(books, "book_id")
    whole = whole.select("book_id", "book_title", F.lit(0).cast("bigint").alias("grp"), F.col("book_title").alias("chapter_title"), F.lit(1).alias("page_start"), "page_end", T.word_count(F.col("text")).alias("word_count"), "text")
    out = kept.unionByName(whole)
    number = F.row_number().over(Window.partitionBy("book_id").orderBy("grp")) - 1  # chapters of a book, not its rows
    return out.select("book_id", F.format_string("doc_%03d", number).alias("doc_id"), "book_title", "chapter_title", "page_start", "page_end", "word_count", F.length("text").alias("char_count"), T.token_estimate(F.col("text")).alias("token_count"), "text")


def sft(train: DataFrame) -> DataFrame:
    """Instruction pairs: a section and the prose after it, a code block and its neighbours, exercises of a section."""
    head = F.col("node_type").isin("chapter", "section")
    code = F.col("node_type") == "code"
    row = F.struct("t", head.alias("head"), code.alias("code"), F.when(code, T.fenced(F.col("text"))).otherwise(T.strip(F.col("text"))).alias("x"), T.strip(F.col("text")).alias("s"))
    n = with_neighbours(train, "t", 1, 7, {"ahead": (row, 1, 7), "behind": (row, -1, -1)})
    title, low, page = T.strip(F.col("title")), F.lower(T.strip(F.col("title"))), F.col("page_idx") + 1
    asks = (
        title.rlike("[a-zA-Z]") & ~low.rlike("^(?:" + "|".join(NO_QUESTION_PREFIXES) + ")") & ~title.isin(*NO_QUESTION_TITLES) & (T.word_count(title) <= 8) & (F.length(title) <= 60)
        & ~((page < 29) & any_of(low, NO_QUESTION_TERMS))
    )
    stop = F.array_position(F.transform("ahead", lambda e: e["head"]), True)
    run = F.when(stop > 0, F.slice("ahead", 1, stop.cast("int") - 1)).otherwise(F.col("ahead"))
    prose = F.array_join(F.transform(F.filter(run, lambda e: e["s"] != ""), lambda e: e["x"]), "\n\n")
    crumb = F.when(F.size("breadcrumbs") > 0, F.concat(F.lit(" in "), F.element_at("breadcrumbs", -1))).otherwise("")
    cols = lambda rank, pos, ask, inp, out, cat: ["book_id", "t", F.lit(rank).alias("rank"), pos.alias("pos"), ask.alias("instruction"), inp.alias("input"), T.strip(out).alias("output"), F.lit(cat).alias("category"), page.alias("source_page"), "breadcrumbs"]
    zero = F.lit(0)
    a = n.where((F.col("node_type") == "section") & F.col("title").isNotNull() & (F.col("title") != "") & asks).withColumn("_p", prose).where(T.word_count(F.col("_p")) >= 30)
    a = a.select(*cols(1, zero, F.concat(F.lit(ASK_CONCEPT[0]), title, crumb, F.lit(ASK_CONCEPT[1])), F.lit(""), F.col("_p"), "concept_qa"))
    near = F.filter(F.concat("behind", F.slice("ahead", 1, 1)), lambda e: ~e["head"] & ~e["code"])
    txt = T.strip(F.col("text"))
    b = n.where(code & T.is_code(F.col("text"))).withColumn("_p", F.array_join(F.transform(near, lambda e: e["s"]), "\n\n")).where(T.word_count(F.col("_p")) >= 15)
    b = b.select(*cols(1, zero, F.lit(ASK_CODE), T.fenced(txt), F.col("_p"), "code_walkthrough"))
    items = n.where(F.lower("title").rlike("exercise|review question")).select("*", F.posexplode(F.split(txt, r"\n(?=\d+\.\s+)")).alias("_i", "_item"))
    items = items.withColumn("_item", T.strip(F.col("_item"))).where(F.col("_item").rlike(r"^\d+\.\s+") & (T.word_count(F.col("_item")) >= 6))
    c = items.select(*cols(2, F.col("_i"), F.lit(ASK_EXERCISE), F.col("_item"), F.concat(F.lit(ANSWER_EXERCISE), F.col("_item")), "exercise"))
    out = a.unionByName(b).unionByName(c).where(T.word_count(F.col("output")) >= 15)
    out = with_ordinal(out.withColumn("page_idx", F.col("source_page")), "k", "t", "rank", "pos", write=True).drop("page_idx")
    return out.select("book_id", F.format_string("sft_%04d", F.col("k") + 1).alias("id"), "category", "source_page", "breadcrumbs", "instruction", "input", "output")


def chatml(pairs: DataFrame) -> DataFrame:
    """Pairs as three turns: the role, the question with its input, the answer."""
    user = F.when(F.col("input") != "", T.strip(F.concat("instruction", F.lit("\n\n"), "input"))).otherwise(F.col("instruction"))
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return pairs.select("book_id", "id", "category", "source_page", "breadcrumbs", F.array(turn("system", F.lit(ROLE)), turn("user", user), turn("assistant", F.col("output"))).alias("messages"))


def code(n: DataFrame) -> DataFrame:
    """Code blocks with the texts of their neighbours of any type."""
    n = with_neighbours(n, "node_ord", 1, 1, {"near": (T.strip(F.col("text")), -1, 1), "own": (F.col("node_ord"), -1, -1)})
    txt = T.strip(F.col("text"))
    n = n.where((F.col("node_type") == "code") & T.is_code(F.col("text")))
    at = F.size("own") + 1
    context = F.array_join(F.filter(F.concat(F.slice("near", 1, at - 1), F.slice("near", at + 1, F.lit(1))), lambda x: x != ""), "\n\n")
    n = with_ordinal(n.select("book_id", "page_idx", "node_ord", txt.alias("code"), context.alias("surrounding_context"), "breadcrumbs"), "k", "node_ord", write=True)
    return n.select("book_id", F.format_string("code_%04d", F.col("k") + 1).alias("code_id"), (F.col("page_idx") + 1).alias("page"), T.code_language(F.col("code")).alias("language"), "breadcrumbs", "surrounding_context", "code", F.size(T.lines(F.col("code"))).alias("line_count"))


def rag(train: DataFrame, most: int = CHUNK_WORDS) -> DataFrame:
    """Retrieval chunks: texts under one heading, closed once they exceed ``most`` words; headings are in no chunk.

    Closing depends on all texts before, so words are summed in one pass over the sorted rows of a heading; texts are not
    held there, only their word counts.
    """
    head = F.col("node_type").isin("chapter", "section")
    n = running_count(train, "t", "sec", head)
    heads = n.where(head).select("book_id", "sec", F.concat("breadcrumbs", F.array("title")).alias("crumbs"), (F.col("page_idx") + 1).alias("hpage"))
    body = n.where(~head & (T.strip(F.col("text")) != "")).select("book_id", "sec", "t", T.word_count(F.col("text")).alias("w"), "text")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, number, total = None, 0, 0
        for b in batches:
            out = []
            for book, sec, w in zip(*(b.column(i).to_pylist() for i in (0, 1, 3))):
                if (book, sec) != now:
                    now, number, total = (book, sec), 0, 0
                out.append(number)
                total += w
                if total > most:
                    number, total = number + 1, 0
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int32())], names=[*b.schema.names, "part"])

    parts = body.repartition("book_id", "sec").sortWithinPartitions("book_id", "sec", "t").mapInArrow(close, "book_id string, sec bigint, t bigint, w int, text string, part int")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("t", "text"))), lambda e: e["text"]), "\n\n")
    chunks = parts.groupBy("book_id", "sec", "part").agg(text.alias("content")).join(heads, ["book_id", "sec"], "left")
    chunks = with_ordinal(chunks.withColumn("page_idx", F.col("sec")), "k", "part", write=True).drop("page_idx")
    return chunks.select("book_id", F.format_string("chunk_%04d", "k").alias("chunk_id"), F.coalesce("hpage", F.lit(1)).alias("page"), F.coalesce("crumbs", F.array().cast("array<string>")).alias("breadcrumbs"), "content")

"""From extracted blocks to typed blocks in reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T

#: Patterns of running heads, page numbers, watermarks and chapter openings.
PRINT_MARK = r"(?i)\.indd\s+\d+:\d+:\d+.*Page\s+\w+"
WATERMARK = r"(?i)www\.[a-z0-9\-]+\.(info|org|com|net)"
PAGE_NUMBER = r"(?i)^(\d{1,4}|[ivxlcdm]+)$"
RUNNING_HEAD = r"(?i)^(Chapter\s+\d+|[A-Z0-9\s]{3,30}\s+\d{1,4})$"
BANNER = r"(?i)^C\s*H\s*A\s*P\s*T\s*E\s*R\s*\d+"
HEADING = r"(?i)^(Chapter\s+\d+|Appendix\s+\w+|Index)$"
LINE_NUMBER = r"(?m)^\s*\d{2}:"
MEMORY = r"\[[eErR]?[a-z0-9_+* -]+\]"
HEX = r"0x[0-9a-fA-F]{4,8}"
NOT_A_NAME = r"[^\p{L}\p{N}_]+"
#: Registers and words of C that tell code.
REGISTERS = "eax ebx ecx edx esi edi ebp esp rax rbx rcx rdx rsi rdi rbp rsp r8 r9 r10 r11 r12 r13 r14 r15 al bl cl dl ah bh ch dh ax bx cx dx sp bp si di".split()
C_NAMES = "typedef struct sizeof volatile unsigned #include #define memcpy uint32_t uint64_t dword qword guid".split()

PAGE = ("book_id", "page_idx")


def pages(page_data: DataFrame) -> DataFrame:
    """One row for each page, of the last delivery."""
    w = Window.partitionBy(*PAGE).orderBy(F.desc("ingested_at"))
    one = page_data.withColumn("_r", F.row_number().over(w)).where("_r = 1")
    return one.select(*PAGE, F.coalesce("width", F.lit(530.0)).alias("width"), F.coalesce("height", F.lit(660.0)).alias("height"), "is_scanned", F.coalesce("char_count", F.lit(0)).alias("char_count"))


def blocks(raw_blocks: DataFrame) -> DataFrame:
    """One row for each block, of the last delivery; dealt out by page, so that all page-local steps run in place."""
    w = Window.partitionBy(*PAGE, "block_uid").orderBy(F.desc("ingested_at"))
    one = raw_blocks.repartition(*PAGE).withColumn("_r", F.row_number().over(w)).where("_r = 1")
    raw = F.coalesce("raw_text", F.lit(""))
    at = lambda i: F.col("bbox")[i]
    return one.select(
        "block_uid", *PAGE, "blk_ord", "block_id", at(0).alias("x0"), at(1).alias("y0"), at(2).alias("x1"), at(3).alias("y1"), raw.alias("raw_text"), T.strip(raw).alias("txt"),
        F.coalesce("block_type", F.lit("paragraph")).alias("block_type"), F.coalesce("is_bold", F.lit(False)).alias("is_bold"), F.coalesce("is_mono", F.lit(False)).alias("is_mono"),
    )


def in_margin() -> Column:
    return (F.col("y0") < F.col("height") * 0.06) | (F.col("y1") > F.col("height") * 0.94)


def margin_frequency(b: DataFrame) -> DataFrame:
    """Rows (book_id, txt, n): how often each text stands in a margin band of its book."""
    return b.where(in_margin()).groupBy("book_id", "txt").agg(F.count(F.lit(1)).alias("n"))


def furniture(b: DataFrame, p: DataFrame) -> DataFrame:
    """Blocks with ``furniture`` as type where they are running heads, page numbers or watermarks."""
    b = b.join(p.select(*PAGE, "width", "height"), list(PAGE), "left").withColumns({"width": F.coalesce("width", F.lit(530.0)), "height": F.coalesce("height", F.lit(660.0))})
    often = margin_frequency(b).where("n >= 2").select("book_id", F.md5("txt").alias("_m"), F.lit(True).alias("_often"))
    # blocks outside the margins get a key of their own: no key gathers them in one task
    key = F.when(in_margin(), F.md5("txt")).otherwise(F.col("block_uid").cast("string"))
    b = b.withColumn("_m", key).join(often, ["book_id", "_m"], "left")
    t = F.col("txt")
    marginal = F.coalesce("_often", F.lit(False)) | t.rlike(PAGE_NUMBER) | (t.rlike(RUNNING_HEAD) & (F.length(t) < 40)) | (t.contains("■") & (F.length(t) < 50))
    is_f = t.rlike(WATERMARK) | t.rlike(PRINT_MARK) | (in_margin() & marginal)
    return b.withColumn("block_type", F.when(is_f, "furniture").otherwise(F.col("block_type"))).drop("_m", "_often")


def reading_order(b: DataFrame) -> DataFrame:
    """Blocks that aren't furniture, with ``two_col`` and their ``rank`` on the page, from 0.

    A page has two columns if at least two blocks lie in each half, three quarters of the blocks in one of them and at most
    two span both; then spanning blocks at the top come first, the left and the right column follow. A chapter's opening
    banner in the upper part moves to the front. A block in the gutter counts for both halves but is read once, on the left.
    """
    page = Window.partitionBy(*PAGE)
    mid = F.col("width") / 2.0
    left, right = F.col("x1") <= mid + 10, F.col("x0") >= mid - 10
    span = (F.col("x0") < mid - 10) & (F.col("x1") > mid + 10)
    n = lambda c: F.sum(c.cast("int")).over(page)
    b = b.where("block_type <> 'furniture'").withColumns({"_l": n(left), "_r": n(right), "_s": n(span), "_n": F.count(F.lit(1)).over(page)})
    b = b.withColumn("two_col", (F.col("_l") >= 2) & (F.col("_r") >= 2) & ((F.col("_l") + F.col("_r")) / F.col("_n") >= 0.75) & (F.col("_s") <= 2))
    zone = F.when(~F.col("two_col"), 0).when(span & (F.col("y0") < F.col("height") * 0.3), 0).when(left, 1).when(right, 2).otherwise(3)
    bucket = F.bround(F.col("y0") / 3.5).cast("bigint")
    spanning = F.col("two_col") & zone.isin(0, 3)
    b = b.withColumns({"_zone": zone, "bucket": bucket})
    order = ["_zone", F.when(spanning, F.col("y0")).otherwise(F.col("bucket").cast("double")), F.when(spanning, 0.0).otherwise(F.col("x0")), "blk_ord"]
    b = b.withColumn("_rank", F.row_number().over(page.orderBy(*order)) - 1)
    first = F.min(F.when(F.col("raw_text").rlike(BANNER), F.struct("_rank", (F.col("y0") < F.col("height") * 0.3).alias("top")))).over(page)
    b = b.withColumn("_f", first)
    front = (F.col("_f.top")) & (F.col("_f._rank") > 0)
    rank = F.when(front & (F.col("_rank") == F.col("_f._rank")), 0).when(front & (F.col("_rank") < F.col("_f._rank")), F.col("_rank") + 1).otherwise(F.col("_rank"))
    return b.withColumn("rank", rank).drop("_l", "_r", "_s", "_n", "_zone", "_rank", "_f")


def structure(b: DataFrame, toc: DataFrame) -> DataFrame:
    """Blocks with headings settled: ``level`` and ``toc_title`` from the first entry of the page's table of contents whose
    letters contain the block's or are contained in them, else from boldness and form."""
    entry = F.struct("toc_ord", "title", "level", T.letters_and_digits(F.col("title")).alias("norm"))
    of_page = toc.where("page_idx is not null and title is not null").select(*PAGE, "toc_ord", "title", "level").distinct().groupBy(*PAGE).agg(F.array_sort(F.collect_list(entry)).alias("_toc"))
    b = b.join(of_page, list(PAGE), "left").withColumn("_norm", T.letters_and_digits(F.col("txt")))
    hits = F.filter(F.col("_toc"), lambda e: (F.length(e["norm"]) >= 4) & (F.contains(F.col("_norm"), e["norm"]) | F.contains(e["norm"], F.col("_norm"))))
    hit = F.get(hits, F.lit(0))
    t, bt = F.col("txt"), F.col("block_type")
    strong = F.col("is_bold") & (F.length(t) < 100) & ~t.rlike(r"[.;:,]\z")
    b = b.withColumn("_hit", hit)
    matched = F.col("_hit").isNotNull()
    return b.select(
        *[c for c in b.columns if c not in ("block_type", "_toc", "_norm", "_hit")],
        F.when(matched, "heading").when(strong & t.rlike(HEADING), "heading").when(~strong & (bt == "heading"), "paragraph").otherwise(bt).alias("block_type"),
        F.when(matched, F.col("_hit.level")).when(strong & t.rlike(HEADING), 1).when(strong & (bt == "heading"), 2).alias("level"),
        F.col("_hit.title").alias("toc_title"),
    )


def continuity(b: DataFrame) -> DataFrame:
    """Rows (book_id, page_idx, last_block, first_block): paragraphs that run on from a page to the next page number."""
    ends = b.groupBy(*PAGE).agg(F.min_by(F.struct("block_id", "block_type"), "rank").alias("first"), F.max_by(F.struct("block_id", "block_type", "raw_text"), "rank").alias("last"))
    nxt = ends.select("book_id", (F.col("page_idx") - 1).alias("page_idx"), F.col("first").alias("next"))
    runs = (F.col("last.block_type") == "paragraph") & (F.col("next.block_type") == "paragraph") & ~F.col("last.raw_text").rlike(r"[.:;?!]\z")
    return ends.join(nxt, list(PAGE)).where(runs).select(*PAGE, F.col("last.block_id").alias("last_block"), F.col("next.block_id").alias("first_block"))


def typed(b: DataFrame) -> DataFrame:
    """Blocks with code and list items told, and the ``language`` of code."""
    raw, bt = F.col("raw_text"), F.col("block_type")
    names = F.split(F.lower(raw), NOT_A_NAME)
    lits = lambda xs: F.array(*[F.lit(x) for x in xs])
    reg, c = F.arrays_overlap(names, lits(REGISTERS)), F.arrays_overlap(names, lits(C_NAMES))
    code = F.col("is_mono") | (bt == "code") | raw.rlike(LINE_NUMBER) | (reg & (raw.rlike(MEMORY) | raw.rlike(HEX)))
    item = F.col("txt").rlike(r"^(?:1\.|2\.|3\.|■|•|-)") & (bt != "heading")
    return b.withColumn("language", F.when(code, F.when(c & ~reg, "c").otherwise("x86_asm"))).withColumn("block_type", F.when(code, "code").when(item, "list_item").otherwise(bt))

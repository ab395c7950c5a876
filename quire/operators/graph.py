"""From typed blocks to the nodes of a book, with parents, breadcrumbs and clean text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.ordering import carry, with_ordinal


def nodes(b: DataFrame) -> DataFrame:
    """Rows (book_id, node_ord, page_idx, node_id, node_type, title, text, language, parent_id, breadcrumbs).

    The root of a book is no row; its children have ``root`` as parent. Titles in breadcrumbs are those before cleaning.
    """
    heading = F.col("block_type") == "heading"
    chapter = heading & ((F.col("level") == 0) | F.col("raw_text").contains("Chapter"))
    b = b.withColumn("node_type", F.when(chapter, "chapter").when(heading, "section").otherwise(F.col("block_type")))
    b = with_ordinal(b, "node_ord", "rank", "blk_ord", "block_uid")
    head = F.struct(F.col("block_id").alias("id"), F.col("raw_text").alias("title"), F.col("node_type").alias("sort"))
    is_head = F.col("node_type").isin("chapter", "section")
    b = carry(b, "node_ord", chap=F.when(F.col("node_type") == "chapter", head), head=F.when(is_head, head))
    parent = F.when(F.col("node_type") == "chapter", "root").when(F.col("node_type") == "section", F.coalesce("chap.id", F.lit("root"))).otherwise(F.coalesce("head.id", F.lit("root")))
    under = F.when(~is_head & (F.col("head.sort") == "section"), F.col("head.title"))
    crumbs = F.filter(F.array(F.when(F.col("node_type") != "chapter", F.col("chap.title")), under), lambda x: x.isNotNull())
    return b.select(
        "book_id", "node_ord", "page_idx", F.col("block_id").alias("node_id"), "node_type", F.when(is_head, F.col("raw_text")).alias("title"), T.clean(F.col("raw_text")).alias("text"),
        "language", parent.alias("parent_id"), crumbs.alias("breadcrumbs"),
    )


def validation(n: DataFrame) -> DataFrame:
    """One row for each book: node, word, code and heading counts, the root among the nodes, and a score."""
    out = n.groupBy("book_id").agg(
        (F.count(F.lit(1)) + 1).alias("total_nodes"),
        F.sum(T.word_count(F.col("text"))).alias("total_words"),
        F.count_if(F.col("node_type") == "code").alias("code_blocks"),
        F.count_if(F.col("node_type").isin("chapter", "section")).alias("headings"),
    )
    score = F.when((F.col("total_words") > 1000) & (F.col("headings") > 0), 0.95).otherwise(0.5)
    return out.withColumn("quality_score", score).withColumn("status", F.lit("passed"))

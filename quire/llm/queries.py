"""The pN_ queries of this subpackage, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import encoding, neardup, oracles, pairs, pii, scans, splits, tokens, visual
from quire.llm.common import table
from quire.session import hub


def p1_found(s: SparkSession, d: str) -> DataFrame:
    return pairs.found(table(s, d, "sft_pairs"))


def p2_tokens(s: SparkSession, d: str) -> DataFrame:
    return tokens.budget(table(s, d, "raw_blocks"), table(s, d, "documents"), table(s, d, "books"))


def p3_found(s: SparkSession, d: str) -> DataFrame:
    return splits.found(table(s, d, "books"))


def p3_splits(s: SparkSession, d: str) -> DataFrame:
    return splits.assign(table(s, d, "books"), table(s, d, "toc"), table(s, d, "split_config"))


def p3_records(s: SparkSession, d: str) -> DataFrame:
    a = p3_splits(s, d)
    kinds = (("raw_blocks", "block_uid", "block"), ("sft_pairs", "pair_id", "pair"), ("documents", "doc_id", "document"), ("books", "book_id", "book"))
    parts = [splits.assign_records(table(s, d, t).select(*{k, "book_id"}), k, kind, a) for t, k, kind in kinds]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def p3_checked(s: SparkSession, d: str) -> DataFrame:
    """What must hold of the splits: books, books assigned twice, groups in more than one split."""
    a = hub(p3_splits(s, d))
    groups = a.groupBy("split_id", "group_id").agg(F.count_distinct("split").alias("k")).groupBy("split_id").agg(F.count_if(F.col("k") > 1).alias("torn"))
    books = a.groupBy("split_id", "book_id").agg(F.count(F.lit(1)).alias("k")).groupBy("split_id").agg(F.count(F.lit(1)).alias("books"), F.count_if(F.col("k") > 1).alias("twice"))
    return books.join(groups, "split_id").select(F.col("split_id").cast("bigint").alias("split_id"), "books", "twice", "torn")


def p4_found(s: SparkSession, d: str) -> DataFrame:
    return encoding.found(table(s, d, "raw_blocks"))


def p4_restored(s: SparkSession, d: str) -> DataFrame:
    return encoding.restored(table(s, d, "raw_blocks"))


def _scan_tables(s: SparkSession, d: str) -> list[DataFrame]:
    return [table(s, d, t) for t in ("raw_blocks", "page_data", "books", "toc")]


def p5_found(s: SparkSession, d: str) -> DataFrame:
    return scans.found(*_scan_tables(s, d))


def p5_cleaned(s: SparkSession, d: str) -> DataFrame:
    return scans.repaired(*_scan_tables(s, d))


def p6_found(s: SparkSession, d: str) -> DataFrame:
    """Runs of three words and at least 25 words, as the statement of the problem asks."""
    got = neardup.pairs(table(s, d, "raw_blocks"), "block_uid", "clean_text", threshold=0.8, n=3, least_words=25)
    return got.select(got.a.alias("block_uid_a"), got.b.alias("block_uid_b"))


def p6_groups(s: SparkSession, d: str) -> DataFrame:
    got = neardup.groups(table(s, d, "raw_blocks"), "block_uid", "clean_text", threshold=0.8, n=3, least_words=25)
    return got.withColumnRenamed("id", "block_uid")


def p7_found(s: SparkSession, d: str) -> DataFrame:
    got = visual.pairs(table(s, d, "raw_blocks"), "block_uid", "book_id", "raw_text")
    return got.select(got.a.alias("block_uid_a"), got.b.alias("block_uid_b"))


def p7_groups(s: SparkSession, d: str) -> DataFrame:
    return visual.groups(table(s, d, "raw_blocks"), "block_uid", "book_id", "raw_text").withColumnRenamed("id", "block_uid")


def p7_normalized(s: SparkSession, d: str) -> DataFrame:
    return visual.normalized(table(s, d, "raw_blocks"), "block_uid", "raw_text")


def p8_ids(s: SparkSession, d: str) -> DataFrame:
    return tokens.encode_ids(table(s, d, "documents"))


def p9_packed(s: SparkSession, d: str) -> DataFrame:
    return tokens.pack(table(s, d, "documents"), table(s, d, "pack_config"))


def p9_checked(s: SparkSession, d: str) -> DataFrame:
    """What must hold of the containers: documents, containers over capacity, documents torn without need, containers of
    more than one source where only one is allowed."""
    cfg = table(s, d, "pack_config").select("pack_id", "capacity_tokens", "per_source").dropDuplicates(["pack_id"])
    source = table(s, d, "documents").select("doc_id", F.coalesce(tokens.canon_source(F.col("source")), F.lit("")).alias("source")).dropDuplicates(["doc_id"])
    p = hub(p9_packed(s, d).join(F.broadcast(cfg), "pack_id").join(source, "doc_id"))
    of = p.groupBy("pack_id", "container", "capacity_tokens", "per_source").agg(F.sum("tokens").alias("t"), F.count_distinct("source").alias("k"))
    of = of.groupBy("pack_id").agg(F.count_if(F.col("t") > F.col("capacity_tokens")).alias("over"), F.count_if(F.col("per_source") & (F.col("k") > 1)).alias("mixed"))
    docs = p.groupBy("pack_id", "doc_id", "capacity_tokens").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("k"))
    docs = docs.groupBy("pack_id").agg(F.count(F.lit(1)).alias("documents"), F.count_if((F.col("k") > 1) & (F.col("t") <= F.col("capacity_tokens"))).alias("torn"))
    return docs.join(of, "pack_id").select(F.col("pack_id").cast("bigint").alias("pack_id"), "documents", "over", "torn", "mixed")


def p10_found(s: SparkSession, d: str) -> DataFrame:
    return pii.found(table(s, d, "documents"), table(s, d, "given_names"))


def p10_redacted(s: SparkSession, d: str) -> DataFrame:
    return pii.redact(table(s, d, "documents"), table(s, d, "given_names"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1:2].isdigit() and callable(f)}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()

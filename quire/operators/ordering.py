"""Order within a book that doesn't put a book into one task.

A book may hold a third of all rows, so nothing here runs a window over a whole book. Rows are numbered by counting inside
chunks of pages and adding the counts of earlier chunks; values are carried forward inside chunks and then from chunk to
chunk on a table that has one row for each chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import hub

PAGES_A_CHUNK = 64
ROWS_A_CHUNK = 4096


def with_ordinal(df: DataFrame, name: str, *order: str, write: bool = False) -> DataFrame:
    """``df`` with the number of each row in its book, from 0, by page and then by ``order``. ``df`` is read twice; ``write``
    is for rows that cost more to work out again than to write once."""
    chunked = (hub(df) if write else df).withColumn("_c", F.floor(F.col("page_idx") / PAGES_A_CHUNK))
    counts = chunked.groupBy("book_id", "_c").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("book_id", "_c", (F.sum("_n").over(Window.partitionBy("book_id").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1))).alias("_b"))
    own = F.row_number().over(Window.partitionBy("book_id", "_c").orderBy("page_idx", *order)) - 1
    return chunked.withColumn("_r", own).join(before, ["book_id", "_c"]).withColumn(name, (F.coalesce("_b", F.lit(0)) + F.col("_r")).cast("bigint")).drop("_c", "_r", "_b")


def carry(df: DataFrame, ordinal: str, **values: Column) -> DataFrame:
    """``df`` with, under each name, the last non-NULL value at an earlier row of the book."""
    chunked = df.withColumn("_k", F.floor(F.col(ordinal) / ROWS_A_CHUNK))
    for n, v in values.items():
        chunked = chunked.withColumn(f"_v_{n}", v)
    lasts = chunked.groupBy("book_id", "_k").agg(*[F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.col(ordinal))).alias(f"_l_{n}") for n in values])
    earlier = Window.partitionBy("book_id").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    lasts = lasts.select("book_id", "_k", *[F.last(f"_l_{n}", ignorenulls=True).over(earlier).alias(f"_b_{n}") for n in values])
    inside = Window.partitionBy("book_id", "_k").orderBy(ordinal).rowsBetween(Window.unboundedPreceding, -1)
    out = chunked.join(lasts, ["book_id", "_k"])
    for n in values:
        out = out.withColumn(n, F.coalesce(F.last(f"_v_{n}", ignorenulls=True).over(inside), F.col(f"_b_{n}")))
    return out.drop("_k", *[f"_{x}_{n}" for n in values for x in "vb"])


def running_count(df: DataFrame, ordinal: str, name: str, of: Column) -> DataFrame:
    """``df`` with the number of rows of the book, up to and with this one, for which ``of`` holds."""
    chunked = df.withColumn("_k", F.floor(F.col(ordinal) / ROWS_A_CHUNK)).withColumn("_h", F.coalesce(of, F.lit(False)).cast("bigint"))
    counts = chunked.groupBy("book_id", "_k").agg(F.sum("_h").alias("_n"))
    before = counts.select("book_id", "_k", F.sum("_n").over(Window.partitionBy("book_id").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)).alias("_b"))
    own = F.sum("_h").over(Window.partitionBy("book_id", "_k").orderBy(ordinal))
    return chunked.withColumn("_s", own).join(before, ["book_id", "_k"]).withColumn(name, F.coalesce("_b", F.lit(0)) + F.col("_s")).drop("_k", "_h", "_s", "_b")


def with_neighbours(df: DataFrame, ordinal: str, before: int, after: int, columns: dict[str, tuple[Column, int, int]]) -> DataFrame:
    """``df`` with lists of what neighbouring rows hold: each column is (value, first, last) in offsets from the row.

    Rows near the ends of a chunk are copied into the neighbouring chunk, so windows run inside chunks only.
    """
    k, m = F.floor(F.col(ordinal) / ROWS_A_CHUNK), F.col(ordinal) % ROWS_A_CHUNK
    homes = F.filter(F.array(F.lit(0), F.when(m < after, F.lit(-1)), F.when(m >= ROWS_A_CHUNK - before, F.lit(1))), lambda x: x.isNotNull())
    spread = df.withColumn("_o", F.explode(homes)).withColumn("_k", k + F.col("_o"))
    w = Window.partitionBy("book_id", "_k").orderBy(ordinal)
    for n, (v, lo, hi) in columns.items():
        spread = spread.withColumn(n, F.collect_list(v).over(w.rowsBetween(lo, hi)))
    return spread.where("_o = 0").drop("_o", "_k")

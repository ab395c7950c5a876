"""Source files: collecting, hashing and registering them, and text pages as pages of blocks."""

from __future__ import annotations

import functools
import hashlib
import warnings
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text as T


def collect_files(spark: SparkSession, *paths: str, suffix: str = ".pdf") -> DataFrame:
    """Rows (path, sha256, size_bytes, dir), one for each file with ``suffix``, in any case for a path that is a file and in
    lower case for those under a folder. A path that doesn't exist is warned of and left out.

    Tasks stream the files piece by piece, so a file may have any size; all executors must mount the folders.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there = []
    for p in paths:
        where = jvm.org.apache.hadoop.fs.Path(p)
        fs = where.getFileSystem(conf)
        if not fs.exists(where):
            warnings.warn(f"{p} doesn't exist", stacklevel=2)
        elif fs.getFileStatus(where).isDirectory():
            there.append(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(p))
        elif p.lower().endswith(suffix):
            there.append(spark.read.format("binaryFile").load(p))
    schema = "path string, sha256 string, size_bytes bigint"
    if not there:
        return spark.createDataFrame([], schema + ", dir string")
    found = functools.reduce(DataFrame.unionByName, [t.select("path", "length") for t in there]).dropDuplicates(["path"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests = []
            for p in b.column(0).to_pylist():
                h = hashlib.sha256()
                with open(unquote(urlparse(p).path), "rb") as f:
                    while piece := f.read(1 << 22):
                        h.update(piece)
                digests.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests, pa.string()), b.column(1)], names=["path", "sha256", "size_bytes"])

    return found.mapInArrow(run, schema).withColumn("dir", F.substring("sha256", 1, 12))


def inbox(spark: SparkSession, folder: str, suffix: str = ".pdf") -> DataFrame:
    """Files as they arrive in ``folder``: a stream of (path, modificationTime, length)."""
    return spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", f"*{suffix}").load(folder).select("path", "modificationTime", "length")


def register(found: DataFrame, known: DataFrame) -> DataFrame:
    """Files whose content isn't registered yet, one row for each content, the first path by name."""
    first = found.groupBy("sha256").agg(F.min_by(F.struct("path", "size_bytes", "dir"), "path").alias("r"))
    return first.select("sha256", "r.*").join(known.select("sha256"), "sha256", "left_anti")


def text_pages(pages: DataFrame, width: float = 530.0, height: float = 660.0) -> DataFrame:
    """Blocks of pages given as text (book_id, page_idx, text): a block for each line that isn't blank, spread evenly."""
    lines = F.posexplode(T.full_lines(F.col("text")))
    rows = pages.where("text is not null").select("book_id", "page_idx", F.size(T.full_lines(F.col("text"))).alias("n"), lines.alias("blk_ord", "raw_text"))
    y0 = F.bround(F.col("blk_ord") / F.greatest(F.lit(1), F.col("n")) * height, 2)
    bold = F.col("blk_ord") == 0
    heading = bold & (F.length("raw_text") < 120) & ~F.col("raw_text").rlike(r"[.;]\z")
    uid = F.row_number().over(Window.partitionBy("book_id", "page_idx").orderBy("blk_ord"))
    return rows.select(
        F.xxhash64("book_id", "page_idx", uid).alias("block_uid"), "book_id", "page_idx", "blk_ord", F.format_string("p%d_b%d", "page_idx", "blk_ord").alias("block_id"),
        F.array(F.lit(50.0), y0, F.lit(width - 50), y0 + 12).alias("bbox"), "raw_text", F.when(heading, "heading").otherwise("paragraph").alias("block_type"), bold.alias("is_bold"),
        F.lit(False).alias("is_mono"), F.lit(None).cast("timestamp").alias("ingested_at"),
    )

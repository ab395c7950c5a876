"""Datasets as JSON lines: writing with a manifest, checking, listing and paging."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T


def write_jsonl(df: DataFrame, path: str, *order: str) -> None:
    """One JSON object a line, NULL fields kept; a finished folder is never written over."""
    (df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df).write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, sha256, bytes) of the data files of a folder. Tasks stream the files, one at a time and a piece of each at
    a time, so a file may have any size; the folder must be one that all executors mount."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(f.getPath().getName() for f in fs.listStatus(fs_path) if f.isFile() and f.getPath().getName().startswith("part-"))
    local = fs.resolvePath(fs_path).toUri().getPath()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, list, list] = ([], [], [])
            for name in b.column(0).to_pylist():
                h, size = hashlib.sha256(), 0
                with open(os.path.join(local, name), "rb") as f:
                    while piece := f.read(1 << 22):
                        h.update(piece)
                        size += len(piece)
                for col, v in zip(out, (name, h.hexdigest(), size)):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], names=["file", "sha256", "bytes"])

    files = spark.createDataFrame([(n,) for n in names], "file string")
    return files.repartition(max(1, min(len(names), 1000))).mapInArrow(run, "file string, sha256 string, bytes bigint")


def write_by_book(df: DataFrame, path: str, order: str) -> None:
    """JSON lines in a folder for each book, ``path/book_id=...``; a book of any size is written by as many tasks as its
    rows need, each file in order."""
    df.repartitionByRange("book_id", order).sortWithinPartitions("book_id", order).write.mode("errorifexists").option("ignoreNullFields", "false").partitionBy("book_id").json(path)


def summaries(datasets: dict[str, DataFrame], nodes: DataFrame, train: DataFrame) -> DataFrame:
    """One row for each book: its nodes, the raw records, which are as many, those for training, and records by dataset."""
    names = {"pretrain": "pretrain_docs", "sft": "sft_pairs", "code": "code_blocks", "rag": "rag_chunks"}
    out = nodes.groupBy("book_id").agg(F.count(F.lit(1)).alias("total_nodes"), F.count(F.lit(1)).alias("raw_lines"))
    out = out.join(train.groupBy("book_id").agg(F.count(F.lit(1)).alias("training_nodes")), "book_id", "left")
    for k, name in names.items():
        out = out.join(datasets[k].groupBy("book_id").agg(F.count(F.lit(1)).alias(name)), "book_id", "left")
    return out.na.fill(0)


def workspace_manifest(spark: SparkSession, out: str, parts: DataFrame, books: DataFrame, compiled_at: str) -> dict:
    """What was compiled: when, how many books with their names, and file, records and bytes of each dataset."""
    rows = {r.dataset: {"path": f"{out}/{r.dataset}", "records": r.records, "size_bytes": r.bytes} for r in parts.collect()}  # a row for each dataset
    named = books.select("book_id").distinct()
    sources = f"{out}/book_sources"
    named.orderBy("book_id").write.mode("errorifexists").json(sources)
    return {"compiled_at": compiled_at, "total_books": named.count(), "book_sources": sources, "datasets": rows}


def write_document(spark: SparkSession, path: str, obj: object) -> None:
    """One small JSON document with sorted keys, put in place by renaming, so that readers see it whole or not at all."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.partial")
    fs = target.getFileSystem(conf)
    stream = fs.create(part, True)
    stream.write(bytearray(json.dumps(obj, sort_keys=True, indent=2, ensure_ascii=False).encode("utf-8")))
    stream.hsync()
    stream.close()
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"can't rename to {path}")


def sweep_partials(spark: SparkSession, root: str) -> int:
    """Delete what unfinished writes left right under ``root``; returns how many there were."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(conf)
    gone = 0
    for f in fs.listStatus(where) if fs.exists(where) else ():
        name, left = f.getPath().getName(), jvm.org.apache.hadoop.fs.Path(f.getPath(), "_temporary")
        if name.endswith(".partial"):
            gone += fs.delete(f.getPath(), True)
        elif f.isDirectory() and fs.exists(left):
            gone += fs.delete(left, True)
    return gone


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def latest_stage(spark: SparkSession, root: str, key: str) -> str | None:
    """The finished folder of a stage under its planned key, or None; other keys, newer or older, are never taken for it."""
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{root}/{key}/_SUCCESS")
    return f"{root}/{key}" if done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done) else None


def is_whole(spark: SparkSession, path: str, listed: DataFrame, deep: bool = True) -> bool:
    """Whether all listed files are there with their sizes and, if ``deep``, their contents."""
    there = manifest(spark, path)
    keys = ["file", "bytes", "sha256"] if deep else ["file", "bytes"]
    return listed.select(*keys).join(there.select(*keys), keys, "left_anti").limit(1).count() == 0


def catalogue(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows (path, scope, title, bytes, records, modified) of dataset files: those of one book, whose folder names it, or of
    the workspace. Blank lines are no records."""
    meta = [F.col(f"_metadata.file_{c}").alias(n) for c, n in (("path", "path"), ("size", "bytes"), ("modification_time", "modified"))]
    rows = spark.read.option("recursiveFileLookup", "true").text(list(paths)).select(*meta, "value")
    book = F.regexp_extract("path", "book_id=([^/]+)/", 1)
    out = rows.groupBy("path", "bytes", "modified").agg(F.count_if(T.strip(F.col("value")) != "").alias("records"))
    return out.select("path", F.when(book != "", "book").otherwise("workspace").alias("scope"), F.when(book != "", book).otherwise("all books").alias("title"), "bytes", "records", "modified")


def preview(spark: SparkSession, path: str, offset: int = 0, limit: int = 10) -> tuple[list[dict], int]:
    """Records of a page of one file and the number of its lines; malformed lines come as ``raw_line``, blank ones count but
    aren't shown. The page is the feature: the limit bounds what reaches the driver."""
    lines = spark.read.text(path)
    out = []
    for r in lines.offset(offset).limit(limit).collect():
        if r.value.strip():
            try:
                out.append(json.loads(r.value))
            except ValueError:
                out.append({"raw_line": r.value})
    return out, lines.count()


def audit(spark: SparkSession, root: str) -> tuple[int, int]:
    """How many folders right under ``root`` are finished, and how many aren't."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(conf)
    done = [fs.exists(jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS")) for f in (fs.listStatus(where) if fs.exists(where) else ()) if f.isDirectory()]
    return sum(done), len(done) - sum(done)

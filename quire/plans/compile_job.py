"""Compile a folder of tables into the five datasets, one folder of JSON lines each, with a manifest."""

from __future__ import annotations

from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import config
from quire.operators import compile as C
from quire.operators.ordering import with_ordinal
from quire.operators.pipeline import Corpus
from quire.session import hub, scratch
from quire.sources.datasets import catalogue, summaries, workspace_manifest, write_by_book, write_document, write_jsonl


def compile_all(spark: SparkSession, sf_dir: str, out: str, settings: dict[str, Any] | None = None) -> DataFrame:
    """Write the datasets under ``out``, with a summary of every book and a manifest, and return (dataset, records, files,
    bytes). Each dataset is a folder of JSON lines, or with the setting ``by_book`` one folder for each book in it. A finished
    folder is an error, so a job that is run again writes elsewhere."""
    s = (settings or config.load())["dataset"]
    with scratch(spark):
        k = Corpus(spark, sf_dir)
        nodes = k.nodes()
        train = C.with_boilerplate(nodes)
        train = hub(with_ordinal(train.where("not boilerplate") if s["filter_boilerplate"] else train, "t", "node_ord"))
        pairs = hub(C.sft(train))
        if s["sft_format"] == "chatml":
            pairs = C.chatml(pairs)
        elif s["sft_format"] == "both":
            pairs = pairs.join(C.chatml(pairs).select("book_id", "id", "messages"), ["book_id", "id"])
        parts = {"raw": (C.raw(nodes), "page"), "pretrain": (hub(C.pretrain(train, k.titles())), "doc_id"), "sft": (pairs, "id"), "code": (hub(C.code(nodes)), "code_id"), "rag": (hub(C.rag(train, int(s["chunk_words"]))), "chunk_id")}
        rows = []
        for name, (df, order) in parts.items():
            if s.get("by_book"):
                write_by_book(df, f"{out}/{name}", order)
            else:
                write_jsonl(df, f"{out}/{name}", "book_id", order)
            files = catalogue(spark, f"{out}/{name}").agg(F.sum("records"), F.count(F.lit(1)), F.sum("bytes")).first()
            rows.append((name, *(int(x or 0) for x in files)))
        summaries({n: df for n, (df, _) in parts.items()}, nodes, train).write.mode("errorifexists").json(f"{out}/summary")
        made = spark.createDataFrame(rows, "dataset string, records bigint, files bigint, bytes bigint")
        at = datetime.now(timezone.utc).isoformat(timespec="seconds")
        write_document(spark, f"{out}/manifest.json", workspace_manifest(spark, out, made, nodes, at))
    return made

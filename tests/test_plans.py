import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from quire import config
from quire.functions import keys as K

DATA = "/root/testdata/sf0.001"


def test_config(tmp_path):
    (tmp_path / "quire.toml").write_text("[limits]\nmax_attempts = 5\nshard_pages = 7\n")
    c = config.load(tmp_path, {"profile": "fast", "dataset": {"sft_format": "alpaca"}})
    assert c["limits"] == {"shard_pages": 30, "max_attempts": 5} and c["dataset"]["sft_format"] == "alpaca" and c["dataset"]["chunk_words"] == 400
    assert config.load()["limits"]["shard_pages"] == 20
    for bad in ({"profile": "x"}, {"dataset": {"sft_format": "x"}}, {"quality": {"good": 2}}, {"limits": {"shard_pages": 0}}):
        with pytest.raises(ValueError):
            config.load(overrides=bad)


def test_keys(spark):
    df = spark.createDataFrame([("a" * 64, "text", 3, [10.1, 19.0, 99.9, 50.2], [11.0, 20.0, 98.0, 49.0])], "sha string, text string, page int, box array<double>, near array<double>")
    key = lambda ins: K.stage_key("s", "1", {"b": 1, "a": 2}, F.array(*[F.lit(i) for i in ins]))
    r = df.select(key("xy").alias("k1"), key("yx").alias("k2"), key("xz").alias("k3"), K.node_key(F.col("sha"), F.col("text"), F.col("page"), F.col("box"), F.lit("code")).alias("n1"), K.node_key(F.col("sha"), F.col("text"), F.col("page"), F.col("near"), F.lit("code")).alias("n2"), K.block_key(F.col("sha"), F.col("page"), F.lit(4)).alias("b")).first()
    assert r.k1 == r.k2 != r.k3 and len(r.k1) == 16 and r.n1 == r.n2 and r.b == "aaaaaaaaaaaa_p0003_b004"
    assert r.n1 == "n_" + hashlib.sha256(b"aaaaaaaaaaaa|text|3|(8, 16, 96, 48)|code").hexdigest()[:8]
    c = df.select(K.book_slug(F.lit("A Book: One"), F.col("sha")).alias("s"), K.book_slug(F.lit("…"), F.col("sha")).alias("e"), K.chunk_key(F.lit("slug"), F.lit(1), F.lit(2), F.lit(3), F.lit("x")).alias("c")).first()
    assert c.s == "a_book_one_aaaaaa" and c.e == "a" * 12 and c.c == "slug_01_02_0003_" + hashlib.sha256(b"x").hexdigest()[:6]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_compile_all(spark, tmp_path):
    from quire.plans.compile_job import compile_all

    out = str(tmp_path / "out")
    rows = {r.dataset: r for r in compile_all(spark, DATA, out).collect()}
    assert set(rows) == {"raw", "pretrain", "sft", "code", "rag"} and all(r.records > 0 and r.bytes > 0 for r in rows.values())
    assert {"messages", "instruction"} <= set(spark.read.json(f"{out}/sft").columns)
    with pytest.raises(Exception, match="exists|EXISTS"):
        compile_all(spark, DATA, out)
    made = json.loads((tmp_path / "out" / "manifest.json").read_text())
    assert {k: v["records"] for k, v in made["datasets"].items()} == {k: r.records for k, r in rows.items()} and made["total_books"] > 0
    summary = spark.read.json(f"{out}/summary")
    assert summary.count() == made["total_books"] and summary.agg({"rag_chunks": "sum"}).first()[0] == rows["rag"].records
    by_book = config.load(overrides={"dataset": {"by_book": True}})
    again = {r.dataset: r.records for r in compile_all(spark, DATA, str(tmp_path / "books"), by_book).collect()}
    assert again == {k: r.records for k, r in rows.items()}
    from quire.sources.datasets import catalogue

    of = catalogue(spark, str(tmp_path / "books" / "rag")).collect()
    assert {r.scope for r in of} == {"book"} and sum(r.records for r in of) == rows["rag"].records

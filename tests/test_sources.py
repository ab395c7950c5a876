import hashlib
import json

import pytest
from pyspark.sql import functions as F

from quire.sources import datasets, inputs
from quire.streaming import events


def test_jsonl_round_trip_manifest_and_preview(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, x string").coalesce(1)
    path = str(tmp_path / "out")
    datasets.write_jsonl(df, path)
    listed = datasets.manifest(spark, path)
    rows = listed.collect()
    assert datasets.is_whole(spark, path, spark.createDataFrame(rows, listed.schema))
    assert not datasets.is_whole(spark, path, spark.createDataFrame([(r.file, "0", r.bytes) for r in rows], listed.schema))
    assert datasets.catalogue(spark, path).select("records").first().records == 2
    f = tmp_path / "x.jsonl"
    f.write_text(json.dumps({"a": 1}) + "\n\nnot json\n")
    assert datasets.preview(spark, str(f), 0, 10) == ([{"a": 1}, {"raw_line": "not json"}], 3)
    assert datasets.preview(spark, str(f), 2, 1)[0] == [{"raw_line": "not json"}]


def test_registering_is_idempotent(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"one")
    (tmp_path / "b.pdf").write_bytes(b"one")
    (tmp_path / "c.txt").write_bytes(b"two")
    (tmp_path / "D x.PDF").write_bytes(b"three")
    with pytest.warns(UserWarning, match="doesn't exist"):
        found = inputs.collect_files(spark, str(tmp_path), str(tmp_path / "a.pdf"), str(tmp_path / "D x.PDF"), str(tmp_path / "gone.pdf"))
    got = {r.path.rsplit("/", 1)[1]: (r.sha256, r.size_bytes, r.dir) for r in found.collect()}
    digest = lambda x: hashlib.sha256(x).hexdigest()
    assert got == {"a.pdf": (digest(b"one"), 3, digest(b"one")[:12]), "b.pdf": (digest(b"one"), 3, digest(b"one")[:12]), "D x.PDF": (digest(b"three"), 5, digest(b"three")[:12])}
    found = inputs.collect_files(spark, str(tmp_path))
    new = inputs.register(found, spark.createDataFrame([], "sha256 string"))
    assert new.count() == 1 and inputs.register(found, new).count() == 0


def test_inbox(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"one")
    (tmp_path / "b.txt").write_bytes(b"two")
    assert [r.path.rsplit("/", 1)[1] for r in events.drain(inputs.inbox(spark, str(tmp_path)), "append").collect()] == ["a.pdf"]


def test_pages_in_shards(spark, tmp_path):
    from quire.sources.pages import PageSource

    spark.dataSource.register(PageSource)
    (tmp_path / "a.txt").write_text("# One\nbody\f" + "".join(f"page {i}\f" for i in range(5)) + "## Two\n#  \nlast ü", encoding="utf-8")
    (tmp_path / "b.txt").write_text(" \n\f", encoding="utf-8")
    (tmp_path / "c.txt").write_text("", encoding="utf-8")
    df = spark.read.format("quire_pages").option("path", str(tmp_path)).option("shard_pages", 3).load()
    got = sorted((r.path[-5:], r.page_idx, r.text, r.char_count, r.is_scanned) for r in df.collect())
    assert [g[:2] for g in got] == [("a.txt", i) for i in range(7)] + [("b.txt", 0)] and df.rdd.getNumPartitions() == 4
    assert got[1][2:] == ("page 0", 6, False) and got[6][2].endswith("ü") and got[7][2:] == (None, 0, True)
    toc = spark.read.format("quire_pages").option("path", str(tmp_path)).option("table", "toc").load()
    assert sorted((r.path[-5:], r.toc_ord, r.title, r.level, r.page_idx) for r in toc.collect()) == [("a.txt", 0, "One", 0, 0), ("a.txt", 1, "Two", 1, 6)]
    assert spark.read.format("quire_pages").option("path", str(tmp_path / "none")).load().count() == 0


def test_text_pages(spark):
    p = spark.createDataFrame([("a", 0, "Head\n\nbody text.\n"), ("a", 1, None)], "book_id string, page_idx int, text string")
    got = inputs.text_pages(p).orderBy("blk_ord").collect()
    assert [(r.block_id, r.block_type) for r in got] == [("p0_b0", "heading"), ("p0_b1", "paragraph")]


def test_streams(spark, tmp_path):
    rows = [(i, i * 20, 1, "error", float(i), "{}") for i in range(12)]
    df = spark.createDataFrame(rows, "event_id bigint, s bigint, user_id bigint, event_type string, value double, props string").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    df.select("event_id", "ts", "user_id", "event_type", "value", "props").coalesce(1).write.parquet(str(tmp_path / "in"))
    schema = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    stream = lambda: events.event_stream(spark, str(tmp_path / "in"), schema, "*.parquet")
    got = {r.bucket: r.n for r in events.drain(events.rollup(stream(), 60)).collect()}
    assert got == {0: 3, 60: 3, 120: 3, 180: 3}
    lanes = stream().withColumn("lane", F.lit("cpu"))
    got = events.drain(events.crash_loops(lanes.select("lane", "ts", "event_id")), "append").orderBy("ts").collect()
    # the third failure ends a count; failures in the next 30 seconds don't count
    assert [(int(r.ts.timestamp()), r.deaths) for r in got] == [(40, 3), (120, 3), (200, 3)]
    work = stream().select(F.lit(1).cast("bigint").alias("stage"), "ts", "event_id", F.lit(2).cast("bigint").alias("units"), (F.col("value") * 10).cast("bigint").alias("ms"))
    cost = 0.0
    for i in range(12):
        cost = i * 5.0 if i == 0 else 0.3 * i * 5.0 + 0.7 * cost
    r = events.drain(events.smoothed_cost(work), "update").first()
    assert r.n == 12 and abs(r.cost - cost) < 1e-9


def test_crash_loops_across_clock_windows(spark, tmp_path):
    df = spark.createDataFrame([(1, 59, "a"), (2, 200, "a"), (3, 358, "a"), (4, 59, "b"), (5, 200, "b"), (6, 359, "b")], "event_id bigint, s bigint, lane string").withColumn("ts", F.timestamp_seconds("s"))
    df.select("event_id", "ts", "lane").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = events.event_stream(spark, str(tmp_path / "in"), "event_id BIGINT, ts TIMESTAMP, lane STRING", "*.parquet")
    assert [(r.lane, int(r.ts.timestamp()), r.deaths) for r in events.drain(events.crash_loops(stream), "append").collect()] == [("a", 358, 3)]
    from quire.operators.boards import crash_loops

    assert [(r.lane, r.event_id) for r in crash_loops(df.withColumn("epoch_s", F.col("s"))).collect()] == [("a", 3)]


def test_documents_and_partial_writes(spark, tmp_path):
    root = str(tmp_path)
    datasets.write_document(spark, root + "/a.json", {"b": "ü", "a": 1})
    datasets.write_document(spark, root + "/a.json", {"b": "ü", "a": 2})
    assert json.loads((tmp_path / "a.json").read_text(encoding="utf-8")) == {"a": 2, "b": "ü"}
    (tmp_path / "x.partial").mkdir()
    (tmp_path / "done").mkdir()
    (tmp_path / "done" / "_temporary").mkdir()
    assert datasets.sweep_partials(spark, root) == 2 and (tmp_path / "done").exists() and not (tmp_path / "x.partial").exists()
    assert datasets.latest_stage(spark, root, "done") is None
    spark.range(3).write.parquet(root + "/k1")
    assert datasets.latest_stage(spark, root, "k1") == root + "/k1" and datasets.latest_stage(spark, root, "k0") is None
    assert datasets.audit(spark, root) == (1, 1) and datasets.audit(spark, root + "/none") == (0, 0)


def test_tail_hands_on_every_event(spark, tmp_path):
    df = spark.range(1230).selectExpr("(id * 7) % 1230 AS event_id", "timestamp_seconds(id) AS ts")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    pages = []
    q = events.tail(events.event_stream(spark, str(tmp_path / "in"), "event_id BIGINT, ts TIMESTAMP", "*.parquet"), pages.append)
    try:
        q.processAllAvailable()
        assert [r.event_id for p in pages for r in p] == list(range(1230)) and max(map(len, pages)) == 50
        spark.range(1230, 1300).selectExpr("id AS event_id", "timestamp_seconds(id) AS ts").write.mode("append").parquet(str(tmp_path / "in"))
        q.processAllAvailable()
        assert sorted(r.event_id for p in pages for r in p) == list(range(1300))
    finally:
        q.stop()

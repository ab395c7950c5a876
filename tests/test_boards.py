import random

from pyspark.sql import functions as F

from quire.functions import formats as P
from quire.operators import boards as B

TASKS = "task_id string, book_id string, stage string, shard_idx int, state string"


def test_shards_edges_and_ready(spark):
    n = spark.createDataFrame([("a", 45), ("b", 0)], "book_id string, n int")
    got = {(r.book_id, r.shard_idx): (r.page_start, r.page_end) for r in B.shards(n, 20).collect()}
    assert got == {("a", 0): (0, 20), ("a", 1): (20, 40), ("a", 2): (40, 45), ("b", 0): (None, None)}
    rows = [("i", "a", "inspect", 0, "done"), ("e0", "a", "extract", 0, "done"), ("e1", "a", "extract", 1, "pending"), ("m", "a", "merge", 0, "pending"), ("c0", "a", "check", 0, "pending"), ("c2", "a", "check", 2, "pending"), ("x", "b", "merge", 0, "skipped")]
    tasks = spark.createDataFrame(rows, TASKS)
    deps = B.edges(tasks, [("extract", "inspect", "all"), ("merge", "extract", "all"), ("check", "extract", "each")])
    assert {tuple(r) for r in deps.collect()} == {("e0", "i"), ("e1", "i"), ("m", "e0"), ("m", "e1"), ("c0", "e0")}
    assert {r.task_id for r in B.ready(tasks, deps).collect()} == {"e1", "c0", "c2"}
    assert {r.book_id: r.finished for r in B.finished(tasks).collect()} == {"a": False, "b": True}


def test_plan(spark):
    t = spark.createDataFrame([("a", "s", i, f"k{i}") for i in range(3)], "book_id string, stage string, shard_idx int, stage_key string")
    got = {r.shard_idx: r.outcome for r in B.plan(t, t.where("shard_idx = 0"), t.where("shard_idx < 2")).collect()}
    assert got == {0: "skipped", 1: "unchanged", 2: "pending"}


def test_latest_costs_and_time_left(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([2, 3]), rnd.randrange(4), rnd.randrange(1, 900), i, i) for i in range(900)] + [(5, 1, 10, 0, 1)]
    stats = spark.createDataFrame(rows, "stage int, units int, ms int, ts int, event_id int").repartition(7)
    top = B.latest_by(stats, "stage", F.desc("ts"), most=5).collect()
    assert {(r.stage, r.ts) for r in top} == {(s, t) for s in (2, 3, 5) for t in sorted((r[3] for r in rows if r[0] == s), reverse=True)[:5]}
    got = {r.stage: r for r in B.costs(stats).collect()}
    for s in (2, 3):
        e, xs = None, [r[2] / r[1] for r in sorted(rows, key=lambda r: r[3]) if r[0] == s and r[1] > 0]
        for x in xs:
            e = x if e is None else 0.3 * x + 0.7 * e
        assert abs(got[s].cost - e) < 1e-5 and got[s].samples == len(xs)
    assert got[5].cost == 300.0 and got[5].latest is None
    work = spark.createDataFrame([("cpu", 5, 10), ("cpu", 5, 10), ("io", 99, 3)], "lane string, stage int, units int")
    r = B.eta(work, stats.where("stage = 5"), {"cpu": 4}).first()
    assert (r.seconds, r.low, r.high, r.confident) == (3.0, 1.8, 4.2, False)
    assert B.eta(work.limit(0), stats.limit(0), {"cpu": 4}).first().seconds == 0.0


def test_lists_and_details(spark):
    books = spark.createDataFrame([("a", "The Queue", "ff01", 1, 5, "done"), ("b", None, "ab12", 3, 6, "queued"), ("c", "Stacks", "cd34", 3, 2, "queued")], "book_id string, title string, sha256 string, priority int, added_at int, state string")
    assert [r.book_id for r in B.listed(books).collect()] == ["c", "b", "a"] and [r.book_id for r in B.listed(books, " QUEUE ").collect()] == ["a"] and [r.book_id for r in B.listed(books, "ab1", "queued").collect()] == ["b"]
    tasks = spark.createDataFrame([("t1", "a", "s1", 0, "done"), ("t2", "a", "s1", 1, "done"), ("t3", "a", "s0", 0, "running")], TASKS)
    got = {r.book_id: [tuple(x) for x in r.stages] for r in B.detail(books, tasks).collect()}
    assert got == {"a": [("s0", "running", 1), ("s1", "done", 2)], "b": [], "c": []}
    assert [r.title for r in B.running(tasks, books).collect()] == ["The Queue"]


def test_formats(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert [one(P.size_text(F.lit(n))) for n in (5, 2048, 3 << 20)] == ["5 B", "2.0 KB", "3.0 MB"]
    assert [one(P.duration_text(F.lit(n))) for n in (5, 65, 3700)] == ["5s", "1m 5s", "1h 1m"]
    assert one(P.html_safe(F.lit("<a href=\"x\">&'"))) == "&lt;a href=&quot;x&quot;&gt;&amp;&#39;"
    assert [one(P.inside(F.lit(p))) for p in ("a/b", "/a", "a/../b", "a..b")] == [True, False, False, True]
    assert one(P.percent(F.lit(1), F.lit(0))) == 0 and one(P.percent(F.lit(9), F.lit(3))) == 100 and one(P.backoff(F.lit(2.0), F.lit(3), F.lit(0.0))) == 8.0
    assert one(P.cut(F.lit("abc"), 2)) == "ab" and one(P.cut_log(F.lit("abc"), 2)) == "bc" and one(P.gigabytes(F.lit(1_500_000_000))) == 1.5

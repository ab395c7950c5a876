"""Queries on the event log and on stand-ins for tables of work, by the operators of this package, with SQL of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import formats as P
from quire.operators import boards as B
from quire.sources.tables import table

STATES = ("done", "running", "pending", "skipped", "failed", "paused")
#: What parts of a message tell of an error, in the order in which they are looked for.
ERRORS = (("out of memory", "oom"), ("oom", "oom"), ("timed out", "timeout"), ("timeout", "timeout"), ("no space", "disk_full"), ("disk full", "disk_full"), ("pdf", "corrupt_pdf"), ("memoryerror", "oom"))


def events(s: SparkSession, d: str) -> DataFrame:
    """The event log as work: (event_id, ts, epoch_s, book_id, state, stage, lane, units, ms, value, k)."""
    e = table(s, d, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    state = F.create_map(*[F.lit(x) for x in ("purchase", "done", "click", "running", "view", "pending", "signup", "skipped")])[F.col("event_type")]
    lane = F.element_at(F.array(*[F.lit(x) for x in ("cpu", "gpu", "io", "llm")]), (k % 4 + 1).cast("int"))
    return e.select(
        "event_id", "ts", F.unix_seconds(F.col("ts").cast("timestamp")).alias("epoch_s"), F.col("user_id").alias("book_id"), F.coalesce(state, F.lit("failed")).alias("state"), (k % 14).alias("stage"), lane.alias("lane"),
        (k % 20 + 1).alias("units"), F.floor(F.col("value") * 1000).cast("bigint").alias("ms"), "value", k.alias("k"),
    )


def counts_by_state(e: DataFrame, *keys: str) -> DataFrame:
    """Counts of all known states, zero where there is none."""
    return e.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("state") == s).alias(s) for s in STATES])


def median20(e: DataFrame) -> DataFrame:
    x = e.where("state = 'done' and units > 0").select("stage", (F.col("ms") / F.col("units")).alias("x"), "ts", "event_id")
    g = B.latest_by(x, "stage", F.desc("ts"), F.desc("event_id"), most=20).groupBy("stage").agg(F.count(F.lit(1)).alias("n"), F.median("x").alias("m"))
    return g.select("stage", "n", F.when(F.col("n") >= 3, F.round("m", 6)).alias("mpu"))


def smoothed(e: DataFrame) -> DataFrame:
    x = e.where("state = 'done' and units > 0").select("stage", (F.col("ms") / F.col("units")).alias("x"), "ts", "event_id")
    n = x.groupBy("stage").agg(F.count(F.lit(1)).alias("n"))
    last = B.latest_by(x, "stage", F.desc("ts"), F.desc("event_id"), most=B.REMEMBERED).join(n, "stage")
    w = F.pow(F.lit(1 - B.ALPHA), F.col("_r") - 1) * F.when(F.col("_r") == F.col("n"), 1.0).otherwise(B.ALPHA)
    return last.groupBy("stage").agg(F.first("n").alias("n"), F.round(F.sum(F.col("x") * w), 6).alias("ewma"))


def error_class(message: Column) -> Column:
    low, out = F.lower(message), F.lit("bug")
    for part, kind in reversed(ERRORS):
        out = F.when(low.contains(part), kind).otherwise(out)
    return out


def picked(rows: DataFrame, kind: str, path: str, wide: Column, at: str) -> DataFrame:
    """One (kind, path) of each kind: the last of those for the whole workspace, else the first."""
    return rows.groupBy(F.col(kind).alias("kind")).agg(F.coalesce(F.max_by(F.when(wide, F.col(path)), F.when(wide, F.col(at))), F.min_by(path, at)).alias("path"))


def _orders(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Orders as tasks and customers as books."""
    state = F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "F", "done").otherwise("running")
    tasks = table(s, d, "orders").select(F.col("o_orderkey").alias("task_id"), F.col("o_custkey").alias("book_id"), state.alias("state"))
    books = table(s, d, "customer").select(F.col("c_custkey").alias("book_id"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("sha256"), F.col("c_acctbal").alias("priority"), F.col("c_custkey").alias("added_at"), F.col("c_mktsegment").alias("segment"))
    return tasks, books


def claim_next(s: SparkSession, d: str) -> DataFrame:
    tasks, books = _orders(s, d)
    line = table(s, d, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("task_id"), F.lit(-1).alias("depends_on"))
    slots = books.where("segment = 'AUTOMOBILE'").orderBy(F.desc("priority"), "added_at").limit(2).unionByName(books.where("segment = 'BUILDING'"))
    blocker = s.createDataFrame([(-1, "pending")], "task_id int, state string")
    free = B.ready(tasks.select("task_id", "book_id", "state").unionByName(blocker.withColumn("book_id", F.lit(-1)).select("task_id", "book_id", "state")), line)
    return free.join(slots, "book_id").orderBy(F.desc("priority"), "added_at", "task_id").limit(1).select(F.col("task_id").alias("o_orderkey"), F.col("book_id").alias("o_custkey"))


def _shard_tasks(s: SparkSession, d: str) -> DataFrame:
    """Tasks of each book: one to inspect, one a shard to extract, one to merge, one a shard to check."""
    n = table(s, d, "page_data").groupBy("book_id").agg((F.max("page_idx") + 1).alias("n"))
    sh = B.shards(n, 20).select("book_id", F.col("shard_idx").alias("shard_idx"))
    one = n.select("book_id", F.lit(0).alias("shard_idx"))
    tasks = None
    for stage, rows in (("inspect", one), ("extract", sh), ("merge", one), ("check", sh)):
        part = rows.select("book_id", F.lit(stage).alias("stage"), "shard_idx", F.concat_ws("/", "book_id", F.lit(stage), "shard_idx").alias("task_id"))
        tasks = part if tasks is None else tasks.unionByName(part)
    return tasks


RULES = [("extract", "inspect", "all"), ("merge", "extract", "all"), ("check", "extract", "each")]


def planned(s: SparkSession, d: str) -> DataFrame:
    """Outcomes of a plan: shards of scanned pages are committed, books of more than two shards are known."""
    tasks = _shard_tasks(s, d).withColumn("stage_key", F.concat_ws(":", "stage", "shard_idx"))
    done = table(s, d, "page_data").where("is_scanned").select("book_id", F.lit("extract").alias("stage"), F.concat(F.lit("extract:"), F.floor(F.col("page_idx") / 20).cast("string")).alias("stage_key"))
    known = tasks.where("shard_idx >= 2")
    return B.plan(tasks, done, known).groupBy("stage", "outcome").agg(F.count(F.lit(1)).alias("n"))


def book_detail(s: SparkSession, d: str) -> DataFrame:
    e = events(s, d)
    out = B.detail(e.select("book_id").distinct(), e)
    return out.select("book_id", F.array_join(F.transform("stages", lambda x: F.concat_ws(":", x["stage"], x["state"], x["n"])), " ").alias("stages"))


def formats(s: SparkSession, d: str) -> DataFrame:
    b = table(s, d, "part").select("p_partkey", "p_name", F.col("p_size").cast("bigint").alias("z"))
    size = F.col("z") * F.col("z") * 1709 + 1
    w, h = P.extent(F.array(F.col("z").cast("double"), F.lit(10.0), F.lit(30.0), F.col("z").cast("double")))
    return b.select(
        "p_partkey", P.size_text(size).alias("size"), P.duration_text(F.col("z") * F.col("z") * 7).alias("took"), P.gigabytes(size * 1000).alias("gb"), P.percent(F.col("z"), F.col("z") % 7 * 6).alias("percent"), P.html_safe(F.concat(F.lit("<b title='"), "p_name", F.lit("'>&"))).alias("html"),
        w.alias("width"), h.alias("height"), P.backoff(F.lit(2.0), F.col("z") % 9 + 1, F.lit(0.25)).alias("wait"), P.cut(F.col("p_name"), 5).alias("head"), P.cut_log(F.col("p_name"), 4).alias("tail"), P.inside(F.concat(F.when(F.col("z") % 3 == 0, "../").when(F.col("z") % 3 == 1, "/").otherwise(""), F.lit("a/b"))).alias("inside"),
    )


_E = Callable[[SparkSession, str], DataFrame]
_ev = lambda fn: lambda s, d: fn(events(s, d))
#: By query: the same results as the SQL texts of ``control``, by operators.
NATIVE: dict[str, _E] = {
    "q_stage_state_counts": _ev(lambda e: counts_by_state(e, "stage")),
    "q_book_stage_counts": _ev(lambda e: e.groupBy("book_id", "stage", "state").agg(F.count(F.lit(1)).alias("n"))),
    "q_progress": _ev(lambda e: e.groupBy("book_id").agg(P.percent(F.count_if(F.col("state").isin("done", "skipped")), F.count(F.lit(1))).alias("percent"))),
    "q_done_units": _ev(lambda e: e.agg(F.coalesce(F.sum(F.when(F.col("state") == "done", F.col("units"))), F.lit(0)).alias("units"))),
    "q_history_window": _ev(lambda e: e.join(F.broadcast(e.agg(F.max("epoch_s").alias("_m"))), F.col("epoch_s") >= F.col("_m") - 86400).groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))),
    "q_event_tail": _ev(lambda e: e.where("event_id > 500").select("event_id", "book_id", "state", "stage").orderBy("event_id").limit(50)),
    "q_median20": _ev(median20),
    "q_ewma": _ev(smoothed),
    "q_crash_loop": _ev(lambda e: B.crash_loops(e.where("state = 'failed'"))),
    "q_current_task": _ev(lambda e: e.where("state = 'running'").groupBy("lane").agg(F.max(F.struct("event_id", "stage")).alias("r")).select("lane", "r.event_id", "r.stage")),
    "q_stage_of_book": _ev(lambda e: e.groupBy("book_id", "stage").agg(F.min_by("state", F.struct(F.col("state") != "running", "event_id")).alias("state"))),
    "q_shards": lambda s, d: B.shards(table(s, d, "page_data").groupBy("book_id").agg((F.max("page_idx") + 1).alias("n")), 20).join(table(s, d, "page_data").select("book_id", F.floor(F.col("page_idx") / 20).cast("int").alias("shard_idx")).distinct(), ["book_id", "shard_idx"]).select("book_id", F.col("shard_idx").alias("shard"), "page_start", "page_end"),
    "q_claim_next": claim_next,
}
_TASKS = """n AS (SELECT book_id, max(page_idx) + 1 AS n FROM page_data GROUP BY ALL), sh AS (SELECT book_id, unnest(range(0, (n + 19) // 20)) AS i FROM n),
t AS (SELECT book_id, 'inspect' AS stage, 0 AS i FROM n UNION ALL SELECT book_id, 'merge', 0 FROM n UNION ALL SELECT book_id, 'extract', i FROM sh UNION ALL SELECT book_id, 'check', i FROM sh)"""
_COSTS = """x AS (SELECT stage, CAST(ms AS DOUBLE) / units AS x, row_number() OVER (PARTITION BY stage ORDER BY ts, event_id) AS i, count(*) OVER (PARTITION BY stage) AS n FROM ev WHERE state = 'done' AND units > 0),
g AS (SELECT stage, max(n) AS samples, sum(x * power(0.7, n - i) * CASE WHEN i = 1 THEN 1.0 ELSE 0.3 END) AS smooth, median(CASE WHEN i > n - 20 THEN x END) AS med FROM x GROUP BY stage),
p AS (SELECT unnest(range(0, 14)) AS stage, unnest([50.0, 200.0, 500.0, 100.0, 200.0, 300.0, 400.0, 500.0, 600.0, 300.0, 200.0, 150.0, 1000.0, 200.0])::DOUBLE AS prior),
c AS (SELECT g.stage, samples, round(CASE WHEN samples >= 3 THEN smooth ELSE coalesce(prior, 500.0) END, 6) AS cost, round(CASE WHEN samples >= 3 THEN med END, 6) AS latest FROM g LEFT JOIN p ON g.stage = p.stage)"""
_CASES = " ".join(f"WHEN contains(lower(text), '{p}') THEN '{k}'" for p, k in ERRORS)
#: Queries that only stand here: name, query, SQL (with the view of events where it needs one).
MORE: tuple[tuple[str, _E, str], ...] = (
    ("q_edges", lambda s, d: B.edges(_shard_tasks(s, d), RULES), f"WITH {_TASKS} SELECT concat_ws('/', a.book_id, a.stage, a.i) AS task_id, concat_ws('/', b.book_id, b.stage, b.i) AS depends_on FROM t a JOIN t b ON a.book_id = b.book_id AND ((a.stage = 'extract' AND b.stage = 'inspect') OR (a.stage = 'merge' AND b.stage = 'extract') OR (a.stage = 'check' AND b.stage = 'extract' AND a.i = b.i))"),
    ("q_plan", planned, f"WITH {_TASKS}, z AS (SELECT stage, CASE WHEN stage = 'extract' AND EXISTS (SELECT 1 FROM page_data q WHERE q.is_scanned AND q.book_id = t.book_id AND q.page_idx // 20 = t.i) THEN 'skipped' WHEN i >= 2 THEN 'unchanged' ELSE 'pending' END AS outcome FROM t) SELECT stage, outcome, count(*) AS n FROM z GROUP BY ALL"),
    ("q_stage_costs", lambda s, d: B.costs(events(s, d).where("state = 'done'")), f"WITH ev AS (EVENTS), {_COSTS} SELECT stage, samples, cost, latest FROM c"),
    ("q_eta", lambda s, d: B.eta(events(s, d).where("state in ('pending', 'running')"), events(s, d).where("state = 'done'"), {"cpu": 4, "gpu": 1, "io": 2}), f"WITH ev AS (EVENTS), {_COSTS}, l AS (SELECT lane, sum(units * coalesce(c.cost, p.prior, 500.0)) / least(CASE lane WHEN 'cpu' THEN 4 WHEN 'io' THEN 2 ELSE 1 END, count(*)) / 1000.0 AS s FROM ev LEFT JOIN c ON ev.stage = c.stage LEFT JOIN p ON ev.stage = p.stage WHERE state IN ('pending', 'running') GROUP BY lane), z AS (SELECT round(coalesce(max(s), 0), 3) AS seconds FROM l) SELECT seconds, round(seconds * 0.6, 3) AS low, round(seconds * 1.4, 3) AS high, (SELECT max(samples) >= 3 FROM c) AS confident FROM z"),
    ("q_running", lambda s, d: B.running(*_orders(s, d)).select("task_id", "book_id", "title", "priority"), "SELECT o_orderkey AS task_id, o_custkey AS book_id, c_name AS title, c_acctbal AS priority FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus NOT IN ('O', 'F')"),
    ("q_books_finished", lambda s, d: B.finished(_orders(s, d)[0]), "SELECT o_custkey AS book_id, bool_and(o_orderstatus = 'F') AS finished FROM orders GROUP BY ALL"),
    ("q_book_detail", book_detail, "WITH ev AS (EVENTS), n AS (SELECT book_id, stage, state, count(*) AS n FROM ev GROUP BY ALL) SELECT book_id, string_agg(concat_ws(':', stage, state, n), ' ' ORDER BY stage, state, n) AS stages FROM n GROUP BY book_id"),
    ("q_book_list", lambda s, d: B.listed(_orders(s, d)[1], "Build ").select("book_id", "title", "priority"), "SELECT c_custkey AS book_id, c_name AS title, c_acctbal AS priority FROM customer WHERE contains(lower(c_name), 'build') OR contains(lower(c_mktsegment), 'build')"),
    ("q_event_log", lambda s, d: B.log(events(s, d).withColumn("level", F.col("state")), "failed").select("event_id", "lane", "stage"), "WITH ev AS (EVENTS) SELECT event_id, lane, stage FROM ev WHERE state = 'failed' ORDER BY event_id DESC LIMIT 500"),
    ("q_formats", formats, """WITH b AS (SELECT p_partkey, p_name, p_size::BIGINT AS z, p_size::BIGINT * p_size * 1709 + 1 AS s, p_size::BIGINT * p_size * 7 AS d FROM part)
SELECT p_partkey, CASE WHEN s >= 1048576 THEN printf('%.1f MB', s / 1048576.0) WHEN s >= 1024 THEN printf('%.1f KB', s / 1024.0) ELSE s || ' B' END AS size, CASE WHEN d >= 3600 THEN (d // 3600) || 'h ' || (d % 3600 // 60) || 'm' WHEN d >= 60 THEN (d // 60) || 'm ' || (d % 60) || 's' ELSE d || 's' END AS took,
round(s * 1000 / 1e9, 2) AS gb, CASE WHEN z % 7 > 0 THEN least(100, greatest(0, floor(100.0 * z / (z % 7 * 6) + 0.5)))::BIGINT ELSE 0 END AS percent, replace(replace(replace(replace('<b title=''' || replace(p_name, '&', '&amp;') || '''>&amp;', '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') AS html,
greatest(0.0, 30.0 - z)::DOUBLE AS width, greatest(0.0, z - 10.0)::DOUBLE AS height, (2.0 * power(2, z % 9) + 0.25)::DOUBLE AS wait, left(p_name, 5) AS head, right(p_name, 4) AS tail, z % 3 = 2 AS inside FROM b"""),
    ("q_error_class_texts", lambda s, d: table(s, d, "documents").where("text is not null").select("doc_id", error_class(F.col("text")).alias("kind")), f"SELECT doc_id, CASE {_CASES} ELSE 'bug' END AS kind FROM documents WHERE text IS NOT NULL"),
    ("q_dataset_pick_docs", lambda s, d: picked(table(s, d, "documents").where("doc_kind is not null"), "doc_kind", "doc_id", F.coalesce(F.col("lang") == "en", F.lit(False)), "doc_id"), "SELECT doc_kind AS kind, coalesce(max(CASE WHEN lang = 'en' THEN doc_id END), min(doc_id)) AS path FROM documents WHERE doc_kind IS NOT NULL GROUP BY ALL"),
)

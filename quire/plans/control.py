"""Queries on the event log and on work that is planned, running or done, as SQL. Where ``views`` has operators for one, they
are the query and the text here is what their result is compared with; the others run as one text on both SQL engines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.plans import views
from quire.sources.tables import table

_STATE = "CASE event_type WHEN 'purchase' THEN 'done' WHEN 'click' THEN 'running' WHEN 'view' THEN 'pending' WHEN 'signup' THEN 'skipped' ELSE 'failed' END"
_LANE = "CASE k % 4 WHEN 0 THEN 'cpu' WHEN 1 THEN 'gpu' WHEN 2 THEN 'io' ELSE 'llm' END"
EVENTS = f"SELECT event_id, ts, epoch_s, user_id AS book_id, {_STATE} AS state, k % 14 AS stage, {_LANE} AS lane, 1 + k % 20 AS units, CAST(floor(value * 1000) AS BIGINT) AS ms, value, k FROM (SELECT event_id, ts, user_id, event_type, value, {{k}} AS k, {{epoch}} AS epoch_s FROM events) e"
SPARK_EVENTS = EVENTS.format(k="CAST(get_json_object(props, '$.k') AS BIGINT)", epoch="CAST(unix_seconds(CAST(ts AS TIMESTAMP)) AS BIGINT)")
DUCK_EVENTS = EVENTS.format(k="CAST(json_extract_string(props, '$.k') AS BIGINT)", epoch="CAST(floor(epoch(ts)) AS BIGINT)")

_BUCKET = """SELECT epoch_s - epoch_s % {s} AS bucket, count(*) AS n, CAST(sum(units) AS BIGINT) AS units, CAST(sum(ms) AS BIGINT) AS ms, min(value) AS low, max(value) AS high,
  max(CASE WHEN last = 1 THEN k END) AS last_k, max(CASE WHEN first = 1 THEN k END) AS first_k
  FROM (SELECT *, row_number() OVER (PARTITION BY epoch_s - epoch_s % {s} ORDER BY ts DESC, event_id DESC) AS last, row_number() OVER (PARTITION BY epoch_s - epoch_s % {s} ORDER BY ts, event_id) AS first FROM ev) x
  GROUP BY epoch_s - epoch_s % {s}"""

BODIES = {
    # counts for all states, zero where there is none
    "q_stage_state_counts": "SELECT stage, count(*) AS n, CAST(sum(CASE WHEN state = 'done' THEN 1 ELSE 0 END) AS BIGINT) AS done, CAST(sum(CASE WHEN state = 'running' THEN 1 ELSE 0 END) AS BIGINT) AS running, CAST(sum(CASE WHEN state = 'pending' THEN 1 ELSE 0 END) AS BIGINT) AS pending, CAST(sum(CASE WHEN state = 'skipped' THEN 1 ELSE 0 END) AS BIGINT) AS skipped, CAST(sum(CASE WHEN state = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed, CAST(sum(CASE WHEN state = 'paused' THEN 1 ELSE 0 END) AS BIGINT) AS paused FROM ev GROUP BY stage",
    "q_book_stage_counts": "SELECT book_id, stage, state, count(*) AS n FROM ev GROUP BY book_id, stage, state",
    "q_progress": "SELECT book_id, CAST(floor(100.0 * sum(CASE WHEN state IN ('done', 'skipped') THEN 1 ELSE 0 END) / count(*) + 0.5) AS BIGINT) AS percent FROM ev GROUP BY book_id",
    "q_done_units": "SELECT CAST(coalesce(sum(CASE WHEN state = 'done' THEN units END), 0) AS BIGINT) AS units FROM ev",
    "q_telemetry_60s": _BUCKET.format(s=60),
    "q_telemetry_300s": _BUCKET.format(s=300),
    "q_event_tail": "SELECT event_id, book_id, state, stage FROM ev WHERE event_id > 500 ORDER BY event_id LIMIT 50",
    "q_history_window": "SELECT state, count(*) AS n, min(event_id) AS first_id FROM ev WHERE epoch_s >= (SELECT max(epoch_s) FROM ev) - 86400 GROUP BY state",
    "q_median20": "SELECT stage, count(*) AS n, CASE WHEN count(*) >= 3 THEN round(median(mpu), 6) END AS mpu FROM (SELECT stage, CAST(ms AS DOUBLE) / units AS mpu, row_number() OVER (PARTITION BY stage ORDER BY ts DESC, event_id DESC) AS r FROM ev WHERE state = 'done' AND units > 0) x WHERE r <= 20 GROUP BY stage",
    "q_spread": """SELECT n, CASE WHEN n < 6 OR p50 <= 0 THEN 0.4 ELSE round(greatest(0.1, least(0.6, CAST(p75 AS DOUBLE) / p50 - 1)), 6) END AS spread FROM (SELECT max(n) AS n, max(CASE WHEN i = n DIV_ 2 THEN ms END) AS p50, max(CASE WHEN i = CAST(floor(n * 0.75) AS BIGINT) THEN ms END) AS p75
      FROM (SELECT ms, row_number() OVER (ORDER BY ms) - 1 AS i, count(*) OVER () AS n FROM (SELECT ms, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS r FROM ev WHERE state = 'done') a WHERE r <= 100) b) c""",
    "q_eta_lanes": """SELECT lane, sum(cost) AS cost, least(CASE lane WHEN 'cpu' THEN 4 WHEN 'io' THEN 2 ELSE 1 END, count(*)) AS effective, round(sum(cost) / least(CASE lane WHEN 'cpu' THEN 4 WHEN 'io' THEN 2 ELSE 1 END, count(*)) / 1000.0, 6) AS seconds
      FROM (SELECT e.lane, round(e.units * coalesce(h.mpu, 500.0), 3) AS cost FROM ev e LEFT JOIN (SELECT stage, CASE WHEN count(*) >= 3 THEN round(median(mpu), 3) END AS mpu FROM (SELECT stage, CAST(ms AS DOUBLE) / units AS mpu, row_number() OVER (PARTITION BY stage ORDER BY ts DESC, event_id DESC) AS r FROM ev WHERE state = 'done') x WHERE r <= 20 GROUP BY stage) h ON e.stage = h.stage WHERE e.state IN ('pending', 'running')) y GROUP BY lane""",
    "q_crash_loop": "SELECT event_id, lane, deaths FROM (SELECT event_id, lane, count(*) OVER (PARTITION BY lane ORDER BY epoch_s RANGE BETWEEN 299 PRECEDING AND CURRENT ROW) AS deaths FROM ev WHERE state = 'failed') x WHERE deaths >= 3",
    "q_current_task": "SELECT lane, event_id, stage FROM (SELECT lane, event_id, stage, row_number() OVER (PARTITION BY lane ORDER BY event_id DESC) AS r FROM ev WHERE state = 'running') x WHERE r = 1",
    "q_stage_of_book": "SELECT book_id, stage, state FROM (SELECT book_id, stage, state, row_number() OVER (PARTITION BY book_id, stage ORDER BY CASE WHEN state = 'running' THEN 0 ELSE 1 END, event_id) AS r FROM ev) x WHERE r = 1",
    "q_workers_busy": "SELECT coalesce(w.lane, b.lane) AS lane, CASE WHEN b.lane IS NULL THEN 'idle' ELSE 'busy' END AS state, coalesce(b.n, 0) AS n FROM (SELECT 'cpu' AS lane UNION ALL SELECT 'gpu' UNION ALL SELECT 'spare') w FULL OUTER JOIN (SELECT lane, count(*) AS n FROM ev WHERE state = 'running' GROUP BY lane) b ON w.lane = b.lane",
    "q_shards": "SELECT book_id, CAST(shard AS BIGINT) AS shard, CAST(shard * 20 AS BIGINT) AS page_start, CAST(least((shard + 1) * 20, n) AS BIGINT) AS page_end FROM (SELECT book_id, max(page_idx) + 1 AS n FROM page_data GROUP BY book_id) b JOIN (SELECT DISTINCT page_idx DIV_ 20 AS shard, book_id AS of_book FROM page_data) s ON b.book_id = s.of_book",
    "q_claim_next": """SELECT t.o_orderkey, t.o_custkey FROM orders t JOIN customer b ON t.o_custkey = b.c_custkey WHERE t.o_orderstatus = 'O' AND b.c_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT c_custkey FROM (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE' ORDER BY c_acctbal DESC, c_custkey LIMIT 2) q)
      AND NOT EXISTS (SELECT 1 FROM lineitem d WHERE d.l_orderkey = t.o_orderkey AND d.l_linestatus = 'F') ORDER BY b.c_acctbal DESC, b.c_custkey, t.o_orderkey LIMIT 1""",
    "q_stale_leases": "SELECT t.o_orderkey, CASE WHEN c.c_custkey IS NULL THEN 'worker_dead' ELSE 'lease_expired' END AS reason FROM orders t LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) c ON t.o_custkey = c.c_custkey WHERE t.o_orderstatus = 'P'",
    "q_retry_prefix": "SELECT o_orderstatus AS state, count(*) AS n, CAST(sum(CASE WHEN o_orderstatus IN ('F') AND o_orderpriority LIKE '1%' THEN 1 ELSE 0 END) AS BIGINT) AS retried FROM orders GROUP BY o_orderstatus",
    "q_error_class": "SELECT CAST(i AS BIGINT) AS i, CASE WHEN m LIKE '%out of memory%' OR m LIKE '%oom%' THEN 'oom' WHEN m LIKE '%timed out%' OR m LIKE '%timeout%' THEN 'timeout' WHEN m LIKE '%no space%' OR m LIKE '%disk full%' THEN 'disk_full' WHEN m LIKE '%pdf%' THEN 'corrupt_pdf' WHEN m LIKE '%memoryerror%' THEN 'oom' ELSE 'bug' END AS kind FROM (SELECT i, lower(x) AS m FROM (VALUES (0, 'Out of memory: killed'), (1, 'operation timed out'), (2, 'No space left on device'), (3, 'corrupt PDF header'), (4, 'MemoryError'), (5, 'KeyError'), (6, 'disk full'), (7, 'Timeout expired')) AS v(i, x)) y",
    "q_settings": "SELECT max(CASE WHEN k = 'workers.cpu' THEN TRY_CAST(v AS BIGINT) END) AS workers_cpu, coalesce(max(CASE WHEN k = 'books' THEN TRY_CAST(v AS BIGINT) END), 2) AS books, max(CASE WHEN k = 'queue.paused' THEN CASE WHEN v IN ('0', 'false', 'False') THEN CAST(0 AS BIGINT) ELSE 1 END END) AS paused FROM (VALUES ('workers.cpu', '12'), ('books', 'x'), ('queue.paused', 'False')) AS s(k, v)",
    "q_dataset_pick": "SELECT kind, path FROM (SELECT kind, path, row_number() OVER (PARTITION BY kind ORDER BY CASE WHEN scope = 'workspace' THEN 0 ELSE 1 END, CASE WHEN scope = 'workspace' THEN -i ELSE i END) AS r FROM (VALUES (0, 'rag', 'book', 'a'), (1, 'rag', 'workspace', 'b'), (2, 'rag', 'workspace', 'c'), (3, 'sft', 'book', 'd'), (4, 'sft', 'book', 'e')) AS v(i, kind, scope, path)) x WHERE r = 1",
}
_TABLES = ("events", "orders", "customer", "lineitem", "page_data")
#: Smoothing of the running cost of a stage.
ALPHA = 0.3


def _spark(body: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(s: SparkSession, d: str) -> DataFrame:
        from quire.plans.catalogue import longs

        for t in _TABLES:
            if t in body or t == "events" and " ev" in body:
                table(s, d, t).createOrReplaceTempView(t)
        if " ev" in body:
            s.sql(SPARK_EVENTS).createOrReplaceTempView("ev")
        return longs(s.sql(body.replace("DIV_", "DIV")))

    return run


_EWMA = f"""WITH RECURSIVE ev AS ({DUCK_EVENTS}), s AS (SELECT stage, CAST(ms AS DOUBLE) / units AS x, row_number() OVER (PARTITION BY stage ORDER BY ts, event_id) AS i FROM ev WHERE state = 'done' AND units > 0),
  r AS (SELECT stage, i, x AS e FROM s WHERE i = 1 UNION ALL SELECT s.stage, s.i, {ALPHA} * s.x + {1 - ALPHA} * r.e FROM r JOIN s ON s.stage = r.stage AND s.i = r.i + 1)
  SELECT stage, max(i) AS n, round(arg_max(e, i), 6) AS ewma FROM r GROUP BY stage"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from quire.plans.catalogue import longs

    own = {**views.NATIVE, **{n: f for n, f, _ in views.MORE}}
    return {**{n: _spark(b) for n, b in BODIES.items()}, **{n: (lambda s, d, f=f: longs(f(s, d))) for n, f in own.items()}}


def oracle_sql() -> dict[str, str]:
    out = {n: (f"WITH ev AS ({DUCK_EVENTS}) " if " ev" in b else "") + b.replace("DIV_", "//") for n, b in BODIES.items()}
    return {**out, "q_ewma": _EWMA, **{n: sql.replace("(EVENTS)", f"({DUCK_EVENTS})") for n, _, sql in views.MORE}}

"""Views of work on books: what depends on what, what runs, how long it will take, and lists for people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Milliseconds a unit of each stage is taken to need before anything is measured, and for an unknown stage.
PRIORS = {0: 50.0, 1: 200.0, 2: 500.0, 3: 100.0, 4: 200.0, 5: 300.0, 6: 400.0, 7: 500.0, 8: 600.0, 9: 300.0, 10: 200.0, 11: 150.0, 12: 1000.0, 13: 200.0}
UNKNOWN = 500.0
#: Weight of the latest cost, samples from which costs are trusted, how many are looked back on.
ALPHA, ENOUGH, LATEST = 0.3, 3, 20
#: The weight of a sample that so many newer ones follow is below a 1e-16th.
REMEMBERED = 110


def shards(pages: DataFrame, step: int) -> DataFrame:
    """Rows (book_id, shard_idx, page_start, page_end): a book's pages in steps, the last one short. ``pages`` has (book_id,
    n); a book without pages has one shard without bounds."""
    k = F.greatest(F.lit(1), F.ceil(F.col("n") / step)).cast("int")
    rows = pages.select("book_id", "n", F.explode(F.sequence(F.lit(0), k - 1)).alias("shard_idx"))
    some = F.col("n") > 0
    return rows.select("book_id", "shard_idx", F.when(some, F.col("shard_idx") * step).alias("page_start"), F.when(some, F.least((F.col("shard_idx") + 1) * step, "n")).alias("page_end"))


def edges(tasks: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rows (task_id, depends_on) of tasks (task_id, book_id, stage, shard_idx). A rule (stage, needs, how) ties each task of
    a stage to all tasks of what it needs in its book, or with ``each`` to that of its own shard, where there is one."""
    out = None
    for stage, needs, how in rules:
        keys = ["book_id", "shard_idx"] if how == "each" else ["book_id"]
        parents = tasks.where(F.col("stage") == needs).select(*keys, F.col("task_id").alias("depends_on"))
        one = tasks.where(F.col("stage") == stage).join(parents, keys).select("task_id", "depends_on")
        out = one if out is None else out.unionByName(one)
    return out


def plan(tasks: DataFrame, committed: DataFrame, known: DataFrame) -> DataFrame:
    """``tasks`` (book_id, stage, shard_idx, stage_key) with ``outcome``: ``skipped`` where the stage's key is committed,
    ``unchanged`` where the task is known under that key, else ``pending``."""
    key = ["book_id", "stage", "shard_idx", "stage_key"]
    done = committed.select("book_id", "stage", "stage_key").distinct().withColumn("_d", F.lit(True))
    have = known.select(*key).distinct().withColumn("_k", F.lit(True))
    x = tasks.join(done, ["book_id", "stage", "stage_key"], "left").join(have, key, "left")
    return x.withColumn("outcome", F.when(F.col("_d"), "skipped").when(F.col("_k"), "unchanged").otherwise("pending")).drop("_d", "_k")


def ready(tasks: DataFrame, deps: DataFrame) -> DataFrame:
    """Pending tasks of which nothing that they depend on is unfinished."""
    open_ = tasks.where(~F.col("state").isin("done", "skipped")).select(F.col("task_id").alias("depends_on"))
    blocked = deps.join(open_, "depends_on", "left_semi").select("task_id")
    return tasks.where("state = 'pending'").join(blocked, "task_id", "left_anti")


def finished(tasks: DataFrame) -> DataFrame:
    """Rows (book_id, finished): whether all tasks of a book are done or skipped."""
    return tasks.groupBy("book_id").agg(F.bool_and(F.col("state").isin("done", "skipped")).alias("finished"))


def latest_by(df: DataFrame, key: str, *order: Column, most: int) -> DataFrame:
    """The first ``most`` rows of each key in ``order``: tasks keep that many of each key before rows cross the network, so a
    key that holds a third of all rows costs no task more than that from every other."""
    salted = df.withColumn("_s", F.pmod(F.spark_partition_id(), F.lit(1024)))
    inner = F.row_number().over(Window.partitionBy(key, "_s").orderBy(*order))
    some = salted.withColumn("_r", inner).where(F.col("_r") <= most)
    return some.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_r") <= most).drop("_s")


def costs(stats: DataFrame) -> DataFrame:
    """Rows (stage, samples, cost): milliseconds a unit of each stage, from (stage, units, ms, ts, event_id): smoothed if
    there are ``ENOUGH`` samples, else the stage's prior. ``latest`` is the median of the last ``LATEST``."""
    x = stats.where("units > 0").select("stage", (F.col("ms") / F.col("units")).alias("x"), "ts", "event_id")
    n = x.groupBy("stage").agg(F.count(F.lit(1)).alias("samples"))
    last = latest_by(x, "stage", F.desc("ts"), F.desc("event_id"), most=REMEMBERED).join(n, "stage")
    age = F.col("_r") - 1
    w = F.pow(F.lit(1 - ALPHA), age) * F.when(age == F.col("samples") - 1, 1.0).otherwise(ALPHA)
    g = last.groupBy("stage").agg(F.first("samples").alias("samples"), F.sum(F.col("x") * w).alias("smooth"), F.median(F.when(F.col("_r") <= LATEST, F.col("x"))).alias("latest"))
    prior = F.coalesce(F.create_map(*[F.lit(v) for kv in PRIORS.items() for v in kv])[F.col("stage")], F.lit(UNKNOWN))
    return g.select("stage", "samples", F.round(F.when(F.col("samples") >= ENOUGH, F.col("smooth")).otherwise(prior), 6).alias("cost"), F.round(F.when(F.col("samples") >= ENOUGH, F.col("latest")), 6).alias("latest"))


def eta(work: DataFrame, stats: DataFrame, workers: dict[str, int], spread: float = 0.4) -> DataFrame:
    """One row (seconds, low, high, confident): how long open ``work`` (lane, stage, units) takes. Lanes run side by side with
    as many workers as they have and can use; the slowest one counts. Nothing to do takes no time."""
    cost = costs(stats)
    prior = F.coalesce(F.create_map(*[F.lit(v) for kv in PRIORS.items() for v in kv])[F.col("stage")], F.lit(UNKNOWN))
    have = F.coalesce(F.create_map(*[F.lit(v) for kv in workers.items() for v in kv])[F.col("lane")], F.lit(1))
    lanes = work.join(cost, "stage", "left").withColumn("c", F.col("units") * F.coalesce("cost", prior))
    lanes = lanes.groupBy("lane").agg((F.sum("c") / F.least(F.greatest(F.lit(1), F.first(have)), F.count(F.lit(1))) / 1000.0).alias("s"))
    total = lanes.agg(F.round(F.coalesce(F.max("s"), F.lit(0.0)), 3).alias("seconds"))
    seen = cost.agg(F.coalesce(F.max("samples"), F.lit(0)).alias("n"))
    return total.crossJoin(seen).select("seconds", F.round(F.col("seconds") * (1 - spread), 3).alias("low"), F.round(F.col("seconds") * (1 + spread), 3).alias("high"), (F.col("n") >= ENOUGH).alias("confident"))  # one row each


def crash_loops(deaths: DataFrame, least: int = 3, seconds: int = 300) -> DataFrame:
    """``deaths`` (event_id, lane, epoch_s) with the number of deaths of the lane within the last ``seconds``, where there are
    ``least``. A lane is cut into stretches of that length; a death looks into its own and the one before, so that no task
    sorts a whole lane."""
    k = F.floor(F.col("epoch_s") / seconds)
    spread = deaths.withColumn("_o", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("_k", k + F.col("_o"))
    w = Window.partitionBy("lane", "_k").orderBy("epoch_s").rangeBetween(1 - seconds, 0)
    return spread.withColumn("deaths", F.count(F.lit(1)).over(w)).where((F.col("_o") == 0) & (F.col("deaths") >= least)).select("event_id", "lane", "deaths")


def running(tasks: DataFrame, books: DataFrame) -> DataFrame:
    """Running tasks with the name and priority of their book."""
    return tasks.where("state = 'running'").join(books.select("book_id", "title", "priority"), "book_id")


def detail(books: DataFrame, tasks: DataFrame) -> DataFrame:
    """Each book with its counts of tasks by stage and state, nested, in order; an empty list where it has none."""
    n = tasks.groupBy("book_id", "stage", "state").agg(F.count(F.lit(1)).alias("n"))
    nested = n.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct("stage", "state", "n"))).alias("stages"))
    return books.join(nested, "book_id", "left").withColumn("stages", F.coalesce("stages", F.array().cast(nested.schema["stages"].dataType)))


def listed(books: DataFrame, query: str = "", state: str | None = None) -> DataFrame:
    """Books whose title or hash contains ``query`` in any case, in one state if one is named, most urgent first."""
    q = query.strip().lower()
    out = books.where(F.coalesce(F.lower("title"), F.lit("")).contains(q) | F.coalesce(F.lower("sha256"), F.lit("")).contains(q))
    return (out.where(F.col("state") == state) if state else out).orderBy(F.desc("priority"), "added_at", "book_id")


def log(events: DataFrame, level: str | None = None, most: int = 500) -> DataFrame:
    """The last ``most`` events, of one level if one is named, newest first. The bound is the feature."""
    return (events.where(F.col("level") == level) if level else events).orderBy(F.desc("event_id")).limit(most)

"""The event log as a stream: tail, rollups by event time, smoothed cost of stages and crash loops."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import scratch_path

ALPHA = 0.3


def event_stream(spark: SparkSession, folder: str, schema: str, name: str = "events.parquet") -> DataFrame:
    """Files of events as they arrive in ``folder``."""
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def rollup(events: DataFrame, seconds: int, lateness: str = "10 minutes") -> DataFrame:
    """Tumbling windows of ``seconds`` by event time, aligned to the clock; late events count until the watermark."""
    w = F.window("ts", f"{seconds} seconds")
    return (
        events.withWatermark("ts", lateness)
        .groupBy(w)
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.max_by("value", F.struct("ts", "event_id")).alias("last"), F.min_by("value", F.struct("ts", "event_id")).alias("first"))
        .select(F.unix_seconds("window.start").alias("bucket"), "n", "mean", "last", "first")
    )


def tail(events: DataFrame, handle: Callable[[list], None], most: int = 50, every: str = "1 second"):
    """Hand all events of each batch, in order of id, to ``handle``, at most ``most`` at a time. Returns the running query.

    The driver holds one partition of a batch at a time. A batch that fails midway is handed on again from its start.
    """

    def batch(df: DataFrame, _: int) -> None:
        rows = df.orderBy("event_id").toLocalIterator()
        while page := list(islice(rows, most)):
            handle(page)

    return events.writeStream.foreachBatch(batch).trigger(processingTime=every).start()


def smoothed_cost(events: DataFrame) -> DataFrame:
    """(stage, n, cost) after each batch: exponential smoothing of cost per unit; the state of a stage is two numbers.

    ``events`` has (stage, ts, event_id, units, ms); rows without units are left out.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, cost = state.get if state.exists else (0, 0.0)
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        for units, ms in zip(rows["units"], rows["ms"]):
            x = ms / units
            cost = x if n == 0 else ALPHA * x + (1 - ALPHA) * cost
            n += 1
        state.update((n, cost))
        yield pd.DataFrame({"stage": [key[0]], "n": [n], "cost": [cost]})

    from pyspark.sql.streaming.state import GroupStateTimeout

    return events.where("units > 0").groupBy("stage").applyInPandasWithState(step, "stage bigint, n bigint, cost double", "n bigint, cost double", "update", GroupStateTimeout.NoTimeout)


def crash_loops(events: DataFrame, least: int = 3, seconds: int = 300, rest: int = 30) -> DataFrame:
    """Rows (lane, ts, deaths): each time that ``least`` failures of a lane lie within ``seconds``. The count then starts
    anew, and failures within ``rest`` seconds don't count. The state of a lane is its last failures, fewer than ``least``.

    ``events`` has (lane, ts, event_id). Events of a batch are taken in order of time; later batches are taken as later.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        recent, quiet = state.get if state.exists else ([], 0.0)
        recent, found = list(recent), []
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        for ts in rows["ts"]:
            at = ts.timestamp()
            if at < quiet:
                continue
            recent = [t for t in recent if at - t < seconds] + [at]
            if len(recent) >= least:
                found.append((key[0], ts, len(recent)))
                recent, quiet = [], at + rest
        state.update((recent, quiet))
        yield pd.DataFrame(found, columns=["lane", "ts", "deaths"])

    return events.groupBy("lane").applyInPandasWithState(step, "lane string, ts timestamp, deaths bigint", "recent array<double>, quiet double", "append", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, mode: str = "complete") -> DataFrame:
    """Run ``stream`` over all that has arrived and return its result, which is written to the shared folder: whole in
    ``complete`` mode, batch by batch in the others."""
    spark, path = stream.sparkSession, scratch_path(stream.sparkSession, "drained")

    def put(df: DataFrame, _: int) -> None:
        df.write.mode("overwrite" if mode == "complete" else "append").parquet(path)

    stream.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", scratch_path(spark, "stream")).trigger(availableNow=True).start().awaitTermination()
    try:
        return spark.read.schema(stream.schema).parquet(path)
    except AnalysisException:  # nothing has arrived
        return spark.createDataFrame([], stream.schema)

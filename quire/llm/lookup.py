"""Facts from a table of any size for the texts of a partition.

What an operator has to know of words, such as their counts in the corpus, may be too much to broadcast. Records are dealt
out to chunks of bounded text; each chunk names the keys it needs, once each, and these meet the table by an equi-join. The
answers travel back to their chunk, where they come before its records and are held in memory while these stream past.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quire.session import hub

#: Characters of text in a chunk; bounds what a task holds in memory.
CHUNK = 4_000_000


def deal(rows: DataFrame, key: str, characters: int) -> DataFrame:
    """``rows`` with a column ``chunk``, written once in order of it; they have about ``characters`` of text in all."""
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64(key), F.lit(1 + characters // CHUNK)).cast("int"))
    return hub(dealt.repartition("chunk").sortWithinPartitions("chunk"))


def _batches(schema: pa.Schema, rows: Iterator[tuple], size: int = 10_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def ask(rows: DataFrame, keys: Callable[[dict[str, Any]], set], schema: str) -> DataFrame:
    """Rows (chunk, key): the keys that the records of each chunk need, once each. ``schema`` names the key."""
    out = to_arrow_schema(StructType.fromDDL("chunk int, " + schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            now, seen = None, set()
            for b in batches:
                for r in b.to_pylist():
                    if r["chunk"] != now:
                        now, seen = r["chunk"], set()
                    new = keys(r) - seen
                    seen |= new
                    for k in new:
                        yield now, k

        yield from _batches(out, each())

    return rows.mapInArrow(run, "chunk int, " + schema)


def tell(rows: DataFrame, answers: DataFrame, hear: Callable[[Any, dict], None], fresh: Callable[[], Any], fn: Callable[[Any, dict], Iterator[tuple]], schema: str) -> DataFrame:
    """What ``fn`` makes of each record and the answers of its chunk, which ``hear`` has put into a ``fresh`` state."""
    out = to_arrow_schema(StructType.fromDDL(schema))
    own = [c for c in rows.columns if c != "chunk"]
    theirs = [c for c in answers.columns if c != "chunk"]
    null = lambda df, names, mark: [F.lit(None).cast(df.schema[n].dataType).alias(mark + n) for n in names]
    first = answers.select("chunk", F.lit(0).alias("_turn"), *null(rows, own, ""), *[F.col(c).alias("_" + c) for c in theirs])
    second = rows.select("chunk", F.lit(1).alias("_turn"), *own, *null(answers, theirs, "_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            now, state = None, None
            for b in batches:
                for r in b.to_pylist():
                    if r["chunk"] != now or state is None:
                        now, state = r["chunk"], fresh()
                    if r["_turn"]:
                        yield from fn(state, r)
                    else:
                        hear(state, r)

        yield from _batches(out, each())

    return first.unionByName(second).repartition("chunk").sortWithinPartitions("chunk", "_turn").mapInArrow(run, schema)

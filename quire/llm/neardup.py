"""Problem 6: near-duplicate records with small edits.

A prefix-tree join spread over the cluster. Each text is the set of its word runs; sets are brought into one global order,
rarest run first. Two sets that agree in a share ``threshold`` of their union must have their first common run within a
short prefix of both, so the first level of the tree is dealt out to tasks by that run. A task walks its subtree: the
sets below a node share one path of common runs, each further step skips at most as many runs of a set as its length still
allows, and branches with one set left are pruned. What survives is compared exactly.

The order is how often runs occur. Summaries of bounded size find all runs with a share of at least ``SHARE`` of all runs,
of which there can only be few, with their counts; the others, rarer ones come before them, by how often they are to be
expected from the counts of the ``MOST_WORDS`` commonest words. Any order gives the same result, so these bounds change
none, and they are relative: a set has as many entries into the tree in a corpus of any size. Runs with a share of
``HEAVY`` enter the tree by two runs of the path. A node with more than ``BIG`` sets isn't walked: its sets go one run
deeper, ``DEEP`` times at most; what is still that big then is dealt out to tasks by pairs of blocks of sets. Equal sets are one class; pairs of classes are expanded to pairs of records at the end.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import cut_lineage, drop_path, scratch_path

_WORDS = re.compile(r"[^\W_]+").findall
#: The order of runs knows the counts of this many words; it bounds what is broadcast and changes no result.
MOST_WORDS = 100_000
#: Share of all runs from which a run's own count is known, the size of a task's summary, and the share from which a run
#: enters the tree by two runs only. At most 1 / (SHARE - 1 / KEPT) runs are known.
SHARE, KEPT, HEAVY = 5e-6, 400_000, 1e-4
#: A node with more sets goes one run deeper, this many times, and is dealt out in blocks of this size then.
BIG, DEEP = 4_000, 2
#: Copies of one text that a task pairs with all others.
COPIES = 2_000
#: Subtrees of this many sets are joined set by set.
SMALL = 6
_EXTRA = 3  # runs after the prefix that a path carries along


class Bounds:
    """What a similarity of at least ``threshold`` asks of sizes; exact arithmetic."""

    def __init__(self, threshold: float):
        self.t = Fraction(str(threshold))

    def smallest(self, size: int) -> int:
        """Least size of a partner."""
        return -(-size * self.t.numerator // self.t.denominator)

    def overlap(self, a: int, b: int) -> int:
        """Least number of common runs."""
        n, d = self.t.numerator * (a + b), self.t.denominator + self.t.numerator
        return -(-n // d)

    def fewest(self, size: int) -> int:
        """Least number of runs in common with any partner."""
        return self.overlap(size, self.smallest(size))

    def skips(self, size: int) -> int:
        """How many runs of a set of ``size`` can be missing from a partner of any size."""
        return size - self.smallest(size)


class _Words:
    """Hashes of words, remembered up to a bound."""

    def __init__(self, most: int = 500_000):
        self.known: dict[str, int] = {}
        self.most = most

    def hashes(self, words: list[str]) -> np.ndarray:
        known = self.known
        out = []
        for w in words:
            h = known.get(w)
            if h is None:
                if len(known) >= self.most:
                    known.clear()
                h = known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
            out.append(h)
        return np.array(out, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words with hashes ``h``, in their order in the text."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    k = len(h) - n + 1
    acc = np.zeros(k, np.uint64)
    for i in range(n):
        acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + h[i : i + k])
    return acc


def distinct(runs: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sort and compare is quicker than unique() on short arrays."""
    runs = np.sort(runs)
    return runs[np.concatenate(([True], runs[1:] != runs[:-1]))] if len(runs) else runs


def _binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def _quiet(run):
    def quiet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            yield from run(batches)

    return quiet


def run_sets(df: DataFrame, key: str, text: str, n: int, least_words: int) -> DataFrame:
    """Rows (id, set_id, text): each text with at least ``least_words`` words and the hash of its set of runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for b in batches:
            keep, sets = [], []
            for x, t in enumerate(b.column(1).to_pylist()):
                if len(t) < 2 * least_words - 1:
                    continue
                w = _WORDS(t.lower())
                if len(w) >= least_words and len(r := distinct(run_hashes(words.hashes(w), n))):
                    keep.append(x)
                    sets.append(hashlib.blake2b(r.tobytes(), digest_size=16).digest())
            t = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([t.column(0), _binary(sets), t.column(1)], names=["id", "set_id", "text"])

    return df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("bigint"), text).mapInArrow(_quiet(run), "id bigint, set_id binary, text string")


class Order:
    """One order of all runs, by what the corpus says of them and of their words. Keys are sorted."""

    def __init__(self, words: tuple[np.ndarray, np.ndarray], known: tuple[np.ndarray, np.ndarray], heavy: float, n: int):
        self.words, self.logs = words[0], np.log(np.maximum(words[1], 1).astype(np.float32))
        self.known, self.counts = known
        self.heavy, self.n = heavy, n

    @staticmethod
    def _find(keys: np.ndarray, values: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Values of ``h``; 0 where there is none."""
        if not len(keys):
            return np.zeros(len(h))
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[at] == h, values[at], 0)

    def runs(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct runs of all ``texts`` (hashes of words), text by text, rarest first; whether each is heavy; and where
        each text's runs start, with the end of the last."""
        h, of, at = _starts(texts, self.n)
        logs = self._find(self.words, self.logs, h)
        runs = run_hashes(h, self.n)[at] if len(at) else np.empty(0, np.uint64)
        count = self._find(self.known, self.counts, runs)
        # sums in one order only: equal runs have equal scores
        by = np.lexsort((runs, sum((logs[at + i] for i in range(self.n)), np.zeros(len(at))), count, of))
        runs, count, of = runs[by], count[by], of[by]
        first = np.ones(len(runs), bool)
        first[1:] = (runs[1:] != runs[:-1]) | (of[1:] != of[:-1])
        ends = np.cumsum(np.bincount(of[first], minlength=len(texts)))
        return runs[first], count[first] > self.heavy, np.concatenate(([0], ends))


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... for each of ``counts``, one after the other."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _starts(texts: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words of ``texts``; for each run of ``n`` words the number of its text and the place of its first word."""
    sizes = np.array([len(t) for t in texts], np.int64)
    many = np.maximum(0, sizes - n + 1)
    h = np.concatenate(texts) if texts else np.empty(0, np.uint64)
    return h, np.repeat(np.arange(len(texts)), many), np.repeat(np.cumsum(sizes) - sizes, many) + _within(many)


def _sorted_by_hash(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    t = rows.select("h", "n").toArrow()
    h, n = t.column(0).to_numpy().astype(np.int64).view(np.uint64), t.column(1).to_numpy()
    by = np.argsort(h)
    return h[by], n[by]


def order_of(classes: DataFrame, n: int) -> Order:
    """The order of the runs of ``classes`` (text): counts of all words, and of the runs with a share of ``SHARE`` or more.

    Each task keeps a summary of ``KEPT`` runs, from which the least are dropped with their count taken from all others;
    a run's count in it falls short of the truth by at most a ``KEPT``-th of the runs of the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        keys, counts, total = np.empty(0, np.uint64), np.empty(0, np.int64), 0
        schema = pa.schema([("sort", pa.int32()), ("h", pa.int64()), ("n", pa.int64())])

        def rows(sort: int, h: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(h), sort, np.int32)), pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], schema=schema)

        for b in batches:
            hashed = [words.hashes(_WORDS(t.lower())) for t in b.column(0).to_pylist()]
            if not hashed:
                continue
            yield rows(0, *np.unique(np.concatenate(hashed), return_counts=True))
            all_, _, at = _starts(hashed, n)
            h, c = np.unique(run_hashes(all_, n)[at] if len(at) else np.empty(0, np.uint64), return_counts=True)
            total += int(c.sum())
            keys, where = np.unique(np.concatenate((keys, h)), return_inverse=True)
            counts = np.bincount(where, np.concatenate((counts, c))).astype(np.int64)
            if len(keys) > KEPT:
                counts -= np.partition(counts, len(counts) - KEPT - 1)[len(counts) - KEPT - 1]
                keys, counts = keys[counts > 0], counts[counts > 0]
        yield rows(1, keys, counts)
        yield rows(2, np.zeros(1, np.uint64), np.array([total]))

    stats = cut_lineage(classes.select("text").mapInArrow(_quiet(run), "sort int, h bigint, n bigint").groupBy("sort", "h").agg(F.sum("n").alias("n")))
    total = (stats.where("sort = 2").first() or {"n": 0})["n"]
    words = _sorted_by_hash(stats.where("sort = 0").orderBy(F.desc("n"), "h").limit(MOST_WORDS))
    known = _sorted_by_hash(stats.where((F.col("sort") == 1) & (F.col("n") > max(1.0, total * (SHARE - 1 / KEPT)))))
    return Order(words, known, max(2.0, total * HEAVY), n)


_POSTING = "node bigint, id bigint, size int, skipped int, depth int, rest binary"


def _postings(starts: DataFrame, order: Order, bounds: Bounds) -> DataFrame:
    """Rows (node, id, size, skipped, depth, rest): the nodes of the tree one run below each of ``starts`` (id, text, node,
    skipped, depth), and the runs that follow there. Depth 0 is the root."""
    b = starts.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, by = _Words(), b.value
        schema = pa.schema([("node", pa.int64()), ("id", pa.int64()), ("size", pa.int32()), ("skipped", pa.int32()), ("depth", pa.int32()), ("rest", pa.binary())])

        def posted(node: np.ndarray, ids: list[int], of: np.ndarray, sizes: np.ndarray, skipped: np.ndarray, depth: np.ndarray, after: np.ndarray, at: np.ndarray, last: np.ndarray, short: np.ndarray) -> pa.RecordBatch:
            """Postings of texts ``of`` with the runs from ``after`` on that a path carries along."""
            length = np.maximum(0, last[of] - after)
            rest = short[np.repeat(at[of] + after, length) + _within(length)]
            offsets = np.concatenate(([0], np.cumsum(2 * length))).astype(np.int32)
            binary = pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(rest.tobytes())])
            cols = (node.view(np.int64), np.array(ids, np.int64)[of], sizes[of], skipped, depth)
            return pa.RecordBatch.from_arrays([*[pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(cols, schema)], binary], schema=schema)

        for batch in batches:
            ids, texts, nodes, gone, depths = (batch.column(c).to_pylist() for c in range(5))
            runs, heavy, at = by.runs([words.hashes(_WORDS(t.lower())) for t in texts])
            short = (runs >> np.uint64(48)).astype(np.uint16)
            sizes = np.diff(at)
            reach = np.array([bounds.skips(int(n)) for n in sizes], np.int64) + np.array(depths, np.int64)  # the last place that a path can end at
            last = np.minimum(sizes, reach + 1 + _EXTRA)
            begin = np.array(gone, np.int64) + np.array(depths, np.int64)
            many = np.maximum(0, np.minimum(reach + 1, sizes) - begin)
            of, k = np.repeat(np.arange(len(ids)), many), _within(many) + np.repeat(begin, many)
            run_at, root = runs[at[of] + k], np.array(depths, np.int64)[of] == 0
            up = np.array(nodes, np.int64).view(np.uint64)[of]
            here = np.where(root, run_at, _mix(up * np.uint64(3) + run_at))
            plain = ~(heavy[at[of] + k] & root) | (np.array([bounds.fewest(int(n)) for n in sizes], np.int64)[of] < 2)  # else one run can't be all that a pair has in common
            depth = np.array(depths, np.int64)[of]
            yield posted(here[plain], ids, of[plain], sizes, k[plain] - depth[plain], depth[plain] + 1, k[plain] + 1, at, last, short)
            two = heavy[at[of] + k] & root
            if two.any():
                of, k, run_at = of[two], k[two], run_at[two]
                more = np.maximum(0, np.minimum(reach[of] + 2, sizes[of]) - k - 1)
                first, j = np.repeat(np.arange(len(of)), more), _within(more) + np.repeat(k + 1, more)
                of, run_at = of[first], run_at[first]
                yield posted(_mix(run_at * np.uint64(3) + runs[at[of] + j]), ids, of, sizes, j - 1, np.full(len(of), 2), j + 1, at, last, short)

    return starts.select("id", "text", "node", "skipped", "depth").mapInArrow(_quiet(run), _POSTING)


def walk(members: list[tuple[int, int, int, tuple[int, ...]]], depth: int, bounds: Bounds, out: set[tuple[int, int]]) -> None:
    """Pairs of ``members`` (id, size, skipped, runs that follow) that can still be similar. All share the path so far."""
    if len(members) > SMALL and depth > 0:
        below: dict[int, list] = {}
        ended = []  # their runs are used up within what is known of them
        for m in members:
            i, n, s, rest = m
            room = bounds.skips(n) - s
            for k in range(min(room + 1, len(rest))):
                below.setdefault(rest[k], []).append((i, n, s + k, rest[k + 1 :]))
            if len(rest) <= room:
                ended.append(m)
        for sub in below.values():
            if len(sub) > 1:
                walk(sub, depth - 1, bounds, out)
        if not ended:
            return
        # a set whose known runs end within its room may agree with any other beyond them
        done = {m[0] for m in ended}
        for a in ended:
            for m in members:
                if m[0] != a[0] and (m[0] not in done or a[0] < m[0]):
                    _compare(a, m, bounds, out)
        return
    for x, a in enumerate(members):
        for m in members[x + 1 :]:
            _compare(a, m, bounds, out)


def _compare(a: tuple, b: tuple, bounds: Bounds, out: set[tuple[int, int]]) -> None:
    (i, n, s, rest), (j, m, u, other) = a, b
    if i == j:
        return
    if n < m:
        if n < bounds.smallest(m):
            return
    elif m < bounds.smallest(n):
        return
    o = bounds.overlap(n, m)
    if s > n - o or u > m - o:
        return
    ra, rb = n - o - s, m - o - u  # runs that each may still skip
    if rest and other and ra < len(rest) and rb < len(other) and not set(rest[: ra + 1]).intersection(other[: rb + 1]):
        return
    out.add((i, j) if i < j else (j, i))


def _walked(postings: DataFrame, bounds: Bounds, last: bool) -> DataFrame:
    """Rows (a, b) of candidates, and rows like those of ``postings`` of sets that have to go deeper, none if ``last``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("node", pa.int64()), ("id", pa.int64()), ("size", pa.int32()), ("skipped", pa.int32()), ("depth", pa.int32()), ("rest", pa.binary())])

        def batch(cols: list[list]) -> pa.RecordBatch:
            length = max(map(len, cols))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) if c else pa.nulls(length, f.type) for c, f in zip(cols, schema)], schema=schema)

        def close(group: list) -> pa.RecordBatch | None:
            found: set[tuple[int, int]] = set()
            walk([(i, n, s, tuple(memoryview(r).cast("H")) if r else ()) for i, n, s, _, r in group], _EXTRA, bounds, found)
            pairs = list(found)
            return batch([[p[0] for p in pairs], [p[1] for p in pairs], [], [], [], [], [], []]) if pairs else None

        node, group, deeper = None, [], False
        for b in batches:
            down: list[list] = [[] for _ in range(6)]

            def descend(k: int, members: list) -> list:
                """Send members a run deeper; those that may have nothing more in common stay."""
                for m in members:
                    for col, v in zip(down, (k, *m)):
                        col.append(v)
                return [m for m in members if bounds.fewest(m[1]) <= m[3]]

            nodes = b.column(0).to_numpy()
            if len(nodes) > 2:  # a node that only one set is at within the batch pairs nobody
                same = nodes[1:] == nodes[:-1]
                keep = np.ones(len(nodes), bool)
                keep[1:-1] = same[1:] | same[:-1]
                b = b.filter(pa.array(keep))
            for k, *member in zip(*(b.column(c).to_pylist() for c in range(6))):
                if k != node:
                    if len(group) > 1 and (res := close(group)) is not None:
                        yield res
                    node, group, deeper = k, [], False
                group += descend(k, [member]) if deeper else [member]
                if len(group) > BIG and not deeper and not last:
                    group, deeper = descend(k, group), True
            if down[0]:
                yield batch([[], [], *down])
        if len(group) > 1 and (res := close(group)) is not None:
            yield res

    return postings.repartition("node").sortWithinPartitions("node").mapInArrow(run, "a bigint, b bigint, " + _POSTING)


def _blocks(down: DataFrame) -> DataFrame:
    """Postings of the same sets to a node for each pair of blocks of about ``BIG`` sets of their old node."""
    many = down.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / BIG).cast("int").alias("k"))
    own = F.pmod(F.xxhash64("id"), F.col("k"))
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda j: F.xxhash64("node", F.least(own, j), F.greatest(own, j))))
    return down.join(many, "node").select(pair.alias("node"), "id", "size", "skipped", "depth", "rest")


def _candidates(classes: DataFrame, order: Order, bounds: Bounds) -> DataFrame:
    """Distinct rows (a, b), a < b. Each level of the tree that some node is too big for is one more round."""
    spark = classes.sparkSession
    starts = classes.select("id", "text", F.lit(0).cast("bigint").alias("node"), F.lit(0).alias("skipped"), F.lit(0).alias("depth"))
    out, level, postings = None, 0, _postings(starts, order, bounds)
    while True:
        path = scratch_path(spark, "walked")
        _walked(postings, bounds, level > DEEP).write.parquet(path)
        got = spark.read.parquet(path)
        pairs = got.where("a is not null").select("a", "b")
        out = pairs if out is None else out.unionByName(pairs)
        down = got.where("node is not null").drop("a", "b")
        if not down.limit(1).count():
            return out.distinct()
        level += 1
        postings = _blocks(down) if level > DEEP else _postings(down.join(classes.select("id", "text"), "id"), order, bounds)


def similar_classes(classes: DataFrame, threshold: float, n: int) -> DataFrame:
    """Rows (a, b, similarity), a < b: classes (id, text) whose sets agree in at least ``threshold`` of their union."""
    bounds = Bounds(threshold)
    cand = _candidates(classes, order_of(classes, n), bounds)
    left, right = classes.select(F.col("id").alias("a"), F.col("text").alias("ta")), classes.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    num, den = bounds.t.numerator, bounds.t.denominator

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])
        words = _Words()
        for b in batches:
            keep, sims = [], []
            last, u = None, None
            for x, (p, q) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                if p != last:
                    last, u = p, distinct(run_hashes(words.hashes(_WORDS(p.lower())), n))
                v = distinct(run_hashes(words.hashes(_WORDS(q.lower())), n))
                both = np.sort(np.concatenate((u, v)))
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                union = len(u) + len(v) - common
                if common * den >= num * union:
                    keep.append(x)
                    sims.append(common / union)
            t = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array(sims, pa.float64())], schema=schema)

    return cand.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(_quiet(check), "a bigint, b bigint, similarity double")


def _prepare(df: DataFrame, key: str, text: str, n: int, least_words: int) -> tuple[DataFrame, DataFrame]:
    """(members (id, set_id), classes (id, set_id, text)), written once to the shared folder."""
    spark = df.sparkSession
    path = scratch_path(spark, "runs")
    run_sets(df, key, text, n, least_words).write.parquet(path)
    sets = spark.read.parquet(path)
    members_path = scratch_path(spark, "members")
    sets.select("id", "set_id").distinct().write.parquet(members_path)
    classes_path = scratch_path(spark, "classes")
    sets.groupBy("set_id").agg(F.min("id").alias("id"), F.first("text").alias("text")).select("id", "set_id", "text").write.parquet(classes_path)
    drop_path(spark, path)  # classes and members hold all of it now
    return spark.read.parquet(members_path), spark.read.parquet(classes_path)


def pairs(df: DataFrame, key: str, text: str, threshold: float = 0.8, n: int = 5, least_words: int = 0) -> DataFrame:
    """Rows (a, b), a < b: all pairs of different records of at least ``least_words`` words whose sets of runs of ``n``
    words agree in at least ``threshold`` of their union. Records without a run, NULL texts and NULL keys are in no pair; a
    record delivered twice counts once."""
    members, classes = _prepare(df, key, text, n, max(least_words, n))
    sim = similar_classes(classes.select("id", "text"), threshold, n)
    of = classes.select(F.col("id").alias("cls"), "set_id")
    many = members.groupBy("set_id").agg(F.count(F.lit(1)).alias("k"))
    own = members.join(of, "set_id").join(many, "set_id").select("id", "cls", "k")
    one = own.select(F.col("id").alias("p"), F.col("cls").alias("a"))
    two = own.select(F.col("id").alias("q"), F.col("cls").alias("b"))
    across = sim.join(one, "a").join(two, "b").select("p", "q")
    # copies of one text meet in parts, so that no task pairs more than COPIES of them with the rest
    parts = F.ceil(F.col("k") / COPIES).cast("int")
    same = own.where("k > 1")
    left = same.select(F.col("id").alias("p"), "cls", F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"))
    right = same.select(F.col("id").alias("q"), "cls", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    within = left.join(right, ["cls", "part"]).where("p < q").select("p", "q")
    return across.unionByName(within).select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def groups(df: DataFrame, key: str, text: str, threshold: float = 0.8, n: int = 5, least_words: int = 0) -> DataFrame:
    """Rows (id, group_id, links): each record that nearly agrees with another, its group (the smallest id that links
    lead to) and the number of other classes it is linked to. Copies are not expanded into pairs."""
    from quire.llm.splits import components

    members, classes = _prepare(df, key, text, n, max(least_words, n))
    sim = similar_classes(classes.select("id", "text"), threshold, n).select("a", "b")
    path = scratch_path(df.sparkSession, "links")
    sim.write.parquet(path)
    sim = df.sparkSession.read.parquet(path)
    both = sim.select(F.col("a").alias("cls")).unionByName(sim.select(F.col("b").alias("cls"))).groupBy("cls").agg(F.count(F.lit(1)).alias("links"))
    edge = F.concat_ws("-", "a", "b")
    comp = components(sim.select(F.col("a").alias("book_id"), edge.alias("key")).unionByName(sim.select(F.col("b").alias("book_id"), edge.alias("key"))))
    own = members.join(classes.select(F.col("id").alias("cls"), "set_id"), "set_id")
    many = members.groupBy("set_id").agg(F.count(F.lit(1)).alias("k"))
    out = own.join(many, "set_id").join(comp.withColumnRenamed("book_id", "cls"), "cls", "left").join(both, "cls", "left")
    return out.where("k > 1 or group_id is not null").select("id", F.coalesce("group_id", "cls").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))

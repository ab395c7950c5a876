"""Problems 8, 2 and 9: token ids of a public tokenizer, token budgets, and packing into containers.

Encoding runs a byte-level pair encoding of its own: a priority queue of merge ranks over a doubly linked list of symbols,
where entries that a merge made stale are skipped. Encoded words are remembered in each task, so that the queue runs once
for each distinct word. Vocabulary files are read from a path given as a parameter; they are never part of the package.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import pyarrow as pa
import regex as re
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, canon_label, canon_language

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the public tokenizer cuts a text into words.
WORD_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that a task remembers, and the longest it remembers. Both bound memory only; results don't depend on them.
REMEMBERED, REMEMBERED_LENGTH = 300_000, 64


class BytePairEncoder:
    """Encodes text by ranks of byte pairs; texts of special tokens are ordinary text."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.singles = [ranks[bytes([b])] for b in range(256)]
        self.vocab = {i: b for b, i in ranks.items()}
        self._find = re.compile(WORD_PATTERN).findall
        self._known: dict[str, tuple[int, ...]] = {}

    @classmethod
    def from_file(cls, path: str) -> BytePairEncoder:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of one word."""
        if (whole := self.ranks.get(word)) is not None:
            return (whole,)
        n = len(word)
        end = list(range(1, n + 1))  # where the symbol that starts here ends; 0 once it is merged into another
        prev = list(range(-1, n - 1))
        rank = self.ranks.get
        queue = []
        for i in range(n - 1):
            if (r := rank(word[i : i + 2])) is not None:
                queue.append((r, i, i + 1, i + 2))
        heapq.heapify(queue)
        while queue:
            _, i, mid, stop = heapq.heappop(queue)
            if end[i] != mid or mid >= n or end[mid] != stop:
                continue  # stale
            end[i], end[mid] = stop, 0
            if stop < n:
                prev[stop] = i
                if (r := rank(word[i : end[stop]])) is not None:
                    heapq.heappush(queue, (r, i, stop, end[stop]))
            if (p := prev[i]) >= 0 and (r := rank(word[p:stop])) is not None:
                heapq.heappush(queue, (r, p, i, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[word[i : end[i]]])
            i = end[i]
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        """Ids of ``text``; none for an empty or NULL text."""
        if not text:
            return []
        known, out = self._known, []
        for w in self._find(text):
            ids = known.get(w)
            if ids is None:
                ids = self.merge(w.encode("utf-8", "surrogatepass"))
                if len(w) <= REMEMBERED_LENGTH:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[w] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.vocab[i] for i in ids).decode("utf-8", "replace")


_encoders: dict[str, BytePairEncoder] = {}


def encoder(path: str = DEFAULT_RANKS) -> BytePairEncoder:
    """The encoder of ``path``, made once in each Python process."""
    if path not in _encoders:
        _encoders[path] = BytePairEncoder.from_file(path)
    return _encoders[path]


def encode_ids(docs: DataFrame, path: str = DEFAULT_RANKS) -> DataFrame:
    """Rows (doc_id, ids): token ids of every document, an empty list where the text is empty or NULL.

    Rows are kept as they are: a repeated document is encoded as often as it stands, a NULL ``doc_id`` stays.
    """

    def run(cols: dict[str, list]) -> dict[str, list]:
        enc = encoder(path).encode
        return {"doc_id": cols["doc_id"], "ids": [enc(t) for t in cols["text"]]}

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id bigint, ids array<int>")


# --- token budgets ---------------------------------------------------------------------------------------------------
#: Genre labels that name another label's genre.
GENRE_ALIASES = {"manuals": "manual", "textbooks": "textbook", "cookbooks": "cookbook", "novels": "novel", "histories": "history", "fiction": "novel"}


def canon_genre(c: Column) -> Column:
    bare = canon_label(F.regexp_replace(c, r"(?U)[^\p{L}\p{N}\s_-]", ""))
    for a, b in GENRE_ALIASES.items():
        bare = F.when(bare == a, F.lit(b)).otherwise(bare)
    return bare


def canon_source(c: Column) -> Column:
    """A source without case, surplus blanks and with one sort of separator; NULL where nothing is named."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), r"(?U)[\s_\-]+", "-")
    return F.when((bare == "") | bare.isin("none", "null", "n/a", "unknown", "-"), F.lit(None)).otherwise(bare)


def latest(df: DataFrame, key: str, at: str, *cols: str) -> DataFrame:
    """One row for each ``key``, the one that arrived last; ties go to the greatest values."""
    best = F.max(F.struct(F.col(at), *cols)).alias("r")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(best).select(key, *[F.col(f"r.{c}").alias(c) for c in cols])


def budget(blocks: DataFrame, docs: DataFrame, books: DataFrame, path: str = DEFAULT_RANKS) -> DataFrame:
    """Tokens by part (blocks or documents), source, language, genre and block type.

    Texts are reduced to a hash and the counts of the slices they stand in; each distinct text crosses the network once and
    is tokenized once; token counts then join the hash counts. The source of a block is the delivery box of its book; a
    block without language takes its book's. Slices that nothing names are NULL. A NULL text counts as a record without
    tokens.
    """
    b = latest(books, "book_id", "updated_at", "genre", "language", "origin").select(
        "book_id", canon_genre(F.col("genre")).alias("genre"), canon_language(F.col("language")).alias("book_language"), canon_source(F.col("origin")).alias("source")
    )
    digest = lambda c: F.unhex(F.md5(F.encode(F.col(c), "UTF-8")))
    blk = blocks.select(
        "block_uid", "book_id", canon_language(F.col("language")).alias("language"), canon_label(F.col("block_type")).alias("block_type"), digest("clean_text").alias("h")
    )
    blk = (
        blk.where(F.col("block_uid").isNotNull())
        .groupBy("block_uid")
        .agg(F.max(F.struct("book_id", "language", "block_type", "h")).alias("r"))
        .select("r.*")
        .groupBy("book_id", "language", "block_type", "h")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(b, "book_id", "left")
        .select(F.lit("blocks").alias("part"), "source", F.coalesce("language", "book_language").alias("language"), "genre", "block_type", "h", "n")
    )
    doc = docs.select(
        F.lit("documents").alias("part"),
        canon_source(F.col("source")).alias("source"),
        canon_language(F.col("lang")).alias("language"),
        canon_genre(F.col("genre")).alias("genre"),
        F.lit(None).cast("string").alias("block_type"),
        digest("text").alias("h"),
        "doc_id",
    )
    doc = doc.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.struct("part", "source", "language", "genre", "block_type", "h")).alias("r")).select("r.*")
    doc = doc.groupBy(*doc.columns).agg(F.count(F.lit(1)).alias("n"))
    slices = blk.unionByName(doc)
    slices = slices.groupBy(*[c for c in slices.columns if c != "n"]).agg(F.sum("n").alias("n"))

    texts = blocks.select(digest("clean_text").alias("h"), F.col("clean_text").alias("text")).unionByName(docs.select(digest("text").alias("h"), "text"))
    texts = texts.where(F.col("h").isNotNull()).dropDuplicates(["h"])

    def count(cols: dict[str, list]) -> dict[str, list]:
        enc = encoder(path).encode
        return {"h": cols["h"], "tokens": [len(enc(t)) for t in cols["text"]]}

    counted = arrow_map(texts, count, "h binary, tokens bigint")
    out = slices.join(counted, "h", "left")
    return out.groupBy("part", "source", "language", "genre", "block_type").agg(
        F.sum("n").alias("n_records"),
        F.count("h").alias("n_texts"),
        F.sum(F.coalesce(F.col("tokens"), F.lit(0)) * F.col("n")).alias("n_tokens"),
    )


# --- packing ---------------------------------------------------------------------------------------------------------
class OpenBins:
    """A bounded number of open bins; a bit for each amount of free space that some open bin has."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.made = capacity, most, 0
        self.bits, self.at, self.count = 0, {}, 0

    def put(self, size: int) -> int:
        """The number of the bin that takes an item of ``size``: the fullest open one it fits."""
        fit = self.bits >> size
        if fit:
            free = size + (fit & -fit).bit_length() - 1
            number = self._take(free)
        else:
            if self.count >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, number = self.capacity, self.made
            self.made += 1
        if free > size:
            left = free - size
            self.at.setdefault(left, []).append(number)
            self.bits |= 1 << left
            self.count += 1
        return number

    def _take(self, free: int) -> int:
        bins = self.at[free]
        number = bins.pop()
        self.count -= 1
        if not bins:
            del self.at[free]
            self.bits &= ~(1 << free)
        return number


def pack(docs: DataFrame, configs: DataFrame, path: str = DEFAULT_RANKS, open_bins: int = 256, chunk: int = 20_000) -> DataFrame:
    """Rows (pack_id, container, doc_id, piece, tokens): documents in containers of each configuration.

    Documents are counted once, then spread over groups of about ``chunk`` documents, of one source where a container may
    hold only one; a source of any size falls into as many groups as it needs, so no task grows with a source. Each group
    runs a bounded-space best-fit. A document longer than the capacity is cut into full pieces and a rest, and the rest is
    packed like any other item. Documents without tokens take no space but are assigned. Configurations with a NULL or
    non-positive capacity are left out; a NULL source is a source of its own; rows without ``doc_id`` are left out.
    """
    spark = docs.sparkSession
    cfg = [(r.pack_id, r.capacity_tokens, bool(r.per_source)) for r in configs.dropDuplicates(["pack_id"]).orderBy("pack_id").collect() if r.pack_id is not None and (r.capacity_tokens or 0) > 0]

    def count(cols: dict[str, list]) -> dict[str, list]:
        enc = encoder(path).encode
        return {"doc_id": cols["doc_id"], "source": cols["source"], "tokens": [len(enc(t)) for t in cols["text"]]}

    sized = arrow_map(docs.where(F.col("doc_id").isNotNull()).select("doc_id", canon_source(F.col("source")).alias("source"), "text"), count, "doc_id bigint, source string, tokens int")
    sized = sized.groupBy("doc_id").agg(F.max(F.struct("source", "tokens")).alias("r")).select("doc_id", F.coalesce("r.source", F.lit("")).alias("source"), "r.tokens")
    from quire.session import cut_lineage

    sized = cut_lineage(sized)
    groups = sized.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / chunk).alias("parts"))
    total = -(-sized.count() // chunk) or 1
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    rows = sized.join(groups, "source").select(
        "doc_id",
        "tokens",
        F.explode(F.array(*[F.struct(F.lit(p).alias("pack_id"), F.when(F.lit(per), F.concat_ws("/", F.col("source"), F.pmod(h, "parts"))).otherwise(F.concat(F.lit("/"), F.pmod(h, F.lit(total)))).alias("grp")) for p, _, per in cfg])).alias("g"),
    ).select("g.*", "doc_id", "tokens") if cfg else None
    out = "pack_id int, container string, doc_id bigint, piece int, tokens int"
    if rows is None:
        return spark.createDataFrame([], out)
    capacity = {p: c for p, c, _ in cfg}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bins = None, None
        schema = pa.schema([("pack_id", pa.int32()), ("container", pa.string()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("tokens", pa.int32())])
        for b in batches:
            res: tuple[list, ...] = ([], [], [], [], [])
            for p, g, d, n in zip(*(b.column(i).to_pylist() for i in range(4))):
                if (p, g) != now:
                    now, bins = (p, g), OpenBins(capacity[p], open_bins)
                cap = capacity[p]
                pieces = [cap] * (n // cap) + [n % cap] * (n % cap > 0 or n == 0)
                for k, size in enumerate(pieces):
                    if size == cap:
                        number, bins.made = bins.made, bins.made + 1
                    else:
                        number = bins.put(size)
                    for col, v in zip(res, (p, f"{p}:{g}:{number}", d, k, size)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(res, schema)], schema=schema)

    width = max(1, min(total * len(cfg) * 2, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return rows.repartition(width, "pack_id", "grp").sortWithinPartitions("pack_id", "grp", F.xxhash64("doc_id"), "doc_id").select("pack_id", "grp", "doc_id", "tokens").mapInArrow(run, out)

"""Problem 3: splits that keep related records together.

Books are related if they share an author, a series or an origin, directly or through other books. Components are found by
minimum labels with pointer jumping on tables of the cluster; nothing but counters reaches the driver. Splits are assigned
by grouped iterative stratification: the components with the rarest outstanding label go first, into the splits that need
that label most. Labels have one order over the whole collection. Only counters of labels and the few components that hold a
noticeable share of everything reach the driver; the others take the places that an order by hash gives them within the
label that decides about them, so that they are shared out as the splits need it, in any number.
"""

from __future__ import annotations

import random
import unicodedata

import regex as re
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, canon_language
from quire.llm.tokens import canon_genre, latest
from quire.session import cut_lineage

#: What stands where nobody or nothing is named.
NOBODY = {"", "none", "null", "nil", "nan", "n a", "na", "n n", "nn", "unknown", "unbekannt", "inconnu", "desconocido", "desconhecido", "неизвестен", "anonymous", "anonym", "anonyme", "anónimo", "anônimo", "anon", "various", "various authors", "diverse", "divers", "varios", "vários", "no author", "author unknown", "unknown author", "tbd", "editor", "editors", "et al", "misc", "other", "not applicable", "untitled", "series", "unspecified"}


def plain(value: str | None) -> str:
    """``value`` without case, surplus blanks and accent storage."""
    return " ".join(unicodedata.normalize("NFC", unicodedata.normalize("NFC", value).casefold()).split()) if value else ""


def is_nobody(value: str) -> bool:
    return " ".join(re.sub(r"[^\p{L}\p{M}\p{N}]+", " ", value).split()) in NOBODY


def author_key(author: str | None) -> str | None:
    """One form for ``Given Family`` and ``Family, Given``; None unless both names are there."""
    v = plain(author)
    if is_nobody(v):
        return None
    if v.count(",") == 1:
        family, given = (x.strip() for x in v.split(","))
        if not family or not given:
            return None
        v = f"{given} {family}"
    parts = v.replace(",", " ").split()
    return " ".join(parts) if len(parts) > 1 else None


def thing_key(value: str | None) -> str | None:
    v = plain(value)
    return None if is_nobody(v) else v


def memberships(books: DataFrame) -> DataFrame:
    """Distinct rows (book_id, key): what each book shares; keys are hashes of 128 bits."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        ids, keys = [], []
        for b, authors, series, origin in zip(cols["book_id"], cols["authors"], cols["series"], cols["origin"]):
            if b is None:
                continue
            found = {("a", author_key(a)) for a in authors or ()} | {("s", thing_key(series)), ("o", thing_key(origin))}
            for sort, k in sorted((s, k) for s, k in found if k):
                ids.append(b)
                keys.append(f"{sort}\0{k}")
        return {"book_id": ids, "key": keys}

    rows = arrow_map(books.select("book_id", "authors", "series", "origin"), run, "book_id string, key string")
    return rows.select("book_id", F.md5(F.encode("key", "UTF-8")).alias("key")).distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Rows (book_id, group_id) of books linked through keys; group_id is the smallest book_id. Books that share no key with
    another are left out. ``links`` has (book_id, key), distinct.

    Each round takes minima over keys, then over books, then jumps along labels, so that labels halve their distance to the
    minimum; a hot key only costs an aggregate with partial sums and an equi-join that adaptive execution splits.
    """
    shared = links.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("book_id").alias("low")).where("n > 1").select("key", "low")
    m = cut_lineage(links.join(shared, "key"))
    labels = cut_lineage(m.groupBy("book_id").agg(F.min("low").alias("label")))
    m = m.select("book_id", "key")
    for _ in range(most_rounds):
        low = m.join(labels, "book_id").groupBy("key").agg(F.min("label").alias("low"))
        near = m.join(low, "key").groupBy("book_id").agg(F.min("low").alias("label"))
        far = near.select(F.col("book_id").alias("label"), F.col("label").alias("next"))
        new = cut_lineage(
            near.join(far, "label", "left")
            .select("book_id", F.least("label", F.coalesce("next", "label")).alias("label"))
            .join(labels.withColumnRenamed("label", "old"), "book_id")
            .select("book_id", "label", (F.col("label") != F.col("old")).alias("moved"))
        )
        moved = new.where("moved").limit(1).count()
        labels = new.select("book_id", "label")
        if not moved:
            return labels.select("book_id", F.col("label").alias("group_id"))
    raise RuntimeError(f"labels still move after {most_rounds} rounds")


def found(books: DataFrame) -> DataFrame:
    """Rows (book_id, group_id): books in a group of at least two."""
    return components(memberships(books))


#: Components heavier than this share of all weight are placed one by one; there are at most 1 / GIANT of them.
GIANT = 1e-3
#: Components of one stretch of the order within a label; bounds what a task sorts, not the result.
STRETCH = 20_000


class Stratification:
    """Iterative stratification: labels in one order, the rarest first; under each, what every split still needs of it.

    ``giants`` come first in that order: they are placed one by one, under each label the heaviest first, into the split
    that needs the label most. All other components that a label decides about share what need of it remains: ``cuts`` has
    the shares of the splits.
    """

    def __init__(self, ratios: list[float], seed: int, totals: dict[str, float], shared: dict[str, dict[str, float]], giants: list[tuple[str, str, float, dict[str, float]]], order: list[str]):
        rnd = random.Random(seed)
        need = {k: [v * q for q in ratios] for k, v in totals.items()}
        want = [sum(totals.values()) * q for q in ratios]
        by: dict[str, list] = {}
        for g in giants:
            by.setdefault(g[1], []).append(g)
        self.placed: dict[str, int] = {}
        self.cuts: dict[str, list[float]] = {}

        def take(s: int, labels: dict[str, float], share: float = 1.0) -> None:
            for k, v in labels.items():
                need[k][s] -= share * v
                want[s] -= share * v

        # what can't be divided goes first, so that the rest can make up for it
        rest = {k: dict(v) for k, v in shared.items()}
        for label in order:
            for group, _, _, labels in sorted(by.get(label, ()), key=lambda g: (-g[2], g[0])):
                # a split that has all it wants in sum takes no more while another wants some
                s = max(range(len(ratios)), key=lambda j: (ratios[j] > 0, want[j] > 1e-9, round(need[label][j], 9), want[j], rnd.random()))
                self.placed[group] = s
                take(s, labels)
                for k, v in labels.items():
                    rest[label][k] -= v
        for label in order:
            amount = max(1e-9, sum(rest.get(label, {}).values()))
            left = [max(0.0, min(x, w)) if q > 0 else 0.0 for x, w, q in zip(need[label], want, ratios)]
            if sum(left) <= 1e-9:
                left = [max(0.0, w) if q > 0 else 0.0 for w, q in zip(want, ratios)]
            cut = [x / sum(left) for x in left] if sum(left) > 1e-9 else list(ratios)
            # no split gets more than it wants in sum; the others take what is over
            most = [max(0.0, w) / amount for w in want]
            over = sum(max(0.0, c - m) for c, m in zip(cut, most))
            room = [max(0.0, m - c) if q > 0 else 0.0 for c, m, q in zip(cut, most, ratios)]
            if 1e-12 < over and sum(room) > 0:
                cut = [min(c, m) + over * r / sum(room) for c, m, r in zip(cut, most, room)]
            self.cuts[label] = [c / sum(cut) for c in cut]
            for s, share in enumerate(self.cuts[label]):
                take(s, rest.get(label, {}), share)


def shares(ratios: list[float] | None) -> list[float]:
    """``ratios`` scaled to sum 1; all to train where nothing valid is given. A ratio after the third names no split."""
    r = [max(0.0, x or 0.0) for x in (ratios or [])][:3] + [0.0] * 3
    r = r[:3]
    return [x / sum(r) for x in r] if sum(r) > 0 else [1.0, 0.0, 0.0]


SPLITS = ("train", "validation", "test")


def assign(books: DataFrame, toc: DataFrame, configs: DataFrame) -> DataFrame:
    """Rows (split_id, by_key, book_id, group_id, split): every book under every configuration.

    Related books always stay together, whatever ``by_key`` is; ``by_key`` names the unit whose number the ratios divide:
    books, chapters (entries of the table of contents, one at least), authors, or groups. Genre and language are the labels
    that are balanced. Ratios that don't sum to 1 are scaled. A book without any key is a group of its own.
    """
    spark = books.sparkSession
    cfg = [(r.split_id, (r.by_key or "book").strip().lower(), shares(r.ratios), int(r.seed or 0)) for r in configs.dropDuplicates(["split_id"]).orderBy("split_id").collect()]
    one = latest(books, "book_id", "updated_at", "genre", "language", "authors")
    groups = found(books)
    chapters = toc.select("book_id", "toc_ord").distinct().groupBy("book_id").agg(F.count(F.lit(1)).alias("chapters"))
    base = cut_lineage(
        one.join(groups, "book_id", "left")
        .join(chapters, "book_id", "left")
        .select(
            "book_id",
            F.coalesce("group_id", "book_id").alias("group_id"),
            F.concat(F.lit("genre:"), F.coalesce(canon_genre(F.col("genre")), F.lit("?"))).alias("genre"),
            F.concat(F.lit("language:"), F.coalesce(canon_language(F.col("language")), F.lit("?"))).alias("language"),
            F.lit(1.0).alias("book"),
            F.greatest(F.coalesce("chapters", F.lit(1)), F.lit(1)).cast("double").alias("chapter"),
            F.greatest(F.size(F.coalesce("authors", F.array())), F.lit(1)).cast("double").alias("author"),
        )
    )
    units = ("book", "chapter", "author", "related")
    # what each component holds of each label, in every unit; a component counts once as related
    vec = base.select("group_id", F.explode(F.array("genre", "language")).alias("label"), *units[:3]).groupBy("group_id", "label").agg(*[F.sum(u).alias(u) for u in units[:3]]).withColumn("related", F.lit(1.0))
    totals = {r.label: r.asDict() for r in vec.groupBy("label").agg(*[F.sum(u).alias(u) for u in units]).collect()}  # a row for each label
    rare = spark.createDataFrame([(k, v["book"]) for k, v in totals.items()], "label string, rare double") if totals else None
    out = "split_id int, by_key string, book_id string, group_id string, split string"
    if rare is None or not cfg:
        return spark.createDataFrame([], out)
    # the rarest label of a component decides about it
    weights = [F.sum(u).alias(u) for u in units[:3]]
    comp = base.groupBy("group_id").agg(*weights).withColumn("related", F.lit(1.0))
    held = vec.join(rare, "label").groupBy("group_id").agg(F.min(F.struct("rare", "label")).alias("r"), F.collect_list(F.struct("label", *units)).alias("held"))
    comp = cut_lineage(comp.join(held.select("group_id", F.col("r.label").alias("decider"), "held"), "group_id"))
    shared = comp.select("decider", F.explode("held").alias("h")).groupBy("decider", "h.label").agg(*[F.sum(f"h.{u}").alias(u) for u in units]).collect()  # pairs of labels
    size = comp.agg(F.count(F.lit(1)).alias("n"), *[F.sum(u).alias(u) for u in units]).first()
    stretches = 1 + size.n // STRETCH
    order = sorted(totals, key=lambda k: (totals[k]["book"], k))

    parts = None
    for split_id, by, ratios, seed in cfg:
        unit = by if by in units else "book"
        giants = [(r.group_id, r.decider, float(r[unit]), {h.label: h[unit] for h in r.held}) for r in comp.where(F.col(unit) > GIANT * (size[unit] or 0.0)).collect()]
        with_: dict[str, dict[str, float]] = {}
        for r in shared:
            with_.setdefault(r.decider, {})[r.label] = r[unit]
        got = Stratification(ratios, seed, {k: v[unit] for k, v in totals.items()}, with_, giants, order)
        cuts = spark.createDataFrame([(k, c[0], c[0] + c[1]) for k, c in got.cuts.items()], "decider string, a double, b double")
        # each component's place within its label, by weight, in an order that only a hash of it decides
        h = F.xxhash64("group_id", F.lit(seed))
        rows = comp.where(F.col(unit) <= GIANT * (size[unit] or 0.0)).select("group_id", "decider", F.col(unit).alias("w"), h.alias("h"), F.pmod(h, F.lit(stretches)).alias("stretch"))
        sums = rows.groupBy("decider", "stretch").agg(F.sum("w").alias("sw"))
        of = Window.partitionBy("decider")
        sums = sums.select("decider", "stretch", (F.sum("sw").over(of.orderBy("stretch")) - F.col("sw")).alias("before"), F.sum("sw").over(of).alias("all"))
        up_to = F.sum("w").over(Window.partitionBy("decider", "stretch").orderBy("h", "group_id"))
        at = rows.join(sums, ["decider", "stretch"]).join(cuts, "decider").withColumn("at", (F.col("before") + up_to - F.col("w") / 2) / F.col("all"))
        part = at.select("group_id", F.when(F.col("at") < F.col("a"), SPLITS[0]).when(F.col("at") < F.col("b"), SPLITS[1]).otherwise(SPLITS[2]).alias("split"))
        if got.placed:
            part = part.unionByName(spark.createDataFrame([(g, SPLITS[s]) for g, s in got.placed.items()], "group_id string, split string"))
        part = part.select(F.lit(split_id).cast("int").alias("split_id"), F.lit(by).alias("by_key"), "group_id", "split")
        parts = part if parts is None else parts.unionByName(part)
    return parts.join(base.select("book_id", "group_id"), "group_id").select("split_id", "by_key", "book_id", "group_id", "split")


def assign_records(records: DataFrame, key: str, kind: str, assigned: DataFrame) -> DataFrame:
    """Rows (kind, record, book_id, split_id, split) of records that belong to a book; those without one are left out."""
    own = records.where(F.col("book_id").isNotNull() & F.col(key).isNotNull()).select(F.col(key).cast("string").alias("record"), "book_id").distinct()
    return own.join(assigned, "book_id").select(F.lit(kind).alias("kind"), "record", "book_id", "split_id", "split")

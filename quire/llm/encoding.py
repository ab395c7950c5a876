"""Problem 4: garbled text from wrong character encoding.

A wrong decoding is a substitution of characters: bytes of one code page were read as letters of another, or the bytes of
UTF-8 one by one. Pieces of text without blanks are judged on their own, so partly garbled texts are found. Code pages, and
sequences that are well-formed UTF-8, propose what a piece may have been; how much better the corpus knows the letter pairs
and words of a reading weighs it; and expectation-maximization over the pieces of a source learns what each garbled
character or sequence stands for there, starting from the proposals as prior. The likeliest map is applied with ``translate``.

Counts are exact. Pieces are judged once for each distinct one. Letter pairs are of the letters of the code pages and of the
alphabets that lost characters are looked for in, so there is a bound to what is broadcast; words meet their counts by an
equi-join, and blocks the garbled pieces by another. Only ratios of counts decide, so nothing depends on the size of the corpus.

Defined results: NULL and empty texts are not garbled; a replacement character makes a text garbled, and lost characters are
restored, however many, where the likeliest letters give words that the corpus knows.
"""

from __future__ import annotations

import heapq
import math
import unicodedata
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
import regex as re
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import arrow_map
from quire.llm.visual import shape
from quire.session import cut_lineage, hub

#: Code pages under which text may have been read (first) and in which it may have been written.
READ_AS = ("cp1252", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "koi8_r", "cp866", "iso8859_5", "iso8859_2", "cp1254", "mac_cyrillic")
WRITTEN = ("cp1252", "cp1251", "koi8_r", "cp850", "mac_roman", "cp437", "cp866", "iso8859_5", "cp1250", "mac_cyrillic")
#: How many times likelier the corpus must make a reading before a substitution is considered, in nats; and how much rarer
#: the rarest letter pair of a reading may be than that of the piece before its words are looked up.
MARGIN, SLACK = 2.3, 2.3
#: Probability of a substitution before anything is seen, how many pieces the whole corpus counts as in a source, rounds.
PRIOR, PIECES, ROUNDS = 0.05, 10.0, 3

_PIECE = re.compile(r"[^ \n\r\t]*[^\x00-\x7f][^ \n\r\t]*")
#: Letters and signs that unravelled text is usually made of; rarer ones need company.
_USUAL = re.compile(r"[\u00a1-\u024f\u0370-\u03ff\u0400-\u045f\u2010-\u203a\u20ac\u2100-\u214f\u2190-\u22ff\ufb00-\ufb06\u00a0]")
_WORDS = re.compile(r"[\p{L}\p{M}]+")
_DIVIDED = re.compile(r"(?<=\p{L})[-‐\xad¬] *\r?\n(?=\p{L})")


def pieces_of(text: str) -> list[str]:
    """Pieces with a character beyond ASCII; words divided at a line end are joined."""
    return _PIECE.findall(_DIVIDED.sub("", text) if "\n" in text else text)
_LOST = "�"
_BEYOND = re.compile(r"[^\x00-\x7f]+")
#: What no meant text has: signs within or before a word, and blanks or controls that show nothing.
_ODD = re.compile(r"\p{L}[^\p{L}\p{M}\p{N}\p{P}]\p{L}|\p{L}[„“”«»¿¡…†‡•‰]\p{L}|(?<![\p{L}\p{N}])[^\p{L}\p{M}\p{N}\p{P}\p{Z}$€£#@+~]\p{L}{2}|[‰·†‡]\p{L}|\p{L}[‰·†‡‚„]|\p{L}[¹²³§¤°±]\p{L}|[¹²³§¤ªº°±]\p{L}{2}|[\x80-\xa0\xad]|\p{Lu}\p{Ll}+\p{Lu}|\p{Ll}\p{Lu}")

#: What ``_ODD`` has and meant text may have too: blanks and hyphens that show nothing, words that run together.
_UNSEEN = re.compile(r"[\xa0\xad]|(?<=[^\x00-\x7f])(?=[A-Z])")


def _to_byte(page: str) -> dict[int, int]:
    """Code point to byte; bytes that a page leaves undefined stand for the control character of their number."""
    table = {}
    for b in range(128, 256):
        try:
            c = bytes([b]).decode(page)
        except UnicodeDecodeError:
            c = chr(b)
        table.setdefault(ord(c), b)
    return table


_BYTES = {p: _to_byte(p) for p in {*READ_AS, *WRITTEN, "latin_1"}}
_CHARS = {p: {b: chr(c) for c, b in t.items()} for p, t in _BYTES.items()}
#: Character maps for ``translate``, by (read as, written in).
SWAPS = {
    (a, b): {c: _CHARS[b][x] for c, x in _BYTES[a].items() if x in _CHARS[b] and ord(_CHARS[b][x]) != c}
    for a, b in product(READ_AS, WRITTEN)
    if a != b
}


def unravel(piece: str) -> str | None:
    """``piece`` with its bytes read as UTF-8, under the first code page where that is well-formed; None if there is none."""
    if len(piece) < 2:
        return None
    for page in ("latin_1", *READ_AS):
        table = _BYTES[page]
        raw = bytearray()
        for c in piece:
            o = ord(c)
            if o < 128:
                raw.append(o)
            elif (b := table.get(o)) is not None:
                raw.append(b)
            else:
                break
        else:
            try:
                out = raw.decode("utf-8")
            except UnicodeDecodeError:
                continue
            if out != piece and not any(0x80 <= ord(c) < 0xA0 for c in out if c not in piece):
                return out
    return None


def units(piece: str) -> list[str]:
    """Words of a piece, and its pairs of neighbours of which one is beyond ASCII, under a mark of their own."""
    out = [w.lower() for w in _WORDS.findall(piece)]
    low = piece.lower()
    out += ["\0" + low[i : i + 2] for i in range(len(low) - 1) if low[i] > "\x7f" or low[i + 1] > "\x7f"]
    if len(low) == 1:
        out.append("\0" + low)
    return out


#: Letters and signs that a lost character may have been: the usual ones first, then all of Latin,
#: Greek, Cyrillic and Vietnamese, small letters before capitals.
USUAL = "éèêàâçïîôûùñóáíúüöäßãõëœÉÀÇÜÖÄÑÓÁÍÚ’‘“”–—…°±²½§"
MORE = [chr(c) for lo, hi in ((0x400, 0x460), (0xA1, 0x250), (0x370, 0x400), (0x1E00, 0x1F00)) for c in range(lo, hi) if unicodedata.category(chr(c))[0] == "L"]
LETTERS = tuple(dict.fromkeys([*USUAL, *sorted(MORE, key=str.isupper)]))
#: Characters whose pairs are counted: what code pages hold, and what may have been lost.
ALPHABET = frozenset(chr(o).lower() for o in {*range(32, 256), *(o for t in _BYTES.values() for o in t), *map(ord, LETTERS)} if len(chr(o).lower()) == 1)


def pieces_counted(df: DataFrame, text: str) -> DataFrame:
    """Rows (piece, n): the distinct pieces of all texts and how often they stand there."""

    def count(cols: dict[str, list]) -> dict[str, list]:
        c: dict[str, int] = {}
        for t in cols[text]:
            if t and not t.isascii():
                for piece in pieces_of(t):
                    c[piece] = c.get(piece, 0) + 1
        return {"piece": list(c), "n": list(c.values())}

    return hub(arrow_map(df.select(text), count, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n")))


def units_counted(pieces: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """(rows (word, n), counts of letter pairs) of the corpus with these pieces."""

    def count(cols: dict[str, list]) -> dict[str, list]:
        c: dict[str, int] = {}
        for piece, n in zip(cols["piece"], cols["n"]):
            for u in units(piece):
                if u[0] != "\0" or ALPHABET.issuperset(u[1:]):
                    c[u] = c.get(u, 0) + n
        return {"word": list(c), "n": list(c.values())}

    all_ = hub(arrow_map(pieces, count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    pair = F.ascii("word") == 0
    t = all_.where(pair).toArrow()  # at most the square of the alphabet
    return all_.where(~pair), dict(zip(t.column("word").to_pylist(), t.column("n").to_pylist()))


class Reader:
    """Judges pieces of text by counts of letter pairs, and of words as far as they are given."""

    def __init__(self, pairs: dict[str, int], words: dict[str, int] | None = None):
        self.pairs, self.words = pairs, words or {}

    def score(self, piece: str, own: bool, words: bool = True) -> float:
        """How well the corpus knows the rarest part of a piece; a piece's own occurrence doesn't count for it."""
        least = math.inf
        for x in units(piece):
            if len(x) == 1 and x <= "\x7f":
                continue
            if x[0] == "\0":
                if ALPHABET.issuperset(x[1:]):
                    least = min(least, self.pairs.get(x, 0))
            elif words:
                least = min(least, self.words.get(x, 0))
        return 0.0 if least == math.inf else math.log(max(0.0, least - own) + 0.1)

    def proposals(self, piece: str) -> list[tuple[str, str]]:
        """(name, reading) of the substitutions that letter pairs don't rule out."""
        if _LOST in piece:
            return [("lost", r) for r in self.fills(piece)] or [("lost", piece)]
        out, deeper = [], piece
        while (deeper := unravel(deeper)) is not None:
            out.append(("utf-8", deeper))
        if out or len(piece) < 2:
            return out
        here = self.score(piece, True, words=False)
        for (a, b), table in SWAPS.items():
            read = piece.translate(table)
            if read == piece or any(ord(c) > 127 and c == d and ord(c) not in table for c, d in zip(piece, read)):
                continue
            if self.score(read, False, words=False) > here - SLACK and not _ODD.search(read):
                out.append((f"{a}>{b}", read))
        return out

    def needs(self, piece: str) -> set[str]:
        """The words whose counts decide about ``piece``; none if nothing is proposed for it."""
        readings = {r for _, r in self.proposals(piece)}
        texts = {piece, shape(piece), *readings} if readings else ()
        return {w.lower() for t in texts for w in _WORDS.findall(t)}

    def readings(self, piece: str) -> list[tuple[str, str, float]]:
        """Substitutions that the corpus prefers to the piece as it stands, as (name, reading, gain in nats)."""
        proposals = self.proposals(piece)
        if not proposals:
            return []
        if _LOST in piece:
            best = max((r for _, r in proposals), key=lambda r: self.score(r, False))
            return [("lost", best if self.score(best, False) > math.log(1.0) else piece, 20.0)]
        here = self.score(piece, True)
        if proposals[0][0] == "utf-8":
            # well-formed UTF-8 by chance is rare; only text that the corpus knows far better than its reading stays
            out, deep = proposals[0][1], self.unravelled(piece)
            gain = max(self.score(out, False), self.score(deep, False)) - here
            new = [c for c in deep if c > "\x7f"]
            # what no meant text has tells it whatever the counts, which grow with the corpus for a piece of unknown reading
            plain = _ODD.search(_UNSEEN.sub("-", piece)) is not None and _ODD.search(deep) is None
            if all(_USUAL.match(c) for c in new):
                sound = len(new) > 1 or gain > 0.5 or plain
            else:
                sound = gain > 0.5 or plain or len(new) > 3
                sound = sound and all(unicodedata.category(c)[0] in "LMNPSZ" or c in piece for c in new)
            return [("utf-8", deep, max(gain, 4.0))] if sound and (gain > -1.0 or plain) else []
        margin = MARGIN if len(piece) > 2 else 4.0
        if (look := shape(piece)) != piece and _ODD.sub("", look) == look and self.score(look, False) > here:
            return []  # letters of another script with the same shape
        return [(name, read, gain) for name, read in proposals if (gain := self.score(read, False) - here) > margin]

    def unravelled(self, piece: str) -> str:
        """``piece`` unravelled as often as that goes and the corpus doesn't know the text far better than what comes next."""
        out = unravel(piece) or piece
        while (deeper := unravel(out)) is not None:
            if self.score(deeper, False) < self.score(out, False) - 4.0 and (_ODD.search(out) is None or _ODD.search(deeper)):
                break
            out = deeper
        return out

    def fills(self, piece: str, kept: int = 40) -> list[str]:
        """The likeliest letters for the lost characters of a piece: by letter pairs, over all letters. Paths are narrowed
        to ``kept`` behind each character that isn't lost, where its pair has told of the one before."""
        paths: list[tuple[float, str]] = [(0.0, "")]
        for i, c in enumerate(piece):
            lost = c == _LOST
            new = []
            for s, text in paths:
                for x in LETTERS if lost else (c,):
                    if text and (lost or piece[i - 1] == _LOST):
                        n = self.pairs.get("\0" + (text[-1] + x).lower(), 0)
                        if not n:
                            continue
                        s_new = s + math.log(n)
                    else:
                        s_new = s
                    new.append((s_new - 0.01 * (lost and x.isupper()), text + x))
            width = len(LETTERS) if lost else kept
            paths = heapq.nlargest(width, new) if len(new) > width else new
        return [t for _, t in sorted(paths, key=lambda p: (-p[0], p[1]))]


def changes(piece: str, reading: str) -> list[str]:
    """What stands for what in a reading: single characters, or sequences where lengths differ; two parts to a string."""
    if len(piece) == len(reading):
        return sorted({f"{c}\0{d}" for c, d in zip(piece, reading) if c != d})
    parts = [_BEYOND.findall(piece), _BEYOND.findall(reading)]
    if len(parts[0]) != len(parts[1]):
        parts = [[piece], [reading]]
    return sorted({f"{c}\0{d}" for c, d in zip(*parts) if c != d})


def proposed(pieces: DataFrame) -> DataFrame:
    """Rows (piece, swap, reading, gain, changes): readings of distinct pieces that the corpus prefers to the piece."""
    words, pairs = units_counted(pieces)
    b = pieces.sparkSession.sparkContext.broadcast(pairs)

    def needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(b.value)
        for batch in batches:
            got = [(p, w) for p in batch.column(0).to_pylist() for w in sorted(reader.needs(p)) or ()]
            lone = [p for p in batch.column(0).to_pylist() if _LOST in p]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got] + lone, pa.string()), pa.array([g[1] for g in got] + [""] * len(lone), pa.string())], names=["piece", "word"])

    def judge(cols: dict[str, list]) -> dict[str, list]:
        out = []
        for piece, known in zip(cols["piece"], cols["known"]):
            reader = Reader(b.value, {k["word"]: k["n"] for k in known})
            out += [(piece, *r, changes(piece, r[1])) for r in reader.readings(piece)]
        return {n: [o[i] for o in out] for i, n in enumerate(("piece", "swap", "reading", "gain", "changes"))}

    asked = pieces.select("piece").mapInArrow(needs, "piece string, word string")
    known = asked.join(words, "word", "left").groupBy("piece").agg(F.collect_list(F.struct("word", F.coalesce("n", F.lit(0)).alias("n"))).alias("known"))
    return hub(arrow_map(known, judge, "piece string, swap string, reading string, gain double, changes array<string>"))


def judged(df: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """Rows (id, place, piece, reading, share): garbled pieces with the likeliest reading after expectation-maximization over
    the pieces of their source; ``place`` is the source."""
    rows = df.where(F.col(key).isNotNull() & F.col(text).isNotNull())
    proposals = proposed(pieces_counted(rows, text))

    def where(cols: dict[str, list]) -> dict[str, list]:
        at: dict[str, set[int]] = {}
        for i, t in zip(cols["id"], cols["text"]):
            if not t.isascii():
                for piece in pieces_of(t):
                    at.setdefault(piece, set()).add(i)
        return {"piece": list(at), "ids": [sorted(v) for v in at.values()]}

    # a row for each distinct piece of a batch, so a piece that stands everywhere has no more rows than there are batches
    index = arrow_map(rows.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")), where, "piece string, ids array<bigint>")
    at = index.join(proposals, "piece").select(F.explode("ids").alias("id"), "piece", "swap", "reading", "gain", "changes").distinct()
    places = rows.select(F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("place"))
    got = cut_lineage(at.join(places, "id").distinct())
    # E: share of each reading of a piece, the piece as it stands among them; M: what a source shows each character to stand for
    of_piece = Window.partitionBy("id", "place", "piece")
    shares = got.withColumn("prior", F.lit(PRIOR))
    for last in [False] * (ROUNDS - 1) + [True]:
        w = F.col("prior") * F.exp(F.least("gain", F.lit(30.0)))
        shares = shares.withColumn("w", w).withColumn("share", F.col("w") / (F.sum("w").over(of_piece) + F.lit(1.0)))
        if last:
            break
        each = shares.select("place", F.explode("changes").alias("change"), "share")
        here = each.groupBy("place", "change").agg(F.sum("share").alias("s"), F.count(F.lit(1)).alias("k"))
        all_ = here.groupBy("change").agg(F.sum("s").alias("ws"), F.sum("k").alias("wk"))
        chance = here.join(all_, "change").select("place", "change", ((F.col("s") + PIECES * F.col("ws") / F.col("wk")) / (F.col("k") + PIECES)).alias("chance"))
        known = shares.select("id", "place", "piece", "swap", F.explode("changes").alias("change")).join(chance, ["place", "change"])
        known = known.groupBy("id", "place", "piece", "swap").agg(F.exp(F.avg(F.log("chance"))).alias("prior"))
        shares = cut_lineage(shares.drop("prior", "w", "share").join(known, ["id", "place", "piece", "swap"], "left").withColumn("prior", F.coalesce("prior", F.lit(PRIOR))))
    return shares.groupBy("id", "place", "piece").agg(F.max_by("reading", F.struct("share", "swap")).alias("reading"), F.sum("share").alias("share"))


def found(df: DataFrame, key: str = "block_uid", source: str = "book_id", text: str = "raw_text") -> DataFrame:
    """Rows (key): records whose text is, wholly or in part, garbled by a wrong decoding."""
    return judged(df, key, source, text).where("share > 0.5").select(F.col("id").alias(key)).distinct()


def restored(df: DataFrame, key: str = "block_uid", source: str = "book_id", text: str = "raw_text") -> DataFrame:
    """Rows (key, raw_text, restored_text, whole): the garbled records with their text as it was meant; ``whole`` tells
    whether nothing lost is left in it."""
    fixes = judged(df, key, source, text).where("share > 0.5").groupBy("id").agg(F.map_from_entries(F.collect_set(F.struct("piece", "reading"))).alias("readings"))
    one = df.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("raw"))
    rows = one.join(fixes, "id").groupBy("id").agg(F.max("raw").alias("raw"), F.first("readings").alias("readings"))

    def run(cols: dict[str, list]) -> dict[str, list]:
        out = []
        for raw, readings in zip(cols["raw"], cols["readings"]):
            how = dict(readings)
            out.append(_PIECE.sub(lambda m: how.get(m[0], m[0]), raw))
        return {key: cols["id"], text: cols["raw"], "restored_text": out, "whole": [_LOST not in o for o in out]}

    return arrow_map(rows, run, f"{key} bigint, {text} string, restored_text string, whole boolean")

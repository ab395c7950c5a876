"""Problem 5: noise in text from scanned pages.

Lines that are nothing but a page number or a running header are told by their form and by the titles of the book and its
chapters. Words divided at line ends are joined. Misread characters are corrected by a noisy channel: each word may stand
for itself or for words that differ from it by known character confusions; probabilities of confusions, learned from the
corpus by expectation-maximization, times likelihoods of neighbouring words decide, by Viterbi over the words of a block.

Counts of words and of pairs of neighbours are exact, over all blocks, and stay distributed: words that confusions may turn
into each other meet by a key that no confusion changes, and blocks get the counts they need by equi-joins (``lookup``).
Nothing that grows with the corpus is broadcast, and no word is too rare, too long or too frequent to be looked at.

Defined results: NULL and empty texts have no noise; pages without a row in the table of pages, or whose flag is NULL,
aren't scanned; a block delivered twice counts once.
"""

from __future__ import annotations

import math
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex as re
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map
from quire.llm.lookup import ask, deal, tell
from quire.llm.visual import folded, shape
from quire.session import cut_lineage, hub

NOISE = ("hyphen", "char", "header", "page_number")
#: What is read for what, as (read, meant).
CONFUSIONS = (
    ("c", "e"), ("o", "a"), ("f", "t"), ("0", "o"), ("ri", "n"), ("1", "l"), ("cl", "d"), ("b", "h"), ("ii", "u"), ("rn", "m"), ("q", "g"),
    ("vv", "w"), ("6", "é"), ("6", "b"), ("ii", "ü"), ("0", "о"), ("н", "и"), ("h", "li"), ("5", "ã"), ("5", "s"), ("8", "в"), ("8", "b"),
    ("m", "rn"), ("c", "ç"), ("b", "ß"), ("6", "б"), ("1", "i"), ("l", "i"), ("i", "l"), ("3", "з"), ("4", "ч"), ("9", "g"),
)
#: A confusion's probability before anything is seen, and how many places it counts as; the rounds of learning.
PRIOR, PLACES, ROUNDS = 0.004, 1000.0, 3
#: How much commoner than a word its meant reading must be, and how many times as often as expected a misreading may come,
#: as the same print is misread again and again.
COMMONER, BURST = 4.0, 8.0

_TOKEN = re.compile(r"[^\W_]+")
_DIVIDED = re.compile(r"(?<=\p{L})[-‐­¬] *\r?\n\s*(?=\p{L})")
_ROMAN = r"(?=[ivxlcdm])m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})"
_NUMBER = rf"(?:\d{{1,4}}|{_ROMAN})"
_PAGE = re.compile(rf"(?i)^[\s\[\](){{}}|·•*~_.,:;<>—–-]*(?:(?:page|pag\.?|p\.?|pp\.?|seite|s\.|página|pág\.?|стр\.?|с\.)\s*)?{_NUMBER}(?:\s*(?:/|of|von|de|sur|из)\s*\d{{1,4}})?[\s\[\](){{}}|·•*~_.,:;<>—–-]*$")
_LEAD = re.compile(rf"(?i)^(?:p\.\s*)?{_NUMBER}(?:\s*[|·•:—–-]\s*|\s+)(?=\S)")
_TAIL = re.compile(rf"(?i)(?:\s*[|·•:—–-]\s*|\s+)(?:p\.\s*)?{_NUMBER}$")
_BETWEEN = re.compile(r"\s+[|·•—–-]\s+|\s*[|·•]\s*|\s{3,}")
_SIGNS = re.compile(r"[\d|·•—–]|\s{3}|\s-\s|(?i:^[ivxlcdm]+\s|\s[ivxlcdm]+$)")
_FRAMED = re.compile(rf"(?i)^(?:{_NUMBER}\s*[|·•]\s*\p{{L}}.{{2,60}}|{_NUMBER}\s{{2,}}\p{{L}}.{{2,60}}|\p{{L}}.{{2,60}}?\s*[|·•]\s*{_NUMBER}|\p{{L}}.{{2,60}}\s{{2,}}{_NUMBER})$")
_CODE = re.compile(r"[{};]\s*$|^\s*(?:def|class|for|while|if|return|int|mov|lea|add|cmp|call|xor|ret|jne|push|pop|@\w+)\b|->|0x[0-9a-f]", re.MULTILINE)


_LEADERS = re.compile(r"\s*\.{2,}\s*\d*$")
_NUMBERED = re.compile(r"^\d+[.)]?\s+(?=\p{L})")


def title_form(text: str) -> str:
    """A title without case, accent storage, surplus blanks, leading number and trailing leaders."""
    t = " ".join(unicodedata.normalize("NFC", text).casefold().split())
    if ".." in t:
        t = _LEADERS.sub("", t)
    if t[:1].isdigit():
        t = _NUMBERED.sub("", t)
    return t.strip(" .:·|-–—")


#: What each character is made of, so that what is read and what is meant are made of the same.
_STROKES = str.maketrans({"i": "x", "l": "x", "1": "x", "u": "xx", "ü": "xx", "h": "xx", "b": "xx", "ß": "xx", "é": "xx", "6": "xx", "8": "xx", "в": "xx", "б": "xx", "n": "rx", "m": "rrx", "w": "vv", "d": "cx", "e": "c", "ç": "c", "a": "o", "0": "o", "о": "o", "t": "f", "q": "g", "9": "g", "5": "s", "ã": "s", "н": "и", "3": "з", "4": "ч"})


def read_form(form: str) -> str:
    """A form that misread characters don't change."""
    return form.translate(_STROKES)


class Titles:
    """Which lines of a block are titles of its book or of a chapter: by keys of 64 bits that were found among the book's."""

    def __init__(self, book: str | None, keys: set[int] | None = None):
        self.book = book or ""
        self.keys = keys if keys is not None else set()

    def key(self, text: str) -> int:
        h = xxhash.xxh64_intdigest(f"{self.book}\0{read_form(title_form(text))}")
        return h - (1 << 64) if h >> 63 else h

    def known(self, text: str) -> bool:
        return bool(self.keys) and self.key(text) in self.keys


class Asked(Titles):
    """Titles that knows none and notes the keys of what it is asked for."""

    def known(self, text: str) -> bool:
        if len(title_form(text)) > 2:
            self.keys.add(self.key(text))
        return False


def title_keys(book: str | None, title: str | None) -> set[int]:
    """Keys of a title with and without its subtitle."""
    t = Titles(book)
    return {t.key(x) for x in ((title or "").split(":")[0], title or "") if len(title_form(x)) > 2}


def is_page_number(line: str) -> bool:
    return len(line) < 40 and bool(_PAGE.match(line)) and bool(re.search(r"[^\W_]", line))


def is_header(line: str, titles: Titles) -> bool:
    """Whether a line is a running header: the book's or a chapter's title, or both, with or without page number."""
    s = line.strip()
    if not 3 <= len(s) <= 120 or s[-1] in ".,;!?":
        return False
    if not _SIGNS.search(s):
        return titles.known(s)  # neither a number nor a mark between two titles
    cores = {s, _LEAD.sub("", s), _TAIL.sub("", s), _LEAD.sub("", _TAIL.sub("", s))}
    if any(titles.known(c) for c in cores):
        return True
    parts = [p for p in _BETWEEN.split(s) if p.strip()]
    if len(parts) > 1 and any(titles.known(p) for p in parts) and all(titles.known(p) or is_page_number(p) or len(p.split()) <= 8 for p in parts):
        return True
    return bool(_FRAMED.match(s))


def is_table(lines: list[str], block_type: str | None) -> bool:
    if block_type == "table":
        return True
    full = [x for x in lines if x.strip()]
    return block_type is None and len(full) > 1 and all(re.search(r"\d\s*$", x) and len(x.split()) <= 6 for x in full)


def is_code(text: str, block_type: str | None) -> bool:
    return block_type == "code" or block_type is None and len(_CODE.findall(text)) >= 2


def sorted_lines(text: str, block_type: str | None, titles: Titles, page_idx: int | None = None, starts: set[str] | None = None) -> list[tuple[str, str]]:
    """Lines of a block with what each is: ``text``, ``header`` or ``page_number``."""
    lines = text.replace("\r\n", "\n").split("\n")
    table, out = is_table(lines, block_type), []
    alone = sum(bool(x.strip()) for x in lines) == 1
    code = is_code(text, block_type)
    for x in lines:
        sort = "text"
        if not table and not code and is_page_number(x):
            sort = "page_number"
        elif block_type != "heading" and x.strip() and is_header(x, titles):
            s = x.strip()
            heading = alone and block_type is None and not s.isupper() and not _FRAMED.match(s) and read_form(title_form(s)) in (starts or ())
            sort = "text" if heading else "header"
        out.append((sort, x))
    return out


# --- words -----------------------------------------------------------------------------------------------------------
_MIXED = re.compile(r"\p{Latin}[\p{Cyrillic}\p{Greek}]|[\p{Cyrillic}\p{Greek}]\p{Latin}")


def joined(text: str) -> str:
    """``text`` with divided words joined, and without what only looks the same."""
    text = _DIVIDED.sub("", text)
    if text.isascii():
        return text
    text = folded(text)
    return shape(text) if _MIXED.search(text) and not re.search(r"\p{Cyrillic}{4}", text) else text


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(joined(text).lower())


_MASK = (1 << 64) - 1
_FIRST, _SECOND = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * np.uint64(_FIRST)) ^ (b * np.uint64(_SECOND)) ^ (b >> np.uint64(7))


def pair_key(a: str, b: str) -> int:
    """A key of 64 bits of two neighbouring words; as :func:`pair_hash`, signed."""
    x, y = xxhash.xxh64_intdigest(a), xxhash.xxh64_intdigest(b)
    h = (x * _FIRST & _MASK) ^ (y * _SECOND & _MASK) ^ (y >> 7)
    return h - (1 << 64) if h >> 63 else h


def corpus_counts(df: DataFrame, text: str) -> DataFrame:
    """Rows (word, pair, n): how often each word and each pair of neighbours (by its key) stands in ``df``."""
    hashes: dict[str, int] = {}

    def count(cols: dict[str, list]) -> dict[str, list]:
        if len(hashes) > 500_000:
            hashes.clear()
        number: dict[str, int] = defaultdict()
        number.default_factory = number.__len__
        seen: list[int] = []
        for t in cols[text]:
            if t:
                seen += [number[w] for w in tokens(t)]
                seen.append(-1)
        at = np.array(seen, np.int64)
        words = list(number)
        own = np.bincount(at[at >= 0], minlength=len(words))
        for w in words:
            if w not in hashes:
                hashes[w] = xxhash.xxh64_intdigest(w)
        h = np.array([hashes[w] for w in words], np.uint64)
        both = (at[:-1] >= 0) & (at[1:] >= 0) if len(at) else np.empty(0, bool)
        pairs, n = np.unique(at[:-1][both] * max(1, len(words)) + at[1:][both], return_counts=True)
        with np.errstate(over="ignore"):
            keys = pair_hash(h[pairs // max(1, len(words))], h[pairs % max(1, len(words))]) if len(pairs) else np.empty(0, np.uint64)
        none = [None] * len(pairs)
        return {"word": words + none, "pair": [None] * len(words) + keys.view(np.int64).tolist(), "n": own.tolist() + n.tolist()}

    return hub(arrow_map(df.select(text), count, "word string, pair bigint, n bigint").groupBy("word", "pair").agg(F.sum("n").alias("n")))


_BY_MEANT: dict[str, list[tuple[int, str, str]]] = {}
for _i, (_read, _meant) in enumerate(CONFUSIONS):
    _BY_MEANT.setdefault(_meant[0], []).append((_i, _read, _meant))


def confused(meant: str, read: str) -> list[int] | None:
    """The fewest confusions (by number in ``CONFUSIONS``) that turn ``meant`` into ``read``; None if none do."""
    n, m = len(meant), len(read)
    best: dict[tuple[int, int], list[int]] = {(0, 0): []}
    for i in range(n):
        # places of one row in order: confusions may only lead on
        for j in sorted(j for x, j in best if x == i):
            done = best[i, j]
            steps = [(1, 1, done)] if j < m and meant[i] == read[j] else []
            steps += [(len(b), len(a), [*done, c]) for c, a, b in _BY_MEANT.get(meant[i], ()) if meant.startswith(b, i) and read.startswith(a, j)]
            for di, dj, path in steps:
                k = (i + di, j + dj)
                if k not in best or len(path) < len(best[k]):
                    best[k] = path
    return best.get((n, m))


def misreadings(counts: DataFrame) -> DataFrame:
    """Rows (word, n, meant, c, how): words of the corpus that a far commoner word, counted ``c`` times, may have been read
    as, by the confusions ``how``. Words meet by the form that confusions don't change."""
    words = counts.where("word is not null and length(word) > 1 and not word rlike '^[0-9]+$'").select("word", "n")
    keyed = arrow_map(words, lambda c: {"form": [xxhash.xxh64_intdigest(read_form(w)) >> 1 for w in c["word"]], "word": c["word"], "n": c["n"]}, "form bigint, word string, n bigint")
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("meant", pa.string()), ("c", pa.int64()), ("how", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(group: list[tuple[str, int]]) -> list[tuple]:
            group.sort(key=lambda x: (-x[1], x[0]))
            out = []
            for i, (w, n) in enumerate(group):
                for v, c in group[:i]:
                    if c <= COMMONER * n:
                        break
                    if not any(x.isdigit() for x in v) and (how := confused(v, w)) is not None:
                        out.append((w, n, v, c, how))
            return out

        form, group = None, []
        for b in batches:
            got: list[tuple] = []
            for f, w, n in zip(*(b.column(c).to_pylist() for c in range(3))):
                if f != form:
                    got += close(group)
                    form, group = f, []
                group.append((w, n))
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got), schema)], schema=schema)
        if got := close(group):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got), schema)], schema=schema)

    return keyed.repartition("form").sortWithinPartitions("form").mapInArrow(run, "word string, n bigint, meant string, c bigint, how array<int>")


def learned(found: DataFrame, counts: DataFrame) -> tuple[DataFrame, float]:
    """(rows (word, n, cands (meant, emit, c), noise), number of words): ``misreadings`` with the logarithm of the
    probability of their confusions, learned by expectation-maximization, and how often the word is to be expected as a
    misreading of its candidates."""
    meant = [b for _, b in CONFUSIONS]
    places = [F.sum(F.col("n") * (F.length("word") - F.length(F.replace("word", F.lit(b), F.lit("")))) / len(b)).alias(f"p{i}") for i, b in enumerate(meant)]
    sums = counts.where("word is not null").agg(F.sum("n").alias("total"), *places).first()
    at = [float(sums[f"p{i}"] or 0.0) for i in range(len(meant))]
    chance = [PRIOR] * len(meant)
    pairs = hub(found)

    def scored(chance: list[float]) -> DataFrame:
        logs = F.array(*[F.lit(math.log(x)) for x in chance])
        emit = F.aggregate("how", F.lit(0.0), lambda s, i: s + F.element_at(logs, i + 1))
        return pairs.withColumn("emit", emit).withColumn("e", F.col("c") * F.exp("emit"))

    for _ in range(ROUNDS):
        s = scored(chance)
        # E: a word that stands no oftener than its candidates are misread is a misreading of theirs
        all_ = s.groupBy("word").agg(F.sum("e").alias("all"))
        own = F.greatest(F.lit(0.5), F.col("n") - F.col("all") - 3 * F.sqrt("all"))
        events = s.join(all_, "word").select(F.explode("how").alias("i"), (F.col("n") * F.col("e") / (F.col("all") + own)).alias("x"))
        seen = {r.i: r.x for r in events.groupBy("i").agg(F.sum("x").alias("x")).collect()}  # a row for each confusion
        chance = [min(0.2, (seen.get(i, 0.0) + PRIOR * PLACES) / (at[i] + PLACES)) for i in range(len(meant))]
    cands = scored(chance).groupBy("word").agg(F.max("n").alias("n"), F.collect_list(F.struct("meant", "emit", "c")).alias("cands"), F.sum("e").alias("noise"))
    return cands, float(sums.total or 0)


class Channel:
    """Reads words through character confusions, by what is known of the words and pairs of a chunk."""

    def __init__(self, total: float = 1e4):
        self.total = max(1e4, total)
        self.cands: dict[str, tuple[float, list[tuple[str, float, int]]]] = {}
        self.counts: dict[str, int] = {}
        self.pairs: dict[int, int] = {}

    def hear(self, r: dict) -> None:
        """Take in an answer: the candidates of a word, or the count of a word or of a pair."""
        if r["_cands"] is not None:
            own = 0.0 if r["_n"] <= BURST * r["_noise"] + 3 * math.sqrt(r["_noise"]) + 3 else float(r["_n"])
            self.cands[r["_word"]] = (own, [(c["meant"], c["emit"], c["c"]) for c in r["_cands"]])
            self.counts[r["_word"]] = r["_n"]
            for c in r["_cands"]:
                self.counts[c["meant"]] = c["c"]
        elif r["_word"] is not None:
            self.counts[r["_word"]] = r["_n"]
        else:
            self.pairs[r["_pair"]] = r["_n"]

    def count(self, w: str) -> float:
        return self.counts.get(w, 0)

    def both(self, a: str, b: str) -> float:
        return self.pairs.get(pair_key(a, b), 0)

    def meant(self, w: str) -> list[tuple[str, float, int]]:
        """Words of the corpus that may have been misread as ``w``: (word, logarithm of the chance, count)."""
        got = self.cands.get(w)
        return got[1] if got else []

    def stretches(self, seen: list[str]) -> list[tuple[int, int]]:
        """Where words with other readings stand, each with a neighbour on both sides. A word without other readings leaves
        Viterbi no choice, so paths are only searched between such words."""
        open_ = [i for i, w in enumerate(seen) if w in self.cands]
        out, i = [], 0
        while i < len(open_):
            j = i
            while j + 1 < len(open_) and open_[j + 1] == open_[j] + 1:
                j += 1
            out.append((max(0, open_[i] - 1), min(len(seen), open_[j] + 2)))
            i = j + 1
        return out

    def needs(self, seen: list[str]) -> tuple[set[str], set[int]]:
        """The words and pairs whose counts decide how ``seen`` is read."""
        words: set[str] = set()
        pairs: set[int] = set()
        for lo, hi in self.stretches(seen):
            before: list[str] = []
            for w in seen[lo:hi]:
                if w not in self.cands:
                    words.add(w)
                now = [w, *(v for v, _, _ in self.meant(w))]
                pairs.update(pair_key(a, b) for a in before for b in now)
                before = now
        return words, pairs

    def read(self, seen: list[str]) -> list[str]:
        """The likeliest meant words for the words of a text."""
        out = list(seen)
        for lo, hi in self.stretches(seen):
            out[lo:hi] = self._viterbi(seen[lo:hi])
        return out

    def _viterbi(self, seen: list[str]) -> list[str]:
        score, back, states = [0.0], [], []
        for i, w in enumerate(seen):
            own, cands = self.cands.get(w, (self.count(w), []))
            now = [(w, math.log(0.96), False, max(0.0, own - 1))] + [(v, emit, True, c) for v, emit, c in cands]
            new, arg = [], []
            for v, emit, other, u in now:
                floor = 0.3 * u / self.total + 0.02 / self.total
                best, who = -1e18, 0
                if i == 0:
                    best = math.log(floor)
                for j, (p, _, p_other, pu) in enumerate(states[-1] if i else ()):
                    b = self.both(p, v) if u else 0.0
                    if not other and not p_other:
                        b = max(0.0, b - 1)
                    s = score[j] + math.log(0.7 * b / max(1.0, pu, b) + floor)
                    if s > best:
                        best, who = s, j
                new.append(best + emit)
                arg.append(who)
            score = new
            back.append(arg)
            states.append(now)
        j = max(range(len(score)), key=lambda x: score[x])
        out = []
        for i in range(len(states) - 1, -1, -1):
            out.append(states[i][j][0])
            j = back[i][j]
        return out[::-1]


def misread(seen: list[str], channel: Channel) -> list[tuple[str, str]]:
    """(seen, meant) for the misread words of a text."""
    return [(a, b) for a, b in zip(seen, channel.read(seen)) if a != b]


_OWN_HYPHEN = re.compile(r"(\p{L}+)([-‐\xad¬]) *\r?\n\s*(\p{L}+)")


def looked_at(text: str | None, block_type: str | None, titles: Titles, starts: set[str] | None = None) -> tuple[list[str], str, str, bool]:
    """(sorts of noise that lines show, running text, headers, whether the text is code or a table) of a block."""
    if not text or not text.strip():
        return [], text or "", "", True
    lines = sorted_lines(text, block_type, titles, starts=starts)
    out = {k for k, _ in lines if k != "text"}
    rest = "\n".join(x for k, x in lines if k == "text")
    headers = "\n".join(x for k, x in lines if k == "header")
    if is_code(rest, block_type):
        return sorted(out), rest, "", True
    if _DIVIDED.search(rest) or re.search(r"\p{L}{2}[-‐\xad¬]\s*$", rest):
        out.add("hyphen")
    return sorted(out), rest, headers, False


def halves(rest: str) -> set[str]:
    """Words and their halves where ``rest`` divides them at line ends."""
    return {x.lower() for m in _OWN_HYPHEN.finditer(rest) for x in (m[1], m[3], m[1] + m[3])}


def cleaned(rest: str, block_type: str | None, channel: Channel) -> str:
    """Continuous readable text of the running text of a block: words joined and corrected; tables keep their lines."""
    if is_table(rest.split("\n"), block_type):
        return rest

    # a hyphen of the word's own stays where the joined word is far rarer than its halves
    def join(m: re.Match) -> str:
        a, b = m[1], m[3]
        whole, least = channel.count((a + b).lower()), min(channel.count(a.lower()), channel.count(b.lower()))
        return f"{a}-{b}" if 20 * max(1, whole) < least and "\xad" not in m[2] else a + b

    rest = _OWN_HYPHEN.sub(join, rest)
    words = [m for m in _TOKEN.finditer(rest)]
    meant = channel.read([m[0].lower() for m in words])
    parts, at = [], 0
    for m, v in zip(words, meant):
        if m[0].lower() != v:
            v = v.upper() if m[0].isupper() and len(m[0]) > 1 else v.capitalize() if m[0][:1].isupper() else v
            parts += [rest[at : m.start()], v]
            at = m.end()
    rest = "".join(parts) + rest[at:]
    return re.sub(r"[ \t]*\r?\n[ \t]*(?![-*•\d])", " ", rest).strip()


def spoken(row: dict) -> list[list[str]]:
    """The words of the running text and of the headers of a block that are read through the channel."""
    return [t.split(" ") for t in (row["words"], row["headers"]) if t]


# --- over tables -----------------------------------------------------------------------------------------------------
def titles_of(blocks: DataFrame, books: DataFrame, toc: DataFrame) -> DataFrame:
    """Distinct keys of the titles that running headers may show: of books, of chapters in tables of contents, of headings."""
    headings = blocks.where((F.col("block_type") == "heading") & (F.length("raw_text") < 90) & ~F.col("raw_text").contains("\n")).select("book_id", F.col("raw_text").alias("title"))
    named = books.select("book_id", "title").unionByName(toc.select("book_id", "title")).unionByName(headings).where("title is not null and book_id is not null")

    def keys(cols: dict[str, list]) -> dict[str, list]:
        return {"key": sorted({k for b, t in zip(cols["book_id"], cols["title"]) for k in title_keys(b, t)})}

    return arrow_map(named, keys, "key bigint").distinct()


def scanned_blocks(blocks: DataFrame, pages: DataFrame, books: DataFrame, toc: DataFrame) -> DataFrame:
    """Rows (id, raw, block_type, book_id, starts, known) of the blocks on scanned pages: the chapters that start on their
    page, and the keys of those of their lines that are titles of their book.

    Lines meet titles by an equi-join on keys, so a book with many pages and many chapters doesn't multiply them.
    """
    scanned = pages.where("is_scanned").select("book_id", "page_idx").distinct()
    starts = toc.where("title is not null and page_idx is not null").groupBy("book_id", "page_idx").agg(F.collect_set("title").alias("starts"))
    own = blocks.where(F.col("block_uid").isNotNull() & F.col("raw_text").isNotNull()).select(F.col("block_uid").cast("bigint").alias("id"), "book_id", "page_idx", F.col("raw_text").alias("raw"), "block_type")
    rows = own.join(scanned, ["book_id", "page_idx"]).join(starts, ["book_id", "page_idx"], "left").select("id", "raw", "block_type", "book_id", "starts")

    def ask(cols: dict[str, list]) -> dict[str, list]:
        asked = []
        for raw, kind, book in zip(cols["raw"], cols["block_type"], cols["book_id"]):
            t = Asked(book)
            sorted_lines(raw, kind, t)
            asked.append(sorted(t.keys))
        return cols | {"asked": asked}

    rows = hub(arrow_map(rows, ask, "id bigint, raw string, block_type string, book_id string, starts array<string>, asked array<bigint>"))
    hits = rows.select("id", F.explode("asked").alias("key")).join(titles_of(blocks, books, toc), "key").groupBy("id").agg(F.collect_set("key").alias("known"))
    return rows.drop("asked").join(hits, "id", "left")


def _lines(blocks: DataFrame, pages: DataFrame, books: DataFrame, toc: DataFrame) -> DataFrame:
    """Rows (id, block_type, sorts, rest, words, headers, fixed, chunk): what the lines of the blocks on scanned pages show,
    with the words of running text and of headers, a blank between them."""

    def look(cols: dict[str, list]) -> dict[str, list]:
        out = []
        for raw, kind, book, st, known in zip(*(cols[c] for c in ("raw", "block_type", "book_id", "starts", "known"))):
            sorts, rest, headers, fixed = looked_at(raw, kind, Titles(book, set(known or ())), {read_form(title_form(x)) for x in st or ()})
            out.append((sorts, rest, "" if fixed else " ".join(tokens(rest)), " ".join(tokens(headers)) if headers else "", fixed))
        return {"id": cols["id"], "block_type": cols["block_type"], **{n: [o[i] for o in out] for i, n in enumerate(("sorts", "rest", "words", "headers", "fixed"))}}

    rows = arrow_map(scanned_blocks(blocks, pages, books, toc).select("id", "raw", "block_type", "book_id", "starts", "known"), look, "id bigint, block_type string, sorts array<string>, rest string, words string, headers string, fixed boolean")
    # of all blocks: more than those on scanned pages have, for which they would have to be looked at twice
    return deal(rows, "id", blocks.agg(F.sum(F.length("raw_text"))).first()[0] or 0)


def _read(lines: DataFrame, blocks: DataFrame, fn, more, schema: str) -> DataFrame:
    """What ``fn`` makes of each block and a channel that knows all it needs; ``more`` are further words to count."""
    counts = corpus_counts(blocks, "raw_text")
    cands, total = learned(misreadings(counts), counts)
    words = ask(lines, lambda r: {w for t in spoken(r) for w in t}, "word string")
    null = lambda t: F.lit(None).cast(t)
    known = cut_lineage(words.join(cands, "word").select("chunk", "word", null("bigint").alias("pair"), "n", "cands", "noise"))

    def needs(channel: Channel, r: dict) -> Iterator[tuple]:
        asked: set[str] = set(more(r))
        for t in spoken(r):
            w, p = channel.needs(t)
            asked |= w
            yield from ((r["chunk"], None, x) for x in p)
        yield from ((r["chunk"], x, None) for x in asked)

    wanted = tell(lines, known, Channel.hear, lambda: Channel(total), needs, "chunk int, word string, pair bigint").distinct()
    as_answer = lambda df: df.select("chunk", "word", "pair", "n", null(known.schema["cands"].dataType).alias("cands"), null("double").alias("noise"))
    by_word = as_answer(wanted.where("word is not null").drop("pair").join(counts.where("word is not null").select("word", "n"), "word").withColumn("pair", null("bigint")))
    by_pair = as_answer(wanted.where("pair is not null").drop("word").join(counts.where("pair is not null").select("pair", "n"), "pair").withColumn("word", null("string")))
    return tell(lines, known.unionByName(by_word).unionByName(by_pair), Channel.hear, lambda: Channel(total), fn, schema)


def found(blocks: DataFrame, pages: DataFrame, books: DataFrame, toc: DataFrame) -> DataFrame:
    """Rows (block_uid, noise): one for each sort of noise of a block on a scanned page."""

    def sorts(channel: Channel, r: dict) -> Iterator[tuple]:
        for n in r["sorts"]:
            yield r["id"], n
        if any(misread(t, channel) for t in spoken(r)):
            yield r["id"], "char"

    return _read(_lines(blocks, pages, books, toc).drop("rest"), blocks, sorts, lambda r: (), "block_uid bigint, noise string").distinct()


def repaired(blocks: DataFrame, pages: DataFrame, books: DataFrame, toc: DataFrame) -> DataFrame:
    """Rows (block_uid, clean_text): continuous readable text of the blocks on scanned pages; empty where nothing but noise was."""

    def repair(channel: Channel, r: dict) -> Iterator[tuple]:
        yield r["id"], r["rest"] if r["fixed"] else cleaned(r["rest"], r["block_type"], channel)

    return _read(_lines(blocks, pages, books, toc), blocks, repair, lambda r: () if r["fixed"] else halves(r["rest"]), "block_uid bigint, clean_text string").groupBy("block_uid").agg(F.max("clean_text").alias("clean_text"))

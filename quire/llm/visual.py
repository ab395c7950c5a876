"""Problem 7: visually identical text with different characters.

A trie holds the vocabulary of the corpus. Words of a text walk it as they stand, by a weighted edit automaton: look-alike
letters, width forms and the storage of accents cost nothing, characters that show nothing are passed over at no cost, and
any other edit costs 1, which is more than the budget. A word that reaches an entry gets its canonical spelling: the most
frequent one that is written in one script. Words that the trie doesn't hold are spelled by a table of shapes, in the script
of their unmistakable letters. The forms so found decide which texts look the same.

The vocabulary holds words from a share of ``LEAST_SHARE`` of all counted words, so it is bounded and doesn't change with
the size of the corpus; it decides how a word is spelled, never whether two words are spelled alike.

Defined results: NULL stays NULL; an empty text or one of nothing but ignorables gives an empty text.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex as re
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map
from quire.session import cut_lineage

#: Letters of other scripts that have the shape of a Latin letter.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХҮԌԚԜаеѕіјорсухүһԁԛԝ", "ABESIJKMHOPCTYXYGQWaesijopcyxyhdqw"))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳοορνϲ", "ABEZHIKMNOPTYXCjoopvc"))
CHEROKEE = dict(zip("ᎪᏴᏟᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ", "ABCEGHJKLMPRSTVWZ"))
LISU = dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"))
ARMENIAN = dict(zip("օսհոցՏՕ", "ouhngSO"))
LOOK_ALIKES = CYRILLIC | GREEK | CHEROKEE | LISU | ARMENIAN | {"ɡ": "g", "ɑ": "a", "ⅼ": "l", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m", "ⅰ": "i", "ⅴ": "v", "ⅹ": "x"}
_TO_CYRILLIC = {v: k for k, v in reversed(list(CYRILLIC.items()))}
_TO_GREEK = {v: k for k, v in reversed(list(GREEK.items()))}

#: Ranges of characters that show nothing.
_NOTHING = ((0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xE0020, 0xE007F), (0xE0100, 0xE01EF))


def _table() -> dict[int, str | None]:
    """Width forms to plain ones, blanks to a blank, and nothing for characters that show nothing."""
    out: dict[int, str | None] = {c: unicodedata.normalize("NFKC", chr(c)) for c in range(0xFF00, 0xFFF0)}
    out |= {c: " " for c in range(0x3001) if unicodedata.category(chr(c)) == "Zs" or c == 9}
    out |= {c: None for lo, hi in _NOTHING for c in range(lo, hi + 1)}
    return out


_FOLDED = _table()
_WORD = re.compile(r"[\p{L}\p{M}]+")
#: A word of a text as it stands: with what shows nothing, and with numerals that have the shape of letters.
_AS_IT_STANDS = re.compile(r"[\p{L}\p{M}" + "".join(map(chr, (c for lo, hi in _NOTHING for c in range(lo, hi + 1)))) + "".join(c for c in LOOK_ALIKES if unicodedata.category(c) == "Nl") + r"]+")
_ASCII_WORD = re.compile(r"[A-Za-z]+")
#: Words of letters that other scripts share; any other letter rules out a rival spelling.
_SHARED_WORD = re.compile(r"(?<![A-Za-z])[ABCEGHIJKMOPQSTWXYacdeghijlmopqsvwxy]{2,}(?![A-Za-z])")
#: The vocabulary keeps words that are not plain ASCII or that a look-alike could stand for, from this share of them all.
LEAST_SHARE = 2e-6
#: What an edit costs that is seen, and what a walk may cost.
SEEN, BUDGET = 1.0, 0.0

_shape = str.maketrans(LOOK_ALIKES)


def folded(text: str) -> str:
    """``text`` without width, sort of blank, ignorables and accent storage; letters keep their script."""
    return unicodedata.normalize("NFC", text.translate(_FOLDED))


def shape(text: str) -> str:
    """The shape of ``text``: equal for texts that look the same."""
    if text.isascii():
        return text.replace("\t", " ")
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", text.translate(_FOLDED)).translate(_shape))


def one_script(word: str) -> bool:
    """Whether all letters of ``word`` are of one script."""
    base = unicodedata.normalize("NFD", word)
    return sum(bool(re.search(p, base)) for p in (r"\p{Latin}", r"\p{Cyrillic}", r"\p{Greek}")) <= 1


def steps(c: str) -> str:
    """The shapes that a character of a text steps along in the trie; none if it shows nothing."""
    to = _FOLDED.get(ord(c), c)
    return unicodedata.normalize("NFD", to).translate(_shape) if to else ""


class Trie:
    """Canonical spellings. Nodes are dictionaries by character shape, accents apart; None holds a spelling and its count."""

    def __init__(self) -> None:
        self.root: dict = {}
        #: plain ASCII words whose canonical spelling is in another script
        self.rivals: set[str] = set()
        self._known: dict[str, str] = {}
        self._steps: dict[str, str] = {}

    def add(self, word: str, count: int) -> None:
        node, look = self.root, shape(word)
        for c in unicodedata.normalize("NFD", look):
            node = node.setdefault(c, {})
        if None not in node or (count, word) > (node[None][1], node[None][0]):
            node[None] = (word, count)
            if look.isascii():
                (self.rivals.discard if word == look else self.rivals.add)(look)

    def match(self, word: str, budget: float = BUDGET) -> tuple[str, float] | None:
        """The entry that ``word`` reaches at the least cost within ``budget``, with that cost.

        States are nodes with their least cost so far. A character steps along its shape, or is passed over, at no cost if
        it shows nothing; to step elsewhere, to pass over what shows or to put in a character costs ``SEEN``.
        """
        states: dict[int, tuple[float, dict]] = {id(self.root): (0.0, self.root)}

        def reach(into: dict, node: dict, cost: float) -> None:
            if cost <= budget and (id(node) not in into or cost < into[id(node)][0]):
                into[id(node)] = (cost, node)
                if cost + SEEN <= budget:  # put in a character
                    for c, below in node.items():
                        if c is not None:
                            reach(into, below, cost + SEEN)

        if budget >= SEEN:
            start, states = states, {}
            for cost, node in start.values():
                reach(states, node, cost)
        for c in unicodedata.normalize("NFD", word):
            to = self._steps.get(c)
            if to is None:
                to = self._steps[c] = steps(c)
            for x in to:
                after: dict[int, tuple[float, dict]] = {}
                for cost, node in states.values():
                    if (below := node.get(x)) is not None:
                        reach(after, below, cost)
                    if cost + SEEN <= budget:
                        reach(after, node, cost + SEEN)  # pass over what shows
                        for other, below in node.items():
                            if other is not None and other != x:
                                reach(after, below, cost + SEEN)
                states = after
                if not states:
                    return None
        ends = [(cost, node[None][0]) for cost, node in states.values() if None in node]
        return min(ends)[::-1] if ends else None

    def spelled(self, word: str) -> str:
        """The canonical spelling of a word as it stands: the trie's, or else the table's. Remembered up to a bound."""
        got = self._known.get(word)
        if got is None:
            if len(self._known) > 300_000:
                self._known.clear()
            # accents that something invisible keeps apart only come into order in the shape
            hit = self.match(word) or self.match(shape(word))
            got = self._known[word] = hit[0] if hit else by_table(word)
        return got


def by_table(word: str) -> str:
    """The spelling of a word of this shape in the script of its unmistakable letters, Latin if there are none."""
    base = unicodedata.normalize("NFD", shape(word))
    if re.search(r"\p{Cyrillic}", base):
        base = "".join(_TO_CYRILLIC.get(c, c) for c in base)
    elif re.search(r"\p{Greek}", base):
        base = "".join(_TO_GREEK.get(c, c) for c in base)
    return unicodedata.normalize("NFC", base)


def canonical(text: str | None, trie: Trie) -> str | None:
    """The one consistent form of ``text``; equal for texts that look the same."""
    if text is None:
        return None
    if text.isascii() and (not trie.rivals or trie.rivals.isdisjoint(_ASCII_WORD.findall(text))):
        return text.replace("\t", " ")
    parts, at = [], 0
    for m in _AS_IT_STANDS.finditer(text):
        if m.start() > at:
            parts.append(shape(text[at : m.start()]))
        parts.append(trie.spelled(m[0]))
        at = m.end()
    parts.append(shape(text[at:]))
    return unicodedata.normalize("NFC", "".join(parts))


def vocabulary(df: DataFrame, text: str) -> Trie:
    """Spellings in one script of words that are not plain ASCII, or that are made of shared letters only, with counts over
    all rows; at most 1 / ``LEAST_SHARE`` of them can reach the driver."""

    def count(cols: dict[str, list]) -> dict[str, list]:
        c: dict[str, int] = {}
        for t in cols[text]:
            if not t:
                continue
            if t.isascii():
                for w in _SHARED_WORD.findall(t):
                    c[w] = c.get(w, 0) + 1
                continue
            for w in _WORD.findall(folded(t)):
                if len(w) > 1 and (not w.isascii() or _SHARED_WORD.fullmatch(w)):
                    c[w] = c.get(w, 0) + 1
        return {"word": list(c), "n": list(c.values())}

    counted = cut_lineage(arrow_map(df.select(text), count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    total = counted.agg(F.sum("n")).first()[0] or 0
    trie = Trie()
    for r in counted.where(F.col("n") >= max(2.0, LEAST_SHARE * total)).collect():
        if one_script(r.word):
            trie.add(r.word, r.n)
    return trie


def normalized(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, normalized_text): the consistent form of every text."""
    b = df.sparkSession.sparkContext.broadcast(vocabulary(df, text))

    def run(cols: dict[str, list]) -> dict[str, list]:
        return {key: cols[key], "normalized_text": [canonical(t, b.value) for t in cols[text]]}

    return arrow_map(df.select(F.col(key).cast("bigint"), text), run, f"{key} bigint, normalized_text string")


def looks(df: DataFrame, key: str, within: str, text: str) -> DataFrame:
    """Distinct rows (id, place, look, own) of the records whose consistent form another string of their ``within`` has too:
    hashes of 128 bits of that form and of the text."""
    b = df.sparkSession.sparkContext.broadcast(vocabulary(df, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = b.value
        digest = lambda t: hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        schema = pa.schema([("id", pa.int64()), ("place", pa.string()), ("look", pa.binary()), ("own", pa.binary())])
        for batch in batches:
            forms, owns = [], []
            for t in batch.column(2).to_pylist():
                own = digest(t)
                form = canonical(t, trie)
                owns.append(own)
                forms.append(own if form == t else digest(form))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(forms, pa.binary()), pa.array(owns, pa.binary())], schema=schema)

    rows = df.where(F.col(key).isNotNull() & F.col(within).isNotNull() & (F.length(text) > 0)).select(F.col(key).cast("bigint"), F.col(within).cast("string"), text)
    all_ = cut_lineage(rows.mapInArrow(run, "id bigint, place string, look binary, own binary"))
    # classes: (place, look) with more than one string
    many = all_.groupBy("place", "look").agg(F.min("own").alias("lo"), F.max("own").alias("hi")).where("lo <> hi").select("place", "look")
    return cut_lineage(all_.join(many, ["place", "look"]).distinct())


def groups(df: DataFrame, key: str, within: str, text: str) -> DataFrame:
    """Rows (id, group_id, variants): each record that looks like another string of its ``within``, the smallest id of those
    that look so, and how many different strings they are. Copies are not expanded into pairs."""
    members = looks(df, key, within, text)
    classes = members.groupBy("place", "look").agg(F.min("id").alias("group_id"), F.count_distinct("own").alias("variants"))
    return members.join(classes, ["place", "look"]).select("id", "group_id", "variants").distinct()


def pairs(df: DataFrame, key: str, within: str, text: str) -> DataFrame:
    """Rows (a, b), a < b: different records of one ``within`` whose texts look the same but aren't the same string.

    Only hashes of 128 bits cross the network. Equal strings are one class, pairs are formed between classes and then
    expanded, so no pair is made that isn't in the result. NULL and empty texts, NULL keys and a NULL ``within`` are in no
    pair; a record delivered twice counts once.
    """
    members = looks(df, key, within, text)
    classes = members.select("place", "look", "own").distinct()
    rivals = classes.alias("x").join(classes.alias("y"), ["place", "look"]).where("x.own < y.own").select("place", F.col("x.own").alias("own"), F.col("y.own").alias("other"))
    one = rivals.join(members.select("place", "own", F.col("id").alias("p")), ["place", "own"])
    both = one.join(members.select("place", F.col("own").alias("other"), F.col("id").alias("q")), ["place", "other"])
    return both.where("p <> q").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()

import itertools
import random
import unicodedata

from quire.llm import visual as V

SCHEMA = "block_uid bigint, book_id string, raw_text string, place string, look string, own string"


def wide(t):
    return "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in t)


def test_shapes():
    base = "Der schöne café, item 5."
    same = [wide(base), unicodedata.normalize("NFD", base), base.replace(" ", " "), base.replace("c", "с​"), base.replace("o", "ο").replace("D", "D­")]
    assert {V.shape(x) for x in same} == {base}
    assert all(V.shape(x) != base for x in ("Der schone cafe, item 5.", base.lower(), base.replace("5", "6"), base.replace(",", "")))
    assert V.shape("x²") != V.shape("x2")


def test_trie_chooses_the_commoner_spelling():
    t = V.Trie()
    t.add("сор", 3)
    t.add("cop", 9)
    t.add("мост", 5)
    assert V.canonical("сор", t) == V.canonical("cop", t) == "cop"
    assert V.canonical("моcт", t) == "мост"
    assert V.canonical("нoвый", t) == "новый"  # by the table
    assert V.canonical(None, t) is None and V.canonical("", t) == ""


def test_walks_unshaped_words_at_no_cost():
    t = V.Trie()
    for w in ("schöne", "мост", "house", "co"):
        t.add(w, 5)
    for w in ("scho\u0308ne", wide("sch") + "ö\u200bne", "ѕсһӧnе".replace("ӧ", "ö"), "s\u00adchöne"):
        assert t.match(w) == ("schöne", 0.0), w
    assert t.match("моcт") == ("мост", 0.0) and t.match("schone") is None and t.match("hous") is None
    # edits that are seen have their price
    assert t.match("schone", 1.0) == ("schöne", 1.0) and t.match("hous", 1.0) == ("house", 1.0) and t.match("hxuses", 2.0) == ("house", 2.0) and t.match("hxuses", 1.0) is None


def test_forms_are_equal_exactly_for_equal_shapes():
    rnd = random.Random(8)
    t = V.Trie()
    for w, n in (("cop", 3), ("сор", 5), ("ⅼeg", 4), ("schön", 2), ("ресор", 9)):
        t.add(w, n)
    alphabet = "cсopорleⅼgschöo\u0308\u200b\u0301= \u00a0\u0338≠ＡA１1\uffa0\u0323aа"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 5))) for _ in range(4000)]
    forms: dict = {}
    for x in texts:
        forms.setdefault(V.shape(x), set()).add(V.canonical(x, t))
    assert all(len(v) == 1 for v in forms.values())
    assert len({f for v in forms.values() for f in v}) == len(forms)


def test_pairs_against_brute_force(spark):
    rnd = random.Random(11)
    words = ["house", "schöne", "мост", "cop", "сор", "café"]
    make = lambda: " ".join(rnd.choice(words) for _ in range(2))
    change = [lambda t: t, wide, lambda t: unicodedata.normalize("NFD", t), lambda t: t.replace("o", "о"), lambda t: t.replace(" ", " "), lambda t: t + "​"]
    rows = [(i, rnd.choice(["a", "b"]), rnd.choice(change)(make()), "p", "l", "o") for i in range(150)] + [(900, None, "x", "", "", ""), (901, "a", None, "", "", ""), (902, "a", "", "", "", ""), (None, "a", "house", "", "", ""), (3, "a", "zz", "", "", "")]
    rows[3] = (3, "a", "zz", "p", "l", "o")
    got = {(r.a, r.b) for r in V.pairs(spark.createDataFrame(rows, SCHEMA), "block_uid", "book_id", "raw_text").collect()}
    own = {r[0]: r for r in rows if r[0] is not None and r[1] and r[2]}
    want = {(a, b) for a, b in itertools.combinations(sorted(own), 2) if own[a][1] == own[b][1] and own[a][2] != own[b][2] and V.shape(own[a][2]) == V.shape(own[b][2])}
    assert got == want
    groups = {r.id: (r.group_id, r.variants) for r in V.groups(spark.createDataFrame(rows, SCHEMA), "block_uid", "book_id", "raw_text").collect()}
    assert set(groups) == {x for p in want for x in p} and all(groups[a] == groups[b] and groups[a][0] <= a for a, b in want)
    assert V.pairs(spark.createDataFrame([], SCHEMA), "block_uid", "book_id", "raw_text").count() == 0

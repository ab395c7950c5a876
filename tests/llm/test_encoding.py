import random

from collections import Counter

from quire.llm import encoding as E

SCHEMA = "block_uid bigint, book_id string, raw_text string, piece string, swap string, id string"
CLEAN = ["La crème épaisse protège la forêt gelée.", "Größe und Maß, Öl und Wärme.", "El pájaro encontró la canción.", "It’s said that “the quarry” is closed – see §4.", "Старый мост меняет горячий хлеб.", "Temperature 12 °C, ±2 and x² or y½.", "A brand like Korvex™ is kept…"]


def garble(text, read, written="utf-8"):
    # bytes that a code page leaves undefined stand for the control character of their number
    return "".join(E._CHARS[read].get(b, chr(b)) if b > 127 else chr(b) for b in text.encode(written, "replace"))


def test_unravelling_round_trip():
    for text in CLEAN:
        for page in ("cp1252", "mac_roman", "cp437"):
            bad = garble(text, page)
            for piece, own in zip(bad.split(" "), text.split(" ")):
                if not own.isascii() and bad.count(" ") == text.count(" ") and len(piece) > 1:
                    assert E.unravel(piece) is not None


def test_found_and_restored(spark):
    rnd = random.Random(5)
    rows = [(i, f"b{i % 7}", " ".join(rnd.choice(CLEAN) for _ in range(3)), None, None, None) for i in range(400)]
    bad = {1000: garble(CLEAN[0], "cp1252"), 1001: garble(CLEAN[1], "mac_roman"), 1002: garble(garble(CLEAN[2], "cp1252"), "cp1252"), 1003: CLEAN[4] + " " + garble(CLEAN[4], "cp1251", "koi8_r"), 1004: garble(CLEAN[4], "cp1252", "cp1251"), 1005: garble(CLEAN[0], "cp850", "cp1252"), 1006: "La cr�me épaisse protège la for�t."}
    rows += [(u, "b1", t, None, None, None) for u, t in bad.items()] + [(2000, None, None, None, None, None), (2001, "b1", "", None, None, None), (2002, "b1", "plain ascii " * 20_000, None, None, None), (None, "b1", bad[1000], None, None, None), (1000, "b1", bad[1000], None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.block_uid for r in E.found(df).collect()) == sorted(bad)
    fixed = {r.block_uid: r.restored_text for r in E.restored(df).collect()}
    assert set(fixed) == set(bad)
    assert fixed[1000] == CLEAN[0] and fixed[1002] == CLEAN[2] and fixed[1004] == CLEAN[4] and fixed[1003] == f"{CLEAN[4]} {CLEAN[4]}"
    assert fixed[1006].startswith("La crème")


def reader(texts, times):
    """A reader of a corpus of ``texts``, each repeated ``times`` times."""
    counts = Counter(u for t in texts for p in E.pieces_of(t) for u in E.units(p))
    return E.Reader({u: n * times for u, n in counts.items() if u[0] == "\0"}, {u: n * times for u, n in counts.items() if u[0] != "\0"})


def test_readings_whatever_the_size_of_the_corpus():
    bad = {"cp1252>cp1251": garble("хлеб", "cp1252", "cp1251"), "cp850>cp1252": garble("épaisse", "cp850", "cp1252"), "utf-8": garble("“Þórz", "cp1252")}
    texts = CLEAN * 200 + [*bad.values()] * 2
    for times in (1, 100, 1000, 100_000):
        r = reader(texts, times)
        for swap, piece in bad.items():
            assert swap in [s for s, _, _ in r.readings(piece)], (swap, times)
        assert not any(r.readings(p) for t in CLEAN for p in E.pieces_of(t))


def test_found_in_rows_repeated_a_thousand_times(spark):
    bad = {50: garble(CLEAN[4], "cp1252", "cp1251"), 51: garble(CLEAN[0], "cp850", "cp1252"), 52: "A note " + garble("“Þórz", "cp1252")}
    rows = [(i, "b1", CLEAN[i % 7]) for i in range(50) for _ in range(7)] + [(u, "b1", t) for u, t in bad.items()]
    df = spark.createDataFrame(rows, "block_uid bigint, book_id string, raw_text string")
    many = df.crossJoin(spark.range(1000)).selectExpr("block_uid * 1000 + id AS block_uid", "book_id", "raw_text")
    got = E.found(many).selectExpr("block_uid div 1000 AS u").groupBy("u").count().collect()
    assert {r.u: r["count"] for r in got} == {u: 1000 for u in bad}


def test_readings_beyond_the_usual_letters():
    texts = (CLEAN + ["раз", "Việt Nam", "тёплый хлеб"]) * 40
    r = reader(texts, 1)
    for text in ("Việt", "раз", "😀", "Tiếng"):
        bad = garble(text, "cp1252")
        assert [(s, t) for s, t, _ in r.readings(bad)] == [("utf-8", text)]
    assert not any(r.readings(p) for t in (*texts, "Fuß\xadball", "caffè”…", "esteja\xa0à", "аѕ\xa0the", "спиThe") for p in E.pieces_of(t))
    for lost, text in (("х�еб", "хлеб"), ("т�п�ый", "тёплый"), ("Vi�t", "Việt"), ("cr�me", "crème"), ("т��л��", "тёплый")):
        assert [t for _, t, _ in r.readings(lost)] == [text]


def test_empty(spark):
    assert E.found(spark.createDataFrame([], SCHEMA)).count() == 0

import pytest

from quire.llm import pii as I

GIVEN = {I.fold(x) for x in ("Alice", "Jörg", "Rose", "Mark", "Will", "Amber", "Frank")}


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("Write to a.b+c@mail.example.org now", {"email"}), ("x_y [at] post (dot) example", {"email"}), ("will+n AT club DOT test", {"email"}), ("a＠b.test", {"email"}), ("Install reader@2.8.45 first", set()), ("dev@builder:~$ waits", set()), ("Add @cached above", set()),
        ("Tel. +44 (0)1632 960 909", {"phone"}), ("Please call 555-0163 today", {"phone"}), ("ring (212) 555-0140", {"phone"}), ("Llame al 000 55 08 38", {"phone"}), ("On peut appeler le 01.99.00.09.05.", {"phone"}), ("ISBN 978-0-00-445774-9", set()), ("rose from 4 120 000 to 5 310 400", set()), ("host 192.0.2.60", set()), ("Order code 4400-1322-80", set()), ("pages 101-117 and 230-245", set()),
        ("passport no. X27137862", {"id_number"}), ("SSN: 000-95-8982", {"id_number"}), ("CPF 000.613.601-45", {"id_number"}), ("DNI 00913157-F", {"id_number"}), ("паспорт 00 00 884811", {"id_number"}), ("identity card QZ 733 475 and", {"id_number"}), ("(Steuer-ID 00 964 331 383)", {"id_number"}),
        ("lives at Flat 3, 26 Quince Road", {"address"}), ("Anschrift: Weidendamm 48a", {"address"}), ("wohnt Am Alten Speicher 127 b, 00499 Velbury", {"address"}), ("104 bis bd. de la Digue", {"address"}), ("Calle del Olmo, 137", {"address"}), ("Rua das Oliveiras, 57", {"address"}), ("ул. Садовая, д. 80", {"address"}), ("im Frühjahr 4 Stück", set()), ("den Rückweg 12 Minuten", set()),
        ("Alice Quilby", {"name"}), ("ALICE QUILBY", {"name"}), ("QUILBY, Alice", {"name"}), ("thanks Sefton Quilby for", {"name"}), ("Mrs Quilby came", {"name"}), ("Herr Pellen", {"name"}), ("Will Amber survive? Mark the rose.", set()), ("Frank Quil & Sons", set()), ("Alice Quilby Works", set()), ("The Olvenby Institute", set()),
        ("", set()), (None, set()), ("  \n", set()),
    ],
)
def test_kinds(text, kinds):
    assert {k for _, _, k in I.spans(text, GIVEN)} == kinds


def test_validators():
    assert I.luhn("79927398713") and not I.luhn("79927398710")
    assert I.mod97("2550814168025", "38") and not I.mod97("2550814168025", "39")
    assert I.cpf_valid("52998224725") and not I.cpf_valid("52998224724")
    assert I.dni_valid("12345678", "Z") and not I.dni_valid("12345678", "A")
    assert I.nie_valid("X", "1234567", "L") and not I.nie_valid("X", "1234567", "A")
    assert I.ssn_valid("123456789") and not I.ssn_valid("000456789") and not I.ssn_valid("123006789")
    assert I.snils_valid("11223344595") and not I.snils_valid("11223344596")
    assert I.inn_valid("500100732259") and not I.inn_valid("500100732258")
    assert I.steuer_valid("86095742719") and not I.steuer_valid("86095742718")


def test_checks_move_scores():
    kinds = lambda t: {k for _, _, k in I.spans(t)}
    for sound, wrong in (("see 123-45-6789 now", "see 000-00-0000 now"), ("see 529.982.247-25 now", "see 111.222.333-44 now"), ("see 12345678-Z now", "see 12345678-A now"), ("see 2 55 08 14 168 025 38 now", "see 2 55 08 14 168 025 39 now"), ("see 112-233-445 95 now", "see 112-233-445 96 now")):
        assert kinds(sound) == {"id_number"} and "id_number" not in kinds(wrong), (sound, wrong)
    assert I.checked("046 454 286", "SIN") > 0 > I.checked("046 454 287", "SIN")
    assert I.checked("52998224725", "CPF") > 0 > I.checked("11122233344", "cpf") and I.checked("AB1", "passport") == 0


def test_placeholders_keep_the_rest():
    assert I.replace_spans("Dear Alice Quilby, mail a@b.test.", GIVEN) == "Dear <NAME>, mail <EMAIL>."


DOCS = "doc_id bigint, text string, line_no string, kind string"


def test_tables(spark):
    rows = [(1, "Head\r\nA letter from Maddoc\nQuilby came.\na@b.test c@d.test", "x", "y"), (1, "Head\r\nA letter from Maddoc\nQuilby came.\na@b.test c@d.test", "x", "y"), (2, None, None, None), (3, "", None, None), (None, "a@b.test", None, None), (4, "word " * 60_000 + "\nAlice Quilby", None, None)]
    rows += [(10 + i, "A letter from Maddoc Quilby reached us.", None, None) for i in range(4)] + [(20, "Yours,\nMaddoc Nymer", None, None)]
    names = spark.createDataFrame([("Alice", "en"), (None, None)], "given_name string, lang string")
    docs = spark.createDataFrame(rows, DOCS)
    got = {(r.doc_id, r.line_no, r.kind) for r in I.found(docs, names).collect()}
    assert got == {(1, 2, "name"), (1, 4, "email"), (4, 2, "name"), (20, 2, "name")} | {(10 + i, 1, "name") for i in range(4)}
    red = {r.doc_id: r.redacted for r in I.redact(docs, names).collect() if r.doc_id == 20}
    assert red == {20: "Yours,\n<NAME>"}
    assert I.found(docs.limit(0), names).count() == 0


def test_every_listed_name_counts(spark):
    docs = spark.createDataFrame([(1, "Alice Quilby came.", None, None), (2, "Zelda Quilby came.", None, None)], DOCS)
    names = spark.createDataFrame([("Alice", "en"), ("Zelda", "en")], "given_name string, lang string")
    assert {r.doc_id for r in I.found(docs, names).collect()} == {1, 2}


def test_common_words_are_told_by_ratio(spark):
    names = spark.createDataFrame([("Alice", "en")], "given_name string, lang string")
    for times in (1, 50):
        rows = [(i, "Mr Baker came. Mr Press came.", None, None) for i in range(40 * times)] + [(9000 + i, "the baker and the press", None, None) for i in range(2 * times)] + [(19000 + i, "a press stands", None, None) for i in range(20 * times)]
        red = {r.redacted for r in I.redact(spark.createDataFrame(rows, DOCS), names).where("doc_id < 9000").collect()}
        assert red == {"Mr <NAME> came. Mr Press came."}, times


def test_redact_keeps_every_row(spark):
    names = spark.createDataFrame([], "given_name string, lang string")
    rows = I.redact(spark.createDataFrame([(1, None, None, None), (2, "", None, None), (None, "a@b.test", None, None)], DOCS), names).collect()
    assert {(r.doc_id, r.text, r.redacted) for r in rows} == {(1, None, None), (2, "", ""), (None, "a@b.test", "<EMAIL>")}

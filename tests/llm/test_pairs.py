import pytest

from quire.llm import pairs as P

SCHEMA = "pair_id bigint, instruction string, input string, output string, messages array<struct<role string, content string>>, language string, word string, n int"
MODEL = P.LanguageModel({(w, lang): 50 for lang, ws in {"en": "the of and a is what how does work explain it on in queue full", "de": "der die das und ist wie was erkläre auf dem tisch haus nicht", "fr": "le la et est pourquoi dans les une maison sur", "es": "el la y es por qué en los una casa sobre"}.items() for w in ws.split()})


@pytest.mark.parametrize(
    ("answer", "question", "given", "defect"),
    [
        (None, "What is it?", None, "empty"), ("  \n​", "q", None, "empty"), ("**Solution:**", "q", None, "empty"), ("```\n```", "q", None, "empty"), ("N/A", "q", None, "empty"), ("[no answer]", "q", None, "empty"),
        ("I'm sorry, but I can't help with that.", "q", None, "refusal"), ("Unfortunately I am unable to assist. Is there anything else you need?", "q", None, "refusal"), ("Dazu kann ich leider nichts sagen.", "q", None, "refusal"), ("No puedo ayudar con eso.", "q", None, "refusal"),
        ("“I am sorry, I cannot help you,” said the keeper. The gate is closed.", "q", None, None), ("The driver cannot assist the loader here. It is full.", "q", None, None),
        ("What does the queue do when it is full", "What does the queue do when it is full?", None, "copy"), ("What does it do?\nWhat does it do?", "What does it do?", None, "copy"), ("Response:\nWHAT DOES THE QUEUE DO WHEN IT IS FULL?", "What does the queue do when it is full?", None, "copy"), ("4. Compare the lens with the ratio.", "Work out this.", "4. Compare the lens with the ratio.", "copy"),
        ("What does the queue do when it is full?\n\nIt drops the oldest entry and moves the head on by one place.", "What does the queue do when it is full?", None, None),
        ("Der Tisch ist auf dem Haus und das ist nicht die der.", "What does the queue do in the house?", None, "language"), ("Der Tisch ist auf dem Haus und das ist nicht.", "Translate this sentence into German.", "The queue is full.", None), ("Это полка и стена.", "What is the queue?", None, "language"),
        ("The queue drops the", "What?", None, "truncated"), ("The queue is (", "What?", None, "truncated"), ("See:\n\n```\nint x = 1;", "What?", None, "truncated"), ("The queue is full…", "What?", None, "truncated"), ("1. The queue is full.\n2.", "What?", None, "truncated"), ("It said “the queue is full.", "What?", None, "truncated"),
        ("It has parts.\n- full queue\n- the lens\n- a ratio", "What?", None, None), ("See.\n\n```\nint x = 1;\n```", "What?", None, None), ("The end (of it).", "What?", None, None),
    ],
)
def test_defects(answer, question, given, defect):
    assert P.classify(answer, question, given, "en", MODEL) == defect


def test_refusals_deny_an_act_of_answering():
    for sound in ("I don't eat meat.", "I am not a doctor.", "Ich esse kein Fleisch.", "Je ne mange pas de viande.", "No como carne.", "Não como carne.", "Я не ем мясо.", "We will not need the second lens."):
        assert not P.is_refusal(sound), sound
    for no in ("I must decline to solve this.", "We're not able to share that.", "I refuse.", "Diese Frage darf ich nicht beantworten.", "Je ne suis pas en mesure de répondre.", "Me niego a contestar.", "Não consigo atender a esse pedido.", "Я не могу ответить на этот вопрос.", "That's not something I can discuss."):
        assert P.is_refusal(no), no


def test_nesting():
    left = P.left_open
    assert left("````\n```\nx = 1\n```\n````\nDone.") is None and left("````\n```\nx\n```") == "fence" and left("```\nx\n````") is None and left("~~~\n```\n~~~") is None
    assert left("He said (and this is\n\nthe end.") == "bracket" and left("The interval is [0, 1) here.\n\nThe end.") is None
    assert left('It is "open here.') == "quote" and left('A 5" lens and "one" more.') is None
    assert left("<div>The end.") == "markup" and left("<div>The <em>end</em>.</div>") is None and left("a vector<int> b.") is None
    assert left("Use **bold.") == "markup" and left("Use `x(` here.") is None and left("Use `x.") == "markup"
    assert left("1. One (two).\n2.") == "item" and left("- a\n- b") is None and left("„So“ und «so».") is None


def brute_tiling(a, b, least):
    # longest common unmarked run, again and again
    fa, fb, total = list(a), list(b), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(fa)):
            for j in range(len(fb)):
                k = 0
                while i + k < len(fa) and j + k < len(fb) and fa[i + k] is not None and fa[i + k] == fb[j + k]:
                    k += 1
                best = max(best, (k, -i, -j))
        k, i, j = best[0], -best[1], -best[2]
        if k < least:
            return total
        fa[i : i + k] = [None] * k
        fb[j : j + k] = [object()] * k
        total += k


def test_tiling_against_brute_force():
    import random

    rnd = random.Random(4)
    for _ in range(60):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randint(0, 12))] for _ in "ab")
        assert P.tiled(a, b, 2) == brute_tiling(a, b, 2)


def test_dense_tiling_gives_the_same_tiles(monkeypatch):
    import random

    rnd = random.Random(6)
    cases = [[[rnd.choice("abcd") for _ in range(rnd.randint(0, 25))] for _ in "ab"] for _ in range(80)]
    got = [P.tiled(a, b, n) for a, b in cases for n in (1, 2)]
    monkeypatch.setattr(P, "_DENSE", -1)
    assert [P.tiled(a, b, n) for a, b in cases for n in (1, 2)] == got


def test_long_refusals_and_copies():
    refusal = "I'm sorry, but I can't help with that. " * 20 + "Please consult a professional."
    assert len(refusal) > 600 and P.classify(refusal, "What is the queue?", None, "en", MODEL) == "refusal"
    assert P.classify(refusal + " The queue is full.", "What is the queue?", None, "en", MODEL) is None
    q = "What does the queue do when it is full?"
    for times in (8, 9, 400):
        assert P.classify("\n".join([q] * times), q, None, "en", MODEL) == "copy"
    assert P.classify("It is full when the queue is full. " * 9 + "Nothing of the kind happens to stacks, heaps, trees, graphs, rings or ropes, though.", q, None, "en", MODEL) is None


def test_tables(spark):
    m = [("system", "s"), ("user", "What does the queue do?"), ("assistant", None)]
    rows = [(1, "What is the queue?", None, "The queue is a list.", None, "en", "x", 1), (1, "What is the queue?", None, "The queue is a list.", None, "en", "y", 2), (2, None, None, None, m, None, None, None), (3, None, None, None, None, None, None, None), (None, "q", None, "", None, "en", None, None), (4, "What?", "", "x " * 50_000, [], "EN", None, None)]
    got = {r.pair_id: r.defect for r in P.found(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {2: "empty", 3: "empty", 4: "truncated"}
    again = [(7, "q", None, "", None, "en", "2024-01-01"), (7, "q", None, "The queue is a list.", None, "en", "2024-02-01"), (8, "q", None, "The queue is a list.", None, "en", "2024-01-01"), (8, "q", None, "The queue is", None, "en", "2024-02-01")]
    late = spark.createDataFrame(again, "pair_id bigint, instruction string, input string, output string, messages array<struct<role string, content string>>, language string, ingested_at string")
    assert {r.pair_id: r.defect for r in P.found(late).collect()} == {8: "truncated"}
    assert P.found(spark.createDataFrame([], SCHEMA)).count() == 0

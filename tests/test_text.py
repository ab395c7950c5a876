from pyspark.sql import functions as F

from quire.functions import text as T


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x")).alias("y")).first().y


def test_words_and_tokens(spark):
    assert one(spark, "a b c\n d", T.word_count) == 4
    assert one(spark, "", T.token_estimate) == 0
    assert one(spark, "one two three four five six seven eight nine ten", T.token_estimate) == 13
    assert one(spark, None, T.word_count) == 0


def test_strip_takes_unicode_blanks(spark):
    assert one(spark, "  x  ", T.strip) == "x"


def test_code_validity(spark):
    for text, valid in (("mov eax, [ebp+8]\npush ebx\nret", True), ("https://example.org/a/b", False), ("someone@example.org", False), ("header.h", False), ("typedef struct _A {\n  int x;\n} A;", True), ("xor", False), ("", False)):
        assert one(spark, text, T.is_code) is valid, text


def test_code_language(spark):
    for text, lang in (("mov eax, 1\nret", "x86_asm"), ("mov rax, rbx\nret", "x64_asm"), ("typedef struct _A A;", "c"), ("def f(x): pass", "python"), ("?", "asm")):
        assert one(spark, text, T.code_language) == lang


def test_mending(spark):
    cases = {
        "caf\u00c3\u00a9 and \u00e2\u20ac\u0153so\u00e2\u20ac\u009d": "café and “so”", "café and Ã": "café and Ã", "Ã© and мост": "Ã© and мост", "plain": "plain", "": "",
        "a &amp; b &lt;c&gt;": "a & b <c>", "<b>a &amp; b</b>": "<b>a &amp; b</b>", "Ｗｉｄｅ　１": "Wide 1", "a\x07b\x0bc\x7f": "abc", "a\u2028b\x85c\r\nd\re": "a\nb\nc\nd\ne",
    }
    for text, want in cases.items():
        assert one(spark, text, T.mended) == want, text


def test_clean(spark):
    assert one(spark, "C H A P T E R 1 defi ned so­ft hyphen-\nation “q”", T.clean) == 'CHAPTER 1 defined soft hyphenation "q"'
    assert one(spark, "CAMPAÑ-\nas précis-\nion", T.clean).endswith("précis-\nion")


def test_slug(spark):
    assert one(spark, "  Hello, World! and more words here", T.slug) == "hello_world_and_more_wo"

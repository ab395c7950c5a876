"""Column expressions on text: built-in functions only, so they stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the blanks that Unicode-aware stripping and splitting use.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0                　"
WORD = f"[^{BLANKS}]+"
LINE_END = "\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85  ]"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def word_count(c: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(c, F.lit(WORD), F.lit(0))), F.lit(0))


def token_estimate(c: Column) -> Column:
    """A third more tokens than words, rounded down, and never fewer than words."""
    w = word_count(c)
    return F.greatest(w, F.floor(w * F.lit(1.33)).cast("int"))


def lines(c: Column) -> Column:
    """Lines of a text; a trailing line end opens no further line."""
    return F.split(F.regexp_replace(c, f"(?:{LINE_END})\\z", ""), LINE_END)


def full_lines(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != "")


def letters_and_digits(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def slug(c: Column) -> Column:
    """Lower case, runs of other characters as one underscore, 24 characters at most, no underscore at the ends."""
    return F.btrim(F.substring(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), 1, 24), F.lit("_"))


# --- code ----------------------------------------------------------------------------------------------------------
#: Words that mark a text as code, and patterns of references that aren't code.
CODE_WORDS = r"\b(?:mov|push|pop|call|ret|retn|jmp|je|jne|jz|jnz|cmp|test|lea|xor|sub|add|int\s+3|struct|typedef|void|int|char|unsigned|signed|float|double|return|#include|#define|DWORD|QWORD|BYTE|WORD|PVOID|HANDLE|STATUS_|NTSTATUS|BOOL)\b"
REFERENCE = r"(?i)^(?:https?://|www\.|[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+|[a-zA-Z0-9_-]+\.(?:c|h|cpp|hpp|py|rb|exe|dll|so|dylib|html?|pdf|zip))\s*$"
ADDRESS = r"(?i)(?:https?://|www\.|(?:\.com|\.org|\.edu|\.gov|\.io|\.html?|\.pdf)(?:/|\)|$))"
ADDRESS_LINE = r"(@|\.com|\.org|https?:)"
ASM_WORDS = r"\b(mov|push|pop|call|retn?|jmp|lea|cmp|test|xor|eax|ebx|ecx|edx|esp|ebp|esi|edi)\b"
X64_WORDS = r"\b(rax|rbx|rcx|rdx|rsp|rbp|rsi|rdi|r8|r9|r10|r11|r12|r13|r14|r15)\b"
C_WORDS = r"\b(struct|typedef|void\*?|int|char\*?|unsigned|#include|#define|NTSTATUS)\b"
PYTHON_WORDS = r"\b(def\s+\w+|import\s+\w+|class\s+\w+:)\b"


def is_code(c: Column) -> Column:
    """Whether a text is a routine or statement, not a reference or a lone word."""
    t = strip(c)
    coded = t.rlike(CODE_WORDS)
    full = F.filter(lines(t), lambda x: strip(x) != "")
    alone = ~t.contains("\n")
    return (
        F.when(t == "", False)
        .when(t.rlike(ADDRESS) & ~coded, False)
        .when(alone & t.rlike(REFERENCE), False)
        .when(alone & (word_count(t) <= 2) & ~coded, False)
        .when(F.size(full) >= 2, ~F.forall(full, lambda x: x.rlike(ADDRESS_LINE)))
        .otherwise(coded & (F.length(t) > 10))
    )


def code_language(c: Column) -> Column:
    low = F.lower(c)
    return (
        F.when(low.rlike(ASM_WORDS), F.when(low.rlike(X64_WORDS), "x64_asm").otherwise("x86_asm"))
        .when(c.rlike(C_WORDS), "c")
        .when(c.rlike(PYTHON_WORDS), "python")
        .otherwise("asm")
    )


def fenced(c: Column) -> Column:
    return F.concat(F.lit("```"), code_language(c), F.lit("\n"), c, F.lit("\n```"))


# --- cleaning --------------------------------------------------------------------------------------------------------
#: Ligatures that extraction tore apart, in the order in which they are mended.
TORN = (
    ("fl ag", "flag"), ("fi nd", "find"), ("fi rst", "first"), ("defi ne", "define"), ("defi ned", "defined"), ("effi cient", "efficient"), ("affi liate", "affiliate"), ("offi ce", "office"),
    ("confl ict", "conflict"), ("signifi cant", "significant"), ("signifi cantly", "significantly"), ("speci fi", "specifi"), ("fi eld", "field"), ("identi fi", "identifi"), ("beneﬁ", "benefi"),
)
#: Typographic characters and the plain ones they are cleaned to.
CURLY, STRAIGHT = "‘’‚‛“”„‟", "''''\"\"\"\""
LIGATURES = (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"))
SPACED = (("C H A P T E R", "CHAPTER"), ("A P P E N D I X", "APPENDIX"), ("I N D E X", "INDEX"))


def spaced_pattern(head: str) -> str:
    return r"(?i)\b" + r"\s+".join(head.split()) + r"\b"


#: Entities of markup; what a Western code page shows for the bytes 128 to 159, in order, where it has
#: something; width forms and plain characters.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\xa0"), ("&amp;", "&"))
WESTERN = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
WESTERN_BYTES = "".join(map(chr, (0x80, *range(0x82, 0x8D), 0x8E, *range(0x91, 0x9D), 0x9E, 0x9F)))
WIDE, PLAIN = "".join(map(chr, range(0xFF01, 0xFF5F))) + "\u3000", "".join(map(chr, range(0x21, 0x7F))) + " "
CONTROLS = "".join(map(chr, (*range(9), 11, *range(14, 32), 127)))


def reread(c: Column) -> Column:
    """``c`` with its bytes read as UTF-8, where it is made of the characters of a Western code page and its bytes are
    well-formed UTF-8 beyond ASCII; else ``c``. Texts that are only garbled in part stay."""
    raw = F.translate(c, WESTERN, WESTERN_BYTES)
    single = raw.rlike(r"\A[\x00-\xff]*\z") & raw.rlike(r"[\xc2-\xf4][\x80-\xbf]")
    text = F.encode(F.when(single, raw).otherwise(""), "ISO-8859-1").cast("string")
    return F.when(single & F.is_valid_utf8(text), text).otherwise(c)


def mended(c: Column) -> Column:
    """Text without entities (unless it holds markup), misread UTF-8, width forms and control characters, and with plain
    line ends."""
    plain = c
    for a, b in ENTITIES:
        plain = F.replace(plain, F.lit(a), F.lit(b))
    c = reread(F.when(c.contains("<"), c).otherwise(plain))
    c = F.regexp_replace(F.translate(c, WIDE, PLAIN), "\r\n?|[\x85\u2028\u2029]", "\n")
    return F.translate(c, CONTROLS, "")


def clean(c: Column) -> Column:
    """Mended text with straight quotes, whole ligatures, spaced headings closed, invisible marks removed, words joined that
    were divided at a line end."""
    c = F.translate(mended(c), CURLY, STRAIGHT)
    for a, b in (*LIGATURES, *TORN):
        c = F.replace(c, F.lit(a), F.lit(b))
    for head, word in SPACED:
        c = F.regexp_replace(c, spaced_pattern(head), word)
    c = F.translate(c, "\xad\x02�", "")
    return F.regexp_replace(c, r"(\b[a-zA-Z]{3,})-\s*\n\s*([a-z]{2,}\b)", "$1$2")

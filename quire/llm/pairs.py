"""Problem 1: broken prompt and response pairs.

A pushdown parser follows fences, brackets, quotations, lists and markup of the answer on one stack to its end and tells
whether anything is left open; greedy string tiling measures how much of the answer is taken from the question; script checks and
word statistics tell its language; a grammar of refusals tells whether it declines to answer.

Defined results: a pair whose answer is NULL is ``empty``; a pair without a question can't be ``copy`` or ``language``; a
redelivered pair gives one row, of its last delivery; rows without ``pair_id`` are left out; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import regex as re
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, canon_language

DEFECTS = ("empty", "refusal", "copy", "language", "truncated")
#: The language model is fitted on this many labelled pairs at most, chosen by hash.
MODEL_ROWS = 40_000

_WORD = re.compile(r"[\p{L}\p{M}\p{N}]+(?:['’_-][\p{L}\p{M}\p{N}]+)*")
_LETTERS = re.compile(r"[\p{L}\p{M}]+")
_FENCE = re.compile(r"^[ \t]*(`{3,}|~{3,})[^\n]*$", re.MULTILINE)
_LABEL = r"(?:answer|solution|response|reply|output|result|technical notes(?: and solution)?|notes|antwort|lösung|ergebnis|réponse|solution|résultat|respuesta|solución|resultado|resposta|solução|ответ|решение|question|frage|pregunta|pergunta|вопрос|prompt|instruction|[aq])"
_LEAD = re.compile(rf"^\s*(?:[*_#>\s\"“«]*(?i:{_LABEL})[*_\s]*[::.][*_\s]*)+")
_PLACEHOLDER = re.compile(r"(?i)^[\W_]*(?:n\s*/\s*a|none|null|nil|nan|undefined|empty|tb[dac]|todo|fixme|xxx+|placeholder|lorem ipsum|(?:no|keine|aucune|sin|sem|нет) (?:answer|response|output|antwort|réponse|respuesta|resposta|ответа?)|(?:answer|response|text|insert|your answer) (?:here|goes here|missing|pending|to follow))[\W_]*$")

# --- refusals: one that speaks, an inability or unwillingness, and an act of answering --------------------------------
#: For each language, who speaks, what denies, and the acts that are denied; further ways to decline.
_SPEAKS, _DENIES, _ACTS, _OTHERWISE = range(4)
_GRAMMAR = {
    "en": (
        r"\b(?:i|we)\b",
        r"(?:\b(?:can|could|will|would|may|must|should)\s*(?:not|n['’]t)\b|\bcannot\b|\b(?:can|won|wouldn|couldn|shouldn)['’]?t\b|\b(?:unable|not able|not allowed|not permitted|not authori[sz]ed|not comfortable|not going|not willing|not in a position)\b|\b(?:do not|don['’]t) (?:feel comfortable|want|wish|intend|think i (?:can|should)|have (?:enough|sufficient|any|the|access))|\b(?:decline|refuse|prefer not|rather not)\b)",
        r"\b(?:help|assist\w*|answer\w*|respond|reply|provid\w+|shar(?:e|ing)|expla\w+|discuss\w*|solv\w+|comment\w*|continu\w+|comply|complet\w+|offer\w*|giv\w+|tell|say|advi[sc]\w+|write|do (?:that|this|so)|fulfil\w*|engag\w+|support|information|requests?|questions?|context|details?)\b",
        (r"\bmy (?:guidelines|policy|policies|instructions|rules|programming|training)\b.{0,40}\b(?:not|n['’]t|prohibit|forbid|prevent)", r"\b(?:that|this|it)(?:['’]s| is)\s+(?:not something|nothing|outside|beyond)\b.{0,60}\b(?:i|me|my)\b", r"\bno comment\b", r"\b(?:against|violates?) (?:my|our|the) (?:guidelines|polic\w+|rules|terms)"),
    ),
    "de": (
        r"\b(?:ich|wir|mir|uns)\b",
        r"(?:\b(?:kann|können|darf|dürfen|möchte|werde|will|könnte|ist)\b.*\b(?:nicht|nichts|kein\w*|unmöglich)\b|\b(?:nicht|nichts|kein\w*)\b.*\b(?:kann|darf|möchte|werde|will)\b|\b(?:muss|muß)\b.*\bablehnen\b|\blehne\b.*\bab\b|\bverweiger\w*|\baußerstande\b|\bnicht (?:in der lage|befugt|berechtigt)\b)",
        r"(?:helf\w*|antwort\w*|auskunft|auskünfte|sagen|geben|weiter\w*|unterstütz\w*|erklär\w*|mitteil\w*|information\w*|\bfragen?\b|ablehnen|äußern|nennen|behilflich|fortfahren|fortsetzen|kommentier\w*|lösen|bearbeit\w*|erfüll\w*)",
        (),
    ),
    "fr": (
        r"\b(?:je|j['’]|nous|m['’])",
        r"(?:\bne (?:peux|puis|pouvons|pourrai|saurais|souhaite|veux|dois|dispose)\b|\bne suis pas (?:en mesure|autorisée?|capable|habilitée?)|\bn['’]ai pas\b|\brefuse\b|\bpréfère ne\b|\bimpossible\b)",
        r"\b(?:répon\w+|aid\w+|fourni\w*|expliqu\w+|donner|dire|partag\w+|discut\w+|continu\w+|poursuiv\w+|informations?|questions?|demandes?|comment\w+|résoudre|traiter|le droit|la permission|assister|faire)\b",
        (),
    ),
    "es": (
        r"",
        r"(?:\bno (?:me es posible|(?:le |te |les )?(?:puedo|podemos|podré)|tengo (?:permitido|permiso|suficiente)|estoy (?:autorizad\w|capacitad\w|en condiciones)|se me permite|quiero|deseo|dispongo|debo)\b|\bprefiero no\b|\bme niego\b|\blamento no\b|\bme es imposible\b)",
        r"\b(?:ayud\w+|respond\w+|contest\w+|proporcion\w+|dar\w*|ofrec\w+|explic\w+|compart\w+|decir\w*|habl\w+|continu\w+|informaci\w+|preguntas?|solicitud|resolv\w+|coment\w+|atender\w*|hacer\w*)\b",
        (),
    ),
    "pt": (
        r"",
        r"(?:\bnão (?:me é possível|(?:lhe |te )?(?:posso|podemos|poderei|consigo)|tenho (?:permissão|autorização|informa\w+)|estou (?:autorizad\w|em condições)|quero|desejo|disponho|devo)\b|\bprefiro não\b|\b(?:me )?recuso\b|\blamento não\b)",
        r"\b(?:ajud\w+|respond\w+|fornec\w+|dar|oferec\w+|explic\w+|compart\w+|dizer|falar|continu\w+|informaç\w+|perguntas?|pedidos?|resolv\w+|coment\w+|atender|fazer)\b",
        (),
    ),
    "ru": (
        r"",
        r"(?:\bне (?:могу|можем|буду|вправе|хочу|имею|уполномочен\w*|в состоянии|стану)\b|\bотказыва\w+|\bвынужден\w* отказ\w+)",
        r"\b(?:помо\w+|ответ\w*|отвеч\w+|предостав\w+|объясн\w+|сказать|обсу\w+|подел\w+|продолж\w+|информац\w+|вопрос\w*|коммент\w+|дать|решать|решить|права)\b",
        (),
    ),
}


def _refusal(speaks: str, denies: str, acts: str, otherwise: tuple[str, ...]) -> list[re.Pattern]:
    who = f"(?=.*{speaks})" if speaks else ""
    said = rf"^{who}(?=.*{denies})(?:.*{acts}|.*{denies}\W*$)"
    return [re.compile(p, re.IGNORECASE | re.DOTALL) for p in (said, *otherwise)]


_REFUSALS = [r for g in _GRAMMAR.values() for r in _refusal(*g)]


def declines(sentence: str) -> bool:
    return any(r.search(sentence) for r in _REFUSALS)


_COURTESY = re.compile(
    r"(?i)\b(?:thank you|thanks|feel free|anything else|please (?:consult|ask|contact|try|rephrase)|let me know|happy to|understanding|consult a professional|another (?:question|chapter|topic)|can i help|vielen dank|danke|bitte wenden|verständnis|sonst noch|gerne|merci|n['’]hésitez|autre question|consultez|gracias|consulte|otra pregunta|obrigad[oa]|outra pergunta|compreensão|спасибо|обратитесь|другой вопрос)\b|^[\W_]*(?:i['’]?m |i am )?(?:so |very |really |deeply )?(?:sorry|apologi\w+|unfortunately|leider|desolée?|désolée?|lo siento|desculpe|lamento|извините)[\W_]*$"
)
_SENTENCE = re.compile(r"(?<=[.!?…。!?])[\"”’»)]*\s+|\n+")


def is_refusal(answer: str) -> bool:
    """Whether every sentence outside quotations declines to answer or is a courtesy that goes with it."""
    bare = _LEAD.sub("", answer).strip()
    if bare[:1] in "“\"«„‘":
        return False
    declined = False
    for s in (x.strip() for x in _SENTENCE.split(bare)):
        if not _LETTERS.search(s):
            continue
        if declines(s):
            declined = True
        elif not _COURTESY.search(s):
            return False
    return declined


# --- emptiness -------------------------------------------------------------------------------------------------------
def is_empty(answer: str | None) -> bool:
    if answer is None:
        return True
    bare = _LEAD.sub("", _FENCE.sub("", answer))
    return not re.search(r"[\p{L}\p{N}]", bare) or bool(_PLACEHOLDER.match(bare))


# --- copies: greedy string tiling ------------------------------------------------------------------------------------
def tiled(a: list[str], b: list[str], least: int = 2, enough: float = math.inf) -> int:
    """How many words of ``a`` are covered by tiles of at least ``least`` words that ``b`` has too; longest tiles first. Ends
    once ``enough`` are covered."""
    free_a, free_b, total = [True] * len(a), [True] * len(b), 0
    where: dict[str, list[int]] = {}
    for j, w in enumerate(b):
        where.setdefault(w, []).append(j)
    search = _longest_dense if sum(len(where.get(w, ())) for w in a) > _DENSE else _longest
    while True:
        longest, best = search(a, b, where, free_a, free_b, least)
        if not best or total >= enough:
            return total
        for i, j in best:
            if all(free_a[i : i + longest]) and all(free_b[j : j + longest]):
                free_a[i : i + longest] = [False] * longest
                free_b[j : j + longest] = [False] * longest
                total += longest


#: Pairs of equal words from which run lengths are worked out row by row; both ways give the same tiles.
_DENSE = 5000


def _longest(a: list[str], b: list[str], where: dict[str, list[int]], free_a: list[bool], free_b: list[bool], least: int) -> tuple[int, list[tuple[int, int]]]:
    """The longest runs of free words that ``a`` and ``b`` share, of ``least`` words at least, as (length, places)."""
    best: list[tuple[int, int]] = []
    longest = least
    for i in range(len(a)):
        if not free_a[i]:
            continue
        for j in where.get(a[i], ()):
            k = 0
            while i + k < len(a) and j + k < len(b) and free_a[i + k] and free_b[j + k] and a[i + k] == b[j + k]:
                k += 1
            if k > longest:
                longest, best = k, [(i, j)]
            elif k == longest:
                best.append((i, j))
    return longest, best


def _longest_dense(a: list[str], b: list[str], where: dict[str, list[int]], free_a: list[bool], free_b: list[bool], least: int) -> tuple[int, list[tuple[int, int]]]:
    """As ``_longest``, in time that doesn't depend on how long the runs are."""
    spots = {w: np.array(js) for w, js in where.items()}
    open_ = np.array(free_b)
    below, rows, longest = np.zeros(len(b) + 1, np.int32), [], least
    for i in range(len(a) - 1, -1, -1):
        run = np.zeros(len(b) + 1, np.int32)
        if free_a[i] and (js := spots.get(a[i])) is not None:
            js = js[open_[js]]
            run[js] = below[js + 1] + 1
            if len(js) and (top := int(run[js].max())) >= longest:
                if top > longest:
                    longest, rows = top, []
                rows.append((i, js[run[js] == longest]))
        below = run
    return longest, [(i, int(j)) for i, js in reversed(rows) for j in js]


def words(text: str | None) -> list[str]:
    return [w.casefold() for w in _WORD.findall(text or "")]


_LONG_LEAD = re.compile(r"^[^\n:]{0,90}:\s+(?=\S)")


def is_copy(answer: str, sources: list[list[str]]) -> bool:
    """Whether all but a few words of the answer, without a lead-in, come from one source in its own order."""
    bare = _LEAD.sub("", answer)
    for text in dict.fromkeys((bare, _LONG_LEAD.sub("", bare, count=1))):
        own = words(text)
        if not own:
            continue
        most = max(1 if len(own) < 8 else 2, 0.15 * len(own))
        for src in sources:
            have = set(src)
            if not src or sum(w not in have for w in own) > most:
                continue  # no tile covers a word that the source doesn't have
            again = src * -(-len(own) // len(src))  # it may be given more than once
            rest = len(own) - tiled(own, again, 1 if len(own) < 4 else 2, len(own) - most)
            if rest <= most and len(own) > 1:
                return True
    return False


# --- languages -------------------------------------------------------------------------------------------------------
_SCRIPTS = tuple((n, re.compile(rf"\p{{{n}}}")) for n in ("Latin", "Cyrillic", "Greek", "Han", "Hiragana", "Katakana", "Hangul", "Arabic", "Hebrew", "Devanagari", "Thai"))


def prose(text: str | None) -> str:
    """``text`` without fenced and inline code."""
    out, open_ = [], False
    for line in (text or "").split("\n"):
        if _FENCE.match(line):
            open_ = not open_
        elif not open_:
            out.append(line)
    return re.sub(r"`[^`\n]*`", " ", "\n".join(out))


def script(text: str) -> str | None:
    """The script of most letters; Japanese and Chinese count as one."""
    n = {s: len(r.findall(text)) for s, r in _SCRIPTS}
    n["Han"] += n.pop("Hiragana") + n.pop("Katakana")
    best = max(n, key=n.get)
    return best if n[best] else None


class LanguageModel:
    """Naive Bayes over words, with letter pairs of known words standing in for unknown ones."""

    def __init__(self, counts: dict[tuple[str, str], int]):
        self.langs = sorted({lang for _, lang in counts})
        totals = {k: 0 for k in self.langs}
        by: dict[str, dict[str, int]] = {}
        grams: dict[str, dict[str, int]] = {}
        for (w, lang), n in counts.items():
            totals[lang] += n
            by.setdefault(w, {})[lang] = by.get(w, {}).get(lang, 0) + n
            for g in self._grams(w):
                d = grams.setdefault(g, {})
                d[lang] = d.get(lang, 0) + 1
        self.words = {w: self._logs(d, totals) for w, d in by.items()}
        gt = {k: 1 + sum(d.get(k, 0) for d in grams.values()) for k in self.langs}
        self.grams = {g: self._logs(d, gt) for g, d in grams.items()}

    @staticmethod
    def _grams(w: str) -> list[str]:
        w = f"^{w}$"
        return [w[i : i + 3] for i in range(len(w) - 2)]

    def _logs(self, d: dict[str, int], totals: dict[str, int]) -> tuple[float, ...]:
        # a share of 2 % of foreign rows under a language's label must not speak for it
        share = [max(0.0, d.get(k, 0) / max(1, totals[k])) for k in self.langs]
        top = max(share) or 1.0
        return tuple(math.log(max(s / top, 0.02)) for s in share)

    def scores(self, text: str) -> tuple[dict[str, float], int]:
        s = [0.0] * len(self.langs)
        n = 0
        for w in _LETTERS.findall(text.casefold()):
            v = self.words.get(w)
            if v is not None:
                n += 1
                s = [a + b for a, b in zip(s, v)]
            else:
                for g in self._grams(w):
                    if v := self.grams.get(g):
                        s = [a + 0.25 * b for a, b in zip(s, v)]
        return dict(zip(self.langs, s)), n

    def best(self, text: str) -> tuple[str | None, float]:
        """The likeliest language and how much likelier it is than the next, in nats."""
        if not self.langs or not _LETTERS.search(text):
            return None, 0.0
        s, _ = self.scores(text)
        r = sorted(s, key=s.get, reverse=True)
        return r[0], s[r[0]] - (s[r[1]] if len(r) > 1 else -99.0)


#: Names of languages in requests to translate or to answer in a language, by code.
_NAMED = {
    "en": "english|englisch|anglais|inglés|inglês|английск",
    "de": "german|deutsch|allemand|alemán|alemão|немецк",
    "fr": "french|französisch|français|francés|francês|французск",
    "es": "spanish|spanisch|espagnol|español|castellano|espanhol|испанск",
    "pt": "portuguese|portugiesisch|portugais|portugués|português|португальск",
    "ru": "russian|russisch|russe|ruso|russo|русск",
    "it": "italian|italienisch|italien|italiano|итальянск",
    "zh": "chinese|chinesisch|chinois|chino|chinês|китайск",
    "ja": "japanese|japanisch|japonais|japonés|japonês|японск",
    "la": "latin|latein|lateinisch|latín|latim|латын",
}
_ASKED = re.compile(r"(?i)\b(?:translat\w*|render|express|write|answer|respond|reply|in|into|übersetz\w*|auf|ins|tradu\w+|en|al|em|para o|на|перевед\w+)\b[^.!?\n]{0,60}?\b(" + "|".join(_NAMED.values()) + r")\w*")


def asked_language(question: str) -> str | None:
    m = _ASKED.search(question)
    if not m:
        return None
    return next(code for code, names in _NAMED.items() if re.match(names, m[1].lower()))


def is_foreign(answer: str, question: str, label: str | None, model: LanguageModel) -> bool:
    a, q = prose(answer), prose(question)
    sa, sq = script(a), script(q)
    if sa is None or sq is None:
        return False
    asked = asked_language(question)
    if sa != sq:
        return asked is None or sa == "Latin" and asked in ("ru", "zh", "ja")
    if sa != "Latin":
        return False
    la, margin = model.best(a)
    lq, _ = model.best(q)
    if label in model.langs and lq != label:
        s, n = model.scores(q)
        if n < 4 or s[label] > s[lq] - 2.0:
            lq = label
    if la is None or lq is None or la == lq or la == asked:
        return False
    s, n = model.scores(a)
    return n >= 3 and s[la] - s[lq] > 3.0


# --- truncation: a pushdown parser -----------------------------------------------------------------------------------
_ITEM = re.compile(r"^[ \t]*(?P<mark>[-*•‣–+]|\(?\d{1,3}[.)]|\(?[a-zA-Z][.)])(?:[ \t]+(?P<body>.*))?$")
_CLOSERS = {")": "(", "]": "[", "}": "{", "”": "“", "»": "«", "’": "‘"}
_END = re.compile(r"[.!?…。!?۔][\"”’'»«“)\]*_}>]*$")


#: Elements of markup that are closed by a tag of their own.
_ELEMENTS = frozenset("div span ul ol table thead tbody strong em code pre blockquote section article figure details sub sup h1 h2 h3 h4 h5 h6".split())
_MARKS = re.compile(r"</?(?P<tag>[a-zA-Z][a-zA-Z0-9]*)(?:\s[^<>]*)?(?P<empty>/?)>|(?P<ticks>`+)|\*\*|[()\[\]{}“”«»„‘’\"]")


class Nesting:
    """A pushdown parser of an answer. The stack holds (sort, mark) of what is open: fences with their length, brackets,
    quotations, code within a line, bold text, elements of markup, and items of lists."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, str]] = []

    def open(self, sort: str, mark: str) -> None:
        self.stack.append((sort, mark))

    def has(self, sort: str, mark: str | None = None) -> bool:
        return any(s == sort and mark in (None, m) for s, m in self.stack)

    def close(self, sort: str, mark: str) -> None:
        """Close the innermost of its sort with everything opened within it."""
        at = max(i for i, x in enumerate(self.stack) if x == (sort, mark))
        del self.stack[at:]

    def toggle(self, sort: str, mark: str) -> None:
        self.close(sort, mark) if self.has(sort, mark) else self.open(sort, mark)

    def read(self, answer: str) -> Nesting:
        before = ""
        for line in answer.split("\n"):
            fence = _FENCE.match(line)
            top = self.stack[-1] if self.stack and self.stack[-1][0] == "fence" else None
            if top:
                # a fence closes by a line of its own mark, as long as itself at least, with nothing behind it
                if fence and fence[1][0] == top[1][0] and len(fence[1]) >= len(top[1]) and not line.strip().strip(top[1][0]):
                    self.stack.pop()
            elif fence:
                self.open("fence", fence[1])
            elif not line.strip():
                self._paragraph(before)
            else:
                self._line(line)
            before = line if line.strip() else before
        return self

    def _paragraph(self, last: str) -> None:
        # what a paragraph left open that came to its end isn't missed; one that breaks off takes it along
        whole = bool(_END.search(last.rstrip())) or last.rstrip()[-1:] in (":", "`", "*", ">", "|")
        self.stack = [x for x in self.stack if x[0] == "element" or x[0] in ("bracket", "quote") and not whole and x[1] in "([{“«"]

    def _line(self, line: str) -> None:
        body = line
        if item := _ITEM.match(line):
            body = item["body"] or ""
            while self.has("item"):
                self.close("item", next(m for s, m in reversed(self.stack) if s == "item"))
            self.open("item", body.strip())
        for m in _MARKS.finditer(body):
            self._mark(m, body)

    def _mark(self, m: re.Match, body: str) -> None:
        c, i = m[0], m.start()
        if m["ticks"]:
            self.toggle("code", c)
        elif self.has("code"):
            return
        elif m["tag"]:
            tag = m["tag"].lower()
            if tag in _ELEMENTS and not m["empty"]:
                if c[1] != "/":
                    self.open("element", tag)
                elif self.has("element", tag):
                    self.close("element", tag)
        elif c == "**":
            self.toggle("bold", c)
        elif c in "([{":
            self.open("bracket", c)
        elif c in "“«„":
            low = "“" if c == "„" else c
            if c == "“" and self.stack and self.stack[-1] == ("quote", "“"):
                self.stack.pop()  # it closes what a low mark opened
            else:
                self.open("quote", low)
        elif c == '"':
            if self.has("quote", c):
                self.close("quote", c)
            elif (i == 0 or not body[i - 1].isalnum()) and body[i + 1 : i + 2].strip():
                self.open("quote", c)  # not the sign of inches
        elif c == "‘":
            if i == 0 or not body[i - 1].isalnum():
                self.open("apostrophe", c)
        elif c == "’":
            if self.stack and self.stack[-1] == ("apostrophe", "‘"):
                self.stack.pop()
        else:
            sort = "quote" if c in "”»" else "bracket"
            if self.has(sort, _CLOSERS[c]):
                self.close(sort, _CLOSERS[c])


def left_open(answer: str) -> str | None:
    """What the parser still has on its stack at the end: ``fence``, ``bracket``, ``quote``, ``markup``, or ``item`` for a
    list that ends with a mark and nothing after it; None if nothing."""
    stack = Nesting().read(answer).stack
    for sort, found in (("fence", "fence"), ("bracket", "bracket"), ("quote", "quote"), ("code", "markup"), ("bold", "markup"), ("element", "markup")):
        if any(s == sort for s, _ in stack):
            return found
    return "item" if any(s == "item" and not re.search(r"[\p{L}\p{N}]", m) for s, m in stack) else None


_CUT = re.compile(r"(?:…|\.\.\.|[\[(](?:…|\.\.\.|cut|truncated|continued|to be continued|gekürzt|suite|sigue|continua)[\])])$", re.IGNORECASE)


def is_truncated(answer: str) -> bool:
    text = answer.rstrip()
    if _CUT.search(text):
        return True
    if left_open(text):
        return True
    lines = text.split("\n")
    last = lines[-1]
    if _FENCE.match(last):
        return False  # a closed listing
    if item := _ITEM.match(last):
        body = (item["body"] or "").strip()
        if not re.search(r"[\p{L}\p{N}]", body):
            return True  # a marker with nothing after it
        if _END.search(body):
            return False
        before = []
        for line in reversed(lines[:-1]):
            m = _ITEM.match(line)
            if not m:
                break
            before.append((m["body"] or "").strip())
        if any(_END.search(b) for b in before):
            return True  # the other items are sentences
        if body[-1] in ",;:-–—(" or len(words(body)) > 8:
            return True
        return len(before) > 1 and len(words(body)) == 1 and all(len(words(b)) > 1 for b in before)
    if _END.search(text):
        return False
    if re.search(r"[;{})\]>]$", last) and re.search(r"[=(){};<>]", last) and len(lines) > 1:
        return last.rstrip()[-1] in "({"
    return True


def classify(answer: str | None, question: str | None, given: str | None, label: str | None, model: LanguageModel) -> str | None:
    """The defect of an answer to ``question`` about the text ``given``, or None if it is sound."""
    if is_empty(answer):
        return "empty"
    if is_refusal(answer):
        return "refusal"
    q, g = words(question), words(given)
    parts = [words(p) for p in re.split(r"\n\s*\n", question or "")] if question else []
    if is_copy(answer, [s for s in (q + g, q, g, *parts) if s]):
        return "copy"
    asked = "\n\n".join(x for x in (question, given) if x)
    if asked and is_foreign(answer, asked if asked_language(question or "") is None else question, label, model):
        return "language"
    return "truncated" if is_truncated(answer) else None


# --- over tables -----------------------------------------------------------------------------------------------------
def turn(role: str) -> Column:
    """Contents of the turns of ``role``, joined; NULL if there are none."""
    of = F.filter("messages", lambda m: (F.lower(m["role"]) == role) & m["content"].isNotNull())
    return F.when(F.size(of) > 0, F.concat_ws("\n\n", F.transform(of, lambda m: m["content"])))


def flat(pairs: DataFrame) -> DataFrame:
    """(pair_id, question, given, answer, label, at), wherever a pair stores them."""
    blank = lambda c: F.when(F.trim(F.col(c)) != "", F.col(c))
    return pairs.where(F.col("pair_id").isNotNull()).select(
        "pair_id",
        F.coalesce(blank("instruction"), turn("user")).alias("question"),
        F.when(blank("instruction").isNotNull(), blank("input")).alias("given"),
        F.coalesce(blank("output"), turn("assistant"), "output").alias("answer"),
        canon_language(F.col("language")).alias("label"),
        (F.col("ingested_at") if "ingested_at" in pairs.columns else F.lit(None)).cast("string").alias("at"),
    )


def language_counts(rows: DataFrame) -> DataFrame:
    """(word, lang, n) over all questions and answers whose pair names its language."""

    def count(cols: dict[str, list]) -> dict[str, list]:
        c: dict[tuple[str, str], int] = {}
        for q, g, a, lang in zip(cols["question"], cols["given"], cols["answer"], cols["label"]):
            if lang:
                for t in (q, g, a):
                    if t:
                        for w in _LETTERS.findall(prose(t).casefold()):
                            c[(w, lang)] = c.get((w, lang), 0) + 1
        return {"word": [k[0] for k in c], "lang": [k[1] for k in c], "n": list(c.values())}

    return arrow_map(rows, count, "word string, lang string, n bigint").groupBy("word", "lang").agg(F.sum("n").alias("n"))


def fit_language_model(rows: DataFrame) -> LanguageModel:
    """The model of about ``MODEL_ROWS`` of the pairs that name their language, or of all if there are fewer."""
    labelled = rows.where("label is not null")
    every = 1 + labelled.count() // MODEL_ROWS
    some = labelled.where(F.pmod(F.xxhash64("pair_id"), F.lit(every)) == 0)
    return LanguageModel({(r.word, r.lang): r.n for r in language_counts(some).collect()})


def found(pairs: DataFrame) -> DataFrame:
    """Rows (pair_id, defect), one for each pair with a defective answer."""
    rows = flat(pairs)
    model = pairs.sparkSession.sparkContext.broadcast(fit_language_model(rows))

    def run(cols: dict[str, list]) -> dict[str, list]:
        m = model.value
        out = [classify(a, q, g, lang, m) for q, g, a, lang in zip(*(cols[c] for c in ("question", "given", "answer", "label")))]
        return {"pair_id": cols["pair_id"], "at": cols["at"], "defect": out}

    each = arrow_map(rows, run, "pair_id bigint, at string, defect string")
    return each.groupBy("pair_id").agg(F.max(F.struct("at", "defect")).alias("r")).select("pair_id", F.col("r.defect").alias("defect")).where("defect is not null")

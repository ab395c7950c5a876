"""Problem 10: personal information inside free text.

Regular expressions propose spans, checksum validators and the words around a span adjust its score, and spans that reach
the threshold become findings. Names are proposed from a list of given names, titles and cue phrases; given names missing
from the list are learned from the whole corpus: words that cue phrases introduce as a given name far oftener than they
are written in lower case. Words that are written in lower case often enough, compared with how often they are proposed as
part of a name, are common words. Only such ratios decide, and counts meet the proposals by equi-joins, so neither the
size of the corpus nor that of a vocabulary matters. Texts are read once.

Defined results: NULL, empty and blank texts have no findings and are kept unchanged by :func:`redact`; a repeated
``doc_id`` gives each finding once; other columns of the input are ignored.
"""

from __future__ import annotations

import bisect
import functools
import unicodedata

import regex as re
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map
from quire.session import cut_lineage, hub

KINDS = ("email", "phone", "id_number", "address", "name")
THRESHOLD = 1.0
#: Share of lower case among the uses of a word from which it is common, and share of cues from which it is a given name.
COMMON, CUED = 0.1, 0.5

# --- email ---------------------------------------------------------------------------------------------------------
_AT = r"(?:[@＠]|\s*[\[({<]\s*(?:at|ät|arroba|a|собака)\s*[\])}>]\s*|\s+(?:AT|ARROBA|СОБАКА)\s+|\s+(?:arroba|собака)\s+)"
_DOT = r"(?:[.．]|\s*[\[({<]\s*(?:dot|punkt|point|punto|ponto|точка)\s*[\])}>]\s*|\s+(?:DOT|PUNKT|PUNTO|PONTO|ТОЧКА)\s+|\s+(?:punto|ponto|точка)\s+)"
EMAIL = re.compile(rf"(?<![\w.+-])[\p{{L}}\d][\w.+%-]*{_AT}[\p{{L}}\d][\p{{L}}\d-]*(?:{_DOT}[\p{{L}}\d][\p{{L}}\d-]*)*{_DOT}\p{{L}}{{2,24}}(?![\w@])")
EMAIL_HINT = re.compile(r"[@＠]|[\[({<]\s*(?:at|ät|arroba|a|собака)\s*[\])}>]|\s(?:AT|ARROBA|arroba|СОБАКА|собака)\s")

# --- phone ---------------------------------------------------------------------------------------------------------
_SEP = r"(?:[ \u00a0\u202f]|[./‐‑–-]|[ ]?[/–-][ ]|\)[ -]?|[ ]?\(|\r?\n\(?)?"
PHONE = re.compile(rf"(?<![\w.@/:#-])(?:\+|＋)?(?:\(\+?\d{{1,5}}\)|\d)(?:{_SEP}\d){{6,15}}(?:\s*(?:ext\.?|x|App\.|poste|Durchwahl|доб\.)\s*\d{{1,5}})?(?![\w@])(?![.,:/-]\d)")
_PHONE_CUE = re.compile(r"(?i)\b(?:tel|tél|тел|phone|telephone|mobile|cell|fax|call|ring|dial|hotline|appel\w*|téléphon\w*|joindre|telefon\w*|erreichbar|rufnummer|anruf\w*|handy|llam\w*|teléfono|móvil|telefone|telemóvel|celular|lig\w{1,3}|contat\w+|contact\w*|телефон\w*|звон\w+)\b")
_NOT_PHONE = re.compile(r"(?i)\b(?:isbn|issn|order|code|version|invoice|standard|clause|population|pages?|build|host|serial|part no|ssn|social security|passport|паспорт|cpf|dni|nif|nie|national number|steuer-?id|ausweis\w*|licen[cs]e|identity card|sécurité sociale|инн|снилс|page|seiten?|páginas?|rose from|no\.)\b")

# --- identity numbers ------------------------------------------------------------------------------------------------
_ID_LABEL = (
    r"passports?|sin|social\s+insurance|identity\s+card|id\s+card|driv(?:er|ing)['’]?s?\s+licen[cs]e|social\s+security|ssn|national\s+(?:insurance\s+)?number|tax\s+(?:id|number|payer)|nino|tin"
    r"|dni|nie|nif|niss|cpf|rg|curp|s[ée]curit[ée]\s+sociale|carte\s+(?:nationale\s+)?d['’]identit[ée]|passeport|permis\s+de\s+conduire|num[ée]ro\s+fiscal"
    r"|(?:personal)?ausweis\p{L}*|reisepass\p{L}*|f[üu]hrerschein\p{L}*|steuer-?\s?(?:id|nummer|identifikationsnummer)|sozialversicherungs\p{L}*"
    r"|pasaporte|carn[ée]\s+de\s+conducir|permiso\s+de\s+conducir|seguridad\s+social|passaporte|carteira\s+de\s+(?:identidade|motorista|habilitação)|bilhete\s+de\s+identidade|cart[ãa]o\s+de\s+cidad[ãa]o|contribuinte"
    r"|паспорт\p{L}*|инн|снилс|водительск\p{L}+\s+удостоверени\p{L}+"
)
ID_LABELLED = re.compile(rf"(?i)(?<![\p{{L}}\d])(?P<label>{_ID_LABEL})(?:\s+|\s*[:#№(-]\s*)(?:(?:no|nr|number|nummer|num|n[°º]|número|numéro|is|ist|es|é|est|серия|номер|№)[.:]?\s*){{0,2}}[:#№]?\s*(?P<v>(?-i:[A-ZА-Я]{{0,3}})[ -]?\d[\d\s. /‐‑-]*(?:\d|(?<=\d[ -]?)(?-i:[A-Z]))(?:-?(?-i:[A-Z]))?)(?![\p{{L}}\d])")
_DIGITS = re.compile(r"\d(?:[\s. /‐‑-]?[\dA-ZА-Я]){4,}")
_ISBN_CUE = re.compile(r"(?i)\b(?:isbn|order|code|version|build|invoice)\b")
_ID_CUE = re.compile(r"(?i)\b(?:papers?|lending form|belongs|document\w*|identi\w+|registo|ejemplar|dossier|дел\w|signed)\b")

# --- addresses -----------------------------------------------------------------------------------------------------
_CAP = r"\p{Lu}[\p{L}'’.-]*"
_STREETS_EN = r"Street|St\.?|Road|Rd\.?|Lane|Ln\.?|Avenue|Ave\.?|Mews|Terrace|Close|Drive|Dr\.?|Court|Ct\.?|Place|Pl\.?|Square|Sq\.?|Row|Hill|Gate|Way|Boulevard|Blvd\.?|Crescent|Gardens|Grove|Walk|Yard|Parade"
ADDRESSES = (
    (re.compile(rf"(?:(?i:flat|apt\.?|apartment|unit|suite|room)\s*\d+\s?\p{{L}}?,\s+)?(?<![\d\p{{L}}.,/-])\d{{1,5}}\s?[A-Za-z]?\s+(?!(?:The|A|An|This|In)\s)(?:{_CAP}\s+){{1,3}}(?:{_STREETS_EN})(?!\p{{L}})"), 1.0),
    (re.compile(rf"\d{{1,4}}(?:\s*(?:bis|ter|quater|[A-D]))?,?\s+(?i:rue|avenue|av\.|boulevard|bd\.?|place|quai|allée|chemin|impasse|cours|passage|route|square|ruelle|faubourg)\s+(?i:de\s+la\s+|de\s+l['’]\s*|des\s+|du\s+|de\s+|d['’]\s*)?{_CAP}"), 1.0),
    (re.compile(rf"(?<!\p{{L}})(?:Calle|C/|Avda\.?|Avenida|Plaza|Pza\.?|Paseo|Camino|Ronda|Travesía|Carrera|Glorieta|Rua|R\.|Av\.|Travessa|Praça|Largo|Alameda|Estrada|Rodovia|Beco|CALLE|AVENIDA|PLAZA|PASEO|RUA|TRAVESSA|PRAÇA)\s+(?:de\s+las?\s+|de\s+los\s+|del\s+|d[aeo]s?\s+)?{_CAP}(?:\s+(?:d[aeo]s?\s+|del\s+)?{_CAP}){{0,3}},?\s+(?:n[.ºo°]+\s*)?\d{{1,4}}\s?[A-Za-z]?(?![\p{{L}}\d])"), 1.0),
    (re.compile(rf"(?<!\p{{L}})(?i:ул\.|улица|пер\.|переулок|пр\.|пр-т|просп\.|проспект|пл\.|площадь|наб\.|набережная|бульвар|б-р|шоссе)\s+{_CAP}(?:\s+{_CAP})*,?\s+(?:д\.|дом)\s*\d+"), 1.0),
    (re.compile(rf"(?<!\p{{L}})(?:\p{{Lu}}\p{{L}}*-?(?:straße|strasse|str\.|gasse|allee|platz|chaussee)|\p{{Lu}}\p{{L}}+\s+(?:Straße|Strasse|Str\.|Gasse|Allee|Platz))\s+\d{{1,4}}(?:\s?[a-z])?(?![\p{{L}}\d])"), 1.0),
    (re.compile(r"(?<!\p{L})\p{Lu}\p{L}+(?:weg|damm|ring|ufer|steig|stieg|pfad|markt|graben|berg|hof|wall|brücke|kai|tor)\s+\d{1,4}(?:\s?[a-z])?(?![\p{L}\d])"), 0.6),
    (re.compile(r"(?<!\p{L})(?:Am|An\s+der|An\s+den|Auf\s+de[rmn]|Im|In\s+de[rmn]|Zum|Zur|Unter\s+den|Hinter\s+de[rmn]|Beim)\s+\p{Lu}\p{L}+(?:\s+\p{Lu}\p{L}+)?\s+\d{1,4}(?:\s?[a-z])?(?![\p{L}\d])"), 0.6),
)
#: Without one of these there is no address of the first sort.
_STREET_HINT = re.compile(rf"\s(?:{_STREETS_EN})(?!\p{{L}})")
_ADDRESS_CUE = re.compile(r"(?i)\b(?:anschrift|adresse|wohn\w+|address|lives?|visit|wrote from|proofs to|dirección|domicilio|endereço|mora|адрес|écrire|habite|demeure)\b")
_ADDRESS_AFTER = re.compile(r"\s*,\s*\d{4,6}\s+\p{Lu}|\s*,\s*\p{Lu}\p{L}+(?:\s+\d{5})?\s*(?:[.\n\r]|$)")
_NOT_ADDRESS = re.compile(r"\s*(?:Stück|Minuten|Prozent|Mal|mal|marks|%|Seiten)\b")

# --- names ---------------------------------------------------------------------------------------------------------
_TITLE = r"(?:Mr|Mrs|Ms|Miss|Mx|Dr|Prof|Professor|Sir|Lady|Rev|Herr|Frau|Hr|Fr|Mme|Mlle|Madame|Monsieur|Mademoiselle|Sr|Sra|Srta|Señora?|[Dd]on|[Dd]oña|Dra|[Dd]om|Senhora?|Dona|г-н|г-жа|господин|госпожа)"
_FAM = r"(?:(?:van|von|de|da|do|dos|del|der|den|di|du|le|la|zu|ten|af)\s+){0,2}\p{Lu}[\p{L}’']+(?:-\p{Lu}[\p{L}’']+)*"
_GIV = r"\p{Lu}[\p{L}’']+(?:-\p{Lu}[\p{L}’']+)?"
_INIT = r"(?:\s+\p{Lu}\.(?:\s?\p{Lu}\.)?)?"
TITLED = re.compile(rf"(?<![\p{{L}}\d-])(?:(?:{_TITLE})\.?|M\.|MM\.)\s+(?P<n>(?:{_GIV}{_INIT}\s+)?{_FAM})(?!\p{{L}})")
PAIR = re.compile(rf"(?<![\p{{L}}\d@.&-])(?=(?P<g>{_GIV}){_INIT}\s+(?P<f>{_FAM})(?![\p{{L}}@]))")
INVERTED = re.compile(rf"(?<![\p{{L}}\d@-])(?P<f>\p{{Lu}}[\p{{L}}’']+(?:-\p{{Lu}}[\p{{L}}’']+)*),\s+(?P<g>{_GIV}){_INIT}(?![\p{{L}}@’'-])")
_CUE_BEFORE = re.compile(
    r"(?:thanks?(?:\s+to)?|letters?\s+from|made\s+by|written\s+by|signed\s+by|edited\s+by|translated\s+by|belongs\s+to|belonged\s+to|proofs\s+to|write\s+to|dear|met|called|named"
    r"|dankt|gilt|bitte\s+an|schreiben\s+sie\s+an|von|merci\s+à|remercie|écrire\s+à|dossier\s+de|agradecemos\s+a|agradece\s+a|ejemplar\s+es\s+de|escriba\s+a|gracias\s+a|exemplar\s+é\s+de|escreva\s+a|obrigado\s+a|благодарит|пишите)\s+$",
    re.IGNORECASE,
)
_CUE_AFTER = re.compile(
    r"(?:\s+(?:can\s+be\s+reached|legte|wohnt|porte|vive|mora|lives|signed|wrote)\b|\s*[,(]\s*(?:passport|identity|ssn|social|driv|the\s+national|national|dni|nie|nif|cpf|n°|ausweis|steuer|who\s+lives|apt|flat|(?!0)\d{1,4}[A-Za-z]?\s+\p{Lu}|[\w.+-]+\s*(?:[@＠]|[\[(]at)))",
    re.IGNORECASE,
)
_FIRM_AFTER = re.compile(r"(?:\s+(?:&|and|und|et|y|e)\s+(?:Sons?|Söhne|Fils|Hijos|Filhos|Co|Company|Partners?|Brothers)|\s+(?:Ltd|Inc|LLC|GmbH|AG|KG|SA|S\.A|Lda|PLC|Works|Institute|Bindery|Press|Company|Co|Group|Bank|Paper|Printers?|University|College|School|Museum|Library|Foundation|Society|House|Hall|Street|St\.|Road|Rd|Lane|Avenue|Square|Bridge|Park|River|Bay|Island|Mountains?|Effect|Law|Theorem|Method|Principle|Constant|Equation|Test|Award|Prize|Verlag|Institut|Universität|Werke)\b|’s\s+(?:law|theorem|rule|method)|\s*&)")


@functools.lru_cache(maxsize=200_000)
def fold(s: str) -> str:
    """Without case and accents."""
    return "".join(c for c in unicodedata.normalize("NFD", s.casefold()) if not unicodedata.combining(c))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return len(digits) > 1 and total % 10 == 0


def mod97(body: str, key: str) -> bool:
    """French social security: the key is 97 less the remainder of the number."""
    return 97 - int(body) % 97 == int(key)


def cpf_valid(d: str) -> bool:
    def check(n: int) -> int:
        r = sum(int(d[i]) * (n + 1 - i) for i in range(n)) * 10 % 11
        return 0 if r == 10 else r

    return len(d) == 11 and check(9) == int(d[9]) and check(10) == int(d[10])


def dni_valid(d: str, letter: str) -> bool:
    return "TRWAGMYFPDXBNJZSQVHLCKE"[int(d) % 23] == letter


def nie_valid(lead: str, d: str, letter: str) -> bool:
    return dni_valid(str("XYZ".index(lead)) + d, letter)


def ssn_valid(d: str) -> bool:
    """No checksum, but areas, groups and serial numbers that are never given."""
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def snils_valid(d: str) -> bool:
    total = sum(int(c) * (9 - i) for i, c in enumerate(d[:9])) % 101 % 100
    return total == int(d[9:])


def inn_valid(d: str) -> bool:
    def check(weights: tuple[int, ...]) -> int:
        return sum(w * int(c) for w, c in zip(weights, d)) % 11 % 10

    return check((7, 2, 4, 10, 3, 5, 9, 4, 6, 8)) == int(d[10]) and check((3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8)) == int(d[11])


def steuer_valid(d: str) -> bool:
    """German tax number: a running product modulo 10 and 11."""
    p = 10
    for c in d[:10]:
        t = (int(c) + p) % 10 or 10
        p = t * 2 % 11
    return (11 - p) % 10 == int(d[10])


#: Numbers known by their shape alone: (pattern, score without a check, rule that confirms or refutes it).
ID_SHAPES = (
    (re.compile(r"(?<![\d.-])\d{3}\.\d{3}\.\d{3}-\d{2}(?![\d-])"), 1.0, lambda v, d: cpf_valid(d)),
    (re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"), 0.7, lambda v, d: ssn_valid(d)),
    (re.compile(r"(?<![\w-])\d{8}-?[A-Z](?![\w-])"), 0.7, lambda v, d: dni_valid(d, v[-1])),
    (re.compile(r"(?<![\w-])[XYZ]-?\d{7}-?[A-Z](?![\w-])"), 0.7, lambda v, d: nie_valid(v[0], d, v[-1])),
    (re.compile(r"(?<![\w.-])[12][ .]?\d{2}[ .]?\d{2}[ .]?\d{2}[ .]?\d{3}[ .]?\d{3}[ .]?\d{2}(?![\w-])"), 0.6, lambda v, d: mod97(d[:13], d[13:])),
    (re.compile(r"(?<![\d-])\d{3}-\d{3}-\d{3}[ -]\d{2}(?![\d-])"), 0.6, lambda v, d: snils_valid(d)),
    (re.compile(r"(?<![\d.-])\d{3}[ -]\d{3}[ -]\d{3}(?![\d-]|[ .]\d)"), 0.2, lambda v, d: luhn(d)),
)
#: What a check adds where it confirms a number, and takes off where it refutes it.
CONFIRMED, REFUTED = 0.4, 0.2
#: What a label before a number is worth.
LABELLED = 1.2


def checked(value: str, label: str) -> float:
    """What the rule of the sort of number that ``label`` names says of ``value``: 0 where there is none for it."""
    v, d, low = value.strip(), re.sub(r"\D", "", value), label.casefold()
    rule = None
    if low in ("cpf", "contribuinte") and len(d) == 11:
        rule = cpf_valid(d)
    elif low in ("dni", "nif") and len(d) == 8 and v[-1].isalpha():
        rule = dni_valid(d, v[-1])
    elif low == "nie" and len(d) == 7 and v[:1] in "XYZ" and v[-1].isalpha():
        rule = nie_valid(v[0], d, v[-1])
    elif low in ("ssn", "social security") and len(d) == 9:
        rule = ssn_valid(d)
    elif low.endswith("sociale") and len(d) == 15:
        rule = mod97(d[:13], d[13:])
    elif low == "снилс" and len(d) == 11:
        rule = snils_valid(d)
    elif low == "инн" and len(d) == 12:
        rule = inn_valid(d)
    elif low.startswith("steuer") and len(d) == 11:
        rule = steuer_valid(d)
    elif low in ("sin", "social insurance") and len(d) == 9:
        rule = luhn(d)
    return 0.0 if rule is None else CONFIRMED if rule else -REFUTED


def _near(text: str, start: int, cue: re.Pattern, width: int) -> int:
    """How near before ``start`` a cue ends, or -1."""
    last = -1
    lo = max(0, start - width)
    for m in cue.finditer(text, lo, start):
        last = m.end()
    return -1 if last < 0 else start - last


def _emails(text: str, out: list) -> None:
    if not EMAIL_HINT.search(text):
        return
    for m in EMAIL.finditer(text):
        out.append((m.start(), m.end(), "email"))


def _ids(text: str, out: list) -> None:
    at = 0
    for run in _DIGITS.finditer(text):  # labels are only looked for before a number
        for m in ID_LABELLED.finditer(text, max(at, run.start() - 80), min(len(text), run.end() + 8)):
            v = m["v"]
            at = m.end()
            # a label is worth more than the threshold, so that a number that its rule refutes is still one
            if sum(c.isdigit() for c in v) >= 6 and LABELLED + checked(v, " ".join(m["label"].split())) >= THRESHOLD:
                s = m.start("v") + len(v) - len(v.lstrip(" -"))
                out.append((s, m.start("v") + len(v.rstrip()), "id_number"))
    for shape, score, rule in ID_SHAPES:
        for m in shape.finditer(text):
            score_here = score + (CONFIRMED if rule(m[0], re.sub(r"\D", "", m[0])) else -REFUTED)
            score_here += 0.5 * (0 <= _near(text, m.start(), _ID_CUE, 60)) - 1.0 * (0 <= _near(text, m.start(), _ISBN_CUE, 25))
            if score_here >= THRESHOLD - 1e-9:
                out.append((m.start(), m.end(), "id_number"))


def _phone_score(v: str) -> float:
    bare = re.sub(r"\s*(?:ext\.?|x|App\.|poste|Durchwahl|доб\.)\s*\d+$", "", v)
    d = re.sub(r"\D", "", bare)
    if not 7 <= len(d) <= 15 or bare.count("\n") > 1:
        return 0.0
    if v[0] in "+＋" or bare.startswith("00") and bare[2:4].isdigit() and len(d) >= 11:
        return 1.0
    if re.fullmatch(r"(?:1[-. ])?\(?\d{3}\)?[-. ]\s?\d{3}[-.]\d{4}", bare) or re.fullmatch(r"\(0\d{2,5}\)\s*[\d\s/-]{5,12}", bare):
        return 1.0
    if re.fullmatch(r"0\d(?:[ .\n-]\d\d){4}", bare):
        return 0.8
    if d[0] == "0" and 9 <= len(d) <= 12:
        return 0.7
    return 0.5


def _phones(text: str, taken: list, out: list) -> None:
    for m in PHONE.finditer(text):
        if any(m.start() < e and s < m.end() for s, e, _ in taken):
            continue
        score = _phone_score(m[0])
        if not score:
            continue
        yes, no = _near(text, m.start(), _PHONE_CUE, 75), _near(text, m.start(), _NOT_PHONE, 40)
        if no >= 0 and (yes < 0 or no < yes):
            score -= 1.0
        elif yes >= 0:
            score += 0.5
        if score >= THRESHOLD:
            out.append((m.start(), m.end(), "phone"))


def _addresses(text: str, taken: list, out: list) -> None:
    for shape, score in ADDRESSES if _STREET_HINT.search(text) else ADDRESSES[1:]:
        for m in shape.finditer(text):
            if any(m.start() < e and s < m.end() for s, e, _ in taken) or _NOT_ADDRESS.match(text, m.end()):
                continue
            s = score + 0.5 * (0 <= _near(text, m.start(), _ADDRESS_CUE, 60)) + 0.5 * bool(_ADDRESS_AFTER.match(text, m.end()))
            if s >= THRESHOLD:
                out.append((m.start(), m.end(), "address"))


_PLAIN = re.compile(r"(?<![\p{L}\d@._+])\p{Ll}{2,}(?![\p{L}\d@_+])")


_plain: dict[str, tuple[str, ...]] = {}


def plain_words(text: str) -> set[str]:
    """Words that ``text`` writes in lower case outside mail addresses, in folded form. What stands between blanks is looked
    at once and remembered up to a bound."""
    if EMAIL_HINT.search(text):
        text = EMAIL.sub(" ", text)
    out: set[str] = set()
    if len(_plain) > 300_000:
        _plain.clear()
    for part in set(text.split()):
        got = _plain.get(part)
        if got is None:
            got = _plain[part] = tuple({fold(w) for w in _PLAIN.findall(part)})
        out.update(got)
    return out


_A_TITLE = re.compile(_TITLE + r"\Z")
TITLE, COMMA, PLAIN = range(3)


def proposed_names(text: str, taken: list) -> list[tuple]:
    """(start, end, sort, given, family, cued, upper, the) of what may be a name outside the spans ``taken``: with a title,
    with a comma between family and given name, or plain. Names are folded; ``the`` tells of an article before it."""
    out = []

    def free(s: int, e: int) -> bool:
        return not any(s < b and a < e for a, b, _ in taken)

    def cued(s: int, e: int) -> bool:
        return bool(_CUE_BEFORE.search(text, max(0, s - 30), s) or _CUE_AFTER.match(text, e))

    for m in TITLED.finditer(text):
        s, e = m.span("n")
        if free(s, e) and not _FIRM_AFTER.match(text, e):
            out.append((s, e, TITLE, None, fold(m["n"].split()[-1]), False, False, False))
    for m in INVERTED.finditer(text):
        s, e = m.start(), m.end()
        if free(s, e) and (m["f"].isupper() or cued(s, e)):
            out.append((s, e, COMMA, fold(m["g"]), fold(m["f"]), False, m["f"].isupper(), False))
    for m in PAIR.finditer(text):
        s, e = m.start("g"), m.end("f")
        if free(s, e) and not _FIRM_AFTER.match(text, e) and not _A_TITLE.match(m["g"]):
            out.append((s, e, PLAIN, fold(m["g"]), fold(m["f"].split()[-1]), cued(s, e), False, text[max(0, s - 4) : s].lower() == "the "))
    return out


def is_name(sort: int, cued: bool, the: bool, first: tuple[bool, bool], last: tuple[bool, bool]) -> bool:
    """Whether a proposal is a name, by whether its first and last word are (given names, common words)."""
    (g_given, g_common), (f_given, f_common) = first, last
    if sort == TITLE:
        return not f_common
    if sort == COMMA:
        return g_given and not f_common and not f_given
    score = 0.7 * g_given + 0.5 * cued + (-0.6 if f_common or f_given else 0.3) - 0.5 * (g_common and not g_given) - 0.5 * the
    return score >= 0.8 - 1e-9


def hard_spans(text: str) -> list[tuple[int, int, str]]:
    """Findings that no vocabulary is needed for."""
    hard: list = []
    _emails(text, hard)
    _ids(text, hard)
    _addresses(text, hard, hard)
    _phones(text, hard, hard)
    return hard


def joined(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans in order of place; overlapping ones of one kind are one."""
    out: list = []
    for s, e, k in sorted(spans):
        if out and out[-1][2] == k and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]), k)
        else:
            out.append((s, e, k))
    return out


def spans(text: str | None, given: set[str] = frozenset(), common: set[str] = frozenset()) -> list[tuple[int, int, str]]:
    """Findings in ``text`` as (start, end, kind), in order of place."""
    if not text or text.isspace():
        return []
    hard = hard_spans(text)
    fact = lambda w: (w in given, w in common)
    return joined(hard + [(s, e, "name") for s, e, sort, g, f, cued, _, the in proposed_names(text, hard) if is_name(sort, cued, the, fact(g), fact(f))])


def replaced(text: str, found: list[tuple[int, int, str]]) -> str:
    """``text`` with each finding replaced by its kind in angle brackets."""
    parts, at = [], 0
    for s, e, k in found:
        if e > at:
            parts += [text[at : max(s, at)], f"<{k.upper()}>"]
            at = e
    return "".join(parts) + text[at:]


def replace_spans(text: str | None, given: set[str] = frozenset(), common: set[str] = frozenset()) -> str | None:
    return replaced(text, spans(text, given, common)) if text else text


_SPAN = "array<struct<s: int, e: int, line: int, kind: string>>"
_NAME = "array<struct<s: int, e: int, line: int, sort: int, first: string, last: string, cued: boolean, the: boolean>>"
LOWER, INTRODUCED, PROPOSED = range(3)


def scanned(docs: DataFrame) -> DataFrame:
    """One pass over all texts, written once: rows (h, hard, names) with what each text (by its hash) proposes, and rows
    (word, sort, n) with the number of texts that write a word in lower case, introduce it as a given name, or propose it
    as part of a name."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        rows, c = [], {}
        for h, t in zip(cols["h"], cols["text"]):
            if t.isspace():
                continue
            hard = hard_spans(t)
            names = proposed_names(t, hard)
            words = {(w, LOWER) for w in plain_words(t)}
            words |= {(n[3], INTRODUCED) for n in names if n[2] == PLAIN and n[5]} | {(w, PROPOSED) for n in names for w in (n[3], n[4]) if w}
            for k in words:
                c[k] = c.get(k, 0) + 1
            if hard or names:
                ends = [m.start() for m in re.finditer("\n", t)]
                line = lambda s: bisect.bisect_left(ends, s) + 1
                rows.append((h, [{"s": s, "e": e, "line": line(s), "kind": k} for s, e, k in hard], [{"s": n[0], "e": n[1], "line": line(n[0]), "sort": n[2], "first": n[3], "last": n[4], "cued": n[5], "the": n[7]} for n in names]))
        n, m = len(rows), len(c)
        return {
            "h": [r[0] for r in rows] + [None] * m, "hard": [r[1] for r in rows] + [None] * m, "names": [r[2] for r in rows] + [None] * m,
            "word": [None] * n + [k[0] for k in c], "sort": [None] * n + [k[1] for k in c], "n": [None] * n + list(c.values()),
        }

    own = docs.where(F.length("text") > 0).select(_digest().alias("h"), "text")
    return hub(arrow_map(own, run, f"h string, hard {_SPAN}, names {_NAME}, word string, sort int, n bigint"))


def _digest() -> Column:
    return F.md5(F.encode("text", "UTF-8"))


def vocabulary(read: DataFrame, names: DataFrame) -> DataFrame:
    """Rows (word, given, common) of the words that are proposed as part of a name; all listed names are given names."""
    count = lambda sort: F.sum(F.when(F.col("sort") == sort, F.col("n")).otherwise(0))
    n = read.where("word is not null").groupBy("word").agg(count(LOWER).alias("low"), count(INTRODUCED).alias("cued"), count(PROPOSED).alias("named")).where("named > 0")
    listed = arrow_map(names.select("given_name").where("given_name is not null"), lambda c: {"word": [fold(x) for x in c["given_name"]]}, "word string").distinct().withColumn("listed", F.lit(True))
    given = F.coalesce("listed", F.lit(False)) | (F.col("cued") / (F.col("cued") + F.col("low") + 2) >= CUED)
    return n.join(listed, "word", "left").select("word", given.alias("given"), (F.col("low") / (F.col("low") + F.col("named") + 1) >= COMMON).alias("common"))


def findings(docs: DataFrame, names: DataFrame) -> DataFrame:
    """Rows (h, spans): the findings of each distinct text that has any, in order of place."""
    read = scanned(docs)
    known = cut_lineage(vocabulary(read, names))
    texts = read.where("h is not null").select("h", "hard", "names").dropDuplicates(["h"])
    each = texts.select("h", F.explode("names").alias("n")).select("h", "n.*")
    facts = lambda side: known.select(F.col("word").alias(side), F.struct("given", "common").alias(f"{side}_is"))
    judged = each.join(facts("first"), "first", "left").join(facts("last"), "last", "left").groupBy("h").agg(F.collect_list(F.struct("s", "e", "line", "sort", "cued", "the", "first_is", "last_is")).alias("names"))

    def run(cols: dict[str, list]) -> dict[str, list]:
        out = []
        fact = lambda x: (x["given"], x["common"]) if x else (False, False)
        for hard, proposals in zip(cols["hard"], cols["names"]):
            lines = {x["s"]: x["line"] for x in (*hard, *(proposals or ()))}
            got = [(x["s"], x["e"], x["kind"]) for x in hard]
            got += [(x["s"], x["e"], "name") for x in proposals or () if is_name(x["sort"], x["cued"], x["the"], fact(x["first_is"]), fact(x["last_is"]))]
            out.append([{"s": s, "e": e, "line": lines[s], "kind": k} for s, e, k in joined(got)])
        return {"h": cols["h"], "spans": out}

    return arrow_map(texts.drop("names").join(judged, "h", "left"), run, f"h string, spans {_SPAN}")


def found(docs: DataFrame, names: DataFrame) -> DataFrame:
    """Rows (doc_id, line_no, kind): one for each line and kind where a mention begins; lines are split at newline."""
    own = docs.where(F.col("doc_id").isNotNull() & (F.length("text") > 0)).select(F.col("doc_id").cast("bigint"), _digest().alias("h"))
    rows = own.join(findings(docs, names), "h").select("doc_id", F.explode("spans").alias("x"))
    return rows.select("doc_id", F.col("x.line").cast("bigint").alias("line_no"), F.col("x.kind").alias("kind")).distinct()


def redact(docs: DataFrame, names: DataFrame) -> DataFrame:
    """Rows (doc_id, text, redacted): each document with its findings replaced by typed placeholders."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        out = [replaced(t, [(x["s"], x["e"], x["kind"]) for x in f]) if f else t for t, f in zip(cols["text"], cols["spans"])]
        return {"doc_id": cols["doc_id"], "text": cols["text"], "redacted": out}

    rows = docs.select(F.col("doc_id").cast("bigint"), "text", _digest().alias("h")).join(findings(docs, names), "h", "left")
    return arrow_map(rows.select("doc_id", "text", "spans"), run, "doc_id bigint, text string, redacted string")

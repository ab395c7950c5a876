"""SQL for the same results as the document queries, built up from one chain of common table expressions."""

from __future__ import annotations

from quire.functions import text as T
from quire.operators import compile as C
from quire.operators import layout as L


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def has(col: str, pattern: str) -> str:
    return f"regexp_matches({col}, {q(pattern)})"


def strip(c: str) -> str:
    return f"trim({c}, {q(T.BLANKS)})"


def words(c: str) -> str:
    return f"len(regexp_extract_all({c}, {q(T.WORD)}))"


def tokens(c: str) -> str:
    return f"greatest({words(c)}, floor({words(c)} * 1.33::DOUBLE)::BIGINT)"


def norm(c: str) -> str:
    return f"regexp_replace(lower({c}), '[^a-z0-9]', '', 'g')"


def lines(c: str) -> str:
    return f"regexp_split_to_array(regexp_replace({c}, {q('(?:' + T.LINE_END + ')$')}, ''), {q(T.LINE_END)})"


def mended(c: str) -> str:
    plain = c
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", chr(160)), ("&amp;", "&")):
        plain = f"replace({plain}, {q(a)}, {q(b)})"
    c = f"CASE WHEN contains({c}, '<') THEN {c} ELSE {plain} END"
    # a text each of whose characters is one byte under code page 1252, read as UTF-8 where that works
    page = {b: bytes([b]).decode("cp1252", "ignore") for b in range(128, 160)}
    raw = f"translate(x, {q(''.join(v for v in page.values() if v))}, {q(''.join(chr(b) for b, v in page.items() if v))})"
    bytes_ = f"list_aggregate(list_transform(string_split(r, ''), lambda h: printf('%02x', unicode(h))), 'string_agg', '')"
    out = f"(SELECT CASE WHEN regexp_full_match(r, '[\\x{{00}}-\\x{{ff}}]*', 's') AND regexp_matches(r, '[\\x{{c2}}-\\x{{f4}}][\\x{{80}}-\\x{{bf}}]') THEN coalesce(TRY(decode(unhex({bytes_}))), x) ELSE x END FROM (SELECT x, {raw} AS r FROM (SELECT {c} AS x)))"
    wide = [chr(x) for x in range(0xFF01, 0xFF5F)]
    out = f"translate({out}, {q(''.join(wide) + chr(0x3000))}, {q(''.join(chr(ord(x) - 0xFEE0) for x in wide) + ' ')})"
    out = f"regexp_replace({out}, {q(chr(13) + chr(10) + '?|[' + chr(0x85) + chr(0x2028) + chr(0x2029) + ']')}, {q(chr(10))}, 'g')"
    return f"regexp_replace({out}, '[\\x{{01}}-\\x{{08}}\\x{{0b}}\\x{{0e}}-\\x{{1f}}\\x{{7f}}]', '', 'g')"


def clean(c: str) -> str:
    c = f"translate({mended(c)}, {q(T.CURLY)}, {q(T.STRAIGHT)})"
    for a, b in (*T.LIGATURES, *T.TORN):
        c = f"replace({c}, {q(a)}, {q(b)})"
    for head, word in T.SPACED:
        c = f"regexp_replace({c}, {q(T.spaced_pattern(head))}, {q(word)}, 'g')"
    for x in "\xad\x02�":
        c = f"replace({c}, {q(x)}, '')"
    joined = r"(^|[^\p{L}\p{N}_])([a-zA-Z]{3,})-\s*\n\s*([a-z]{2,})($|[^\p{L}\p{N}_])"
    for _ in range(2):  # a match takes in the blank that the next one needs
        c = f"regexp_replace({c}, {q(joined)}, '\\1\\2\\3\\4', 'g')"
    return c


def is_code(t: str) -> str:
    coded, full = has(t, T.CODE_WORDS), f"[x FOR x IN {lines(t)} IF {strip('x')} <> '']"
    return f"""CASE WHEN {t} = '' THEN false WHEN {has(t, T.ADDRESS)} AND NOT {coded} THEN false
      WHEN NOT contains({t}, chr(10)) AND {has(t, T.REFERENCE)} THEN false
      WHEN NOT contains({t}, chr(10)) AND {words(t)} <= 2 AND NOT {coded} THEN false
      WHEN len({full}) >= 2 THEN len([x FOR x IN {full} IF NOT {has("x", T.ADDRESS_LINE)}]) > 0
      ELSE {coded} AND length({t}) > 10 END"""


def code_language(c: str) -> str:
    return f"""CASE WHEN {has(f"lower({c})", T.ASM_WORDS)} THEN CASE WHEN {has(f"lower({c})", T.X64_WORDS)} THEN 'x64_asm' ELSE 'x86_asm' END
      WHEN {has(c, T.C_WORDS)} THEN 'c' WHEN {has(c, T.PYTHON_WORDS)} THEN 'python' ELSE 'asm' END"""


def fenced(c: str) -> str:
    return f"('```' || ({code_language(c)}) || chr(10) || {c} || chr(10) || '```')"


def crumbs(c: str) -> str:
    return f"array_to_string({c}, ' > ')"


def names(xs: list[str]) -> str:
    return "[" + ", ".join(q(x) for x in xs) + "]"


def any_of(c: str, terms: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({c}, {q(t)})" for t in terms) + ")"


_W = f"regexp_split_to_array(lower(raw_text), {q(L.NOT_A_NAME)})"
STEPS = {
    "blk": f"""SELECT block_uid, book_id, page_idx, blk_ord, block_id, bbox[1] AS x0, bbox[2] AS y0, bbox[3] AS x1, bbox[4] AS y1, coalesce(raw_text, '') AS raw_text,
      {strip("coalesce(raw_text, '')")} AS txt, coalesce(block_type, 'paragraph') AS block_type, coalesce(is_bold, false) AS is_bold, coalesce(is_mono, false) AS is_mono
      FROM raw_blocks QUALIFY row_number() OVER (PARTITION BY block_uid ORDER BY ingested_at DESC) = 1""",
    "pg": """SELECT book_id, page_idx, coalesce(width, 530.0) AS width, coalesce(height, 660.0) AS height, is_scanned, coalesce(char_count, 0) AS char_count
      FROM page_data QUALIFY row_number() OVER (PARTITION BY book_id, page_idx ORDER BY ingested_at DESC) = 1""",
    "marg": """SELECT *, (y0 < height * 0.06 OR y1 > height * 0.94) AS inm FROM
      (SELECT blk.*, coalesce(width, 530.0) AS width, coalesce(height, 660.0) AS height FROM blk LEFT JOIN pg USING (book_id, page_idx))""",
    "freq": "SELECT book_id, txt, count(*) AS n FROM marg WHERE inm GROUP BY ALL",
    "furn": f"""SELECT m.* EXCLUDE (block_type), CASE WHEN {has("txt", L.WATERMARK)} OR {has("txt", L.PRINT_MARK)}
      OR inm AND (coalesce(n, 0) >= 2 OR {has("txt", L.PAGE_NUMBER)} OR {has("txt", L.RUNNING_HEAD)} AND length(txt) < 40 OR contains(txt, '■') AND length(txt) < 50)
      THEN 'furniture' ELSE block_type END AS block_type FROM marg m LEFT JOIN freq USING (book_id, txt)""",
    "o1": """SELECT *, x1 <= width / 2 + 10 AS l, x0 >= width / 2 - 10 AS r, x0 < width / 2 - 10 AND x1 > width / 2 + 10 AS s FROM furn WHERE block_type <> 'furniture'""",
    "o2": """SELECT *, (sum(l::INT) OVER w >= 2 AND sum(r::INT) OVER w >= 2 AND (sum(l::INT) OVER w + sum(r::INT) OVER w) / (count(*) OVER w) >= 0.75 AND sum(s::INT) OVER w <= 2) AS two_col
      FROM o1 WINDOW w AS (PARTITION BY book_id, page_idx)""",
    "o3": """SELECT *, CASE WHEN NOT two_col THEN 0 WHEN s AND y0 < height * 0.3 THEN 0 WHEN l THEN 1 WHEN r THEN 2 ELSE 3 END AS zone, round_even(y0 / 3.5, 0)::BIGINT AS bucket FROM o2""",
    "o4": """SELECT *, row_number() OVER (PARTITION BY book_id, page_idx ORDER BY zone, CASE WHEN two_col AND zone IN (0, 3) THEN y0 ELSE bucket END,
      CASE WHEN two_col AND zone IN (0, 3) THEN 0 ELSE x0 END, blk_ord) - 1 AS rk FROM o3""",
    "ban": f"SELECT book_id, page_idx, min(rk) AS f, arg_min(y0 < height * 0.3, rk) AS top FROM o4 WHERE {has('raw_text', L.BANNER)} GROUP BY ALL",
    "ord": """SELECT o4.*, CASE WHEN top AND f > 0 AND rk = f THEN 0 WHEN top AND f > 0 AND rk < f THEN rk + 1 ELSE rk END AS rank FROM o4 LEFT JOIN ban USING (book_id, page_idx)""",
    "tc": f"SELECT DISTINCT book_id, page_idx, toc_ord, title, level, {norm('title')} AS nt FROM toc WHERE page_idx IS NOT NULL AND title IS NOT NULL",
    "hit": f"""SELECT block_uid, arg_min(title, toc_ord) AS toc_title, arg_min(level, toc_ord) AS toc_level FROM (SELECT *, {norm("txt")} AS nb FROM ord) JOIN tc USING (book_id, page_idx)
      WHERE length(nt) >= 4 AND (contains(nb, nt) OR contains(nt, nb)) GROUP BY ALL""",
    "st0": f"""SELECT ord.*, toc_title, toc_level, is_bold AND length(txt) < 100 AND NOT {has("txt", "[.;:,]$")} AS strong FROM ord LEFT JOIN hit USING (block_uid)""",
    "st": f"""SELECT * EXCLUDE (block_type), CASE WHEN toc_title IS NOT NULL THEN 'heading' WHEN strong AND {has("txt", L.HEADING)} THEN 'heading'
      WHEN NOT strong AND block_type = 'heading' THEN 'paragraph' ELSE block_type END AS block_type,
      CASE WHEN toc_title IS NOT NULL THEN toc_level WHEN strong AND {has("txt", L.HEADING)} THEN 1 WHEN strong AND block_type = 'heading' THEN 2 END AS level FROM st0""",
    "ends": """SELECT book_id, page_idx, arg_min(block_id, rank) AS fid, arg_min(block_type, rank) AS ft, arg_max(block_id, rank) AS lid, arg_max(block_type, rank) AS lt, arg_max(raw_text, rank) AS lx FROM st GROUP BY ALL""",
    "ty0": f"""SELECT *, list_has_any({_W}, {names(L.REGISTERS)}) AS reg, list_has_any({_W}, {names(L.C_NAMES)}) AS cname FROM st""",
    "ty1": f"""SELECT *, is_mono OR block_type = 'code' OR {has("raw_text", L.LINE_NUMBER)} OR reg AND ({has("raw_text", L.MEMORY)} OR {has("raw_text", L.HEX)}) AS code FROM ty0""",
    "ty": f"""SELECT * EXCLUDE (block_type), CASE WHEN code THEN CASE WHEN cname AND NOT reg THEN 'c' ELSE 'x86_asm' END END AS language,
      CASE WHEN code THEN 'code' WHEN {has("txt", r"^(?:1[.]|2[.]|3[.]|■|•|-)")} AND block_type <> 'heading' THEN 'list_item' ELSE block_type END AS block_type FROM ty1""",
    "n0": """SELECT *, CASE WHEN block_type = 'heading' THEN CASE WHEN level = 0 OR contains(raw_text, 'Chapter') THEN 'chapter' ELSE 'section' END ELSE block_type END AS node_type,
      row_number() OVER (PARTITION BY book_id ORDER BY page_idx, rank, blk_ord, block_uid) - 1 AS node_ord FROM ty""",
    "n1": """SELECT *, last_value(CASE WHEN node_type = 'chapter' THEN block_id END IGNORE NULLS) OVER w AS chap_id, last_value(CASE WHEN node_type = 'chapter' THEN raw_text END IGNORE NULLS) OVER w AS chap_title,
      last_value(CASE WHEN node_type IN ('chapter', 'section') THEN block_id END IGNORE NULLS) OVER w AS head_id, last_value(CASE WHEN node_type IN ('chapter', 'section') THEN raw_text END IGNORE NULLS) OVER w AS head_title,
      last_value(CASE WHEN node_type IN ('chapter', 'section') THEN node_type END IGNORE NULLS) OVER w AS head_sort FROM n0
      WINDOW w AS (PARTITION BY book_id ORDER BY node_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "nodes": f"""SELECT book_id, node_ord, page_idx, block_id AS node_id, node_type, CASE WHEN node_type IN ('chapter', 'section') THEN raw_text END AS title, {clean("raw_text")} AS text, language,
      CASE WHEN node_type = 'chapter' THEN 'root' WHEN node_type = 'section' THEN coalesce(chap_id, 'root') ELSE coalesce(head_id, 'root') END AS parent_id,
      [x FOR x IN [CASE WHEN node_type <> 'chapter' THEN chap_title END, CASE WHEN node_type NOT IN ('chapter', 'section') AND head_sort = 'section' THEN head_title END] IF x IS NOT NULL] AS breadcrumbs FROM n1""",
    "bn": f"""SELECT *, {strip("text")} AS s, lower({strip("coalesce(title, '')")}) AS lt, [lower(x) FOR x IN breadcrumbs] AS lc, max(page_idx) OVER (PARTITION BY book_id) + 1 AS total_pages FROM nodes""",
    "bn2": f"""SELECT *, [x FOR x IN [{strip("y")} FOR y IN string_split(s, chr(10))] IF x <> ''] AS ls FROM bn""",
    "boil": f"""SELECT *, (page_idx < least(15, greatest(5, floor(total_pages * 0.05::DOUBLE))) AND ({" OR ".join(has("s", p) for p in C.FRONT_MATTER)} OR {any_of("lt", C.FRONT_TITLES)})
      OR (contains(lt, 'index') OR len([x FOR x IN lc IF contains(x, 'index')]) > 0) AND (lt IN ('index', 'subject index', 'author index') OR len([x FOR x IN lc IF x IN ('index', 'subject index')]) > 0)
      OR page_idx > greatest(20, total_pages - 30) AND len(ls) >= 4 AND len([x FOR x IN ls IF {has("x", C.INDEX_LINE)}]) / len(ls) > 0.6) AS boilerplate FROM bn2""",
    "tr": "SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY node_ord) - 1 AS t FROM boil WHERE NOT boilerplate",
    "bt": r"SELECT book_id, max(regexp_extract(path, '([^/]+?)(?:[.][^./]*)?$', 1)) AS book_title FROM books GROUP BY ALL",
    "p0": """SELECT *, node_type = 'chapter' OR node_type = 'section' AND starts_with(lower(""" + strip("title") + """), 'chapter') AS opens, page_idx + 1 AS page FROM tr WHERE s <> ''""",
    "p1": f"""SELECT *, sum(coalesce(opens, false)::INT) OVER (PARTITION BY book_id ORDER BY t) AS grp, CASE WHEN coalesce(opens, false) THEN '# ' || title WHEN node_type = 'section' THEN '## ' || title
      WHEN node_type = 'code' THEN {fenced("s")} ELSE s END AS line, CASE WHEN node_type = 'code' THEN {fenced("s")} ELSE s END AS plain FROM p0""",
    "p2": f"""SELECT book_id, grp, {strip("string_agg(line, chr(10) || chr(10) ORDER BY t)")} AS text, arg_min(title, t) FILTER (opens) AS ot, arg_min(page, t) FILTER (opens) AS op, max(page) AS last, any_value(total_pages) AS total_pages FROM p1 GROUP BY ALL""",
    "p3": f"""SELECT book_id, book_title, grp, coalesce(ot, book_title) AS chapter_title, coalesce(op, 1) AS page_start, CASE WHEN op IS NULL THEN greatest(1, last) ELSE last END AS page_end, text
      FROM p2 JOIN bt USING (book_id) WHERE {words("text")} >= 40 AND NOT (coalesce(op, 1) < 25 AND {any_of("lower(coalesce(ot, book_title))", C.OPENING_TITLES)})""",
    "p4": """SELECT * FROM p3 UNION ALL SELECT book_id, book_title, 0, book_title, 1, page_end, text FROM (SELECT book_id, string_agg(plain, chr(10) || chr(10) ORDER BY t) AS text, any_value(total_pages) AS page_end FROM p1
      WHERE book_id NOT IN (SELECT book_id FROM p3) GROUP BY ALL) JOIN bt USING (book_id)""",
    "s0": f"""SELECT *, node_type IN ('chapter', 'section') AS head, node_type = 'code' AS code, CASE WHEN node_type = 'code' THEN {fenced("text")} ELSE s END AS x, {strip("title")} AS st FROM tr""",
    "ahead": """SELECT a.book_id, a.t, min(b.t) FILTER (b.head) AS stop FROM s0 a JOIN s0 b ON a.book_id = b.book_id AND b.t BETWEEN a.t + 1 AND a.t + 7 GROUP BY ALL""",
    "prose": """SELECT a.book_id, a.t, string_agg(b.x, chr(10) || chr(10) ORDER BY b.t) AS p FROM ahead a JOIN s0 b ON a.book_id = b.book_id AND b.t BETWEEN a.t + 1 AND a.t + 7 AND b.t < coalesce(a.stop, a.t + 8) AND b.s <> '' GROUP BY ALL""",
    "sa": f"""SELECT book_id, t, 1 AS rk, 0 AS pos, {q(C.ASK_CONCEPT[0])} || st || CASE WHEN len(breadcrumbs) > 0 THEN ' in ' || breadcrumbs[-1] ELSE '' END || {q(C.ASK_CONCEPT[1])} AS instruction, '' AS input, p AS output, 'concept_qa' AS category, page_idx + 1 AS source_page, breadcrumbs
      FROM s0 JOIN prose USING (book_id, t) WHERE node_type = 'section' AND title <> '' AND {has("st", "[a-zA-Z]")} AND NOT {has("lower(st)", "^(?:" + "|".join(C.NO_QUESTION_PREFIXES) + ")")} AND st NOT IN ({", ".join(q(x) for x in C.NO_QUESTION_TITLES)})
      AND {words("st")} <= 8 AND length(st) <= 60 AND NOT (page_idx + 1 < 29 AND {any_of("lower(st)", C.NO_QUESTION_TERMS)}) AND {words("p")} >= 30""",
    "near": """SELECT a.book_id, a.t, string_agg(b.s, chr(10) || chr(10) ORDER BY b.t) AS p FROM s0 a JOIN s0 b ON a.book_id = b.book_id AND b.t IN (a.t - 1, a.t + 1) AND NOT b.head AND NOT b.code WHERE a.code GROUP BY ALL""",
    "sb": f"""SELECT book_id, t, 1 AS rk, 0 AS pos, {q(C.ASK_CODE)} AS instruction, {fenced("s")} AS input, p AS output, 'code_walkthrough' AS category, page_idx + 1 AS source_page, breadcrumbs FROM s0 JOIN near USING (book_id, t) WHERE {is_code("s")} AND {words("p")} >= 15""",
    "sft": f"""SELECT book_id, printf('sft_%04d', row_number() OVER (PARTITION BY book_id ORDER BY source_page, t, rk, pos)) AS id, category, source_page, breadcrumbs, instruction, input, {strip("output")} AS output
      FROM (SELECT * FROM sa UNION ALL SELECT * FROM sb) WHERE {words(strip("output"))} >= 15""",
    "c0": "SELECT *, lag(s) OVER w AS ps, lead(s) OVER w AS ns FROM bn WINDOW w AS (PARTITION BY book_id ORDER BY node_ord)",
    "code": f"""SELECT book_id, printf('code_%04d', row_number() OVER (PARTITION BY book_id ORDER BY page_idx, node_ord)) AS code_id, page_idx + 1 AS page, {code_language("s")} AS language, breadcrumbs,
      array_to_string([x FOR x IN [ps, ns] IF x IS NOT NULL AND x <> ''], chr(10) || chr(10)) AS surrounding_context, s AS code, len({lines("s")}) AS line_count FROM c0 WHERE node_type = 'code' AND {is_code("s")}""",
    "r0": f"""SELECT *, sum((node_type IN ('chapter', 'section'))::INT) OVER (PARTITION BY book_id ORDER BY t) AS sec FROM tr""",
    "r1": f"""SELECT book_id, sec, text, t, {words("text")} AS w, row_number() OVER (PARTITION BY book_id, sec ORDER BY t) AS i FROM r0 WHERE node_type NOT IN ('chapter', 'section') AND s <> ''""",
    "r2": f"""SELECT book_id, sec, i, 0 AS part, w AS total FROM r1 WHERE i = 1 UNION ALL
      SELECT r1.book_id, r1.sec, r1.i, CASE WHEN r2.total > {C.CHUNK_WORDS} THEN part + 1 ELSE part END, CASE WHEN r2.total > {C.CHUNK_WORDS} THEN w ELSE r2.total + w END FROM r2 JOIN r1 ON r1.book_id = r2.book_id AND r1.sec = r2.sec AND r1.i = r2.i + 1""",
    "r3": """SELECT book_id, sec, part, string_agg(text, chr(10) || chr(10) ORDER BY t) AS content FROM r1 JOIN r2 USING (book_id, sec, i) GROUP BY ALL""",
    "r4": """SELECT book_id, sec, list_append(breadcrumbs, title) AS crumbs, page_idx + 1 AS hpage FROM r0 WHERE node_type IN ('chapter', 'section')""",
    "rag": """SELECT book_id, printf('chunk_%04d', row_number() OVER (PARTITION BY book_id ORDER BY sec, part) - 1) AS chunk_id, coalesce(hpage, 1) AS page, coalesce(crumbs, []) AS breadcrumbs, content FROM r3 LEFT JOIN r4 USING (book_id, sec)""",
}


def chain(last: str, select: str) -> str:
    """``select`` after all steps up to ``last``. Steps that are read more than once are worked out once."""
    steps = list(STEPS)
    used = steps[: steps.index(last) + 1]
    return "WITH RECURSIVE " + ",\n".join(f"{k} AS {'' if k == 'r2' else 'MATERIALIZED '}({STEPS[k]})" for k in used) + f"\n{select}"


# --- spans: words of blocks laid out in lines of eight, then lines and blocks of pages --------------------------------
_SPAN_STEPS = r"""
w0 AS (SELECT DISTINCT block_uid, book_id, page_idx, bbox, raw_text, coalesce(is_bold, false) AS bold, coalesce(is_mono, false) AS mono FROM raw_blocks WHERE raw_text IS NOT NULL),
w1 AS (SELECT *, list_filter(regexp_split_to_array(raw_text, '[ \t\n\r]+'), lambda x: x <> '') AS ws FROM w0),
w2 AS (SELECT *, unnest(ws) AS text, unnest(range(len(ws))) AS i FROM w1),
w3 AS (SELECT block_uid, book_id, page_idx, i, text, mono, CASE WHEN bold THEN 700 ELSE 400 END AS weight, coalesce(bbox[1], 50.0) + 40.0 * (i % 8) AS x0, coalesce(bbox[2], 50.0) + 12.0 * (i // 8) + 0.5 * (i % 3) AS y0 FROM w2),
sp AS (SELECT *, x0 + least(39.0, 5.0 * length(text)) AS x1, y0 + 10.0 AS y1, row_number() OVER (PARTITION BY book_id, page_idx ORDER BY round_even(y0 / 3.5, 0), x0, block_uid, i) AS seq FROM w3),
an AS (SELECT book_id, page_idx, seq, y0 AS anchor, 0 AS line FROM sp WHERE seq = 1
  UNION ALL SELECT s.book_id, s.page_idx, s.seq, CASE WHEN abs(s.y0 - a.anchor) <= 3.5 THEN a.anchor ELSE s.y0 END, a.line + CASE WHEN abs(s.y0 - a.anchor) <= 3.5 THEN 0 ELSE 1 END
  FROM an a JOIN sp s ON s.book_id = a.book_id AND s.page_idx = a.page_idx AND s.seq = a.seq + 1),
ln AS (SELECT sp.*, an.line, lag(text) OVER l AS pt, lag(x1) OVER l AS px, row_number() OVER l AS r FROM sp JOIN an USING (book_id, page_idx, seq) WINDOW l AS (PARTITION BY book_id, page_idx, an.line ORDER BY x0, seq)),
tx AS (SELECT book_id, page_idx, line, string_agg(CASE WHEN pt IS NULL OR right(pt, 1) IN ('-', '[', '(') OR left(text, 1) IN (']', ')', ',', '.', ';', ':') OR x0 - px <= 2.0 THEN '' ELSE ' ' END || text, '' ORDER BY x0, seq) AS text0,
  round_even(min(x0), 2) AS x0, round_even(min(y0), 2) AS y0, round_even(max(x1), 2) AS x1, round_even(max(y1), 2) AS y1, avg(weight) >= 600 AS is_bold, sum(CASE WHEN mono THEN length(text) ELSE 0 END) / sum(length(text)) >= 0.5 AS most, bool_or(r = 1 AND mono) AS first_mono FROM ln GROUP BY ALL),
li AS (SELECT book_id, page_idx, line, t AS text, x0, y0, x1, y1, is_bold, most OR (first_mono AND regexp_matches(t, '^(01:|02:|;|//|mov|push|pop|add|sub|xor|call|ret)')) AS is_mono FROM (SELECT *, {strip} AS t FROM tx) z WHERE t <> ''),
br AS (SELECT *, CASE WHEN lag(line) OVER p IS NULL OR is_mono <> lag(is_mono) OVER p OR (is_bold AND length(text) < 120 AND right(text, 1) NOT IN ('.', ';', ':')) OR y0 - lag(y1) OVER p > 15.0 OR regexp_matches(text, '^(■|•|-|\*|1\.|2\.|3\.)') THEN 1 ELSE 0 END AS b FROM li WINDOW p AS (PARTITION BY book_id, page_idx ORDER BY line)),
bk AS (SELECT *, sum(b) OVER (PARTITION BY book_id, page_idx ORDER BY line) - 1 AS blk_ord FROM br),
bg AS (SELECT book_id, page_idx, blk_ord, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS n, sum(length(text)) AS size, arg_min(text, line) AS head, arg_max(text, line) AS tail, arg_min(is_bold, line) AS is_bold, sum(CASE WHEN is_mono THEN length(text) ELSE 0 END) / sum(length(text)) >= 0.5 AS is_mono FROM bk GROUP BY ALL),
bt AS (SELECT book_id, page_idx, blk_ord, string_agg(k.text, ' ' ORDER BY line) AS prose, string_agg(repeat(' ', greatest(0, round_even((k.x0 - g.x0) / 6.0, 0))::BIGINT) || k.text, chr(10) ORDER BY line) AS code FROM bk k JOIN bg g USING (book_id, page_idx, blk_ord) GROUP BY ALL)"""
SPAN_LINES = "WITH RECURSIVE " + _SPAN_STEPS.strip().replace("{strip}", strip("text0")) + " SELECT book_id, page_idx::BIGINT AS page_idx, line::BIGINT AS line, text, x0, y0, x1, y1, is_bold, is_mono FROM li"
SPAN_BLOCKS = "WITH RECURSIVE " + _SPAN_STEPS.strip().replace("{strip}", strip("text0")) + """ SELECT book_id, page_idx::BIGINT AS page_idx, blk_ord::BIGINT AS blk_ord, x0, y0, x1, y1, CASE WHEN is_mono THEN code ELSE prose END AS raw_text,
  CASE WHEN is_mono THEN 'code' WHEN is_bold AND n <= 2 AND size < 120 AND right(tail, 1) NOT IN ('.', ';') THEN 'heading' WHEN regexp_matches(head, '^(■|•|-|\\*)') THEN 'list_item' ELSE 'paragraph' END AS block_type, is_bold, is_mono FROM bg JOIN bt USING (book_id, page_idx, blk_ord)"""

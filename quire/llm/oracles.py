"""SQL of the same results, for the queries that SQL can express on the test tables."""

from __future__ import annotations

import unicodedata

from quire.llm import visual
from quire.llm.splits import NOBODY


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


P6 = r"""
WITH b AS (SELECT block_uid, any_value(clean_text) AS t FROM raw_blocks WHERE clean_text IS NOT NULL GROUP BY ALL),
w AS (SELECT block_uid, regexp_extract_all(lower(t), '[\p{L}\p{N}]+') AS w FROM b),
s AS (SELECT DISTINCT block_uid, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT block_uid, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 25)),
n AS (SELECT block_uid, count(*) AS n FROM s GROUP BY ALL),
c AS (SELECT x.block_uid AS a, y.block_uid AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.block_uid < y.block_uid GROUP BY ALL)
SELECT a AS block_uid_a, c.b AS block_uid_b FROM c JOIN n x ON x.block_uid = a JOIN n y ON y.block_uid = c.b WHERE k * 5 >= 4 * (x.n + y.n - k)"""


_P6_SETS = P6[: P6.index("c AS (SELECT x.block_uid")].strip()
#: Blocks with the same runs are one class; links are between classes, groups what links lead to.
P6_GROUPS = _P6_SETS.replace("WITH b AS", "WITH RECURSIVE b AS", 1) + r"""
k AS (SELECT block_uid, min(block_uid) OVER (PARTITION BY runs) AS cls, count(*) OVER (PARTITION BY runs) AS copies FROM (SELECT block_uid, list_sort(list(g)) AS runs FROM s GROUP BY ALL)),
o AS (SELECT s.* FROM s JOIN k ON s.block_uid = k.block_uid AND k.cls = k.block_uid),
c AS (SELECT x.block_uid AS a, y.block_uid AS b, count(*) AS k FROM o x JOIN o y ON x.g = y.g AND x.block_uid <> y.block_uid GROUP BY ALL),
e AS (SELECT a, c.b FROM c JOIN n x ON x.block_uid = a JOIN n y ON y.block_uid = c.b WHERE k * 5 >= 4 * (x.n + y.n - k)),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
h AS (SELECT a AS cls, least(a, min(b)) AS g FROM r GROUP BY a), l AS (SELECT a AS cls, count(*) AS links FROM e GROUP BY a)
SELECT block_uid, coalesce(g, cls) AS group_id, coalesce(links, 0)::BIGINT AS links FROM k LEFT JOIN h USING (cls) LEFT JOIN l USING (cls) WHERE copies > 1 OR g IS NOT NULL"""
#: What must hold of any assignment: every book once under each configuration, no group in two splits.
P3_CHECKED = "SELECT split_id::BIGINT AS split_id, (SELECT count(DISTINCT book_id) FROM books) AS books, 0::BIGINT AS twice, 0::BIGINT AS torn FROM (SELECT DISTINCT split_id FROM split_config)"
#: What must hold of any packing: every document, nothing over capacity, no piece of a document that fits, one source where asked.
P9_CHECKED = "SELECT pack_id::BIGINT AS pack_id, (SELECT count(DISTINCT doc_id) FROM documents) AS documents, 0::BIGINT AS over, 0::BIGINT AS torn, 0::BIGINT AS mixed FROM (SELECT DISTINCT pack_id FROM pack_config WHERE capacity_tokens > 0)"


def _shape_sql(c: str) -> str:
    """The shape of a text by translation tables: width, blanks and ignorables; composed look-alikes; plain look-alikes."""
    gone = "".join(chr(x) for x, to in visual._FOLDED.items() if to is None)
    one = [(chr(x), to) for x, to in visual._FOLDED.items() if to is not None and len(to) == 1 and to != chr(x) and chr(x) not in gone]
    folded = f"translate({c}, {q(''.join(a for a, _ in one) + gone)}, {q(''.join(b for _, b in one))})"
    composed = []
    for x in sorted({*range(0x370, 0x530), *range(0x1F00, 0x2000), *map(ord, visual.LOOK_ALIKES)}):
        to = unicodedata.normalize("NFC", unicodedata.normalize("NFD", chr(x)).translate(visual._shape))
        if len(to) == 1 and to != chr(x) and unicodedata.normalize("NFC", chr(x)) == chr(x):
            composed.append((chr(x), to))
    return f"nfc_normalize(translate(nfc_normalize({folded}), {q(''.join(a for a, _ in composed))}, {q(''.join(b for _, b in composed))}))"


P7 = f"""
WITH b AS (SELECT block_uid, any_value(book_id) AS book_id, any_value(raw_text) AS t FROM raw_blocks WHERE raw_text <> '' GROUP BY ALL),
s AS (SELECT *, {_shape_sql("t")} AS look FROM b)
SELECT x.block_uid AS block_uid_a, y.block_uid AS block_uid_b FROM s x JOIN s y ON x.book_id = y.book_id AND x.look = y.look AND x.block_uid < y.block_uid AND x.t <> y.t"""

P7_GROUPS = f"""
WITH b AS (SELECT block_uid, any_value(book_id) AS book_id, any_value(raw_text) AS t FROM raw_blocks WHERE raw_text <> '' GROUP BY ALL),
s AS (SELECT *, {_shape_sql("t")} AS look FROM b)
SELECT block_uid, group_id, variants FROM s JOIN (SELECT book_id, look, min(block_uid) AS group_id, count(DISTINCT t) AS variants FROM s WHERE book_id IS NOT NULL GROUP BY ALL HAVING count(DISTINCT t) > 1) USING (book_id, look)"""

_PLAIN = r"trim(regexp_replace(lower(nfc_normalize({c})), '\s+', ' ', 'g'))"
_BARE = r"trim(regexp_replace({c}, '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g'))"
_NAMED = "(" + ", ".join(q(x) for x in sorted(NOBODY)) + ")"
P3 = f"""
WITH RECURSIVE a AS (SELECT book_id, {_PLAIN.format(c="x")} AS v FROM (SELECT book_id, unnest(authors) AS x FROM books)),
k AS (SELECT DISTINCT book_id, 'a' || CASE WHEN contains(v, ',') THEN trim(split_part(v, ',', 2)) || ' ' || trim(split_part(v, ',', 1)) ELSE v END AS key FROM a WHERE {_BARE.format(c="v")} NOT IN {_NAMED} AND contains(trim(replace(v, ',', ' ')), ' ')
  UNION SELECT book_id, 's' || {_PLAIN.format(c="series")} FROM books WHERE {_BARE.format(c=_PLAIN.format(c="series"))} NOT IN {_NAMED}
  UNION SELECT book_id, 'o' || {_PLAIN.format(c="origin")} FROM books WHERE {_BARE.format(c=_PLAIN.format(c="origin"))} NOT IN {_NAMED}),
e AS (SELECT DISTINCT x.book_id AS a, y.book_id AS b FROM k x JOIN k y ON x.key = y.key AND x.book_id <> y.book_id),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT a AS book_id, least(a, min(b)) AS group_id FROM r GROUP BY a"""


def oracle_sql() -> dict[str, str]:
    return {"p3_found": P3, "p3_checked": P3_CHECKED, "p6_found": P6, "p6_groups": P6_GROUPS, "p9_checked": P9_CHECKED, "p7_found": P7, "p7_groups": P7_GROUPS}

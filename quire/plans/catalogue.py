"""Queries of the engine's own operators by name, and the SQL of the same results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import keys as K
from quire.functions import text as T
from quire.operators import compile as C
from quire.operators import graph, layout, spans
from quire.operators.pipeline import Corpus
from quire.plans import control
from quire.plans import oracles as O
from quire.sources.tables import table
from quire.streaming import events

Query = Callable[[SparkSession, str], DataFrame]


def joined(name: str) -> Column:
    return F.array_join(name, " > ").alias(name)


def longs(df: DataFrame) -> DataFrame:
    """``df`` with all whole numbers as BIGINT, as SQL engines count."""
    return df.select(*[F.col(f"`{n}`").cast("bigint").alias(n) if t in ("int", "smallint", "tinyint") else F.col(f"`{n}`") for n, t in df.dtypes])


def _corpus(fn: Callable[[Corpus], DataFrame]) -> Query:
    return lambda s, d: longs(fn(Corpus(s, d)))


def _table(name: str, fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda s, d: longs(fn(table(s, d, name)))


_CODE_LINES = (
    "mov eax, [ebp+8]\npush ebx\nret", "mov rax, rbx\nret", "typedef struct _A {\n  int x;\n} A;", "https://example.org/a/b", "someone@example.org", "header.h", "def load(rows):\n    return rows", "import os", "xor",
    "www.example.com/page\nsee www.example.org/other", "int main(void)", "", "push ebp", "lea rdi, [rip+0x10]\ncall f", "nothing special here", "a.c", "struct",
)
_TYPED_LINES = ("01: push ebp", "mov eax, [ebx+4]", "eax holds 0x00401000", "- an item", "1. first", "plain prose", "uint32_t eax", "typedef unsigned word", "• mark", "2. second", "see 0x00401000 only", "al [x]")


def _values(rows: tuple[str, ...]) -> str:
    return "(VALUES " + ", ".join(f"({i}, {O.q(x)})" for i, x in enumerate(rows)) + ") AS v(i, x)"


def _frame(s: SparkSession, rows: tuple[str, ...]) -> DataFrame:
    return s.createDataFrame(list(enumerate(rows)), "i int, x string")


def _typed_values(s: SparkSession, _: str) -> DataFrame:
    b = _frame(s, _TYPED_LINES).select("i", F.col("x").alias("raw_text"), T.strip(F.col("x")).alias("txt"), F.lit(False).alias("is_mono"), F.lit("paragraph").alias("block_type"))
    return longs(layout.typed(b).select("i", "block_type", "language"))


_TYPED_SQL = f"WITH st AS (SELECT i, x AS raw_text, x AS txt, false AS is_mono, 'paragraph' AS block_type FROM {_values(_TYPED_LINES)}), " + ", ".join(f"{k} AS ({O.STEPS[k]})" for k in ("ty0", "ty1", "ty")) + " SELECT i::BIGINT AS i, block_type, language FROM ty"


def _whole_words(c: str) -> str:
    """``c`` with a word character for each letter beyond ASCII, which word boundaries of the SQL engine would take for a gap."""
    return f"regexp_replace({c}, '[^\\P{{L}}\\x00-\\x7F]', '_', 'g')"


def _born_digital(k: Corpus) -> DataFrame:
    p = k.pages()
    n = p.groupBy("book_id").agg((F.max("page_idx") + 1).alias("n"))
    p = p.join(n, "book_id")
    probe = F.array(F.lit(0), F.least(F.lit(5), F.col("n") - 1), F.floor(F.col("n") / 2).cast("int"), F.greatest(F.lit(0), F.col("n") - 2))
    out = p.where(F.array_contains(probe, F.col("page_idx"))).groupBy("book_id").agg(F.first("n").alias("page_count"), F.sum("char_count").alias("sampled_chars"))
    return out.withColumn("is_born_digital", F.col("sampled_chars") > 200)


_SPAN = (
    "SELECT book_id, n AS page_count, sum(char_count)::BIGINT AS sampled_chars, sum(char_count) > 200 AS is_born_digital FROM pg JOIN (SELECT book_id, max(page_idx)::BIGINT + 1 AS n FROM pg GROUP BY ALL) USING (book_id) "
    "WHERE page_idx IN (0, least(5, n - 1), n // 2, greatest(0, n - 2)) GROUP BY ALL"
)

DATASETS: dict[str, Callable[[Corpus], DataFrame]] = {
    "raw": lambda k: C.raw(k.nodes()),
    "pretrain": lambda k: C.pretrain(k.train(), k.titles()),
    "sft": lambda k: C.sft(k.train()),
    "code": lambda k: C.code(k.nodes()),
    "rag": lambda k: C.rag(k.train()),
}


def consolidated(k: Corpus) -> DataFrame:
    """Records and characters of each dataset over all books, nodes worked out once."""
    n, t = k.nodes(), k.train()
    parts = (("code", C.code(n), "code"), ("pretrain", C.pretrain(t, k.titles()), "text"), ("rag", C.rag(t), "content"), ("raw", C.raw(n), "text"), ("sft", C.sft(t), "output"))
    out = None
    for name, df, col in parts:
        one = df.agg(F.count(F.lit(1)).alias("records"), F.countDistinct("book_id").alias("books"), F.sum(F.length(col)).alias("chars")).select(F.lit(name).alias("dataset"), "records", "books", "chars")
        out = one if out is None else out.unionByName(one)
    return out


def preview(k: Corpus, offset: int = 20, limit: int = 10) -> DataFrame:
    """A page of the raw dataset; paging is the feature here."""
    return C.raw(k.nodes()).select("book_id", "id", "page", "type", "text", joined("breadcrumbs")).orderBy("book_id", "page", "id").offset(offset).limit(limit)


EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def stream_rollup(s: SparkSession, d: str) -> DataFrame:
    """The rollup of the event stream, run over all files that are there."""
    return longs(events.drain(events.rollup(events.event_stream(s, d, EVENT_SCHEMA), 300)))


def _doc_stats(df: DataFrame) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    return df.select("doc_id", T.word_count(t).alias("word_count"), F.length(t).alias("char_count"), T.token_estimate(t).alias("token_count"), F.sha2(F.col("text"), 256).alias("sha256"))


_R = "array_to_string(breadcrumbs, ' > ') AS breadcrumbs"
_LIST = (
    ("q_span_lines", _table("raw_blocks", lambda t: spans.lines(spans.words_as_spans(t)).drop("font_size")), O.SPAN_LINES),
    ("q_span_blocks", _table("raw_blocks", lambda t: spans.assemble(spans.words_as_spans(t)).drop("font_size")), O.SPAN_BLOCKS),
    ("q_ingest_blocks", _corpus(lambda k: k.blocks().select("block_uid", "book_id", "page_idx", "blk_ord", "block_id", "txt", "block_type")), O.chain("blk", "SELECT block_uid, book_id, page_idx::BIGINT AS page_idx, blk_ord::BIGINT AS blk_ord, block_id, txt, block_type FROM blk")),
    ("q_born_digital", _corpus(_born_digital), O.chain("pg", _SPAN)),
    ("q_margin_freq", _corpus(lambda k: layout.margin_frequency(k.blocks().join(k.pages(), ["book_id", "page_idx"], "left")).select("book_id", "txt", "n")), O.chain("freq", "SELECT book_id, txt, n FROM freq")),
    ("q_furniture", _corpus(lambda k: k.furnished().where("block_type = 'furniture'").groupBy("book_id").agg(F.count(F.lit(1)).alias("n"), F.min("block_uid").alias("first"), F.sum("block_uid").alias("sum_uid"))), O.chain("furn", "SELECT book_id, count(*) AS n, min(block_uid) AS first, sum(block_uid)::BIGINT AS sum_uid FROM furn WHERE block_type = 'furniture' GROUP BY ALL")),
    ("q_reading_order", _corpus(lambda k: k.ordered().select("block_uid", "book_id", "page_idx", "two_col", "bucket", "rank")), O.chain("ord", "SELECT block_uid, book_id, page_idx::BIGINT AS page_idx, two_col, bucket, rank FROM ord")),
    ("q_toc_match", _corpus(lambda k: k.structured().select("block_uid", "block_type", "level", "toc_title")), O.chain("st", "SELECT block_uid, block_type, level::BIGINT AS level, toc_title FROM st")),
    ("q_continuity", _corpus(lambda k: layout.continuity(k.structured())), O.chain("ends", "SELECT a.book_id, a.page_idx::BIGINT AS page_idx, a.lid AS last_block, b.fid AS first_block FROM ends a JOIN ends b ON a.book_id = b.book_id AND b.page_idx = a.page_idx + 1 WHERE a.lt = 'paragraph' AND b.ft = 'paragraph' AND NOT regexp_matches(a.lx, '[.:;?!]$')")),
    ("q_typed_blocks", _corpus(lambda k: k.typed().select("block_uid", "block_type", "language")), O.chain("ty", "SELECT block_uid, block_type, language FROM ty")),
    ("q_typed_content", _typed_values, _TYPED_SQL),
    ("q_graph_nodes", _corpus(lambda k: k.nodes().select("book_id", "node_ord", "page_idx", "node_id", "node_type", "title", "parent_id")), O.chain("nodes", "SELECT book_id, node_ord, page_idx::BIGINT AS page_idx, node_id, node_type, title, parent_id FROM nodes")),
    ("q_breadcrumbs", _corpus(lambda k: k.nodes().select("book_id", "node_id", joined("breadcrumbs"))), O.chain("nodes", f"SELECT book_id, node_id, {_R} FROM nodes")),
    ("q_clean_text", _corpus(lambda k: k.nodes().select("book_id", "node_id", "text")), O.chain("nodes", "SELECT book_id, node_id, text FROM nodes")),
    ("q_validate", _corpus(lambda k: graph.validation(k.nodes())), O.chain("nodes", f"SELECT book_id, count(*) + 1 AS total_nodes, sum({O.words('text')})::BIGINT AS total_words, count(*) FILTER (node_type = 'code') AS code_blocks, count(*) FILTER (node_type IN ('chapter', 'section')) AS headings, CASE WHEN sum({O.words('text')}) > 1000 AND count(*) FILTER (node_type IN ('chapter', 'section')) > 0 THEN 0.95 ELSE 0.5 END::DOUBLE AS quality_score, 'passed' AS status FROM nodes GROUP BY ALL")),
    ("q_boilerplate", _corpus(lambda k: C.with_boilerplate(k.nodes()).select("book_id", "node_id", "total_pages", "boilerplate")), O.chain("boil", "SELECT book_id, node_id, total_pages::BIGINT AS total_pages, boilerplate FROM boil")),
    ("q_raw", _corpus(lambda k: C.raw(k.nodes()).withColumn("breadcrumbs", joined("breadcrumbs"))), O.chain("bn", f"SELECT book_id, node_id AS id, (page_idx + 1)::BIGINT AS page, node_type AS type, text, {_R} FROM bn WHERE s <> ''")),
    ("q_pretrain", _corpus(lambda k: C.pretrain(k.train(), k.titles())), O.chain("p4", f"SELECT book_id, printf('doc_%03d', row_number() OVER (PARTITION BY book_id ORDER BY grp) - 1) AS doc_id, book_title, chapter_title, page_start::BIGINT AS page_start, page_end::BIGINT AS page_end, {O.words('text')}::BIGINT AS word_count, length(text)::BIGINT AS char_count, {O.tokens('text')}::BIGINT AS token_count, text FROM p4")),
    ("q_sft", _corpus(lambda k: C.sft(k.train()).withColumn("breadcrumbs", joined("breadcrumbs"))), O.chain("sft", f"SELECT book_id, id, category, source_page::BIGINT AS source_page, {_R}, instruction, input, output FROM sft")),
    ("q_sft_chatml", _corpus(lambda k: C.chatml(C.sft(k.train())).select("book_id", "id", F.size("messages").alias("turns"), F.col("messages")[0]["role"].alias("first_role"), F.col("messages")[1]["content"].alias("user"), F.col("messages")[2]["content"].alias("assistant"))), O.chain("sft", f"SELECT book_id, id, 3::BIGINT AS turns, 'system' AS first_role, CASE WHEN input <> '' THEN {O.strip('(instruction || chr(10) || chr(10) || input)')} ELSE instruction END AS user, output AS assistant FROM sft")),
    ("q_code_dataset", _corpus(lambda k: C.code(k.nodes()).withColumn("breadcrumbs", joined("breadcrumbs"))), O.chain("code", f"SELECT book_id, code_id, page::BIGINT AS page, language, {_R}, surrounding_context, code, line_count::BIGINT AS line_count FROM code")),
    ("q_rag", _corpus(lambda k: C.rag(k.train()).withColumn("breadcrumbs", joined("breadcrumbs"))), O.chain("rag", f"SELECT book_id, chunk_id, page::BIGINT AS page, {_R}, content FROM rag")),
    ("q_consolidate", _corpus(consolidated), O.chain("rag", "SELECT 'raw' AS dataset, count(*) AS records, count(DISTINCT book_id) AS books, sum(length(text))::BIGINT AS chars FROM bn WHERE s <> '' UNION ALL SELECT 'pretrain', count(*), count(DISTINCT book_id), sum(length(text))::BIGINT FROM p4 UNION ALL SELECT 'sft', count(*), count(DISTINCT book_id), sum(length(output))::BIGINT FROM sft UNION ALL SELECT 'code', count(*), count(DISTINCT book_id), sum(length(code))::BIGINT FROM code UNION ALL SELECT 'rag', count(*), count(DISTINCT book_id), sum(length(content))::BIGINT FROM rag")),
    ("q_preview", _corpus(preview), O.chain("bn", f"SELECT book_id, node_id AS id, (page_idx + 1)::BIGINT AS page, node_type AS type, text, {_R} FROM bn WHERE s <> '' ORDER BY book_id, page, id LIMIT 10 OFFSET 20")),
    ("q_code_valid", lambda s, d: longs(_frame(s, _CODE_LINES).select("i", T.is_code(F.col("x")).alias("valid"))), f"SELECT i::BIGINT AS i, {O.is_code('x')} AS valid FROM (SELECT i, {O.strip('x')} AS x FROM {_values(_CODE_LINES)})"),
    ("q_code_language", lambda s, d: longs(_frame(s, _CODE_LINES).select("i", T.code_language(F.col("x")).alias("language"))), f"SELECT i::BIGINT AS i, {O.code_language('x')} AS language FROM {_values(_CODE_LINES)}"),
    ("q_code_valid_blocks", _corpus(lambda k: k.blocks().select("block_uid", T.is_code(F.col("raw_text")).alias("valid"))), O.chain("blk", f"SELECT block_uid, {O.is_code('x')} AS valid FROM (SELECT block_uid, {_whole_words('txt')} AS x FROM blk)")),
    ("q_code_language_blocks", _corpus(lambda k: k.blocks().select("block_uid", T.code_language(F.col("raw_text")).alias("language"))), O.chain("blk", f"SELECT block_uid, {O.code_language('x')} AS language FROM (SELECT block_uid, {_whole_words('raw_text')} AS x FROM blk)")),
    ("q_doc_stats", _table("documents", _doc_stats), f"SELECT doc_id, {O.words("t")}::BIGINT AS word_count, length(t)::BIGINT AS char_count, {O.tokens('t')}::BIGINT AS token_count, CASE WHEN text IS NOT NULL THEN sha256(text) END AS sha256 FROM (SELECT *, coalesce(text, '') AS t FROM documents)"),
    ("q_stream_rollup", stream_rollup, "SELECT bucket, count(*) AS n, round(avg(value), 6) AS mean, arg_max(value, (ts, event_id)) AS last, arg_min(value, (ts, event_id)) AS first FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) // 300 * 300 AS bucket FROM events) GROUP BY bucket"),
    ("q_doc_hash", _table("documents", lambda t: t.where("text is not null").select("doc_id", K.book_dir(F.sha2("text", 256)).alias("dir"), K.stage_key("inspect", "1", {"dpi": 300, "backend": "auto"}, F.array(F.sha2("text", 256), F.sha2(F.col("doc_id").cast("string"), 256))).alias("stage_key"))), """SELECT doc_id, substring(sha256(text), 1, 12) AS dir, substring(sha256('inspect|1|{"backend":"auto","dpi":300}|' || least(sha256(text), sha256(doc_id::VARCHAR)) || '|' || greatest(sha256(text), sha256(doc_id::VARCHAR))), 1, 16) AS stage_key FROM documents WHERE text IS NOT NULL"""),
    ("q_quality_bucket", _corpus(lambda k: k.t("books").where("quality_score is not null").groupBy("book_id").agg(F.max("quality_score").alias("q")).groupBy(F.when(F.col("q") >= 0.95, "verified").when(F.col("q") >= 0.85, "good").when(F.col("q") >= 0.7, "review").otherwise("poor").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))), "SELECT CASE WHEN q >= 0.95 THEN 'verified' WHEN q >= 0.85 THEN 'good' WHEN q >= 0.7 THEN 'review' ELSE 'poor' END AS bucket, count(*) AS n FROM (SELECT book_id, max(quality_score) AS q FROM books WHERE quality_score IS NOT NULL GROUP BY ALL) GROUP BY ALL"),
    ("q_record_kind", _table("sft_pairs", lambda t: t.groupBy("pair_id").agg(F.max(F.when(F.col("instruction").isNotNull(), 2).when(F.size("messages") > 0, 1).otherwise(0)).alias("r")).groupBy(F.element_at(F.array(F.lit("other"), F.lit("messages"), F.lit("instruction")), F.col("r") + 1).alias("kind")).agg(F.count(F.lit(1)).alias("n"))), "SELECT ['other', 'messages', 'instruction'][r + 1] AS kind, count(*) AS n FROM (SELECT pair_id, max(CASE WHEN instruction IS NOT NULL THEN 2 WHEN len(messages) > 0 THEN 1 ELSE 0 END) AS r FROM sft_pairs GROUP BY ALL) GROUP BY ALL"),
    ("q_slug", _table("part", lambda p: p.select("p_partkey", F.concat(T.slug(F.col("p_name")), F.lit("_"), F.substring(F.sha2("p_name", 256), 1, 6)).alias("slug"))), "SELECT p_partkey, trim(substring(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), 1, 24), '_') || '_' || substring(sha256(p_name), 1, 6) AS slug FROM part"),
    ("q_exact_dedup", _table("documents", lambda t: t.where("text is not null").groupBy(F.sha2("text", 256).alias("sha256")).agg(F.min("doc_id").alias("keep"), F.count(F.lit(1)).alias("copies"))), "SELECT sha256(text) AS sha256, min(doc_id) AS keep, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY ALL"),
)


def queries() -> dict[str, Query]:
    return {**{n: f for n, f, _ in _LIST}, **control.queries()}


def oracle_sql() -> dict[str, str]:
    return {**{n: sql for n, _, sql in _LIST}, **control.oracle_sql()}

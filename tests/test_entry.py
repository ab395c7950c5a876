import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_core_queries_agree_with_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from quire.plans.catalogue import oracle_sql, queries

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"create view {f[:-8]} as select * from '{DATA}/{f}'")
    flat = lambda v: round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v
    for name in ("q_furniture", "q_toc_match", "q_typed_content", "q_graph_nodes", "q_code_valid", "q_telemetry_60s", "q_ewma", "q_median20", "q_eta_lanes", "q_crash_loop", "q_stream_rollup", "q_span_lines", "q_span_blocks", "q_edges", "q_plan", "q_stage_costs", "q_eta", "q_running", "q_book_detail", "q_formats", "q_claim_next", "q_error_class_texts", "q_dataset_pick_docs"):
        df = queries()[name](spark, DATA)
        cols = sorted(df.columns)
        got = sorted((repr(tuple(flat(r[c]) for c in cols)) for r in df.collect()))
        rel = con.sql(oracle_sql()[name])
        at = [rel.columns.index(c) for c in cols]
        assert got == sorted(repr(tuple(flat(row[i]) for i in at)) for row in rel.fetchall()), name


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize(("name", "column"), [("q_code_valid_blocks", "valid"), ("q_code_language_blocks", "language")])
def test_code_tests_over_all_blocks_agree_with_sql(spark, name, column):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"create view raw_blocks as select * from '{DATA}/raw_blocks.parquet'")
    got = [(r.block_uid, r[column]) for r in entry.queries()[name](spark, DATA).collect()]
    blocks = spark.read.parquet(f"{DATA}/raw_blocks.parquet").select("block_uid").distinct().count()
    assert len(got) == blocks and sorted(got, key=repr) == sorted(con.sql(f"select block_uid, {column} from ({entry.oracle_sql()[name]})").fetchall(), key=repr)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_entry(spark):
    assert entry.entry(spark).count() > 0

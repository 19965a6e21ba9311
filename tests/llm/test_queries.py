import os

import pytest

from passageworks.llm import queries, sql

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")

COLUMNS = {
    "p1_found": {"block_id": "bigint", "line_no": "int"}, "p2_found": {"chunk_id_a": "string", "chunk_id_b": "string"}, "p3_found": {"chunk_id_a": "string", "chunk_id_b": "string"},
    "p4_found": {"item_type": "string", "item_key": "string"}, "p5_found": {"run_id": "bigint", "query_id": "bigint", "item_id": "string"}, "p6_found": {"doc_id": "bigint", "query_id": "bigint"}, "p8_found": {"doc_id": "bigint"},
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_no_repeats(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    assert dict(df.dtypes) == COLUMNS[name]
    rows = df.collect()
    assert rows and len(rows) == len(set(rows))


@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    df = queries.QUERIES[name](spark, DATA)
    want = con.execute(sql.SQL[name])
    names = [d[0] for d in want.description]
    flat = lambda rows, get: sorted(tuple(f"{v:.5f}" if isinstance(v, float) else str(v) for v in get(r)) for r in rows)
    assert sorted(names) == sorted(df.columns)
    assert flat(df.collect(), lambda r: [r[c] for c in names]) == flat(want.fetchall(), lambda r: r)


def test_pieces_hold_all_text(spark):
    pieces = queries.QUERIES["p4_pieces"](spark, DATA).collect()
    assert pieces and max(r["token_count"] for r in pieces) <= 512
    text = {r["chunk_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/chunk.parquet").collect()}
    by = {}
    for r in sorted(pieces, key=lambda r: r["piece_no"]):
        if r["item_type"] == "chunk":
            by[r["item_key"]] = by.get(r["item_key"], "") + r["text"][r["overlap_chars"] :]
    assert by and all(text[k] == v for k, v in by.items())

"""The registered queries: their columns, and DuckDB's rows where SQL can express them."""

import glob
import math
import os
import zlib

import duckdb
import pytest

from lodestone.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_exact_dedup": "doc_id bigint keep_id bigint group_size bigint kept boolean text_sha256 string",
    "op2_piece_codec": "doc_id bigint n_tokens bigint ids_sha256 string decoded_sha256 string",
    "op3_top_k": "query_id bigint rank int vec_id bigint score bigint",
    "op4_language_id": "doc_id bigint held_out boolean lang_pred string score double",
    "op5_secret_scan": "doc_id bigint n_assign bigint n_access bigint n_hex bigint base_sha256 string spans string",
    "op6_near_dup": "doc_id bigint class_id bigint",
    "op7_quality": "doc_id bigint held_out boolean score double predicted int",
    "op8_packing": "doc_id bigint start bigint length bigint ids_crc32 bigint doc_tokens bigint sequence_id bigint offset bigint",
    "op9_toxicity": "doc_id bigint held_out boolean score double predicted int",
    "op11_token_alignment": "doc_id bigint n_a bigint n_b bigint n_groups bigint n_links bigint n_best bigint count_sum bigint groups_sha256 string",
    "op12_spelling_variants": "word string form string root string n bigint n_near bigint form_n bigint",
    "op13_private_data": "doc_id bigint n_email bigint n_ip bigint n_card bigint n_phone bigint base_sha256 string spans string",
    "op10_html_text": "page_id bigint url string text string n_chars bigint",
}
FOLDS = {"op4_language_id": (4, 2), "op7_quality": (5, 0), "op9_toxicity": (3, 1)}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_contract(spark, name):
    df = queries.queries()[name](spark, SF)
    kinds = dict(df.dtypes)
    want = COLUMNS[name].split()
    assert {k: kinds[k] for k in want[::2]} == dict(zip(want[::2], want[1::2], strict=True))
    rows = df.collect()
    table = {"op3_top_k": None, "op8_packing": None, "op12_spelling_variants": None, "op10_html_text": "pages"}.get(name, "documents")
    if table:
        assert len(rows) == spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name in FOLDS:
        n, held = FOLDS[name]
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % n == held) for r in rows)
        assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    plain = lambda v: round(v, 6) if isinstance(v, float) and not math.isnan(v) else v
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    rel = con.sql(queries.oracle_sql()[name])
    at = [rel.columns.index(c) for c in columns]
    assert sorted(rel.columns) == columns
    assert got == sorted((tuple(plain(r[k]) for k in at) for r in rel.fetchall()), key=repr)

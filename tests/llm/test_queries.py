"""Every registered query runs on a small size and has the columns and rows that it should."""

import pytest
from lakeshore.llm import queries

ROWS = {"op1_simhash": "documents", "op2_pii": "documents", "op3_sentencepiece": "documents", "op4_quality": "documents", "op7_lines": "documents", "op8_toxicity": "documents", "op9_warc": "pages", "op10_sentence_spans": "documents", "op11_tokenizer_alignment": "documents", "op12_merkle_manifest": "documents", "op13_exact_dedup": "documents"}
ID = {"documents": "doc_id", "pages": "page_id"}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, name):
    sf = sf.replace("0.001", "0.01") if name == "op5_secrets" else sf  # the smallest size has no secrets
    got = queries.QUERIES[name](spark, sf)
    rows = got.collect()
    assert rows
    if name in ROWS:
        key = ID[ROWS[name]]
        assert sorted(r[key] for r in rows) == sorted(r[0] for r in spark.read.parquet(f"{sf}/{ROWS[name]}.parquet").select(key).collect())
    else:
        assert all(isinstance(r.doc_id, int) for r in rows)

"""The registered corpus queries: rows of their SQL, or one row per document."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tidecast.llm.queries import QUERIES, SQL

COLUMNS = {
    "op1_byte_level_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op2_elias_fano_lm": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op3_token_counts": "doc_id n_tokens file document start closed",
    "op4_simhash_golay": "doc_id fingerprint component_id",
    "op5_kd_tree_shards": "doc_id size text_crc32 law shard slot grown_shard",
    "op7_fm_index_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op10_byte_cnn_language": "doc_id held_out lang_pred score",
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, data, name):
    con = duckdb.connect()
    for path in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got = QUERIES[name](spark, data)
    columns = sorted(got.columns)
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = Counter(tuple(r[i] for i in order) for r in cursor.fetchall())
    assert want and Counter(tuple(r) for r in got.select(*columns).collect()) == want


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_per_document(spark, data, name):
    got = QUERIES[name](spark, data)
    assert got.columns == COLUMNS[name].split()
    ids = sorted(r["doc_id"] for r in got.collect())
    assert ids == sorted(r["doc_id"] for r in spark.read.parquet(f"{data}/documents.parquet").collect())


def test_all_are_registered():
    assert set(COLUMNS) | set(SQL) == set(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))

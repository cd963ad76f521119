"""The registered queries on the smallest tables: whole results, contract columns, SQL where there is any."""

import os

import pytest

from tests.compare import connect, rows
from tidewell.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
COLUMNS = {
    "op1_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op2_toxicity": "doc_id held_out score predicted",
    "op3_benchmark_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op4_mixing_lm": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5_url_filters": "page_id host path rule verdict",
    "op6_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op7_multiprobe_neighbours": "query_id rank vec_id score",
    "op8_jaccard_join": "doc_id n_shingles component_id",
    "op9_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op10_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op11_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op12_token_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op13_filter_audit": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    got = queries.QUERIES[name](spark, FOLDER).toPandas()
    assert list(got.columns)[: len(COLUMNS[name].split())] == COLUMNS[name].split()
    table = {"op5_url_filters": ("pages", "page_id"), "op7_multiprobe_neighbours": None, "op1_best_fit_packing": None, "op13_filter_audit": None}.get(name, ("documents", "doc_id"))
    if table:
        ids = spark.read.parquet(f"{FOLDER}/{table[0]}.parquet").select(table[1]).toPandas()[table[1]]
        assert sorted(got[table[1]]) == sorted(ids)
    if name in queries.ORACLE_SQL:
        assert rows(got) == rows(connect(FOLDER).execute(queries.ORACLE_SQL[name]).fetchdf())

"""Registered queries on the smallest test data: against their SQL where there is some."""

import os

import pytest

from registry import compare
from sluicebox.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")
COLUMNS = {
    "op1_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op2_html_text": "page_id url text n_chars",
    "op3_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op4_toxicity": "doc_id held_out score predicted",
    "op5_near_duplicates": "doc_id n_shingles component_id kept",
    "op6_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op7_language_model": "doc_id n_words log_prob mean_log_prob",
    "op8_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op9_substring_dedup": "doc_id text removed",
    "op10_topk": "query_id rank vec_id score",
    "op11_merkle_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op12_centroid_clustering": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    "op13_language_id": "doc_id held_out lang_pred score",
    "pipeline": "doc_id piece sequence_id",
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    if name in ORACLES:
        assert compare.difference(df, compare.connect(SF_DIR), ORACLES[name]) == ""
    else:
        assert df.count() > 0

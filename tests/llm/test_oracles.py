"""The registered training-data queries next to their SQL twins, and what they return."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from runlens import llm
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = llm.load()

COLUMNS = {
    "op1_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op2_longest_factor": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op3_near_dup": "doc_id n_shingles component_id kept",
    "op4_decontaminate": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op6_jump_hash": "doc_id size text_crc32 law shard slot grown_shard",
    "op7_importance": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op9_toxicity": "doc_id held_out score predicted",
    "op10_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op11_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_token_files": "doc_id start n_tokens ids_crc32",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    ok, note = compare(spark, connect(SF_DIR), name, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert ok, note
    wanted = COLUMNS.get(name, "").split()
    assert QUERIES[name](spark, SF_DIR).columns[: len(wanted)] == wanted


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))

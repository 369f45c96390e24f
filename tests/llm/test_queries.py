"""Every registered query on the smallest test tables: columns, one row per row of its table (if any), SQL where there is one."""

from __future__ import annotations

import zlib

import pytest

from ampertide.llm.queries import ORACLES, QUERIES
from tests.parity import connection, differences

FOLDER = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_main_text": ("pages", {"page_id", "url", "text", "n_chars"}),
    "op2_exact_dedup": ("documents", {"doc_id", "keep_id", "group_size", "kept", "text_sha256"}),
    "op3_token_files": ("documents", {"doc_id", "start", "n_tokens", "ids_crc32"}),
    "op4_language_id": ("documents", {"doc_id", "held_out", "lang_pred", "score"}),
    "op5_shard_documents": ("documents", {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}),
    "op6_decontaminate": ("documents", {"doc_id", "contaminated"}),
    "op7_token_counts": ("documents", {"doc_id", "n_tokens"}),
    "op8_line_dedup": ("documents", {"doc_id", "text"}),
    "op9_mix_sources": ("documents", {"doc_id", "size", "source_size", "target", "taken"}),
    "op10_near_dup": ("documents", {"doc_id", "n_shingles", "component_id", "kept"}),
    "op11_embedding_dedup": ("embeddings", {"vec_id", "n_links", "component_id", "kept"}),
    "op12_source_divergence": (None, {"lang", "source", "part", "item", "value", "rank"}),
    "op13_align_tokens": ("documents", {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}),
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    table, columns = COLUMNS[name]
    result = QUERIES[name](spark, FOLDER)
    assert columns <= set(result.columns)
    rows = result.collect()
    if table is not None:
        assert len(rows) == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()
    if name == "op4_language_id":
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    if name == "op3_token_files":
        start = 0
        for r in sorted(rows, key=lambda r: r.doc_id):
            assert r.start == start
            start += r.n_tokens


def test_every_operator_has_a_query():
    assert set(QUERIES) == set(COLUMNS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    problems, _ = differences(QUERIES[name](spark, FOLDER), ORACLES[name], connection(FOLDER))
    assert not problems

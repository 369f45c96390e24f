"""Exact dedup against a dictionary of normalised texts."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from ampertide.llm.exact_dedup import exact_dedup

SCHEMA = "doc_id long, text string, keep_id string, lang string"


def test_against_dictionary(spark):
    texts = ["a b", "a\t\n b", " a b", "", None, " ", "a b", "x" * 200_000, "x" * 200_000, "a b "]
    rows = [(i * 3 % 31, texts[i % 10] if i % 3 else f"only {i}", None, "en") for i in range(31)]
    result = exact_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    wanted = {
        i: (min(ids), len(ids), i == min(ids), hashlib.sha256(text.encode()).hexdigest())
        for text, ids in groups.items()
        for i in ids
    }
    assert {r.doc_id: tuple(r)[1:] for r in result} == wanted and len(result) == 31


def test_null_and_repeated_ids(spark):
    rows = [(None, "t", None, None), (4, "t", None, None), (4, "t", None, None), (None, "u", None, None), (None, "u", None, None)]
    result = exact_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    t = [r for r in result if r.group_size == 3]
    assert [r.keep_id for r in t] == [4, 4, 4] and [r.doc_id for r in t if r.kept] == [4]
    u = [r for r in result if r.group_size == 2]
    assert [r.keep_id for r in u] == [None, None] and sum(r.kept for r in u) == 1


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).collect() == []

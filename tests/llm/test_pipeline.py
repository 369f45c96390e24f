"""The pipeline's stages against brute force on a small table, and the whole run on the smallest test tables."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from ampertide.llm.queries import vocabulary
from tests.llm.test_decontaminate import brute_cover
from tests.llm.test_near_dup import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two invented languages, near copies, benchmark passages, texts without letters."""
    rng = random.Random(8)
    lexicon = {l: ["".join(rng.choice(c) for _ in range(rng.randint(2, 7))) for _ in range(300)] for l, c in (("xx", "abcdeu"), ("yy", "klmnoé"))}
    prose = lambda lang, n: [rng.choice(lexicon[lang]) for _ in range(n)]
    items = [(i, " ".join(prose("xx", 20))) for i in range(5)]
    rows = []
    for i in range(160):
        lang = rng.choice(["xx", "yy"])
        words = prose(lang, rng.randint(20, 120))
        if i % 9 == 0:
            at = rng.randrange(len(words))
            words[at:at] = items[i % 5][1].split()
        rows.append((i, " ".join(words), lang if i % 7 else None, f"s{i % 3}"))
        if i % 5 == 0:
            words[rng.randrange(len(words))] = "changed"
            rows.append((1000 + i, " ".join(words), lang, "s1"))
    rows += [(2000, None, None, None), (2001, "", "xx", "s0"), (2002, "12 34 !", "yy", None), (2003, rows[1][1], "xx", None)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, items


def test_stages_against_brute_force(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    named = cp.language(spark, docs, path)
    assert named.columns == docs.columns
    expected = {r[0]: r[1] for r in rows if re.search(r"[^\W\d_]", r[1] or "")}
    assert {r.doc_id: r.text for r in named.collect()} == expected

    from ampertide.session import materialise

    distinct = cp.near_duplicates(spark, materialise(named, "t"), path)
    roots = brute([(i, t) for i, t in expected.items()], 5)
    expected = {i: t for i, t in expected.items() if roots[i][2]}
    assert {r.doc_id for r in distinct.collect()} == set(expected)

    clean = cp.benchmark_free(spark, materialise(distinct, "t"), path)
    leaked = {i for i, t in expected.items() for _, item in items if (c := brute_cover(t, item))[0] >= 0.5 * c[1]}
    assert leaked
    expected = {i: t for i, t in expected.items() if i not in leaked}
    stored = materialise(clean, "t")
    assert {r.doc_id for r in stored.collect()} == set(expected)

    mixed = materialise(cp.mixture(spark, stored, path), "t")
    assert mixed.columns == docs.columns
    copies = Counter(r.doc_id for r in mixed.collect())
    assert max(copies.values()) <= 2 and set(copies) <= set(expected)

    encode = Tokenizer.from_file(vocabulary()).encode
    start, wanted = 0, []
    for i in sorted(copies.elements()):
        ids = [*encode(expected[i], add_special_tokens=False).ids, 2]
        wanted.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, cp.tokens(spark, mixed, path).collect()), key=lambda r: r[1]) == wanted


def test_run_on_test_tables(spark):
    result = cp.run(spark, "/root/testdata/sf0.001")
    assert result.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and result.count() > 50


def test_empty_documents(spark, folder, tmp_path):
    path, *_ = folder
    spark.read.parquet(f"{path}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0

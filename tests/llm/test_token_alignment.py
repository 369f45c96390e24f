"""Alignment of two vocabularies against a plain loop over all pairs of tokens."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ampertide.llm.common import prepare
from ampertide.llm.queries import BYTES, PIECES, QUERIES, vocabulary
from ampertide.llm.token_alignment import Aligner, ByteSide, align, groups, overlaps, with_pair_counts

TEXTS = [
    "The quick brown fox jumps over the lazy dog.",
    "The quick brown fox",
    None,
    "",
    " ",
    "   two  blanks\tand\n\nlines \r\n",
    "naïve façade 漢字かな 😀 Ünïcödé é́ ﬁ",
    "<|endoftext|> <s> </s> <unk> <0x0A>",
    "a ▁ is given back as a blank",
    "zero \x00 byte",
    "The quick brown fox",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
]


@pytest.fixture(scope="module")
def aligner():
    return Aligner(vocabulary(BYTES), vocabulary(PIECES))


def spans(sizes):
    ends = np.cumsum(sizes).tolist()
    return list(zip([0, *ends[:-1]], ends))


def brute(aligner, text):
    """Ids, written groups and all linked pairs, by comparing every A token with every B token."""
    tokenizer, model = aligner.a.tokenizer, aligner.b.model
    if not text:
        return [], [], "", []
    a, b = tokenizer.encode(f" {text}", add_special_tokens=False).ids, model.encode(text)
    if any(b"".join(side.bytes[i] for i in ids) != f" {text}".encode() for side, ids in ((aligner.a, a), (aligner.b, b))):
        return [], [], "", []
    at_a, at_b = spans([len(aligner.a.bytes[i]) for i in a]), spans([len(aligner.b.bytes[i]) for i in b])
    links = [(i, j) for i, (s, e) in enumerate(at_a) for j, (p, q) in enumerate(at_b) if max(s, p) < min(e, q)]
    cuts = sorted({e for _, e in at_a} & {e for _, e in at_b})
    written = []
    for low, high in zip([0, *cuts[:-1]], cuts):
        own_a = ",".join(str(a[i]) for i, (_, e) in enumerate(at_a) if low < e <= high)
        own_b = ",".join(str(b[j]) for j, (_, e) in enumerate(at_b) if low < e <= high)
        written.append(f"{own_a}|{own_b}")
    return a, b, ";".join(written), [(a[i], b[j]) for i, j in links]


def expected(aligner, texts):
    found = [brute(aligner, t) for t in texts]
    counts = Counter(pair for *_, links in found for pair in set(links))
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    return [
        (len(a), len(b), written.count(";") + bool(written), len(links), written, sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links))
        for a, b, written, links in found
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]


@pytest.mark.parametrize("hot_pairs", [0, 5, 1 << 20])
def test_every_column_as_by_brute_force(spark, aligner, hot_pairs):
    prepare(spark)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = with_pair_counts(align(docs, vocabulary(BYTES), vocabulary(PIECES)), 1 << 16, hot_pairs).collect()
    found = [tuple(r[c] for c in COLUMNS) for r in sorted(rows, key=lambda r: r.doc_id)]
    assert found == expected(aligner, TEXTS)


def test_texts_without_tokens(aligner):
    assert [len(x) for x in aligner.tokens([None or "", "", "a ▁ b"])[0]] == [0, 0, 0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab '.\n\t 1éß漢😀▁<|>", max_size=30), max_size=5))
def test_batches_as_by_brute_force(aligner, texts):
    found = aligner.align(texts)
    for k, text in enumerate(texts):
        a, b, written, links = brute(aligner, text)
        assert (found["n_a"][k], found["n_b"][k], found["groups"][k], found["n_links"][k]) == (len(a), len(b), written, len(links))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=40), st.lists(st.integers(1, 5), min_size=1, max_size=40))
def test_pointer_jumping_finds_components(sizes_a, sizes_b):
    short = sum(sizes_a) - sum(sizes_b)
    (sizes_b if short > 0 else sizes_a).extend([abs(short)] if short else [])
    end_a, end_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    first, last = overlaps(end_a, end_b)
    label = groups(end_a, end_b, last)
    parent = list(range(len(end_a) + len(end_b)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (low, high) in enumerate(zip(first, last)):
        for j in range(low, high + 1):
            parent[root(i)] = root(len(end_a) + j)
    for x in range(len(parent)):
        for y in range(x):
            assert (label[x] == label[y]) == (root(x) == root(y))
    assert all(label[x] < len(end_a) for x in range(len(parent)))


def test_long_chain(aligner):
    """Tokens of two and three bytes that never end together but at the end."""
    end_a = np.array([2 * k for k in range(1, 300_000)] + [600_000 + 1])
    end_b = np.array([2 * k + 1 for k in range(300_001)])
    assert end_a[-1] == end_b[-1]
    label = groups(end_a, end_b, overlaps(end_a, end_b)[1])
    assert (label == len(end_a) - 1).all()


def test_quick_encoder_gives_the_ids_of_the_file(spark, aligner):
    assert aligner.a.quick is not None
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").where("text is not null").collect()]
    texts += [t for t in TEXTS if t] + ["<|endoftext|>" * 3, " " * 5000, "x" * 5000, "\n" * 999]
    assert aligner.a.encode(texts) == [e.ids for e in aligner.a.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_other_files_are_encoded_by_the_library():
    side = ByteSide(vocabulary("word_bpe_49k.json"))
    assert side.quick is None
    assert side.encode(["a word"]) == [side.tokenizer.encode("a word", add_special_tokens=False).ids]


def test_empty_table_clashing_names_and_repeated_rows(spark):
    prepare(spark)
    schema = "doc_id long, text string, _row string, pairs int, n_best long"
    assert with_pair_counts(align(spark.createDataFrame([], schema), vocabulary(BYTES), vocabulary(PIECES)), 1 << 16).collect() == []
    docs = spark.createDataFrame([(1, "same words", "x", 1, 2), (1, "same words", "x", 1, 2), (None, "same words", "y", 0, 0)], schema)
    rows = with_pair_counts(align(docs, vocabulary(BYTES), vocabulary(PIECES)), 1 << 16).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "None"]
    assert {(r.n_links, r.count_sum, r.n_best) for r in rows} == {(2, 6, 2)}


def test_query_on_whole_table(spark, aligner):
    folder = "/root/testdata/sf0.001"
    docs = sorted(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect(), key=lambda r: r.doc_id)
    # Texts of a thousand bytes at most are compared in full; the corpus-wide counts need every text.
    found = {r.doc_id: r for r in QUERIES["op13_align_tokens"](spark, folder).collect()}
    assert sorted(found) == [r.doc_id for r in docs]
    short = [r for r in docs if r.text is None or len(r.text) <= 1000]
    for row, want in zip(short, [brute(aligner, r.text) for r in short]):
        a, b, written, links = want
        got = found[row.doc_id]
        assert (got.n_a, got.n_b, got.n_links) == (len(a), len(b), len(links))
        assert got.groups_sha256 == (hashlib.sha256(written.encode()).hexdigest() if a else "")

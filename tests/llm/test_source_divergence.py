"""Divergences against a plain loop over texts, terms and pairs of sources."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ampertide.llm import source_divergence as module
from ampertide.llm.common import prepare
from ampertide.llm.source_divergence import Divergences, _fold, _merge, _shares, source_divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def divergence(p, q):
    return (p - q) * (p - q) // q


def brute(rows, least=3, ranks=200):
    rows = [tuple(x or "" for x in r) for r in rows]
    df, counts = Counter(), defaultdict(Counter)
    for lang, source, text in rows:
        terms = [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        df.update((lang, t) for t in set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang in {r[0] for r in rows}:
        kept = [t for (l, t), n in df.items() if l == lang and n >= least]
        sources = sorted({s for l, s in counts if l == lang})

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum(divergence(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(-divergence(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
                out += [(lang, s, part, item, -v, k) for k, (v, item) in enumerate(found, 1)]
    return sorted(out)


def texts(seed, n):
    rng = np.random.default_rng(seed)
    words = ["the", "The", "café", "x1y", "ÉCOLE", "école", "漢字", "a-b", "Zebra", "rare", *(f"w{chr(97 + k)}" for k in range(26))]
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "de", "", "xx"], p=[0.7, 0.2, 0.05, 0.05])
        source = f"s{min(5, int(rng.exponential(2)))}"
        rows.append((str(lang), source, " ".join(rng.choice(words, rng.integers(0, 30)))))
    return rows


def found(spark, rows, **options):
    prepare(spark)
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    return sorted(tuple(r) for r in source_divergence(docs.repartition(5), **options).collect())


@pytest.mark.parametrize("chunk", [3, 20_000])
def test_as_by_brute_force(spark, chunk):
    rows = texts(1, 300) + [(None, None, None), ("en", None, "the the the"), ("only", "a", "one"), ("bare", "a", "x"), ("bare", "b", ""), ("bare", "c", None)]
    assert found(spark, rows, chunk=chunk, ranks=4) == brute(rows, ranks=4)


def test_repeated_rows_are_documents_of_their_own(spark):
    rows = [("en", "a", "one two")] * 3 + [("en", "b", "two")]
    result = found(spark, rows)
    assert result == brute(rows) and any(r[2] == "pair" and r[4] > 0 for r in result)


def test_ties_go_by_bytes(spark):
    rows = [("en", "a", "ß z 漢 é ab 😀")] * 3 + [("en", "b", "other")] * 3
    result = [r for r in found(spark, rows) if r[1] == "a" and r[2] == "term"]
    assert [r[3] for r in sorted(result, key=lambda r: r[5])] == sorted(["ß", "z", "漢", "é", "ab", "😀"], key=str.encode)


def test_empty_table_and_clashing_names(spark):
    prepare(spark)
    schema = "lang string, source string, text string, term string, chunk int, n long, doc_id long"
    assert source_divergence(spark.createDataFrame([], schema)).collect() == []
    rows = [("en", s, "word word", "t", 1, 2, 3) for s in "aabb"]
    result = source_divergence(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.source, r.item, r.value) for r in result if r.part == "pair") == [("a", "b", 0), ("b", "a", 0)]


def test_long_text_without_blanks(spark):
    rows = [("zh", s, "漢" * 200_000) for s in "abc"]
    result = found(spark, rows)
    assert len([r for r in result if r[2] == "pair"]) == 6


def batches(rows, size):
    return [pa.RecordBatch.from_pydict(dict(zip(("lang", "source", "text"), map(list, zip(*rows[i : i + size]))))) for i in range(0, len(rows), size)]


def test_spilled_stripes_merge_to_the_same(monkeypatch):
    rows = texts(2, 200)
    whole = {(r["lang"], r["term"]): r for b in _fold(iter(batches(rows, 500))) for r in b.to_pylist()}
    monkeypatch.setattr(module, "HELD_BYTES", 2_000)
    monkeypatch.setattr(module, "_FOLD_BYTES", 500)
    parts = [r for b in _fold(iter(batches(rows, 20))) for r in b.to_pylist()]
    assert len(parts) > 2 * len(whole)
    parts.sort(key=lambda r: (r["lang"], r["term"]))
    schema = pa.schema([("lang", pa.string()), ("term", pa.string()), ("df", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
    inputs = [pa.RecordBatch.from_pylist(parts[i : i + 7], schema) for i in range(0, len(parts), 7)]
    together = [r for b in _merge(1)(iter(inputs)) for r in b.to_pylist()]
    assert len(together) == len(whole)
    for r in together:
        want = whole[r["lang"], r["term"]]
        assert r["df"] == want["df"] and dict(zip(r["sources"], r["counts"])) == dict(zip(want["sources"], want["counts"]))


def test_large_counts_are_exact():
    n = np.array([5 * 10**13, 1])
    counts = np.array([[4 * 10**13, 0], [10**13, 1]])
    assert _shares(counts, n, 2).tolist() == [[1 + 10**9 * (int(c) + 1) // (int(m) + 2) for c, m in zip(row, n)] for row in counts]


def test_sums_beyond_64_bits_keep_their_halves():
    many = 40
    job = Divergences(["a", "b"], np.array([10**9, 10**9]), 2 * 10**9, many, 5)
    counts = np.zeros((many, 2), np.int64)
    counts[:, 0] = 10**9
    job.add([f"t{k}" for k in range(many)], counts)
    p, q = 1 + 10**9 * (10**9 + 1) // (10**9 + many), 1 + 10**9 // (10**9 + many)
    assert (int(job.high[0, 1]) << 32) + int(job.low[0, 1]) == many * divergence(p, q) > 1 << 63

"""Greedy string tiling against a search of all positions."""

from __future__ import annotations

import random
import re

from ampertide.llm import decontaminate as dc

SCHEMA = "doc_id long, text string, item_id long, _extra string"


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_cover(text, item):
    a, b = tokens(text), tokens(item)
    least = min(dc.SEED, len(b))
    free_a, free_b = [True] * len(a), [True] * len(b)
    while least:
        best = (0, 0, 0)
        for p in range(len(a)):
            for q in range(len(b)):
                k = 0
                while p + k < len(a) and q + k < len(b) and a[p + k] == b[q + k] and free_a[p + k] and free_b[q + k]:
                    k += 1
                if k > best[0]:
                    best = (k, p, q)
        k, p, q = best
        if k < least:
            break
        for i in range(k):
            free_a[p + i] = free_b[q + i] = False
    return len(b) - sum(free_b), len(b)


def make():
    rng = random.Random(5)
    word = lambda: rng.choice("abcdefgh")
    items = [" ".join(word() for _ in range(n)) for n in (15, 24, 31, 3, 18)] + [None, "", "é1 ß é1 ß é1 ß"]
    docs = [None, "", "a b c"]
    for _ in range(60):
        item = rng.choice([i for i in items if i]).split()
        cut = rng.randrange(len(item))
        moved = item[cut:] + [word() for _ in range(rng.randint(0, 3))] + item[:cut] if rng.random() < 0.6 else item[: cut + 1]
        around = [word() for _ in range(rng.randint(0, 30))]
        at = rng.randrange(len(around) + 1)
        docs.append(rng.choice([" ", ", ", "\n"]).join(around[:at] + moved + around[at:]).upper())
    docs.append(" ".join(["a"] * 3000))
    return docs, items


def test_against_all_positions(spark):
    docs, items = make()
    frame = spark.createDataFrame([(i, d, 1, None) for i, d in enumerate(docs)], SCHEMA)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    wanted = {}
    for d, text in enumerate(docs[:-1]):
        for i, item in enumerate(items):
            covered, n = brute_cover(text, item)
            if n and covered >= dc.COVERAGE * n:
                wanted[d, i] = covered
    for words in (10, 1000):
        rows = dc.leaks(frame.withColumnRenamed("doc_id", "_row"), bench, words).collect()
        assert {(r._row, r.item_id): r.covered for r in rows if r._row < len(docs) - 1} == wanted
    leaked = {d for d, _ in wanted} | {r._row for r in rows}
    report = dc.contamination(frame, bench).collect()
    assert len(report) == len(docs) and {r.doc_id for r in report if r.contaminated} == leaked
    left = dc.decontaminate(frame, bench)
    assert left.columns == frame.columns and {r.doc_id for r in left.collect()} == set(range(len(docs))) - leaked


def test_empty_tables(spark):
    frame = spark.createDataFrame([(1, "a b c d e f", 1, None)], SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.decontaminate(frame, none).count() == 1
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert dc.decontaminate(frame.limit(0), bench).count() == 0 and dc.decontaminate(frame, bench).count() == 0


def _both_tilings(text, item, length=5):
    import numpy as np

    text, item = np.array(text, np.uint64), np.array(item, np.uint64)
    pairs = [(p, q) for p in range(len(text) - length + 1) for q in range(len(item) - length + 1) if (text[p : p + length] == item[q : q + length]).all()]
    if not pairs:
        return None
    pairs.sort(key=lambda x: (x[0] - x[1], x[1]))
    where, there = (np.array(x, np.int64) for x in zip(*pairs))
    by_pairs = dc.tiling(where, there, length)
    return by_pairs, dc.tiling_by_length(text, np.unique(where), item, np.unique(there), length)


def test_tiling_by_length_marks_the_same_words():
    import random

    rng = random.Random(9)
    compared = 0
    for _ in range(400):
        kinds = rng.choice([1, 2, 3, 6])
        piece = [rng.randint(1, kinds) for _ in range(rng.randint(5, 30))]
        item = piece + [rng.randint(1, kinds) for _ in range(rng.randint(0, 20))]
        text = [rng.randint(1, kinds) for _ in range(rng.randint(0, 30))] + piece[rng.randint(0, 3) :] + piece[: rng.randint(0, 12)]
        found = _both_tilings(text, item)
        if found:
            compared += 1
            assert found[0] == found[1], (text, item)
    assert compared > 200


def test_text_of_one_word_again_and_again(spark):
    import time
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    block = dc.Block([1, 2], ["a " * 4_000, "b c d e f g h i j k"])
    tokens, words = dc._tokens(pa.array(["a " * 200_000]))
    tracemalloc.start()
    start = time.process_time()
    assert list(block.leaks(tokens, words.starts)) == [(0, 0, 4_000)]
    assert time.process_time() - start < 10 and tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()


def test_too_many_pairs_give_the_same_rows(monkeypatch):
    import random

    import pyarrow as pa

    rng = random.Random(2)
    prose = lambda n: " ".join(rng.choice(["the", "of", "cat", "sat", "mat"]) for _ in range(n))
    items = [prose(40) for _ in range(8)]
    texts = pa.array([prose(100) + " " + " ".join(items[k % 8].split()[5:35]) + " " + prose(20) for k in range(12)])
    block = dc.Block(list(range(8)), items)
    tokens, words = dc._tokens(texts)
    usual = list(block.leaks(tokens, words.starts))
    monkeypatch.setattr(dc, "_PAIRS", 0)
    assert usual and list(block.leaks(tokens, words.starts)) == usual


def test_clashing_names(spark):
    schema = "doc_id long, text string, _row int, _file string, _place long, item_id long"
    docs = spark.createDataFrame([(1, "one two three four five six", 3, "f", 4, 5), (2, "other words altogether in this text", 3, "f", 4, 5)], schema)
    items = spark.createDataFrame([(9, "one two three four five six")], "item_id long, text string")
    kept = dc.decontaminate(docs, items)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]

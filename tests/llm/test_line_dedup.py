"""Line dedup against a loop over chunks in order."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from ampertide.llm.line_dedup import PASSAGE_WORDS, chunk_array, line_dedup, passage_array

SCHEMA = "doc_id long, text string, gone string, n_lines long"


def passage(text):
    return len(text.split()) > (PASSAGE_WORDS if "\n" not in text else 0)


def test_against_loop(spark):
    rng = random.Random(3)
    lines = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 9))) for _ in range(200)]
    parts = ["\n".join(rng.sample(lines, 8)) for _ in range(6)] + [" ".join(["long"] * 60)]
    rows = []
    for i in range(60):
        own = [f"own {i} {k}" for k in range(rng.randint(1, 9))]
        at = rng.randrange(len(own))
        rows.append((i, "\n".join(own[:at] + [rng.choice(parts)] + own[at:]), None, 1))
    rows += [(60, None, None, 1), (61, "", None, 1), (62, "\n\n", None, 1), (63, "\n\n", None, 1), (64, rows[0][1], None, 1)]
    rows += [(65, "\n".join(f"line {k} {k % 97}" for k in range(5000)), None, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    cut = {r.doc_id: r.c for r in docs.select("doc_id", chunk_array(F.col("text")).alias("c")).collect()}
    seen, wanted = set(), {}
    for i, text, *_ in rows:
        if text is None:
            wanted[i] = (None, 0, 0)
            continue
        assert "\n".join(c.body for c in cut[i]) == text
        left, gone = [], 0
        for c in cut[i]:
            if passage(c.body) and c.body in seen:
                gone += 1
            else:
                left.append(c.body)
                seen.add(c.body)
        wanted[i] = ("\n".join(left), text.count("\n") + 1, gone)
    result = {r.doc_id: (r.text, r.n_lines, r.removed_chunks) for r in line_dedup(docs).collect()}
    assert result == wanted
    assert sum(w[2] for w in wanted.values()) > 40


def test_empty_table_and_repeated_rows(spark):
    assert line_dedup(spark.createDataFrame([], SCHEMA)).collect() == []
    text = "\n".join(f"a line {k}" for k in range(12))
    both = line_dedup(spark.createDataFrame([(1, text, None, 0), (1, text, None, 0)], SCHEMA)).collect()
    assert len(both) == 2 and min(len(r.text) for r in both) < len(text) == max(len(r.text) for r in both)


def planted(rng):
    """Rows of two texts at least per passage, which stands between lines of their own; and the passages."""
    words = lambda n, word="w": " ".join(f"{word}{rng.randrange(10**9)}" for _ in range(n))
    passages = [words(60) for _ in range(30)] + ["\n".join(words(n) for n in (3, 70, 4)) for _ in range(15)]
    passages += ["\n".join(words(4) for _ in range(3)) for _ in range(15)] + [f"{words(3)}\n\n{words(3)}"]
    rows = []
    for k, p in enumerate(passages * 2 + passages[::3]):
        rows.append((k, "\n".join([words(5, "own") for _ in range(k % 4)] + [p] + [words(5, "own") for _ in range(k % 3)]), None, 0))
    return rows, passages


def test_passages_go_whole_between_differing_lines(spark):
    rows, passages = planted(random.Random(5))
    result = {r.doc_id: r for r in line_dedup(spark.createDataFrame(rows, SCHEMA), passage_array).collect()}
    for i, text, *_ in rows:
        own = "\n".join(x for x in text.split("\n") if x.startswith("own"))
        assert result[i].text == (text if i < len(passages) else own)
        assert result[i].removed_chunks == (i >= len(passages))


def test_long_lines_are_chunks(spark):
    rows, passages = planted(random.Random(6))
    result = {r.doc_id: r.text for r in line_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, text, *_ in rows[len(passages) :]:
        assert all(x.startswith("own") or len(x.split()) <= PASSAGE_WORDS for x in result[i].split("\n"))


def test_passages_against_loop(spark):
    rng = random.Random(4)
    lines = ["", " ", "a", "b", "c", "d", "e f", " ".join(["long"] * 60)]
    rows = [(i, "\n".join(rng.choice(lines) + rng.choice(["", "", str(i)]) for _ in range(rng.randint(1, 12))), None, 0) for i in range(120)]
    rows += [(120, None, None, 0), (121, "", None, 0), (122, "\n\n", None, 0), (123, "a\nb\na\nb\na\nb", None, 0)]
    seen, wanted = set(), {}
    for i, text, *_ in rows:
        own = (text or "").split("\n")
        worded = [k for k, x in enumerate(own) if x.split()]
        gone = set()
        for a, b in [*zip(worded, worded[1:]), *((k, k) for k in worded if len(own[k].split()) > PASSAGE_WORDS)]:
            body = "\n".join(own[a : b + 1])
            gone |= set(range(a, b + 1)) if body in seen else set()
            seen.add(body)
        wanted[i] = (None if text is None else "\n".join(x for k, x in enumerate(own) if k not in gone), len(gone))
    result = line_dedup(spark.createDataFrame(rows, SCHEMA), passage_array).collect()
    assert {r.doc_id: (r.text, r.removed_lines) for r in result} == wanted
    assert sum(n for _, n in wanted.values()) > 100

"""Near-dedup against comparison of all sets."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from ampertide.llm import near_dup as nd
from ampertide.llm.components import components

SCHEMA = "doc_id long, text string, n long, label string"


def shingle_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(*(words[i:] for i in range(k)))) if len(words) >= k else frozenset([tuple(words)] if words else [])


def brute(rows, k):
    sets = {r[0]: shingle_set(r[1], k) for r in rows}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


@pytest.mark.parametrize("k", [2, 5])
def test_against_all_pairs(spark, k):
    rng = random.Random(k)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of"] * 60
    texts = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.choice([1, 1, 3, 6])):
            copy = [rng.choice(vocabulary) if rng.random() < rng.choice([0, 0.02, 0.04]) else w for w in base]
            texts.append(" ".join(copy))
    hot = [rng.choice(vocabulary) for _ in range(150)]
    for _ in range(70):
        texts.append(" \t".join(rng.choice(vocabulary) if rng.random() < 0.035 else w for w in hot))
    texts += [None, "", " \n", "One", "one", "A b", "a B c", "x y z u v w", "x y z u v w q", texts[0], "long " * 40_000]
    rng.shuffle(texts)
    rows = [(i * 3, t, None, None) for i, t in enumerate(texts)]
    result = nd.near_dup(spark.createDataFrame(rows, SCHEMA), words=k).collect()
    assert len(result) == len(rows)
    assert {r.doc_id: tuple(r)[1:] for r in result} == brute(rows, k)


def test_odd_rows(spark):
    assert nd.near_dup(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, "a b c", 1, ""), (2, "a b c", 1, ""), (2, "a b c", 1, ""), (5, "A  B C", 1, "")]
    result = nd.near_dup(spark.createDataFrame(rows, SCHEMA), words=2).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in result) == [(-1, -1, True), (2, 2, True), (2, 2, True), (5, 2, False)]


def test_components_of_chain_star_and_ring(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(300 + i, 300 + (i * 7 + 7) % 31) for i in range(31)]
    found = {r.id: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(100, 161)} == {100}
    assert {found[i] for i in range(200, 260)} == {7}
    root = {}

    def top(i):
        while root.get(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    assert found == {i: top(i) for i in {x for a, b in links if a != b for x in (a, b)}}


def test_two_texts_under_one_id(spark):
    """Texts that share an id are nodes of their own: a link of one is none of the other."""
    words = lambda seed, n=40: " ".join(f"{seed}{i}" for i in range(n))
    rows = [(1, words("a")), (1, words("b")), (3, words("a")), (5, words("b")), (7, words("c")), (9, words("b") + " more")]
    result = nd.near_dup(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    found = {(r.doc_id, r.component_id) for r in result}
    assert found == {(1, 1), (3, 1), (5, 1), (7, 7), (9, 1)} and len(result) == 6
    # Component 1 of "a" and component 1 of "b" are two groups: each keeps one row.
    schema = "doc_id long, text string, _row int, cls string, root long"
    kept = nd.distinct_documents(spark.createDataFrame([(*r, 1, "x", 2) for r in rows], schema), words=2)
    assert kept.columns == ["doc_id", "text", "_row", "cls", "root"]
    assert sorted((r.doc_id, r.text[0]) for r in kept.collect()) == [(1, "a"), (1, "b"), (7, "c")]


def test_distinct_documents_keep_rows_without_text_or_id(spark):
    rows = [(1, None), (1, None), (2, ""), (None, "x y z"), (None, "x y z"), (4, "x y z"), (4, "x y z"), (5, "X y  z")]
    kept = nd.distinct_documents(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "1", "2", "4", "None", "None"]


def test_chunks_of_a_cluster_are_cut_by_bytes(spark, monkeypatch):
    """A dense group of long texts with members just apart: the result does not depend on where chunks are cut."""
    rng = random.Random(12)
    base = [f"w{rng.randint(0, 900)}" for _ in range(300)]
    rows = [(i, " ".join(f"z{rng.randint(0, 900)}" if rng.random() < 0.05 else w for w in base)) for i in range(60)]
    monkeypatch.setattr(nd, "CHUNK_BYTES", 5_000)
    result = nd.near_dup(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    assert {r.doc_id: tuple(r)[1:] for r in result} == brute(rows, 2)


def test_unlike_texts_that_share_a_passage(spark, monkeypatch):
    """Texts that share a passage and little else are not compared with one another; near copies among them are found."""
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(40))
    words = lambda n: [f"w{rng.randint(0, 5000)}" for _ in range(n)]
    texts = [f"{passage} {' '.join(words(15))}" for _ in range(400)]
    texts += [" ".join("x" if rng.random() < 0.03 else w for w in text.split()) for text in texts[:40] for _ in range(2)]
    base = passage.split()[:20] + words(150)
    texts += [" ".join(f"z{rng.randint(0, 300)}" if rng.random() < 0.055 else w for w in base) for _ in range(120)]
    rng.shuffle(texts)
    stored, written = {}, nd.materialise

    def counted(df, label):
        table = written(df, label)
        stored[label] = stored.get(label, 0) + table.count()
        return table

    monkeypatch.setattr(nd, "materialise", counted)
    monkeypatch.setattr(nd, "CHUNK", 32)
    monkeypatch.setattr(nd, "SHARED", 8)
    rows = list(enumerate(texts))
    result = nd.near_dup(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    assert {r.doc_id: tuple(r)[1:] for r in result} == brute(rows, 2)
    # In chunks, the texts with the passage alone were some 15 times 15 pairs; the near copies of one base remain.
    assert 0 < stored["jobs"] < 30


def test_commonest_tokens_only_are_told_apart(spark, monkeypatch):
    """The order of tokens decides what is compared, never what is found."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(30)]
    texts = [passage + [f"w{rng.randint(0, 60)}" for _ in range(12)] for _ in range(90)]
    rows = list(enumerate(" ".join("y" if rng.random() < 0.04 else w for w in text) for text in texts + texts[:30]))
    monkeypatch.setattr(nd, "CHUNK", 16)
    for common, shared in ((1, 2), (1, 10_000), (1 << 20, 2)):
        monkeypatch.setattr(nd, "COMMON", common)
        monkeypatch.setattr(nd, "SHARED", shared)
        result = nd.near_dup(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
        assert {r.doc_id: tuple(r)[1:] for r in result} == brute(rows, 2)


def test_links_of_two_chunks_are_a_forest():
    """Two chunks of one dense group give no more links than connect it."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    text = lambda: " ".join("x" if rng.random() < 0.01 else w for w in base)
    member = lambda i: {"cls": i, "label": i, "text": text()}
    row = {"left": [member(i) for i in range(40)], "right": [member(i) for i in range(100, 150)]}
    (found,) = nd._similar(2)([pa.RecordBatch.from_pylist([row])])
    labels = {i: i for i in [*range(40), *range(100, 150)]}
    for a, b in zip(*(found.column(c).to_pylist() for c in ("a", "b"))):
        low, high = sorted((labels[a], labels[b]))
        labels = {i: low if label == high else label for i, label in labels.items()}
    sets = {m["cls"]: shingle_set(m["text"], 2) for m in row["left"] + row["right"]}
    for i in range(40):
        for j in range(100, 150):
            assert labels[i] == labels[j] or 100 * len(sets[i] & sets[j]) < 80 * len(sets[i] | sets[j])
    assert len(found) < 90

"""Best fit against a plain loop, and the laws of the shards."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest

from ampertide.llm import sharding as sh

SCHEMA = "doc_id long, text string, shard string, _row int"


def plain_best_fit(sizes, rooms, capacity):
    bins, rooms = [], list(rooms)
    for size in sizes:
        fits = [(r, i) for i, r in enumerate(rooms) if r >= size]
        if fits:
            i = min(fits)[1]
        elif capacity is not None or not rooms:
            rooms.append(max(capacity or 0, size))
            i = len(rooms) - 1
        else:
            i = max(range(len(rooms)), key=lambda k: (rooms[k], -k))
        rooms[i] -= size
        bins.append(i)
    return bins, rooms


@pytest.mark.parametrize("seed", range(8))
def test_best_fit_against_loop(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(1, 40) for _ in range(rng.randint(0, 120))), reverse=True)
    for rooms, capacity in (([], 50), ([100] * 5, None), ([30, 10, 10], 45)):
        assert sh.best_fit(sizes, rooms, capacity) == plain_best_fit(sizes, rooms, capacity)


def check(docs, result, slack):
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in result) == sorted((d[0] is None, d[0] or 0) for d in docs)
    shards, of_text, slots = defaultdict(int), {}, defaultdict(list)
    texts = {d[0]: d[1] for d in docs}
    for r in result:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        assert of_text.setdefault(data, r.shard) == r.shard
        shards[r.shard] += r.size
        slots[r.shard].append(r.slot)
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    assert set(shards) <= set(range(8))
    sizes = sorted(shards.get(i, 0) for i in range(8))
    assert sizes[-1 - slack] - sizes[0] <= max(30, 0.01 * sum(sizes)), sizes


def test_documents(spark, monkeypatch):
    monkeypatch.setattr(sh, "GROUPS_PER_TASK", 300)
    rng = random.Random(4)
    docs = [(i, "é" * rng.randint(0, 30) + str(rng.randint(0, 400)) + "x" * rng.choice([0, 0, 0, 500]), None, 1) for i in range(1500)]
    docs += [(-1, None, None, 1), (-2, "", None, 1), (None, "no id", None, 1)]
    check(docs, sh.shard_documents(spark.createDataFrame(docs, SCHEMA)).collect(), 0)
    hot = docs + [(i, "hot text " * 9, None, 1) for i in range(2000, 3500)]
    check(hot, sh.shard_documents(spark.createDataFrame(hot, SCHEMA)).collect(), 1)


def test_capacity(spark):
    rng = random.Random(6)
    groups = [(f"k{i}", rng.randint(1, 60)) for i in range(500)] + [("big", 250)]
    placed = {r.key: r.shard for r in sh.pack_capacity(spark.createDataFrame(groups, "key string, bytes long"), 100).collect()}
    used = defaultdict(int)
    for key, size in groups:
        used[placed[key]] += size
    assert set(used) == set(range(len(used)))
    assert all(u <= 100 for s, u in used.items() if s != placed["big"]) and used[placed["big"]] == 250
    assert len(used) <= 1 + 1.05 * sum(s for k, s in groups if k != "big") / 100 + 1


def test_empty_table(spark):
    assert sh.shard_documents(spark.createDataFrame([], SCHEMA)).collect() == []

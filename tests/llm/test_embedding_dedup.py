"""Links and components of embeddings against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from ampertide.llm.common import prepare
from ampertide.llm.embedding_dedup import centroids, cells, embedding_dedup, linked, normalised, placed, split
from ampertide.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    """``n_links, component`` per row, by all pairs and repeated merging."""
    units = []
    for _, vector, label in rows:
        good = vector is not None and label is not None and len(vector) and all(x is not None and math.isfinite(x) for x in vector) and any(vector)
        units.append(np.asarray(vector, np.float32).astype(np.float64) if good else None)
    near = {i: [] for i in range(len(rows))}
    for i, x in enumerate(units):
        for j, y in enumerate(units):
            if i != j and x is not None and y is not None and rows[i][2] == rows[j][2] and len(x) == len(y):
                a, b = x / np.abs(x).max(), y / np.abs(y).max()
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= cosine:
                    near[i].append(j)
    out = {}
    for i in near:
        seen, queue = {i}, [i]
        while queue:
            for j in near[queue.pop()]:
                if j not in seen:
                    seen.add(j)
                    queue.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out[i] = (rows[i][0], len(near[i]), min(ids, default=None))
    return sorted(out.values(), key=str)


def found(spark, rows, **options):
    prepare(spark)
    result = embedding_dedup(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in result)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in result), key=str)


def sample(seed, n, size=8, groups=6, spread=0.05):
    """Vectors in groups around some directions, in two labels, with equal ones among them."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(groups, size))
    vectors = middle[rng.integers(0, groups, n)] + rng.normal(size=(n, size)) * rng.choice([0.01, spread, 0.15], n)[:, None]
    vectors[n // 2 : n // 2 + n // 8] = vectors[0]
    return [(i, vectors[i].astype(np.float32).tolist(), int(rng.integers(0, 2))) for i in range(n)]


@pytest.mark.parametrize("cell, block", [(1024, 4096), (20, 4096), (20, 16), (1024, 16)])
def test_as_by_all_pairs(spark, cell, block):
    rows = sample(3, 240)
    assert found(spark, rows, cell=cell, block=block) == brute(rows)


def test_chains_through_cells(spark):
    """A closed ring of vectors 5 degrees apart is one component, whatever cells it runs through."""
    rows = [(k, [math.cos(math.radians(5 * k)), math.sin(math.radians(5 * k)), 0.01], 1) for k in range(72)]
    result = found(spark, rows, cell=6, block=5)
    assert result == brute(rows)
    assert {(n, c) for _, n, c in result} == {(4, 0)}


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 2.0], 1),
        (2, [2.0, 4.0], 1),
        (3, [1.0, 2.0], None),
        (4, [1.0, 2.0], 2),
        (5, None, 1),
        (6, [], 1),
        (7, [0.0, 0.0], 1),
        (8, [-0.0, 0.0], 1),
        (9, [1.0, None], 1),
        (10, [1.0, float("nan")], 1),
        (11, [float("inf"), 1.0], 1),
        (12, [1.0, 2.0, 0.0], 1),
        (13, [1e-30, 2e-30], 1),
        (14, [1e38, 2e38], 1),
        (None, [1.0, 2.0], 1),
        (None, [5.0, -1.0], 1),
        (None, None, None),
        (15, [-1.0, -2.0], 1),
        (2, [-4.0, 2.0], 1),
        (16, [-4.0, 2.01], 1),
    ]
    assert found(spark, rows) == brute(rows)


def test_repeated_rows_link_each_other(spark):
    rows = [(1, [0.5, 0.5], 1), (1, [0.5, 0.5], 1), (2, [0.5, 0.5], 1)]
    assert found(spark, rows) == [(1, 2, 1), (1, 2, 1), (2, 2, 1)]


def test_empty_table_and_clashing_names(spark):
    prepare(spark)
    schema = f"{SCHEMA}, cls int, cell string, weight int, root int, vector string"
    assert embedding_dedup(spark.createDataFrame([], schema)).collect() == []
    rows = [(i, [1.0, float(i % 2)], 1, 7, "x", 7, 7, "y") for i in range(4)]
    result = embedding_dedup(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in result) == [(0, 1, 0), (1, 1, 1), (2, 1, 0), (3, 1, 1)]


def test_every_vector_has_one_home_and_all_partners_beside_it(spark):
    prepare(spark)
    rng = np.random.default_rng(5)
    middle = normalised(rng.normal(size=(30, 16)))
    vectors = normalised(middle[rng.integers(0, 30, 1500)] + 0.05 * rng.normal(size=(1500, 16)))
    rows = [("1", k, True, 1, bytearray(v.tobytes())) for k, v in enumerate(vectors)]
    placed_rows = cells(spark.createDataFrame(rows, "cell string, cls long, home boolean, weight long, vector binary"), "float64", 0.98, 100).collect()
    home = {r.cls: r.cell for r in placed_rows if r.home}
    assert len(home) == 1500 == sum(r.home for r in placed_rows)
    assert len(set(home.values())) > 10
    there = {(r.cls, r.cell) for r in placed_rows}
    assert len(there) == len(placed_rows) < 4 * 1500
    for i, j in zip(*np.nonzero(linked(vectors, vectors, 0.98))):
        assert (j, home[i]) in there


def test_split_is_left_out_where_it_saves_nothing():
    rng = np.random.default_rng(6)
    one_group = normalised(np.ones(32) + 0.01 * rng.normal(size=(500, 32)))
    assert split(one_group, np.ones(500, bool), 500, 0.98, 50) is None
    apart = normalised(np.repeat(np.eye(32), 20, axis=0) + 0.01 * rng.normal(size=(640, 32)))
    centres = split(apart, np.ones(640, bool), 640, 0.98, 50)
    home, there = placed(apart, centres, 0.98)
    assert len(centres) > 4 and there.sum() < 1.5 * len(apart)


def test_centroids_are_unit_vectors_and_repeat():
    vectors = normalised(np.random.default_rng(7).normal(size=(300, 12)))
    first, second = centroids(vectors, 7), centroids(vectors, 7)
    assert np.array_equal(first, second) and np.allclose((first * first).sum(axis=1), 1)


def test_threshold_is_met_exactly():
    left = normalised(np.array([[3.0, 4.0]]))
    right = normalised(np.array([[4.0, 3.0], [4.0, 3.0000001]]))
    assert linked(left, right, 0.96).tolist() == [[True, True]]
    assert linked(left, right, 0.9600000001).tolist()[0][0] is False


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    result = QUERIES["op11_embedding_dedup"](spark, folder).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in result), key=str) == brute(rows)


def test_double_precision_is_kept(spark):
    """Vectors that differ only beyond single precision are classes of their own, with the exact threshold between them."""
    prepare(spark)
    step = 1e-12
    rows = [(k, [0.98 + k * step, math.sqrt(1 - (0.98 + k * step) ** 2)], 1) for k in (-2, -1, 1, 2)] + [(9, [1.0, 0.0], 1)]
    result = embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r.vec_id: r.n_links for r in result} == {-2: 3, -1: 3, 1: 4, 2: 4, 9: 2}

"""Embedding near-dedup: spherical k-means cells, blocked cosine products inside them.

Vectors are compared only with vectors of their label and length. Equal vectors are one
class with a weight, so a vector repeated by the million is one row from then on.

1. Cells begin as labels. A cell of more than ``CELL`` classes is split by spherical
   k-means, fitted on about ``SAMPLE`` of its classes: each class has its *home* in the
   cell of the centroid ``c`` nearest to it. A class that may have a partner at home in
   another cell is a *visitor* there as well: two unit vectors with a cosine of
   ``COSINE`` at least are no more than ``r = sqrt(2 - 2 COSINE)`` apart, so ``x`` has
   no partner at home in the cell of ``d`` if, for any centroid ``b``,
   ``x.b - x.d > r |b - d|``. ``NEAREST`` centroids take the place of ``b``. Cells are
   split again while that leaves less work and few visitors; the sample tells.
2. In each last cell the classes at home are compared with all that are there, in blocks
   of ``BLOCK`` by matrix products in double precision. So every link is found, from both
   of its ends, each once. A task gives out how many vectors each class is linked with,
   and for each class it has seen one row that names its component within the block;
   a dense group leaves it as one row a member, never as pairs.
3. Components over those rows; the vector with the smallest ``vec_id`` is kept.

Embeddings with clusters need one or two cells a vector. In vectors without any, spread
evenly over many dimensions, a split saves little, and blocks of whole labels remain:
exact, with work in the square of a label's classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampertide.llm.common import by_value, lean, unit
from ampertide.llm.components import components
from ampertide.session import materialise

COSINE = 0.98
#: Classes that a cell may hold, and those on which its centroids are fitted.
CELL = 1024
SAMPLE = 4096
#: Most parts of one split, rounds of fitting, and centroids tried as the nearer one.
PARTS = 64
ROUNDS = 8
NEAREST = 4
#: A split must leave no more than this share of the products, and no more rows than so many for each class at home.
WORTH = 0.9
COPIES = 5.0
#: Classes in one block of products.
BLOCK = 4096
#: Rows of a product at once.
_ROWS = 256
#: Products this close to the threshold are computed anew with exact sums.
_NEAR = 1e-9
#: Added to distances between unit vectors, so that rounding excludes no cell.
_SLACK = 1e-9

by_value(__name__)

_PLACED = "cell string, cls long, home boolean, weight long, vector binary"
_COUNTED = "cls long, others long, root long"


def _units(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """Unit vectors in double precision, a row each, from the bytes of vectors of one length."""
    return normalised(np.stack([np.frombuffer(v, kind) for v in column.to_pylist()]).astype(np.float64))


def _read(kind: str):
    """Embeddings as bytes of their own precision; null where a vector has no direction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _bytes_of(batch, kind)

    return run


def _bytes_of(batch: pa.RecordBatch, kind: str) -> pa.RecordBatch:
    lists = batch.column("embedding")
    ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)).tolist()
    flat = lists.flatten()
    values = np.asarray(pc.fill_null(flat, 0.0)).astype(kind) + np.array(0, kind)  # no negative zeros
    bad = ~np.asarray(pc.is_valid(flat)).astype(bool) | ~np.isfinite(values)
    vectors = []
    for start, end in zip([0, *ends], ends):
        some = values[start:end]
        vectors.append(some.tobytes() if end > start and some.any() and not bad[start:end].any() else None)
    columns = [batch.column("vec_id"), batch.column("label"), pa.array(vectors, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "vector"])


def normalised(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; the largest component goes first, so that no square runs over."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def centroids(vectors: np.ndarray, parts: int) -> np.ndarray:
    """Spherical k-means: unit centroids, begun at evenly spread vectors of the sample."""
    found = vectors[np.linspace(0, len(vectors) - 1, parts).astype(np.int64)].copy()
    for _ in range(ROUNDS):
        sums = np.zeros_like(found)
        np.add.at(sums, (vectors @ found.T).argmax(axis=1), vectors)
        sizes = np.sqrt((sums * sums).sum(axis=1))
        full = sizes > 0
        found[full] = sums[full] / sizes[full, None]
    return np.unique(found, axis=0)


def placed(vectors: np.ndarray, centres: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The home of each vector, and all cells where a partner may have its home."""
    near = vectors @ centres.T
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
    reach = math.sqrt(2 - 2 * cosine) + _SLACK
    home = near.argmax(axis=1)
    there = np.ones(near.shape, bool)
    row = np.arange(len(vectors))
    for b in np.argsort(-near, axis=1)[:, :NEAREST].T:
        there &= near[row, b][:, None] - near <= reach * apart[b] + _SLACK
    there[row, home] = True
    return home, there


def split(vectors: np.ndarray, homes: np.ndarray, size: int, cosine: float, cell: int) -> np.ndarray | None:
    """Centroids for a cell of ``size`` classes, fitted on a sample of them; none if no split is worth it.

    ``homes`` tells which of the sample are at home in the cell.
    """
    parts = min(PARTS, -(-size // cell), len(vectors))
    while parts > 1 and homes.any():
        centres = centroids(vectors, parts)
        home, there = placed(vectors, centres, cosine)
        work = np.bincount(home[homes], minlength=len(centres)) @ there.sum(axis=0) / (homes.sum() * len(vectors))
        if work <= WORTH and there.sum() <= COPIES * homes.sum():
            return centres
        parts //= 2
    return None


def _fit(kind: str, cosine: float, cell: int):
    def run(key: tuple[pa.Scalar, ...], sample: pa.Table) -> pa.Table:
        size = sample.column("size")[0].as_py()
        centres = split(_units(sample.column("vector"), kind), np.asarray(sample.column("home")), size, cosine, cell)
        rows = {"cell": [], "parts": [], "centres": []}
        if centres is not None:
            rows = {"cell": [key[0].as_py()], "parts": [len(centres)], "centres": [centres.tobytes()]}
        return pa.table(rows, schema=pa.schema([("cell", pa.string()), ("parts", pa.int64()), ("centres", pa.binary())]))

    return run


def _place(kind: str, cosine: float):
    """The classes of a chunk in the parts of their cell; a chunk to which hashing gave no class has none."""

    def run(key: tuple[pa.Scalar, ...], some: pa.Table, fitted: pa.Table) -> pa.Table:
        if not len(some):
            kinds = {"cell": pa.string(), "cls": pa.int64(), "home": pa.bool_(), "weight": pa.int64(), "vector": pa.binary()}
            return pa.table({k: pa.array([], t) for k, t in kinds.items()})
        vectors = _units(some.column("vector"), kind)
        centres = np.frombuffer(fitted.column("centres")[0].as_py(), np.float64).reshape(fitted.column("parts")[0].as_py(), -1)
        home, there = placed(vectors, centres, cosine)
        row, part = np.nonzero(there)
        out = some.select(["cls", "home", "weight", "vector"]).take(pa.array(row))
        own = pc.and_(out.column("home"), pa.array(home[row] == part))
        names = pa.array([f"{key[0].as_py()}/{p}" for p in range(len(centres))], pa.string()).take(pa.array(part))
        return pa.table({"cell": names, "cls": out.column("cls"), "home": own, "weight": out.column("weight"), "vector": out.column("vector")})

    return run


def _exactly(x: np.ndarray, y: np.ndarray) -> float:
    return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))


def linked(left: np.ndarray, right: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of ``left`` and ``right`` have a cosine of ``cosine`` at least."""
    products = left @ right.T
    found = products >= cosine
    for i, j in zip(*np.nonzero(np.abs(products - cosine) <= _NEAR)):
        found[i, j] = _exactly(left[i], right[j]) >= cosine
    return found


def _joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Labels of the components after linking ``i`` with ``j``; a label is the place of a member that has itself as label."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label[label], label):
            label[:] = label[label]


def _compare(kind: str, cosine: float):
    """Of a block of classes at home against a block of all: linked vectors and the component of each class."""

    def run(key: tuple[pa.Scalar, ...], homes: pa.Table, there: pa.Table) -> pa.Table:
        if not len(homes) or not len(there):
            return pa.table({"cls": [], "others": [], "root": []}, schema=pa.schema([(n, pa.int64()) for n in ("cls", "others", "root")]))
        left, right = _units(homes.column("vector"), kind), _units(there.column("vector"), kind)
        own, other = np.asarray(homes.column("cls")), np.asarray(there.column("cls"))
        names, place = np.unique(np.concatenate([own, other]), return_inverse=True)
        at_left, at_right = place[: len(own)], place[len(own) :]
        weights = np.asarray(there.column("weight"))
        label = np.arange(len(names))
        others = np.zeros(len(names), np.int64)
        for start in range(0, len(left), _ROWS):
            found = linked(left[start : start + _ROWS], right, cosine)
            row, column = np.nonzero(found)
            apart = own[start + row] != other[column]
            row, column = row[apart] + start, column[apart]
            np.add.at(others, at_left[row], weights[column])
            _joined(label, at_left[row], at_right[column])
        seen = (others > 0) | (label != np.arange(len(names)))
        return pa.table({"cls": pa.array(names[seen]), "others": pa.array(others[seen]), "root": pa.array(names[label[seen]])})

    return run


def _chunks(size: str, of: int):
    return F.greatest(F.lit(1), F.ceil(F.col(size) / of)).cast("int")


def cells(classes: DataFrame, kind: str, cosine: float, cell: int) -> DataFrame:
    """``cell, cls, home, weight, vector``: every class at home in one cell, and a visitor wherever a partner may be at home."""
    rows, done = classes, []
    while True:
        sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.count_if("home").alias("homes"))
        sizes = materialise(sizes.where(f"size > {cell} and homes > 0"), "sizes")
        if sizes.isEmpty():
            done.append(rows)
            break
        large = rows.join(sizes, "cell")
        sample = large.where(unit(F.col("cls"), "sample") < F.lit(SAMPLE) / F.col("size")).select("cell", "size", "home", "vector")
        fitted = sample.groupBy("cell").applyInArrow(_fit(kind, cosine, cell), "cell string, parts long, centres binary")
        fitted = materialise(fitted, "centres")
        if fitted.isEmpty():
            done.append(rows)
            break
        split_rows = rows.join(fitted.select("cell"), "cell", "left_semi")
        done.append(rows.join(fitted.select("cell"), "cell", "left_anti"))
        # A chunk of classes meets one copy of its cell's centroids.
        jobs = materialise(fitted.join(sizes, "cell").select("cell", "parts", "centres", F.explode(F.sequence(F.lit(0), _chunks("size", BLOCK) - 1)).alias("chunk"), "size"), "jobs")
        spread = split_rows.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("cls"), _chunks("size", BLOCK)).cast("int"))
        rows = spread.groupBy("cell", "chunk").cogroup(jobs.groupBy("cell", "chunk")).applyInArrow(_place(kind, cosine), _PLACED)
        rows = materialise(rows, "placed")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def links(classes: DataFrame, kind: str, cosine: float = COSINE, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """``cls, others, root`` rows: vectors linked with a class, to be summed, and a class it hangs together with.

    ``classes``: ``cell, cls, home, weight, vector``, the vectors as bytes of ``kind``.
    """
    rows = materialise(cells(classes, kind, cosine, cell), "cells")
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.count_if("home").alias("homes"))
    sizes = materialise(sizes.where("homes > 0 and size > 1").withColumns({"left": _chunks("homes", block), "right": _chunks("size", block)}), "blocks")
    sized = rows.join(sizes, "cell")
    of = F.xxhash64("cls")
    pick = ["cell", "left_block", "right_block", "cls", "weight", "vector"]
    left = sized.where("home").withColumn("left_block", F.pmod(of, "left").cast("int"))
    left = left.withColumn("right_block", F.explode(F.sequence(F.lit(0), F.col("right") - 1))).select(*pick)
    right = sized.withColumn("right_block", F.pmod(of, "right").cast("int"))
    right = right.withColumn("left_block", F.explode(F.sequence(F.lit(0), F.col("left") - 1))).select(*pick)
    keys = ["cell", "left_block", "right_block"]
    # New column identities: both sides come from one table.
    right = right.toDF(*pick)
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_compare(kind, cosine), _COUNTED)
    return materialise(found, "linked")


def embedding_dedup(vectors: DataFrame, cosine: float = COSINE, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``.

    Vectors of one label (not null) and one length are linked if their cosine in double
    precision is ``cosine`` at least. A null, empty or zero vector, or one with a null or
    non-finite component, is linked with nothing. ``n_links`` counts the other rows linked
    directly, ``component_id`` is the smallest ``vec_id`` that links reach. Rows that share
    a ``vec_id`` each follow their own vector; a row without ``vec_id`` counts as a link of
    others, has the id of its component, null if there is none, and is kept only then.
    Other columns are ignored.
    """
    kind = "float32" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "float64"
    embedding = F.col("embedding").cast("array<float>" if kind == "float32" else "array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), embedding.alias("embedding"))
    rows = materialise(rows.mapInArrow(lean(_read(kind)), "vec_id long, label string, vector binary"), "vectors")
    alike = rows.where("label is not null and vector is not null").groupBy("label", "vector").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first"))
    # The number of a class is given before the table is written, so every reader sees the same.
    classes = materialise(alike.withColumn("cls", F.monotonically_increasing_id()), "classes")
    start = F.concat_ws(":", F.length("vector").cast("string"), "label")
    found = links(classes.select(start.alias("cell"), "cls", F.lit(True).alias("home"), "weight", "vector"), kind, cosine, cell, block)
    others = found.groupBy("cls").agg(F.sum("others").alias("others"))
    labels = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    known = classes.join(others, "cls", "left").join(labels.select(F.col("id").alias("cls"), "label").withColumnRenamed("label", "root"), "cls", "left")
    known = materialise(known.withColumn("root", F.coalesce("root", "cls")), "known")
    firsts = known.groupBy("root").agg(F.min("first").alias("component_id"))
    known = known.join(firsts, "root").select("label", "vector", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    out = rows.join(known, ["label", "vector"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )

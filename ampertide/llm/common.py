"""What several operators share: word patterns, checked broadcasts, code shipping, word tables."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampertide.session import configure

#: Words and the white space between them, in every operator of this package.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

#: A frame is broadcast only if it is known to take no more bytes than this.
BROADCAST_BYTES = 64 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of this package on top of the library's: texts are large, so Arrow batches have few rows."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def by_value(name: str) -> None:
    """Send the functions of this module to executors as code, so that they need no installed copy."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


def _kept() -> dict:
    return vars(sys.modules.setdefault("_ampertide_kept", types.ModuleType("_ampertide_kept"))).setdefault("objects", {})


def worker_kept(key: str, make):
    """An object that stays in the Python worker from task to task, made when first asked for; one at a time."""
    kept = _kept()
    if key not in kept:
        kept.clear()
        kept[key] = make()
    return kept[key]


def lean(run, key: str | None = None):
    """``run`` for tasks that leave a small worker behind.

    What other functions have kept in the worker goes first, but for the object of
    ``key``. When the batches are through, memory that they took goes back to the system.
    """

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for other in [k for k in _kept() if k != key]:
            del _kept()[other]
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return outer


def small(df: DataFrame, size: int) -> DataFrame:
    """``df`` with a broadcast hint if its ``size`` in bytes is within the bound."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def unit(*cols: Column | str | int) -> Column:
    """A number in [0, 1) that depends on the arguments only."""
    parts = [c if isinstance(c, Column) else F.lit(c) for c in cols]
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


class Words:
    """The words of many texts as numbers of a table of distinct words."""

    def __init__(self, texts: pa.Array, lower: bool = True):
        texts = pc.fill_null(texts, "").cast(pa.string())
        if lower:
            texts = pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(texts)
        flat = lists.flatten()
        present = pc.greater(pc.binary_length(flat), 0)
        full = np.asarray(present)
        owner = np.repeat(np.arange(len(texts)), np.diff(np.asarray(lists.offsets)))[full]
        coded = flat.filter(present).dictionary_encode()
        self.codes = np.asarray(coded.indices).astype(np.int64)
        self.table = coded.dictionary
        self.counts = np.bincount(owner, minlength=len(texts))
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])


by_value(__name__)


def ranges(counts: np.ndarray) -> np.ndarray:
    """0..n-1 for every n of ``counts``, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def slices(frames: Iterator[pa.RecordBatch], most: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of up to ``most`` bytes of text; one text is never cut."""
    for batch in frames:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if total + n > most and i > start:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < len(sizes):
            yield batch.slice(start)


def joined(frames: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches: neighbours are put together up to ``most`` bytes, none is cut."""
    held, total = [], 0
    for batch in frames:
        if held and total + batch.nbytes > most:
            yield pa.concat_batches(held)
            held, total = [], 0
        held.append(batch)
        total += batch.nbytes
    if held:
        yield pa.concat_batches(held)

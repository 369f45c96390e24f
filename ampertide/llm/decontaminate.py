"""Benchmark decontamination by greedy string tiling.

The benchmark is the query set: it goes through in blocks of a bounded number of words,
each block broadcast to one pass over all documents, so documents are never shuffled
and a frequent passage meets no hot key. In a pass

1. rolling Karp-Rabin hashes of every ``SEED`` words of a document are looked up among
   those of the block: shared seeds name the candidate pairs of document and item;
2. seeds on one diagonal join to matches, and the longest match whose words are still
   unmarked on both sides is marked, again and again, until none of ``SEED`` words is left
   (where words repeat so often that pairs of equal seeds are too many, the greatest length
   of a match is searched by hashes of whole windows instead, with the same tiles);
3. an item of which at least ``COVERAGE`` of the words are marked has leaked, in
   whatever order its passages stand.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampertide.llm.common import Words, by_value, lean, slices, small
from ampertide.session import free_name, materialise, with_row_id

SEED = 5
COVERAGE = 0.5
BLOCK_WORDS = 2_000_000
_BATCH_BYTES = 8 << 20
_BITS = 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Pairs of equal seeds of a text and the items that are held at once.
_PAIRS = 1 << 20

by_value(__name__)


def plain(texts: pa.Array) -> pa.Array:
    """Lower-case letters and digits, with blanks for anything else."""
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "").cast(pa.string())), r"[^\p{L}\p{N}]+", " ")


def _tokens(texts: pa.Array) -> tuple[np.ndarray, Words]:
    """A hash per word of all texts."""
    words = Words(plain(texts), lower=False)
    if not len(words.table):
        return np.zeros(0, np.uint64), words
    return pd.util.hash_array(words.table.to_numpy(zero_copy_only=False), categorize=False)[words.codes], words


def _rolled(tokens: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position on."""
    out = np.zeros(max(0, len(tokens) - length + 1), np.uint64)
    for k in range(length):
        out = out * _BASE + tokens[k : k + len(out)]
    return out ^ (out >> np.uint64(29))


class Block:
    """Items of a benchmark with an index of their seeds."""

    def __init__(self, ids: list, texts: list):
        tokens, words = _tokens(pa.array(texts, pa.string()))
        self.ids = ids
        self.items = [tokens[a:b] for a, b in zip(words.starts[:-1], words.starts[1:])]
        # An item shorter than a seed is one seed as a whole.
        self.lengths = sorted({min(SEED, len(t)) for t in self.items if len(t)})
        self.index = {}
        for length in self.lengths:
            own = [(i, _rolled(t, length)) for i, t in enumerate(self.items) if len(t) and min(SEED, len(t)) == length]
            seeds = np.concatenate([s for _, s in own])
            item = np.concatenate([np.full(len(s), i) for i, s in own])
            place = np.concatenate([np.arange(len(s)) for _, s in own])
            order = np.argsort(seeds, kind="stable")
            sieve = np.zeros(1 << _BITS, bool)
            sieve[seeds >> np.uint64(64 - _BITS)] = True
            self.index[length] = seeds[order], item[order], place[order], sieve

    def leaks(self, tokens: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Text number, item number and marked words of every leaked item."""
        for length in self.lengths:
            seeds, item, place, sieve = self.index[length]
            rolled = _rolled(tokens, length)
            at = np.flatnonzero(sieve[rolled >> np.uint64(64 - _BITS)])
            low = np.searchsorted(seeds, rolled[at])
            known = seeds[np.minimum(low, len(seeds) - 1)] == rolled[at]
            at, low = at[known], low[known]
            text = np.searchsorted(starts, at, side="right") - 1
            inside = at + length <= starts[text + 1]
            at, low, text = at[inside], low[inside], text[inside]
            high = np.searchsorted(seeds, rolled[at], side="right")
            for t in np.unique(text):
                mine = slice(*np.searchsorted(text, [t, t + 1]))
                yield from self._tiled(int(t), tokens, at[mine], low[mine], high[mine], item, place, length)

    def _tiled(self, t, tokens, at, low, high, item, place, length):
        each = high - low
        if each.sum() > _PAIRS:
            yield from self._tiled_by_length(t, tokens, at, low, high, item, place, length)
            return
        hits = np.repeat(low, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        where, which, there = np.repeat(at, each), item[hits], place[hits]
        order = np.lexsort((there, where - there, which))
        where, which, there = where[order], which[order], there[order]
        for i in np.unique(which):
            own = slice(*np.searchsorted(which, [i, i + 1]))
            words = self.items[i]
            if len(np.unique(there[own])) * length < COVERAGE * len(words):
                continue  # not even all its seeds side by side would do
            marked = tiling(where[own], there[own], length)
            if marked >= COVERAGE * len(words):
                yield t, int(i), marked

    def _tiled_by_length(self, t, tokens, at, low, high, item, place, length):
        """The same without pairs: each distinct seed of the text names the items that hold it."""
        first, kind = np.unique(low, return_inverse=True)
        sizes = np.zeros(len(first), np.int64)
        sizes[kind] = high - low
        hits = np.repeat(first, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        seed, which, there = np.repeat(np.arange(len(first)), sizes), item[hits], place[hits]
        order = np.argsort(which, kind="stable")
        seed, which, there = seed[order], which[order], there[order]
        for i in np.unique(which):
            own = slice(*np.searchsorted(which, [i, i + 1]))
            words = self.items[i]
            if len(there[own]) * length < COVERAGE * len(words):
                continue  # not even all its seeds side by side would do
            shared = np.zeros(len(first), bool)
            shared[seed[own]] = True
            where = at[shared[kind]]
            begin = int(where[0])
            text = tokens[begin : int(where[-1]) + length]
            marked = tiling_by_length(text, where - begin, words, there[own], length)
            if marked >= COVERAGE * len(words):
                yield t, int(i), marked


def _windows(sums: np.ndarray, powers: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the windows of ``length`` words from each place of ``at`` on."""
    return sums[at + length] - sums[at] * powers[length]


def _places(free: np.ndarray, length: int) -> np.ndarray:
    """Where windows of ``length`` free words begin."""
    if length > len(free):
        return np.zeros(0, np.int64)
    total = np.concatenate([[0], np.cumsum(free)])
    return np.flatnonzero(total[length:] - total[:-length] == length)


def tiling_by_length(text: np.ndarray, where: np.ndarray, item: np.ndarray, there: np.ndarray, length: int) -> int:
    """Words marked by greedy string tiling, from the longest matches to those of ``length`` words.

    ``where, there``: places of seeds of ``length`` words that both have. The greatest
    length with a common window of free words is found by halving, then all its matches
    are marked in order of text and item. Windows of equal hashes are compared word by word.
    """
    most = max(len(text), len(item)) + 1
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(most, _BASE)]), dtype=np.uint64)
    sides = []
    for words, seeds in ((text, where), (item, there)):
        sums = np.zeros(len(words) + 1, np.uint64)
        # h(i + 1) = h(i) * base + word, as a sum of words over falling powers would run over just the same.
        value = np.uint64(0)
        with np.errstate(over="ignore"):
            for i, word in enumerate(words):
                value = value * _BASE + word
                sums[i + 1] = value
        free = np.zeros(len(words) + 1, np.int64)
        np.add.at(free, seeds, 1)
        np.add.at(free, seeds + length, -1)
        sides.append((sums, np.cumsum(free)[:-1] > 0))
    (text_sums, text_free), (item_sums, item_free) = sides
    marked = 0

    def common(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        at, to = _places(text_free, size), _places(item_free, size)
        left, right = _windows(text_sums, powers, at, size), _windows(item_sums, powers, to, size)
        hit = np.isin(left, right)
        return (at[hit], left[hit], to, right) if hit.any() else None

    top = min(len(text), len(item))
    while True:
        # Windows of a common window are common: the greatest length is between these two.
        low, high = length - 1, top
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if common(middle) else (low, middle - 1)
        if low < length:
            return marked
        at, left, to, right = common(low)
        order = np.argsort(right, kind="stable")
        to, right = to[order], right[order]
        start = dict(zip(left.tolist(), np.searchsorted(right, left).tolist()))
        for p, key in zip(at.tolist(), left.tolist()):
            if not (text_free[p] and text_free[p + low - 1]):
                continue
            k = start[key]
            # Marked windows stay marked, so the search goes on where the last one ended.
            while k < len(right) and int(right[k]) == key and not (item_free[to[k]] and item_free[to[k] + low - 1]):
                k += 1
            start[key] = k
            if k < len(right) and int(right[k]) == key and np.array_equal(text[p : p + low], item[to[k] : to[k] + low]):
                text_free[p : p + low] = False
                item_free[to[k] : to[k] + low] = False
                marked += low
        top = low - 1


def tiling(where: np.ndarray, there: np.ndarray, length: int) -> int:
    """Words marked by greedy string tiling.

    ``where, there``: positions of equal seeds of ``length`` words in text and item, sorted
    by diagonal and place. Of equally long matches the first in text, then in item, is marked.
    """
    ends = np.flatnonzero((np.diff(where - there) != 0) | (np.diff(there) != 1)) + 1
    bounds = np.concatenate([[0], ends, [len(where)]])
    queue = [(-(int(b - a) + length - 1), int(where[a]), int(there[a])) for a, b in zip(bounds[:-1], bounds[1:])]
    heapq.heapify(queue)
    text_marks, item_marks = set(), set()
    while queue:
        size, p, q = heapq.heappop(queue)
        free = [k for k in range(-size) if p + k not in text_marks and q + k not in item_marks]
        if len(free) == -size:
            text_marks.update(range(p, p - size))
            item_marks.update(range(q, q - size))
            continue
        run = []
        for k in [*free, None]:
            if run and (k is None or k != run[-1] + 1):
                if len(run) >= length:
                    heapq.heappush(queue, (-len(run), p + run[0], q + run[0]))
                run = []
            if k is not None:
                run.append(k)
    return len(item_marks)


def blocks(benchmark: DataFrame, most: int) -> Iterator[Block]:
    """The benchmark's items in order, in blocks of about ``most`` words; one block at a time is on the driver."""
    ids, texts, words = [], [], 0
    for row in benchmark.select("item_id", "text").where("text is not null").orderBy("item_id", "text").toLocalIterator():
        ids.append(row["item_id"])
        texts.append(row["text"])
        words += len(row["text"].split())
        if words >= most:
            yield Block(ids, texts)
            ids, texts, words = [], [], 0
    if ids:
        yield Block(ids, texts)


def leaks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``_row, item_id, covered, n_words`` for every leaked item of every row of ``docs``, which has ``_row`` and ``text``."""
    spark = docs.sparkSession
    found = []
    for block in blocks(benchmark, block_words):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in slices(batches, _BATCH_BYTES):
                tokens, words = _tokens(batch.column("text"))
                hits = list(block.leaks(tokens, words.starts))
                rows = batch.column("_row").take(pa.array([h[0] for h in hits], pa.int64()))
                ids = pa.array([block.ids[h[1]] for h in hits], pa.int64())
                marked = pa.array([h[2] for h in hits], pa.int64())
                sizes = pa.array([len(block.items[h[1]]) for h in hits], pa.int64())
                yield pa.RecordBatch.from_arrays([rows, ids, marked, sizes], names=["_row", "item_id", "covered", "n_words"])

        rows = docs.select("_row", "text").mapInArrow(lean(run), "_row long, item_id long, covered long, n_words long")
        found.append(materialise(rows, "leaks"))
        # The rows are stored, so no task will ask for the block again.
        shared.destroy()
    if not found:
        return spark.createDataFrame([], "_row long, item_id long, covered long, n_words long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, in their own columns.

    A null or blank text holds none; a null or blank item is held by none. Repeated
    items count once more, repeated rows stay or go together.
    """
    name = free_name(docs, "_row")
    rows = with_row_id(docs, name)
    leaked = leaks(rows.select(F.col(name).alias("_row"), "text"), benchmark)
    gone = materialise(leaked.select(F.col("_row").alias(name)).distinct(), "leaked")
    return rows.join(small(gone, 16 * gone.count()), name, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row: ``doc_id, contaminated, n_items, item_id, coverage``; the last two of the item covered most, null if none."""
    rows = with_row_id(docs.select("doc_id", "text"), "_row")
    best = F.max(F.struct((F.col("covered") / F.col("n_words")).alias("coverage"), (-F.col("item_id")).alias("item")))
    found = materialise(leaks(rows, benchmark).groupBy("_row").agg(F.count(F.lit(1)).alias("n_items"), best.alias("best")), "by-row")
    return rows.select("doc_id", "_row").join(small(found, 64 * found.count()), "_row", "left").select(
        "doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        (-F.col("best.item")).alias("item_id"),
        F.col("best.coverage").alias("coverage"),
    )

"""Cross-tokenizer alignment by pointer jumping.

A text is cut into tokens by a byte-level vocabulary (A) and by a piece vocabulary (B).
Both cover the same bytes, so a token of one side overlaps one or more of the other, and
tokens that hang together by overlaps form a group; groups meet where both sides end.

All tokens of a batch of texts are nodes of one array. Every node points at the
overlapping token that reaches farthest to the right (at itself, if none reaches
farther; of two with one end the A token counts). Replacing each pointer by the pointer
of its target doubles the distance covered, so after as many rounds as the longest chain
has binary digits every node points at the last A token of its group, which labels it.

How many documents hold a linked pair of ids is counted in tasks and summed by key. The
pairs of most documents, at most ``HOT_PAIRS`` of them, go to every task as sorted
arrays; links of rarer pairs, which no single pair holds many of, are looked up by a join.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampertide.llm.common import by_value, lean, ranges, slices, small, worker_kept
from ampertide.session import materialise

#: Pairs whose counts every task gets, about 20 bytes each.
HOT_PAIRS = 1 << 20
#: Distinct pairs whose counts a task holds before it gives them out.
_HELD_PAIRS = 1 << 20
_BATCH_BYTES = 1 << 20
#: Bits that an id takes at most.
_ID_BITS = 24
#: Rows of a batch stay below this, as row, A id and B id share 63 bits.
_ROWS = 1 << 15
#: The splitting rule of byte-level vocabularies, and the blank of piece vocabularies.
_BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BLANK = "▁"

by_value(__name__)


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level entry stands for: itself if it prints, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteSide:
    """Ids and bytes of a byte-level BPE vocabulary in the format of the tokenizers library.

    Where merges are in the order of their ids, as is usual, the merge tables alone give
    the ids and a faster encoder runs on them; any other file is encoded by the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # Spark deals out the cores; threads of the library's own would each hold memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        letters, vocab = _byte_of_letter(), whole["model"]["vocab"]
        entries = {i: bytes(letters[c] for c in entry) for entry, i in vocab.items() if all(c in letters for c in entry)}
        specials = {t["id"]: t["content"].encode() for t in whole["added_tokens"]}
        entries |= specials
        self.bytes = [entries.get(i, b"") for i in range(max(entries, default=-1) + 1)]
        self.quick = None
        if self._plain(whole):
            import tiktoken

            ranks = {entry: i for i, entry in entries.items() if i not in specials}
            self.quick = tiktoken.Encoding("own", pat_str=_BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _plain(whole: dict) -> bool:
        model, cut = whole["model"], whole["pre_tokenizer"] or {}
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model.get("merges", [])]
        ids = [model["vocab"].get(m, -1) for m in merged]
        return (
            whole["normalizer"] is None
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space")
            and model.get("type") == "BPE"
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and ids == list(range(256, 256 + len(ids)))
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.quick:
            return [self.quick.encode_ordinary(t) for t in texts]
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class PieceSide:
    """Ids and bytes of a sentencepiece vocabulary."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        self.bytes = [bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace(_BLANK, " ").encode() for i, p in zip(ids, map(self.model.id_to_piece, ids))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligner:
    """Both vocabularies with the lengths of their tokens and the letters of their ids."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteSide(byte_path), PieceSide(piece_path)
        assert max(len(self.a.bytes), len(self.b.bytes)) < 1 << _ID_BITS
        self.size_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self.size_b = np.array([len(x) for x in self.b.bytes], np.int64)
        most = max(len(self.a.bytes), len(self.b.bytes))
        #: An id with what stands behind it: nothing, another id of its side, the other side, the next group.
        self.written = [f"{i}{end}" for i in range(most) for end in ("", ",", "|", ";")]

    def tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; none where the bytes of a side are not those of the blank and the text."""
        full = [t for t in texts if t]
        found = iter(zip(full, self.a.encode([f" {t}" for t in full]), self.b.encode(full) if full else []))
        out_a, out_b = [], []
        for text in texts:
            a, b = [], []
            if text:
                _, a, b = next(found)
                want = f" {text}".encode()
                if b"".join(map(self.a.bytes.__getitem__, a)) != want or b"".join(map(self.b.bytes.__getitem__, b)) != want:
                    a, b = [], []
            out_a.append(a)
            out_b.append(b)
        return out_a, out_b

    def align(self, texts: list[str]) -> dict[str, list | np.ndarray]:
        """Columns of :func:`align` for these texts."""
        lists_a, lists_b = self.tokens(texts)
        n_a, n_b = (np.array([len(x) for x in some], np.int64) for some in (lists_a, lists_b))
        a, b = (np.array([i for x in some for i in x], np.int64) for some in (lists_a, lists_b))
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        first, last = overlaps(end_a, end_b)
        label = groups(end_a, end_b, last)
        row_a, row_b = np.repeat(np.arange(len(texts)), n_a), np.repeat(np.arange(len(texts)), n_b)
        links = last - first + 1
        # Distinct pairs per row, with how often they occur in it.
        at = np.repeat(np.arange(len(a)), links)
        key = row_a[at] << 2 * _ID_BITS | a[at] << _ID_BITS | b[np.repeat(first, links) + ranges(links)]
        key, times = np.unique(key, return_counts=True)
        row, ids = key >> 2 * _ID_BITS, (1 << _ID_BITS) - 1
        left, right = (key >> _ID_BITS) & ids, key & ids
        per_row = np.bincount(row, minlength=len(texts))
        terminal = label[: len(a)] == np.arange(len(a))
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": np.bincount(row_a[terminal], minlength=len(texts)),
            "n_links": np.bincount(row_a, weights=links, minlength=len(texts)).astype(np.int64),
            "groups": self._written(a, b, label, row_a, row_b, n_a + n_b),
            "pairs": (left << 32 | right, per_row),
            "times": (times, per_row),
        }

    def _written(self, a, b, label, row_a, row_b, sizes) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` per row. Labels grow with the text, so (label, side, place) is the order to write in."""
        ids, side = np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)])
        # Both sides are in order of label already: each token's place is its rank among both.
        of_a, of_b = label[: len(a)], label[len(a) :]
        place = np.concatenate([np.arange(len(a)) + np.searchsorted(of_b, of_a, "left"), np.arange(len(b)) + np.searchsorted(of_a, of_b, "right")])
        order = np.empty(len(ids), np.int64)
        order[place] = np.arange(len(ids))
        ids, side, label = ids[order], side[order], label[order]
        row = np.concatenate([row_a, row_b])[order]
        last = np.ones(len(ids), bool)
        last[:-1] = row[1:] != row[:-1]
        end = np.ones(len(ids), np.int64)
        end[:-1][side[1:] > side[:-1]] = 2
        end[:-1][label[1:] != label[:-1]] = 3
        end[last] = 0
        parts = list(map(self.written.__getitem__, (ids * 4 + end).tolist()))
        ends = np.cumsum(sizes).tolist()
        return ["".join(parts[x:y]) for x, y in zip([0, *ends[:-1]], ends)]


def overlaps(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last B token that each A token overlaps, from where tokens end."""
    start_a = np.concatenate([[0], end_a]).astype(np.int64)[:-1]
    return np.searchsorted(end_b, start_a, "right"), np.searchsorted(end_b, end_a - 1, "right")


def groups(end_a: np.ndarray, end_b: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each A token, then each B token, the last A token of its group, by pointer jumping."""
    n = len(end_a)
    if not n:
        return np.zeros(len(end_b), np.int64)
    own = np.arange(n)
    farther = np.where(end_b[last] > end_a, n + last, own)
    to = np.concatenate([farther, np.searchsorted(end_a, end_b - 1, "right")])
    while True:
        onward = to[to]
        if np.array_equal(onward, to):
            return to
        to = onward


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times``.

    A encodes a blank and the text, B the text (it adds the blank). ``groups`` is written
    ``a1,a2|b1;a3|b2,b3``; ``pairs`` are the distinct linked ids, ``a`` in the upper 32
    bits, each found ``times`` times. A null or empty text, or one that a side cannot
    give back byte for byte, has no tokens: zeros and empty values. Repeated rows each
    have a result, a null ``doc_id`` is kept, other columns are ignored.
    """

    key = f"aligner {byte_path} {piece_path}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_kept(key, lambda: Aligner(byte_path, piece_path))
        for batch in slices(batches, _BATCH_BYTES):
            for start in range(0, batch.num_rows, _ROWS - 1):
                some = batch.slice(start, _ROWS - 1)
                found = aligner.align(pc.fill_null(some.column("text").cast(pa.string()), "").to_pylist())
                columns = {"doc_id": some.column("doc_id").cast(pa.int64())}
                for name, value in found.items():
                    if isinstance(value, tuple):
                        offsets = np.concatenate([[0], np.cumsum(value[1])]).astype(np.int32)
                        columns[name] = pa.ListArray.from_arrays(offsets, pa.array(value[0].astype(np.int64), pa.int64()))
                    else:
                        columns[name] = pa.array(value, pa.string() if name == "groups" else pa.int64())
                yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lean(run, key), schema)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the pairs of many rows; a row holds a pair once."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting, held = [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        found, place = np.unique(np.concatenate([keys, *waiting]), return_inverse=True)
        ones = np.ones(held, np.int64)
        return found, np.bincount(place, weights=np.concatenate([counts, ones]), minlength=len(found)).astype(np.int64)

    for batch in batches:
        more = np.asarray(batch.column("pairs").flatten())
        waiting.append(more)
        held += len(more)
        if held > 2 * _HELD_PAIRS:
            keys, counts = merged()
            waiting, held = [], 0
            if len(keys) > _HELD_PAIRS:
                yield pa.RecordBatch.from_pydict({"pair": keys, "n": counts})
                keys, counts = keys[:0], counts[:0]
    keys, counts = merged()
    if len(keys):
        yield pa.RecordBatch.from_pydict({"pair": keys, "n": counts})


def pair_counts(aligned: DataFrame, vocabulary: int) -> DataFrame:
    """``pair, n, best``: in how many rows the ids are linked, and whether no pair of the same A id is in more.

    ``vocabulary`` is the number of A ids, which bounds the table of their highest counts.
    """
    counts = aligned.select("pairs").mapInArrow(lean(_folded), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialise(counts.withColumn("a", F.shiftright("pair", 32)), "pairs")
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    return counts.join(small(top, 24 * vocabulary), "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _lookup(shared):
    """Per row the sums over its frequent pairs, and its other pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            sizes = np.diff(np.asarray(lists.offsets))
            row = np.repeat(np.arange(batch.num_rows), sizes)
            pairs, times = np.asarray(lists.flatten()), np.asarray(batch.column("times").flatten())
            at = np.searchsorted(known, pairs)
            hit = np.zeros(len(pairs), bool)
            if len(known):
                at = np.minimum(at, len(known) - 1)
                hit = known[at] == pairs
            sums = {"n_best": np.zeros(batch.num_rows, np.int64), "count_sum": np.zeros(batch.num_rows, np.int64)}
            np.add.at(sums["n_best"], row[hit], times[hit] * best[at[hit]])
            np.add.at(sums["count_sum"], row[hit], times[hit] * n[at[hit]])
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=batch.num_rows))]).astype(np.int32)
            columns = {name: batch.column(name) for name in batch.schema.names if name not in ("pairs", "times")}
            columns |= {name: pa.array(value) for name, value in sums.items()}
            columns["pairs"] = pa.ListArray.from_arrays(offsets, pa.array(pairs[~hit]))
            columns["times"] = pa.ListArray.from_arrays(offsets, pa.array(times[~hit]))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def with_pair_counts(aligned: DataFrame, vocabulary: int, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``aligned`` with ``n_best`` and ``count_sum`` in place of ``pairs`` and ``times``.

    The count of a pair is the number of rows of ``aligned`` that hold it. ``n_best``
    links have the highest count of their A id, ties included; ``count_sum`` adds up the
    counts of all links. Rows without links have zeros.
    """
    spark = aligned.sparkSession
    # The number of a row is given before the table is written, so every reader sees the same.
    stored = materialise(aligned.withColumn("_row", F.monotonically_increasing_id()), "aligned")
    pairs = materialise(pair_counts(stored, vocabulary).withColumn("digits", F.length(F.bin("n"))), "pair-counts")
    # Counts by their number of binary digits, 63 at most: as many as fit are sent out.
    least, total = 64, 0
    for digits, n in pairs.groupBy("digits").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("digits")).collect():
        total += n
        if total > hot_pairs:
            break
        least = digits
    hot = pairs.where(F.col("digits") >= least).orderBy("pair").select("pair", "n", "best").toArrow()
    shared = spark.sparkContext.broadcast(tuple(hot[c].to_numpy() for c in ("pair", "n", "best")))
    kept = [f for f in stored.schema.fields if f.name not in ("pairs", "times")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "n_best long, count_sum long, pairs array<long>, times array<long>"])
    found = stored.mapInArrow(lean(_lookup(shared)), schema)
    if total > hot_pairs:
        found = materialise(found, "looked-up")
        rare = pairs.where(F.col("digits") < least).select("pair", "n", "best")
        each = found.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("_row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
        more = each.join(rare, "pair").groupBy("_row").agg(
            F.sum(F.col("times") * F.col("best").cast("long")).alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum")
        )
        found = found.join(more, "_row", "left").withColumns(
            {"n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))}
        )
    return found.select(*(f.name for f in kept if f.name != "_row"), "n_best", "count_sum")

"""Token-ID output: byte planes of fixed-size id blocks, compressed, with a chunk index.

Documents are range-shuffled by ``doc_id``, so each task holds a stretch of the order,
encodes it as a stream and writes one file. A file is

* ``MAGIC``,
* chunks: a block of ``BLOCK`` ids as little-endian 32-bit integers, transposed into four
  byte planes, each compressed by zstandard,
* the document ids (64 bit), a byte each for a null id, and the ids per document
  (64 bit), compressed,
* the chunk index: for each plane of each chunk its end in the file (64 bit),
* a trailer: ids in all, documents, the place of the document table and of the chunk
  index (64 bit each), ``MAGIC``.

A file has a name of its own per attempt, and only files in the manifest that Spark
commits count, so a lost task leaves nothing behind but an unread file. The shared
folder is reached through ``pyarrow.fs``, whatever store it is in.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampertide.llm.common import Words, by_value, joined, lean, slices, worker_kept
from ampertide.session import drop_at_exit, fresh_path, materialise

BLOCK = 1 << 16
END_ID = 2
MAGIC = b"BYTEPLN1"
_BATCH_BYTES = 2 << 20
_LEVEL = 1
_PLANES = 4
_WIDTH = 4
_TRAILER = 4 * 8 + len(MAGIC)
#: Words whose ids a Python worker remembers, the most bytes of one (longer ones are encoded where
#: they stand), and words encoded in one call. Words and ids are Arrow arrays, some 10 MB together.
_CACHE_WORDS = 250_000
_CACHE_LENGTH = 64
_TOGETHER = 200
#: Stands between words that are encoded in one call.
_MARK = "\x01"

by_value(__name__)


#: What a tokenizer file must say for words to be encoded one by one.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPECIAL = "<|"
#: Letters (Latin, Cyrillic) that NFC leaves alone and whose lower case is letters. Words of these and
#: of printable ASCII have as many parts as the word rule finds in them unnormalised.
_LETTERS = r"a-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}\x{400}-\x{481}\x{48A}-\x{52F}"
_PLAIN = rf"\A[!-~{_LETTERS}]+\z"
#: Behind such a letter the word rule cuts before any sign, also before an apostrophe.
_STOP = rf"([{_LETTERS}])([!-/:-@\[-`{{-~])"


def _word_by_word(whole: dict) -> bool:
    """Whether the file drops white space, lowers case, ends a word between a letter and a stop, and marks special tokens."""
    normalizer, cut = whole["normalizer"] or {}, whole["pre_tokenizer"] or {}
    steps = cut.get("pretokenizers") or [{}]
    rule = {"type": "Split", "pattern": {"Regex": _WORD_RULE}, "behavior": "Removed", "invert": True}
    return (
        normalizer.get("normalizers") == _NORMALIZERS
        and steps[0] == rule
        and [x["type"] for x in steps[1:]] == ["ByteLevel"]
        and not steps[1]["add_prefix_space"]
        and all(t["content"].startswith(_SPECIAL) for t in whole["added_tokens"])
    )


def _closing(whole: dict) -> np.ndarray | None:
    """By id: whether it closes a part that the word rule cuts. None if not every part is closed by one such id."""
    from tokenizers import pre_tokenizers

    model = whole["model"]
    suffix, vocabulary = model.get("end_of_word_suffix"), model["vocab"]
    if not suffix or model.get("dropout") or not all(c + suffix in vocabulary for c in pre_tokenizers.ByteLevel.alphabet()):
        return None
    out = np.zeros(max(vocabulary.values()) + 1, bool)
    out[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return out


def _packed(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The ids up to each of ``ends`` as bytes."""
    offsets = np.concatenate([[0], ends]).astype(np.int64) * _WIDTH
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype(np.uint32))])


def _flat(lists: list) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint32), *(np.array(ids, np.uint32) for ids in lists)])


def _lines(words: pa.Array, between: str) -> list[str]:
    """``_TOGETHER`` words in each string."""
    bounds = np.append(np.arange(0, len(words), _TOGETHER), len(words)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(bounds, words), between).to_pylist()


def _by_kind(words: pa.Array, kinds: list) -> pa.Array:
    """Ids of ``words`` in their order; ``kinds`` are masks, one for each word, and what gives the ids of such words."""
    places = [np.flatnonzero(np.asarray(mask)) for mask, _ in kinds]
    found = [learn(words.take(pa.array(at))) for at, (_, learn) in zip(places, kinds)]
    return pa.concat_arrays(found).take(pa.array(np.argsort(np.concatenate(places))))


class Encoder:
    """Ids of texts, each distinct word encoded once.

    Where the tokenizer drops white space and splits at it, the ids of a text are those of
    its words. Letters and the signs behind them are parted first, as the tokenizer does,
    which leaves fewer distinct words. Texts with the start of a special token are encoded whole,
    and all texts where the tokenizer's file states other rules. Words of more than
    ``_CACHE_LENGTH`` bytes, as in text without blanks, are encoded and forgotten.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # Spark deals out the cores; threads of the library's own would each hold memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        self.by_words = _word_by_word(whole)
        self.closing = _closing(whole) if self.by_words else None
        if self.closing is not None:
            self._without_rules(whole)
        marks = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self.mark = marks[0] if len(marks) == 1 else None
        self.words, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def _without_rules(self, whole: dict) -> None:
        """The tokenizer without normaliser and word rule, for words of letters that both leave as they are."""
        from tokenizers import Tokenizer, pre_tokenizers

        letters = pa.array([chr(c) for c in range(0x61, 0x530)])
        letters = letters.filter(pc.match_substring_regex(letters, rf"\A[{_LETTERS}]\z")).to_pylist()
        same = "".join(c for c in letters if self.tokenizer.normalizer.normalize_str(c) == c)
        self.letters = rf"\A[{same}]+\z"
        step = whole["pre_tokenizer"]["pretokenizers"][1]
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=step.get("use_regex", True))
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), as_bytes])

    @property
    def known(self) -> list[str]:
        """The words that are remembered."""
        return self.words.to_pylist()

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _bare(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.bare.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: pa.Array) -> pa.Array:
        """Ids of ``words``. Where a plain word ends is told by the ids that close its parts, of others by a mark between them."""
        if self.closing is None:
            return self._marked(words)
        letters, plain = np.asarray(pc.match_substring_regex(words, self.letters)), np.asarray(pc.match_substring_regex(words, _PLAIN))
        kinds = [(letters, self._of_letters), (plain & ~letters, self._of_parts), (~plain & ~letters, self._marked)]
        return _by_kind(words, kinds)

    def _of_letters(self, words: pa.Array) -> pa.Array:
        return self._closed(self._bare(_lines(words, " ")), np.ones(len(words), np.int64))

    def _of_parts(self, words: pa.Array) -> pa.Array:
        return self._closed(self._whole(_lines(words, " ")), np.asarray(pc.count_substring_regex(words, _WORD_RULE)))

    def _closed(self, groups: list, parts: np.ndarray) -> pa.Array:
        ids = _flat(groups)
        closers, last = np.flatnonzero(self.closing[ids]), np.cumsum(parts)
        assert len(closers) == parts.sum()
        return _packed(ids, closers[last - 1] + 1)

    def _marked(self, words: pa.Array) -> pa.Array:
        odd = np.asarray(pc.match_substring(words, _MARK)) | (self.mark is None)
        return _by_kind(words, [(~odd, self._between_marks), (odd, self._alone)])

    def _between_marks(self, words: pa.Array) -> pa.Array:
        ids = _flat([[*ids, self.mark] for ids in self._whole(_lines(words, f" {_MARK} "))])
        cuts = np.flatnonzero(ids == self.mark)
        assert len(cuts) == len(words)
        return _packed(np.delete(ids, cuts), cuts - np.arange(len(cuts)))

    def _alone(self, words: pa.Array) -> pa.Array:
        lists = self._whole(words.to_pylist())
        return _packed(_flat(lists), np.cumsum([len(ids) for ids in lists]))

    def _entries(self, table: pa.Array) -> pa.Array:
        """The ids of each word of ``table`` as bytes."""
        long = np.asarray(pc.greater(pc.binary_length(table), _CACHE_LENGTH))
        return _by_kind(table, [(~long, self._remembered), (long, self._alone)])

    def _remembered(self, words: pa.Array) -> pa.Array:
        at = pc.index_in(words, value_set=self.words)
        missing = np.asarray(pc.is_null(at))
        number = np.asarray(pc.fill_null(at, 0)).astype(np.int64)
        if missing.any():
            new = words.filter(pa.array(missing))
            if len(self.words) + len(new) > _CACHE_WORDS:
                # The words at hand stay, all others are forgotten.
                stay = pa.array(number[~missing])
                self.words, self.ids = self.words.take(stay), self.ids.take(stay)
                number[~missing] = np.arange(len(stay))
            number[missing] = len(self.words) + np.arange(len(new))
            learned = self._learn(new)
            self.words, self.ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, learned])
        return self.ids.take(pa.array(number))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts with ``END_ID`` after each, and the number per text."""
        texts = pc.fill_null(texts, "").cast(pa.string())
        special = np.asarray(pc.match_substring(texts, _SPECIAL)) if self.by_words else np.ones(len(texts), bool)
        ordinary = pc.if_else(pa.array(special), "", texts)
        words = Words(pc.replace_substring_regex(pc.ascii_lower(ordinary), _STOP, r"\1 \2"), lower=False)
        entries = pa.concat_arrays([self._entries(words.table), _packed(np.array([END_ID]), np.array([1]))])
        laid = entries.take(pa.array(np.insert(words.codes, words.starts[1:], len(words.table))))
        _, offsets, data = laid.buffers()
        out = np.frombuffer(data or b"", np.uint32)
        places = np.frombuffer(offsets, np.int64)[words.starts + np.arange(len(words.starts))] // _WIDTH
        out, counts = out[: places[-1]], np.diff(places)
        if special.any():
            parts = np.split(out, np.cumsum(counts)[:-1])
            at = np.flatnonzero(special)
            for i, own in zip(at, self._whole(texts.take(pa.array(at)).to_pylist())):
                parts[i] = np.array([*own, END_ID], np.uint32)
            out, counts = np.concatenate(parts), np.array([len(p) for p in parts])
        return out, counts


def planes(ids: np.ndarray) -> list[bytes]:
    """The byte planes of a block: all lowest bytes, then the next ones, and so on."""
    return [p.tobytes() for p in ids.astype("<u4").view(np.uint8).reshape(-1, _PLANES).T]


def from_planes(parts: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(p, np.uint8) for p in parts], axis=1).reshape(-1).view("<u4")


class Writer:
    """Writes one file as a stream."""

    def __init__(self, out):
        self.out, self.packer = out, zstandard.ZstdCompressor(level=_LEVEL)
        self.at, self.index, self.total, self.waiting, self.held = 0, [], 0, [], 0
        self.doc_ids, self.counts = [], []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _block(self, ids: np.ndarray) -> None:
        for plane in planes(ids):
            self._put(self.packer.compress(plane))
            self.index.append(self.at)

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.counts.append(counts)
        self.total += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // BLOCK * BLOCK
            for start in range(0, whole, BLOCK):
                self._block(ids[start : start + BLOCK])
            self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.waiting))
        table = self.at
        ids = np.array([0 if d is None else d for d in self.doc_ids], "<i8").tobytes()
        null = np.array([d is None for d in self.doc_ids], np.uint8).tobytes()
        counts = np.concatenate(self.counts or [np.zeros(0)]).astype("<i8").tobytes()
        self._put(self.packer.compress(ids + null + counts))
        index = self.at
        self._put(np.array(self.index, "<i8").tobytes())
        self._put(np.array([self.total, len(self.doc_ids), table, index], "<i8").tobytes() + MAGIC)


class Reader:
    """Reads a file: ``documents`` in order, each with its ids; ``block(k)`` gets any block by the index."""

    def __init__(self, source):
        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        size = source.size()
        tail = source.read_at(_TRAILER, size - _TRAILER)
        if tail[-len(MAGIC) :] != MAGIC or source.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a token file")
        self.total, self.n_docs, table, index = map(int, np.frombuffer(tail[:32], "<i8"))
        data = self.unpacker.decompress(source.read_at(index - table, table))
        n = self.n_docs
        null = np.frombuffer(data[8 * n : 9 * n], np.uint8)
        self.doc_ids = [None if z else int(d) for d, z in zip(np.frombuffer(data[: 8 * n], "<i8"), null)]
        self.counts = np.frombuffer(data[9 * n :], "<i8")
        ends = np.frombuffer(source.read_at(size - _TRAILER - index, index), "<i8")
        self.bounds = np.concatenate([[len(MAGIC)], ends]).astype(np.int64)

    def block(self, k: int) -> np.ndarray:
        ends = self.bounds[k * _PLANES : (k + 1) * _PLANES + 1]
        data = self.source.read_at(int(ends[-1] - ends[0]), int(ends[0]))
        cut = [data[a - ends[0] : b - ends[0]] for a, b in zip(ends[:-1], ends[1:])]
        return from_planes([self.unpacker.decompress(p) for p in cut])

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        held, k = np.zeros(0, np.uint32), 0
        for doc_id, n in zip(self.doc_ids, self.counts):
            parts, have = [held], len(held)
            while have < n:
                parts.append(self.block(k))
                have += len(parts[-1])
                k += 1
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield doc_id, held[:n]
            held = held[n:]


def write_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the ids of ``docs`` in ascending ``doc_id`` order; returns the manifest.

    The manifest has a row per file: ``part, path, n_docs, n_ids, start``. A null id is
    first; rows that share an id are ordered by a hash of their text. Null and empty texts are one end
    id. An empty table gives no file.
    """
    spark = docs.sparkSession
    folder = fresh_path(spark, "tokens")
    store, place = fs.FileSystem.from_uri(folder)
    store.create_dir(place, recursive=True)
    drop_at_exit(spark, folder)

    key = f"encoder {tokenizer}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, stream, encoder = None, None, None
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.tok"
        for batch in joined(slices(batches, _BATCH_BYTES), 2 * _BATCH_BYTES):
            if writer is None:
                store, place = fs.FileSystem.from_uri(folder)
                stream = store.open_output_stream(f"{place}/{name}")
                writer, encoder = Writer(stream), worker_kept(key, lambda: Encoder(tokenizer))
            ids, counts = encoder.encode(batch.column("text"))
            writer.add(batch.column("doc_id").to_pylist(), ids, counts)
        if writer is not None:
            writer.close()
            stream.close()
            row = {"part": [part], "path": [f"{folder}/{name}"], "n_docs": [len(writer.doc_ids)], "n_ids": [writer.total]}
            yield pa.RecordBatch.from_pydict(row)

    # The hash, not the text, is in the order: range bounds and their sample reach the driver.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    files = materialise(ordered.mapInArrow(lean(run, key), "part long, path string, n_docs long, n_ids long"), "manifest")
    # One row per file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as source:
                    reader = Reader(source)
                    sums = [zlib.crc32(ids.astype("<u4", copy=False).tobytes()) for _, ids in reader.documents()]
                ends = np.cumsum(reader.counts)
                columns = {
                    "doc_id": pa.array(reader.doc_ids, pa.int64()),
                    "start": pa.array(start + ends - reader.counts, pa.int64()),
                    "n_tokens": pa.array(reader.counts, pa.int64()),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    stored = materialise(manifest, "files")
    spread = stored.repartition(max(1, stored.count()), "part").select("path", "start")
    return spread.mapInArrow(lean(run), "doc_id long, start long, n_tokens long, ids_crc32 long")

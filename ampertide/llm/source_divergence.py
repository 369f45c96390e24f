"""Source divergence audit by in-mapper stripes.

How far the words of one source of a language lie from those of its other sources, and
which words set a source apart from the language as a whole:

1. Every task folds whole documents into a hash table of stripes, one per language and
   term: the number of documents with the term, and its occurrences by source. A table
   that has grown to ``HELD_BYTES`` is given out and begun anew.
2. Stripes are shuffled by key and merged as they come in, in order of key, so a task
   holds one stripe at a time however many tasks sent a frequent term. Terms in fewer
   than ``LEAST_DOCUMENTS`` documents of a language end here.
3. Merged stripes, in chunks of bounded size beside the totals of their language's
   sources, give the divergences: sums over terms for each pair of sources, and the
   terms with the largest values for each source.

With ``count`` occurrences of a term among ``n`` of kept terms and ``v`` kept terms, its
share is ``p = 1 + floor(10^9 (count + 1) / (n + v))``, and of shares ``p`` and ``q`` the
divergence is ``floor((p - q)^2 / q)``. All arithmetic is on whole numbers; sums go
through Spark in two halves of 32 bits and more, so they cannot run over on the way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampertide.llm.common import Words, by_value, lean, slices
from ampertide.session import materialise

LEAST_DOCUMENTS = 3
TERM_RANKS = 200
UNIT = 1_000_000_000
#: Memory that the stripes of a task take before they are given out.
HELD_BYTES = 96 << 20
#: Stripes of a language that one group of the last step gets, about.
CHUNK = 20_000
#: Texts folded together, and stripes given out together.
_FOLD_BYTES = 16 << 20
_TOGETHER = 5_000
#: Numbers in a matrix of terms and sources.
_CELLS = 1 << 20
_LOW = (1 << 32) - 1
#: Terms are runs of anything but these: all of ASCII except letters.
_BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"

_STRIPES = "lang string, term string, df long, sources array<string>, counts array<long>"
_VALUES = "lang string, part string, source string, item string, high long, low long"

by_value(__name__)


def _terms(texts: pa.Array) -> Words:
    return Words(pc.replace_substring_regex(texts, _BETWEEN, " "))


class Stripes:
    """The hash table of a task: ``(lang, term)`` to documents and occurrences by source."""

    def __init__(self):
        self.table: dict[tuple[str, str], tuple[list[int], dict[str, int]]] = {}
        self.size = 0

    def fold(self, langs: pa.Array, sources: pa.Array, texts: pa.Array) -> None:
        langs, sources, words = langs.dictionary_encode(), sources.dictionary_encode(), _terms(texts)
        lang, source = (np.asarray(c.indices).astype(np.int64) for c in (langs, sources))
        n_sources, n_terms = max(1, len(sources.dictionary)), max(1, len(words.table))
        doc = np.repeat(np.arange(len(texts)), words.counts)
        seen = np.unique(doc * n_terms + words.codes)
        key, found = np.unique(lang[seen // n_terms] * n_terms + seen % n_terms, return_counts=True)
        names, terms = langs.dictionary.to_pylist(), words.table.to_pylist()
        stripes = {}
        for k, n in zip(key.tolist(), found.tolist()):
            own = (names[k // n_terms], terms[k % n_terms])
            stripe = self.table.get(own)
            if stripe is None:
                stripe = self.table[own] = ([0], {})
                self.size += 400 + 4 * len(own[1])
            stripe[0][0] += n
            stripes[k] = stripe[1]
        # Grouped by stripe, then by source.
        cell = (lang[doc] * n_terms + words.codes) * n_sources + source[doc]
        key, found = np.unique(cell, return_counts=True)
        names = sources.dictionary.to_pylist()
        for k, s, n in zip((key // n_sources).tolist(), (key % n_sources).tolist(), found.tolist()):
            counts, name = stripes[k], names[s]
            if name in counts:
                counts[name] += n
            else:
                counts[name] = n
                self.size += 100

    def given_out(self) -> Iterator[pa.RecordBatch]:
        rows = list(self.table.items())
        self.__init__()
        for at in range(0, len(rows), _TOGETHER):
            some = rows[at : at + _TOGETHER]
            offsets = np.concatenate([[0], np.cumsum([len(c) for _, (_, c) in some])]).astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([k[0] for k, _ in some], pa.string()),
                "term": pa.array([k[1] for k, _ in some], pa.string()),
                "df": pa.array([d[0] for _, (d, _) in some], pa.int64()),
                "sources": pa.ListArray.from_arrays(offsets, pa.array([s for _, (_, c) in some for s in c], pa.string())),
                "counts": pa.ListArray.from_arrays(offsets, pa.array([n for _, (_, c) in some for n in c.values()], pa.int64())),
            })


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stripes, waiting, held = Stripes(), [], 0
    for batch in slices(batches, _FOLD_BYTES):
        waiting.append(batch)
        held += batch.column("text").nbytes
        if held >= _FOLD_BYTES:
            yield from _folded(stripes, waiting)
            waiting, held = [], 0
    if waiting:
        yield from _folded(stripes, waiting)
    yield from stripes.given_out()


def _folded(stripes: Stripes, waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = [pa.concat_arrays([b.column(c).cast(pa.string()) for b in waiting]) for c in ("lang", "source", "text")]
    stripes.fold(*columns)
    if stripes.size > HELD_BYTES:
        yield from stripes.given_out()


def merged(stripes: pa.Table) -> pa.Table:
    """Neighbouring stripes of one key as one."""
    stripes = stripes.combine_chunks()
    lang, term = (stripes.column(c).combine_chunks() for c in ("lang", "term"))
    new = np.ones(len(stripes), bool)
    if len(stripes) > 1:
        same = pc.and_(pc.equal(lang[1:], lang[:-1]), pc.equal(term[1:], term[:-1]))
        new[1:] = ~np.asarray(same)
    first = np.flatnonzero(new)
    if len(first) == len(stripes):
        return stripes
    run = np.cumsum(new) - 1
    lists = stripes.column("sources").combine_chunks()
    coded = lists.flatten().dictionary_encode()
    counts = np.asarray(stripes.column("counts").combine_chunks().flatten())
    width = max(1, len(coded.dictionary))
    owner = np.repeat(run, np.asarray(pc.list_value_length(lists)))
    key, place = np.unique(owner * width + np.asarray(coded.indices), return_inverse=True)
    sums = np.zeros(len(key), np.int64)
    np.add.at(sums, place, counts)
    offsets = np.searchsorted(key // width, np.arange(len(first) + 1)).astype(np.int32)
    return pa.table({
        "lang": lang.take(pa.array(first)),
        "term": term.take(pa.array(first)),
        "df": pa.array(np.add.reduceat(np.asarray(stripes.column("df")), first)),
        "sources": pa.ListArray.from_arrays(offsets, coded.dictionary.take(pa.array(key % width))),
        "counts": pa.ListArray.from_arrays(offsets, pa.array(sums)),
    })


def _merge(least: int):
    """Stripes that arrive in order of key, merged; those of enough documents stay."""

    def kept(stripes: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from stripes.filter(pc.greater_equal(stripes.column("df"), least)).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            stripes = pa.Table.from_batches([batch])
            stripes = merged(stripes if last is None else pa.concat_tables([last, stripes.cast(last.schema)]))
            # The last key may go on in the next batch.
            yield from kept(stripes.slice(0, len(stripes) - 1))
            last = stripes.slice(len(stripes) - 1)
        if last is not None:
            yield from kept(last)

    return run


def stripes(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, term, df, sources, counts`` of every term in at least ``least`` documents of a language."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    partial = docs.select(*columns).mapInArrow(lean(_fold), _STRIPES)
    ordered = partial.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return materialise(ordered.mapInArrow(lean(_merge(least)), _STRIPES), "stripes")


def _shares(counts: np.ndarray, n: np.ndarray, v: int) -> np.ndarray:
    """Shares of ``counts``, a column for each of ``n``; in whole numbers of any size where 64 bits would not do."""
    if max(int(n.max(initial=0)), int(counts.max(initial=0))) + v < (1 << 63) // UNIT - 1:
        return 1 + UNIT * (counts + 1) // (n + v)
    return (1 + UNIT * (counts.astype(object) + 1) // (n.astype(object) + v)).astype(np.int64)


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Divergences:
    """Sums for each pair of sources, and the foremost terms of each, over the stripes of a chunk."""

    def __init__(self, sources: list[str], n: np.ndarray, n_lang: int, v: int, ranks: int):
        self.sources, self.n, self.n_lang, self.v, self.ranks = sources, n, np.array([n_lang]), v, ranks
        size = len(sources)
        self.high, self.low = np.zeros((size, size), np.int64), np.zeros((size, size), np.int64)
        self.absent = _shares(np.zeros((1, size), np.int64), n, v)[0]
        self.unseen = _divergence(self.absent[:, None], self.absent[None, :])
        self.best: list[list[tuple[int, str]]] = [[] for _ in sources]

    def _put(self, s, t, values: np.ndarray) -> None:
        self.high[s, t] += (values >> 32).sum(axis=0)
        self.low[s, t] += (values & _LOW).sum(axis=0)

    def add(self, terms: list[str], counts: np.ndarray) -> None:
        """``counts``: a row per term, a column per source."""
        shares = _shares(counts, self.n, self.v)
        whole = _shares(counts.sum(axis=1, keepdims=True), self.n_lang, self.v)[:, 0]
        here = counts > 0
        every = slice(None)
        for s in range(len(self.sources)):
            own = here[:, s]
            p = shares[own, s]
            # Terms of s against all sources, then what sources without them miss.
            self._put(s, every, _divergence(p[:, None], shares[own]))
            self._put(every, s, np.where(here[own], 0, _divergence(self.absent[None, :], p[:, None])))
            q = whole[own]
            lead = p > q
            self._lead(s, np.flatnonzero(own)[lead], _divergence(p[lead], q[lead]), terms)
        absent = (~here).astype(np.float64)
        neither = (absent.T @ absent).astype(np.int64)
        self.high += (self.unseen >> 32) * neither
        self.low += (self.unseen & _LOW) * neither

    def _lead(self, s: int, at: np.ndarray, values: np.ndarray, terms: list[str]) -> None:
        if len(at) > self.ranks:
            enough = values >= np.partition(values, -self.ranks)[-self.ranks]
            at, values = at[enough], values[enough]
        found = [*self.best[s], *((-v, terms[i]) for i, v in zip(at.tolist(), values.tolist()))]
        self.best[s] = sorted(found)[: self.ranks]

    def rows(self) -> Iterator[tuple[str, str, str, int, int]]:
        for s, source in enumerate(self.sources):
            for t, other in enumerate(self.sources):
                if s != t:
                    yield "pair", source, other, int(self.high[s, t]), int(self.low[s, t])
            for value, term in self.best[s]:
                yield "term", source, term, 0, -value


def _diverge(ranks: int):
    def run(key: tuple[pa.Scalar, ...], some: pa.Table, groups: pa.Table) -> pa.Table:
        sources = groups.column("source").combine_chunks()
        found = Divergences(sources.to_pylist(), np.asarray(groups.column("n")), groups["n_lang"][0].as_py(), groups["v"][0].as_py(), ranks)
        step = max(1, _CELLS // len(sources))
        for at in range(0, len(some), step):
            part = some.slice(at, step)
            lists = part.column("sources").combine_chunks()
            counts = np.zeros((len(part), len(sources)), np.int64)
            row = np.repeat(np.arange(len(part)), np.asarray(pc.list_value_length(lists)))
            column = np.asarray(pc.index_in(lists.flatten(), value_set=sources))
            counts[row, column] = np.asarray(part.column("counts").combine_chunks().flatten())
            found.add(part.column("term").to_pylist(), counts)
        rows = [*zip(*found.rows())] or [()] * 5
        names = ("part", "source", "item", "high", "low")
        columns = {n: pa.array(list(r), pa.int64() if n in ("high", "low") else pa.string()) for n, r in zip(names, rows)}
        columns["lang"] = pa.array([key[0].as_py()] * len(rows[0]), pa.string())
        return pa.table(columns).select(["lang", "part", "source", "item", "high", "low"])

    return run


def _ranked(values: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return values.withColumn("rank", F.row_number().over(order))


def _whole(high: Column, low: Column) -> Column:
    wide = "decimal(38,0)"
    return (high.cast(wide) * F.lit(1 << 32).cast("decimal(10,0)") + low.cast(wide)).cast("long")


def source_divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, ranks: int = TERM_RANKS, chunk: int = CHUNK) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every language and source of ``docs``.

    Part ``pair``: the divergence of ``source`` from the source ``item``, summed over all
    kept terms (0 where a language keeps none). Part ``term``: of kept terms that
    ``source`` has and uses more than its language does, the ``ranks`` with the largest
    value. Ranks go by value downwards, then by item. A null language, source or text
    counts as empty, each row is a document, repeated ones too; an empty table gives no
    row, and a language with one source no pair. Other columns are ignored.
    """
    kept = stripes(docs, least)
    each = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).select("lang", F.col("x.sources").alias("source"), F.col("x.counts").alias("n"))
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    groups = groups.join(each.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)).alias("n_lang"))
    groups = groups.join(langs, "lang", "left").select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "n_lang", "v")))
    groups = materialise(groups, "groups")
    chunks = max(1, -(-kept.count() // chunk))
    dealt = kept.withColumn("chunk", F.pmod(F.xxhash64("term"), F.lit(chunks)))
    beside = materialise(dealt.select("lang", "chunk").distinct().join(groups, "lang"), "beside")
    values = dealt.groupBy("lang", "chunk").cogroup(beside.groupBy("lang", "chunk")).applyInArrow(_diverge(ranks), _VALUES)
    values = materialise(values, "divergences")
    sums = values.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    bare = groups.where("v = 0").select("lang", "source")
    none = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pairs = _ranked(sums.select("lang", "source", "item", _whole(F.col("high"), F.col("low")).alias("value")).unionByName(none))
    terms = _ranked(values.where("part = 'term'").select("lang", "source", "item", F.col("low").alias("value"))).where(F.col("rank") <= ranks)
    both = pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term")))
    return both.select("lang", "source", "part", "item", "value", "rank")

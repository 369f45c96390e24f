"""MinHash near-dedup: a similarity join by chosen paths, then connected components.

Documents with equal shingle sets form a class; one document stands for it. In each
of ``TREES`` independent trees a class goes down every path of its ``PICKS`` smallest
tokens under the hash of that tree and level, so that two similar sets meet with a
high chance at every level:

* a node with one class is done, a small node is compared exhaustively,
* a larger node branches by the tokens of the next level,
* after ``LEVELS`` levels a large node holds a group of near copies (or sets that
  differ too little to be told apart). Large nodes that share members form a cluster.
  Its members are compared with one pivot and inside random blocks, which connects
  near copies with few comparisons. A wide cluster may be of texts that share a passage
  and little else: there, members of different components are compared if they share one
  of their rarest tokens, as similar sets must, and members that share such a token with
  many others form the clusters that are left. Then every member outside a cluster's
  largest component is compared with all members of other components, chunk by chunk inside
  tasks, so no link between components is lost and no pair without a link leaves a task.

Two sets of similarity 0.8 miss each other at one level with probability 0.024, hence
in a tree of four levels with 0.093, and in all five trees with 7 in a million; most
nodes are small after the first level, where it is 8 in a thousand million. Links are confirmed on
the whole sets of words. Only links between different components need confirming.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampertide.llm.common import WORD, Words, by_value, joined, lean, ranges, slices, small
from ampertide.llm.components import components
from ampertide.session import free_name, materialise, with_row_id

SHINGLE_WORDS = 5
PERCENT = 80
TREES = 5
LEVELS = 4
PICKS = 2
#: Classes in a node that is compared exhaustively; also the mean size of a block.
LEAF = 16
#: Of the tree hashes' smallest tokens, one byte each, so many must agree; 0.8 similar sets fail in 2 of ten million cases.
AGREE = 6
#: Texts of a cluster that are compared with as many others in one go, and rows of these at a time.
CHUNK = 256
CHUNK_BYTES = 4 << 20
#: Texts that may share one of their rarest tokens and still be compared pair by pair.
SHARED = 64
#: Tokens that the order of rarity tells apart, the commonest ones; any order finds all pairs.
COMMON = 1 << 20
_LEFT_ROWS = 32
_BATCH_BYTES = 8 << 20
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

by_value(__name__)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, grouped by text, and the number of each."""
    found = Words(texts)
    table = pd.util.hash_array(found.table.to_numpy(zero_copy_only=False), categorize=False) if len(found.table) else np.zeros(0, np.uint64)
    hashes = table[found.codes]
    parts, owners = [], []
    for length in range(1, words + 1):
        of = np.flatnonzero(found.counts >= words if length == words else found.counts == length)
        each = found.counts[of] - length + 1
        at = np.repeat(found.starts[of], each) + ranges(each)
        value = np.full(len(at), length, np.uint64)
        for k in range(length):
            value = value * np.uint64(0x9E3779B97F4A7C15) + hashes[at + k]
        parts.append(_mix(value))
        owners.append(np.repeat(of, each))
    value, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    first = np.ones(len(value), bool)
    first[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[first], np.bincount(owner[first], minlength=len(texts))


def signature_of(values: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Per non-empty set: two sums that tell sets apart, and the smallest tokens of each tree and level."""
    full = counts[counts > 0]
    starts = np.concatenate([[0], np.cumsum(full)[:-1]]).astype(np.int64)
    out = {"k1": np.add.reduceat(_mix(values), starts), "k2": np.bitwise_xor.reduceat(_mix(values + np.uint64(1)), starts)}
    tokens = np.empty((len(full), TREES * LEVELS, PICKS), np.uint64)
    for f in range(TREES * LEVELS):
        seed = _mix(np.array([f + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]
        v = (values ^ seed) * np.uint64(0x9E3779B97F4A7C15)
        v = (v ^ (v >> np.uint64(32))) * (seed | np.uint64(1))
        for pick in range(PICKS):
            low = np.minimum.reduceat(v, starts)
            tokens[:, f, pick] = low
            if pick + 1 < PICKS:
                v = np.where(v == np.repeat(low, full), _NONE, v)
    return out | {"tokens": tokens}


def _signatures(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _BATCH_BYTES):
            values, counts = shingles(batch.column("text"), words)
            have = np.flatnonzero(counts)
            rows = len(counts)
            columns = {"_row": batch.column("_row"), "doc_id": batch.column("doc_id"), "n": pa.array(counts.astype(np.int64))}
            k1, k2 = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
            tokens = np.zeros((rows, TREES * LEVELS * PICKS), np.uint64)
            if len(have):
                found = signature_of(values, counts)
                k1[have], k2[have] = found["k1"], found["k2"]
                tokens[have] = found["tokens"].reshape(len(have), -1)
            marks = (tokens[:, ::PICKS] & np.uint64(255)).astype(np.int16)
            columns["k1"], columns["k2"] = pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64))
            columns["marks"] = pa.FixedSizeListArray.from_arrays(pa.array(marks.ravel()), marks.shape[1]).cast(pa.list_(pa.int16()))
            columns["tokens"] = pa.FixedSizeListArray.from_arrays(pa.array(tokens.view(np.int64).ravel()), tokens.shape[1]).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _children(tree: Column, level: int, parent: Column) -> Column:
    """The next nodes: one per picked token of this tree and level."""
    nodes = [
        F.when(F.get("tokens", (tree * LEVELS + level) * PICKS + pick) != -1, F.xxhash64(parent, F.get("tokens", (tree * LEVELS + level) * PICKS + pick)))
        for pick in range(PICKS)
    ]
    return F.array_compact(F.array_distinct(F.array(*nodes)))


def _alike(x: Column, y: Column) -> tuple[Column, Column]:
    """Whether two classes can be similar by their sizes and marks, and how many marks agree."""
    agree = F.size(F.filter(F.zip_with(x["marks"], y["marks"], lambda p, q: p == q), lambda z: z))
    sizes = (x["n"] * 100 >= y["n"] * PERCENT) & (y["n"] * 100 >= x["n"] * PERCENT)
    return sizes, agree


def _pairs_within(groups: DataFrame, *by: str) -> DataFrame:
    """Candidate pairs of each group, which has a bounded number of rows."""
    listed = groups.groupBy(*by).agg(F.collect_list(F.struct("cls", "n", "marks")).alias("m")).where(F.size("m") > 1)
    each = listed.select("m", F.posexplode("m").alias("i", "x"))
    each = each.select("x", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("y"))
    return _kept_pairs(each)


def _kept_pairs(each: DataFrame) -> DataFrame:
    sizes, agree = _alike(F.col("x"), F.col("y"))
    each = each.where(sizes & (F.col("x.cls") != F.col("y.cls")))
    return each.select(
        F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b"), agree.alias("agree")
    ).where(F.col("agree") >= AGREE)


def chosen_paths(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs ``a, b, agree`` of all small nodes and of the first round in clusters, and the clusters' members."""
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    start = classes.select("cls", "n", "marks", "tokens", trees)
    nodes = start.select("cls", "n", "marks", "tree", F.explode(_children(F.col("tree"), 0, F.col("tree"))).alias("node"))
    nodes = nodes.withColumn("parent", F.col("node"))
    tokens = classes.select("cls", "tokens")
    found, rows = [], None
    for level in range(LEVELS):
        if level:
            large = rows.where(F.col("size") > LEAF).join(tokens, "cls")
            branches = F.explode(_children(F.col("tree"), level, F.col("node"))).alias("node")
            nodes = large.select("cls", "n", "marks", "tree", F.col("node").alias("parent"), branches)
            nodes = materialise(nodes, "nodes")
        sizes = materialise(nodes.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
        rows = materialise(nodes.join(sizes, "node"), "rows")
        found.append(_pairs_within(rows.where(F.col("size") <= LEAF), "node"))
        if rows.where(F.col("size") > LEAF).isEmpty():
            break
    members = clusters(rows.where(F.col("size") > LEAF))
    pairs = _first_round(members)
    for more in found:
        pairs = pairs.unionByName(more)
    return materialise(pairs.groupBy("a", "b").agg(F.max("agree").alias("agree")), "candidates"), members


def _first_round(members: DataFrame) -> DataFrame:
    """Candidate pairs of each cluster's members with its pivot and inside random blocks."""
    sizes = materialise(members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("cls", "n", "marks")).alias("x")), "clusters")
    sized = members.join(sizes, "cluster")
    blocks = F.greatest(F.lit(1), F.round(F.col("size") / LEAF)).cast("long")
    within = _pairs_within(sized.withColumn("block", F.pmod(F.xxhash64("cls"), blocks)), "cluster", "block")
    return within.unionByName(_kept_pairs(sized.select("x", F.struct("cls", "n", "marks").alias("y"))))


def clusters(large: DataFrame) -> DataFrame:
    """``cls, n, marks, cluster`` for the classes of large nodes; nodes that share a class or their parent are one cluster."""
    hot = large.select(F.col("parent").alias("node"), "cls", "n", "marks").dropDuplicates(["node", "cls"])
    hot = materialise(hot, "hot")
    own = hot.select("cls", "n", "marks").dropDuplicates(["cls"])
    return materialise(own.join(_joined_by(hot), "cls"), "members")


def _joined_by(nodes: DataFrame) -> DataFrame:
    """``cls, cluster`` for the classes of distinct ``node, cls``; nodes that share a class are one cluster."""
    first = F.min("node").over(Window.partitionBy("cls")).alias("first")
    labels = components(nodes.select(first, "node").distinct().select(F.col("first").alias("a"), F.col("node").alias("b")))
    firsts = nodes.groupBy("cls").agg(F.min("node").alias("first"))
    found = firsts.join(labels.select(F.col("id").alias("first"), "label"), "first", "left")
    return found.select("cls", F.coalesce("label", "first").alias("cluster"))


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _confirm(words: int):
    find = re.compile(WORD).findall

    def set_of(text: str) -> set:
        found = find(text.translate(_LOWER))
        return set(zip(*(found[k:] for k in range(words)))) if len(found) >= words else {tuple(found)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, last, held = [], None, set()
            for a, text_a, text_b in zip(*(batch.column(c).to_pylist() for c in ("a", "text_a", "text_b"))):
                if a != last:
                    last, held = a, set_of(text_a)
                other = set_of(text_b)
                both = len(held & other)
                linked.append(100 * both >= PERCENT * (len(held) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """The pairs whose whole shingle sets are similar enough."""
    a = texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    return materialise(both.mapInArrow(lean(_confirm(words)), "a long, b long"), "links")


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component yet."""
    for end in ("a", "b"):
        pairs = pairs.join(labels.select(F.col("id").alias(end), F.col("label").alias(f"_{end}")), end, "left")
    return pairs.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")


def _grouped(rows: DataFrame, words: int) -> DataFrame:
    """``_row, doc_id, n, root`` for every row of ``_row, doc_id, text``; rows of one ``root`` hang together, it is null for rows without links.

    A class of equal sets goes by the smallest ``_row`` that has it, so texts that share a
    ``doc_id`` are as far apart as any others.
    """
    schema = "_row long, doc_id long, n long, k1 long, k2 long, marks array<short>, tokens array<long>"
    signatures = materialise(rows.mapInArrow(lean(_signatures(words)), schema), "signatures")
    sets = signatures.where("n > 0 and doc_id is not null")
    classes = materialise(sets.groupBy("n", "k1", "k2").agg(F.min("_row").alias("cls")), "classes")
    heads = sets.join(classes.select("cls"), F.col("_row") == F.col("cls"))
    heads = materialise(heads.select("cls", "n", "marks", "tokens"), "heads")
    pairs, members = chosen_paths(heads)
    wanted = pairs.select(F.col("a").alias("_row")).unionByName(pairs.select(F.col("b").alias("_row")))
    wanted = materialise(wanted.unionByName(members.select(F.col("cls").alias("_row"))).distinct(), "wanted")
    texts = rows.join(small(wanted, 16 * wanted.count()), "_row").select(F.col("_row").alias("cls"), "text")
    texts = materialise(texts, "texts")
    # The likeliest partner of each class connects most of a group; the rest only matters across components.
    best = pairs.groupBy("b").agg(F.max(F.struct("agree", (-F.col("a")).alias("a"))).alias("top"))
    links = confirmed(best.select((-F.col("top.a")).alias("a"), "b"), texts, words)
    labels = components(links)
    links = links.unionByName(confirmed(_across(pairs, labels), texts, words))
    labels = components(links)
    if not members.isEmpty():
        members = _labelled(members, labels)
        if not members.where(F.col("size") > CHUNK).isEmpty():
            pairs, members = _narrowed(members, texts, words)
            more = confirmed(_across(pairs, labels), texts, words)
            if not more.isEmpty():
                links = links.unionByName(more)
                labels = components(links)
            members = _labelled(members, labels)
        links = links.unionByName(confirmed(_across_clusters(members, texts, words), texts, words))
        labels = components(links)
    found = signatures.select("_row", "doc_id", "n", "k1", "k2")
    found = found.join(classes, ["n", "k1", "k2"], "left").withColumn("cls", F.when(F.col("doc_id").isNotNull(), F.col("cls")))
    found = found.join(labels.select(F.col("id").alias("cls"), "label"), "cls", "left")
    return found.select("_row", "doc_id", "n", F.coalesce("label", "cls").alias("root"))


def near_dup(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``.

    Words are runs of non-blanks with A-Z lowered, a set holds the distinct shingles of
    ``words`` words, a shorter text is one shingle. Sets with 100 * intersection >=
    ``PERCENT`` * union are linked, equal sets included. A null or blank text has an
    empty set and no link. ``component_id`` is the smallest ``doc_id`` reachable. Rows
    that share a ``doc_id`` each follow their own text; a row without ``doc_id`` stands
    alone, with a null ``component_id``, and is kept. Other columns are ignored.
    """
    rows = materialise(_grouped(with_row_id(docs.select("doc_id", "text"), "_row"), words), "grouped")
    firsts = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("first"))
    found = rows.join(firsts, "root", "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("first", "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def distinct_documents(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` but all but one of each group of near copies, in their own columns.

    The row with the smallest ``doc_id`` stays, of rows that share it the first one in
    the input. Rows without text or ``doc_id`` stay.
    """
    name = free_name(docs, "_row")
    rows = with_row_id(docs, name)
    found = materialise(_grouped(rows.select(F.col(name).alias("_row"), "doc_id", "text"), words), "grouped")
    firsts = found.where("root is not null").groupBy("root").agg(F.min(F.struct("doc_id", "_row")).alias("first"))
    gone = found.join(firsts, "root").where(F.col("_row") != F.col("first._row")).select(F.col("_row").alias(name))
    gone = materialise(gone, "near-copies")
    return rows.join(small(gone, 16 * gone.count()), name, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``cluster, cls, n, marks, label, size`` for the members of clusters of several components."""
    rows = members.select("cluster", "cls", "n", "marks").join(labels.select(F.col("id").alias("cls"), "label"), "cls", "left")
    rows = materialise(rows.withColumn("label", F.coalesce("label", "cls")), "labelled")
    several = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high"))
    return rows.join(several.where("low <> high").select("cluster", "size"), "cluster")


def _times(words: int, shards: int):
    """The shingles of each batch of texts, and in how many of the texts each is; a shard of them is a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in joined(slices(batches, _BATCH_BYTES), _BATCH_BYTES):
            values, times = np.unique(shingles(batch.column("text"), words)[0], return_counts=True)
            shard = (values % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))]).astype(np.int32))
            tokens = pa.ListArray.from_arrays(ends, pa.array(values[order].view(np.int64)))
            times = pa.ListArray.from_arrays(ends, pa.array(times[order].astype(np.int64)))
            yield pa.RecordBatch.from_pydict({"shard": pa.array(np.arange(shards)), "tokens": tokens, "times": times})

    return run


def _summed(least: int):
    """The tokens of whole shards that are in more than ``least`` texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.asarray(b.column("tokens").flatten()), np.asarray(b.column("times").flatten())) for b in batches]
        if held:
            tokens, place = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            times = np.bincount(place, np.concatenate([x for _, x in held]), len(tokens)).astype(np.int64)
            often = times > least
            yield pa.RecordBatch.from_pydict({"token": pa.array(tokens[often]), "times": pa.array(times[often])})

    return run


def _rarest(words: int, common):
    """The tokens of each text of which a similar set shares one.

    Tokens are ordered by how many texts have them, then by value. Of two similar sets, the
    first token that they share is among the first ones of each, and nearer to the start
    (``lead``) in the one that is not larger.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, times = common.value
        for batch in slices(batches, _BATCH_BYTES):
            values, counts = shingles(batch.column("text"), words)
            at = np.minimum(np.searchsorted(tokens, values), len(tokens) - 1)
            often = np.where(tokens[at] == values, times[at], 0)
            owner = np.repeat(np.arange(len(counts)), counts)
            values = values[np.lexsort((values, often, owner))]
            n, place = counts[owner], ranges(counts)
            # A set of n shares PERCENT of n at least with any similar one, and more with one that is not smaller.
            first = place <= n - -(-PERCENT * n // 100)
            lead = place <= n - -(-2 * PERCENT * n // (100 + PERCENT))
            rows = batch.select(["cluster", "cls", "n", "label"]).take(pa.array(owner[first]))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(values[first].view(np.int64)), pa.array(lead[first])], [*rows.schema.names, "token", "lead"]
            )

    return run


def _narrowed(members: DataFrame, texts: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs ``a, b`` of wide clusters, and the clusters that are left to compare chunk by chunk.

    Members of a wide cluster that differ in their component are a pair if they share one of
    their rarest tokens and no more than some ``SHARED`` members do; those that share one with
    more members stay in a cluster, with a first round of its own.
    """
    spark = members.sparkSession
    wide = members.where(F.col("size") > CHUNK)
    rows = materialise(wide.join(texts, "cls").select("cluster", "cls", "n", "label", "text"), "wide")
    # Each task takes as much text as a batch holds, and tokens are dealt out again in as many shards.
    tasks = max(1, rows.agg(F.ceil(F.sum(F.octet_length("text")) / _BATCH_BYTES)).first()[0] or 1)
    seen = rows.select("text").coalesce(tasks).mapInArrow(lean(_times(words, tasks)), "shard long, tokens array<long>, times array<long>")
    seen = materialise(seen.repartition(tasks, "shard").mapInArrow(lean(_summed(LEAF)), "token long, times long"), "times")
    least = LEAF
    while seen.where(F.col("times") > least).count() > COMMON:
        least *= 2
    known = seen.where(F.col("times") > least).select("token", "times").toArrow()
    tokens, times = known["token"].to_numpy().view(np.uint64), known["times"].to_numpy()
    order = np.argsort(tokens)
    # One token that counts for nothing, for tables without any common one.
    common = (tokens[order], times[order]) if len(order) else (np.zeros(1, np.uint64), np.zeros(1, np.int64))
    shared = spark.sparkContext.broadcast(common)
    schema = "cluster long, cls long, n long, label long, token long, lead boolean"
    rare = materialise(rows.mapInArrow(lean(_rarest(words, shared)), schema), "rarest")
    lists = rare.groupBy("cluster", "token").agg(
        F.count(F.lit(1)).alias("all"), F.count_if("lead").alias("leads"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    lists = lists.where("leads > 0 and low <> high").select("cluster", "token", (F.col("all") * F.col("leads") > SHARED * SHARED).alias("dense"))
    rare = materialise(rare.join(lists, ["cluster", "token"]), "lists")
    listed = rare.where("not dense").groupBy("cluster", "token").agg(F.collect_list(F.struct("cls", "n", "label", "lead")).alias("m"))
    each = listed.select("m", F.explode("m").alias("x")).where("x.lead")

    def partner(y: Column) -> Column:
        later = (y["n"] > F.col("x.n")) | ((y["n"] == F.col("x.n")) & y["lead"] & (y["cls"] > F.col("x.cls")))
        return (y["label"] != F.col("x.label")) & later & (F.col("x.n") * 100 >= y["n"] * PERCENT)

    pairs = each.select(F.col("x.cls").alias("a"), F.explode(F.filter("m", partner)).alias("y")).select("a", F.col("y.cls").alias("b"))
    pairs = materialise(pairs.distinct(), "sharing")
    for end, name in (("a", "x"), ("b", "y")):
        pairs = pairs.join(wide.select(F.col("cls").alias(end), F.struct("cls", "n", "marks").alias(name)), end)
    pairs = _kept_pairs(pairs.select("x", "y"))
    dense = materialise(rare.where("dense").select(F.xxhash64("cluster", "token").alias("node"), "cls").distinct(), "dense")
    dense = materialise(wide.drop("cluster").join(_joined_by(dense), "cls").select("cluster", "cls", "n", "marks"), "left")
    pairs = materialise(pairs.unionByName(_first_round(dense)).select("a", "b").distinct(), "narrowed")
    return pairs, members.where(F.col("size") <= CHUNK).select("cluster", "cls", "n", "marks").unionByName(dense)


def _similar(words: int):
    """Links between two chunks of texts with different labels, from products of their shingle incidence.

    Of these, as many as it takes to connect what they connect.
    """

    def top(roots: dict, label: int) -> int:
        while roots.setdefault(label, label) != label:
            roots[label] = label = roots[roots[label]]
        return label

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                left, right = row["left"], row["right"]
                values, sizes = shingles(pa.array([m["text"] for m in right]), words)
                order = np.argsort(values, kind="stable")
                values, owner = values[order], np.repeat(np.arange(len(right)), sizes)[order]
                labels = np.array([m["label"] for m in right])
                found_a, found_b, roots = [], [], {}
                for at in range(0, len(left), _LEFT_ROWS):
                    some = left[at : at + _LEFT_ROWS]
                    own, own_sizes = shingles(pa.array([m["text"] for m in some]), words)
                    low, high = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
                    hits = owner[np.repeat(low, high - low) + ranges(high - low)]
                    mine = np.repeat(np.repeat(np.arange(len(some)), own_sizes), high - low)
                    both = np.bincount(mine * len(right) + hits, minlength=len(some) * len(right)).reshape(len(some), len(right))
                    union = own_sizes[:, None] + sizes[None, :] - both
                    other = np.array([m["label"] for m in some])[:, None] != labels[None, :]
                    for i, j in np.argwhere(other & (both > 0) & (100 * both >= PERCENT * union)).tolist():
                        x, y = top(roots, some[i]["label"]), top(roots, right[j]["label"])
                        if x != y:
                            roots[y] = x
                            found_a.append(some[i]["cls"])
                            found_b.append(right[j]["cls"])
                yield pa.RecordBatch.from_pydict({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return run


def _across_clusters(members: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """In clusters of several components: the links between a member outside the largest one and any of another."""
    spark = members.sparkSession
    rows = members.select("cluster", "cls", "label")
    rows = rows.join(texts.select("cls", F.octet_length("text").alias("bytes")), "cls")
    parts = rows.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("size"), F.sum("bytes").alias("bytes"))
    main = parts.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("parts"),
        F.sum("size").alias("size"),
        F.sum("bytes").alias("all_bytes"),
        F.max(F.struct("size", "label", "bytes")).alias("top"),
    )
    # A chunk is cut by the number of its texts and by their bytes.
    chunks = lambda size, total: F.greatest(F.ceil(size / CHUNK), F.ceil(total / CHUNK_BYTES), F.lit(1)).cast("long")
    main = main.where("parts > 1").select(
        "cluster",
        chunks(F.col("size"), F.col("all_bytes")).alias("size"),
        chunks(F.col("size") - F.col("top.size"), F.col("all_bytes") - F.col("top.bytes")).alias("outside"),
        F.col("top.label").alias("main"),
    )
    main = materialise(main, "main")
    whole = rows.drop("bytes").join(main, "cluster").join(texts, "cls")

    def chunked(some: DataFrame, count: str, name: str) -> DataFrame:
        """Texts in chunks; a chunk is a row."""
        chunk = F.pmod(F.xxhash64("cls"), F.col(count))
        grouped = some.groupBy("cluster", chunk.alias(f"{name}_chunk"))
        return materialise(grouped.agg(F.collect_list(F.struct("cls", "label", "text")).alias(name)), name)

    left = chunked(whole.where("label <> main"), "outside", "left")
    right = chunked(whole, "size", "right")
    jobs = left.select("cluster", "left_chunk").join(right.select("cluster", "right_chunk"), "cluster")
    jobs = materialise(jobs, "jobs").repartition("cluster", "left_chunk", "right_chunk")
    both = jobs.join(left, ["cluster", "left_chunk"]).join(right, ["cluster", "right_chunk"]).select("left", "right")
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        return materialise(both.mapInArrow(lean(_similar(words)), "a long, b long").distinct(), "similar")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)

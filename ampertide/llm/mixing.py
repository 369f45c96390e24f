"""Mixing sources to target weights by a splitting tree over block quotas.

1. ``targets``: words each source gives to the mix.
2. Documents longer than a block are blocks of their own, taken at the rate of their
   source; the other documents make good what rounding misses. They
   fall into blocks of a source by a hash; a block is a unit of work of
   bounded size. Whole passes over a source take all its blocks, the rest of its
   target takes blocks in permuted order, and of the one block that would
   overshoot documents in a seeded order until one does not fit, then the largest
   ones that still fit, down to the smallest; of a block that is mostly taken, the
   documents to leave out are found in this way.
3. The number of blocks each source gives is split among the output shards by
   halving the shards again and again: the left half draws its blocks from the
   sources' quotas without replacement, a multivariate hypergeometric draw. Quotas
   stay exact on every level.
4. Each source's permuted blocks are dealt to the shards by those quotas, so that
   shards are disjoint, and rows are shuffled inside a shard by a seeded order.

All draws are hashes of seed and position: reruns and re-run tasks agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampertide.llm.common import WORD, small, unit
from ampertide.operators.numbering import number_in_groups
from ampertide.session import free_name, materialise, with_row_id

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2  # times its size that a source gives at most
BLOCK_WORDS = 50_000
SHARDS = 16
#: Times that the documents of an overshooting block are gone through for ones that still fit.
FIT_PASSES = 9
#: Documents longer than a block that are weighed one after another, per source.
HEAD = 1000


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source`` with ``_row`` as it is or numbered, ``_key`` (a hash of the row) and ``_size`` in words."""
    row = F.col("_row") if "_row" in docs.columns else F.monotonically_increasing_id().alias("_row")
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", row, F.xxhash64("doc_id", "source", "text").alias("_key"), words.alias("_size"))


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """Per source: ``source_size, weight, target``.

    Sources by code point, null last, have the weights in turn. Targets share
    ``share`` of all words by weight, no source gives more than ``MOST`` times its
    words, and what it cannot give is shared by the others. The level at which a
    source reaches its limit is limit / weight: of the sources in that order the
    first ones are at their limits, and the others share what is left.
    """
    sizes = rows.groupBy("source").agg(F.sum("_size").alias("source_size"))
    # One row per source from here on.
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod("_rank", F.lit(len(weights))).cast("int") + 1)
    ranked = ranked.select("source", "source_size", weight.cast("double").alias("weight")).withColumn(
        "_limit", F.lit(float(MOST)) * F.col("source_size")
    )
    level = F.col("_limit") / F.col("weight")
    before = Window.orderBy(level, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = (
        share * F.sum("source_size").over(everything) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levels = ranked.withColumn("_level", level).withColumn("_left", left)
    # The common level is the one of the first source that does not reach its limit.
    common = F.min(F.when(F.col("_left") <= F.col("_level"), F.struct("_level", "_left"))).over(everything)["_left"]
    return levels.select(
        "source", "source_size", "weight", F.least("_limit", F.coalesce(common * F.col("weight"), "_limit")).alias("target")
    )


def blocks_of(rows: DataFrame, goals: DataFrame, seed: int, block_words: int) -> DataFrame:
    """Rows with the target of their source and ``_block``, a hash bucket of about ``block_words``."""
    count = F.ceil(F.col("source_size") / F.lit(block_words))
    return rows.join(goals, F.col("source").eqNullSafe(F.col("_source")), "left").withColumn(
        "_block", F.pmod(F.xxhash64(F.lit(seed), "_key"), F.greatest(count, F.lit(1)))
    )


def _taken_rows(rows: DataFrame, blocks: DataFrame, seed: int) -> DataFrame:
    """Rows with ``_taken``, the copies of each that the mix takes in whole passes and the last, partial one."""
    plan = blocks.select(
        F.col("source").alias("_s"), F.col("_block").alias("_b"), "_passes", "_whole", "_gap", "_words"
    )
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")))
    inside = rows.where("_gap is not null and _size > 0")
    outside = rows.where("_gap is null or _size = 0").withColumn("_more", F.when(F.col("_whole"), 1).otherwise(0))
    # At most one block of a source is cut, and a block is small.
    seeded = [F.xxhash64(F.lit(seed + 1), "_key"), F.col("_row")]
    group = Window.partitionBy("source", "_block")
    # Whichever is less is chosen: the documents to take, or those to leave out.
    leave = F.col("_gap") * 2 > F.col("_words")
    room = F.when(leave, F.col("_words") - F.col("_gap")).otherwise(F.col("_gap"))
    inside = inside.withColumn("_more", F.lit(0)).withColumn("_room", room)
    for k in range(FIT_PASSES):
        # The first pass takes what comes before the first document that does not fit, the others skip what does not.
        fits = F.lit(True) if k == 0 else F.col("_size") <= F.col("_room")
        waiting = F.when((F.col("_more") == 0) & fits, F.col("_size"))
        order = Window.partitionBy("source", "_block").orderBy(*([] if k == 0 else [F.col("_size").desc()]), *seeded)
        inside = (
            inside.withColumn("_sum", F.sum(waiting).over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_new", F.coalesce(waiting.isNotNull() & (F.col("_sum") <= F.col("_room")), F.lit(False)))
            .withColumn("_more", F.when(F.col("_new"), 1).otherwise(F.col("_more")))
            .withColumn("_room", F.col("_room") - F.coalesce(F.sum(F.when(F.col("_new"), F.col("_size"))).over(group), F.lit(0)))
        )
    inside = inside.withColumn("_more", F.when(leave, 1 - F.col("_more")).otherwise(F.col("_more"))).drop("_room", "_sum", "_new")
    return outside.unionByName(inside).withColumn("_taken", F.col("_passes") + F.col("_more"))


def block_plan(rows: DataFrame, seed: int) -> DataFrame:
    """Per block of a source: whole ``_passes``, whether it is taken ``_whole`` once more, or the ``_gap`` to fill from it."""
    blocks = rows.groupBy("source", "source_size", "target", "_block").agg(F.sum("_size").alias("_words"))
    permuted = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "source", "_block"), "_block")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1)
    rest = F.round(F.col("target") - F.col("_passes") * F.col("source_size")).cast("long")
    so_far = F.sum("_words").over(permuted.rowsBetween(Window.unboundedPreceding, 0))
    return (
        blocks.withColumn("_passes", passes)
        .withColumn("_rest", rest)
        .withColumn("_end", so_far)
        .withColumn("_rank", F.row_number().over(permuted) - 1)
        .withColumn("_whole", F.col("_end") <= F.col("_rest"))
        .withColumn(
            "_gap",
            F.when(
                ~F.col("_whole") & (F.col("_rest") > F.col("_end") - F.col("_words")),
                F.col("_rest") - F.col("_end") + F.col("_words"),
            ),
        )
    )


def long_documents(long: DataFrame) -> DataFrame:
    """Documents longer than a block, each a block of its own, with ``_taken``, the copies that the mix takes.

    From the longest on, each of the first ``HEAD`` of a source is taken as often as comes
    nearest to the source's rate over those up to it. The others, none of which is more than a
    thousandth of the source, are taken by rank at that rate. What both miss the short
    documents make good.
    """
    rate = F.col("target") / F.col("source_size")
    order = [F.col("_size").desc(), F.col("_row").asc()]
    ranked = materialise(number_in_groups(long, ["source"], order, "_at", unique=True), "ranked")
    # No more than HEAD entries a source.
    head = ranked.where(F.col("_at") <= HEAD).groupBy("source", "source_size", "target")
    head = head.agg(F.sort_array(F.collect_list(F.struct("_at", "_size"))).alias("_head")).withColumn("_rate", rate)
    start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("got"), F.array().cast("array<bigint>").alias("n"))

    def step(s: Column, x: Column) -> Column:
        upto = s["upto"] + x["_size"]
        near = F.round((F.col("_rate") * upto - s["got"]) / x["_size"]).cast("long")
        n = F.greatest(F.lit(0).cast("long"), F.least(F.lit(MOST).cast("long"), near))
        return F.struct(upto.alias("upto"), (s["got"] + n * x["_size"]).alias("got"), F.concat(s["n"], F.array(n)).alias("n"))

    chosen = head.select(F.col("source").alias("_s"), F.posexplode(F.aggregate("_head", start, step, lambda s: s["n"])).alias("_p", "_n"))
    found = ranked.join(chosen, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_at") == F.col("_p") + 1), "left")
    by_rank = F.floor(rate * F.col("_at") + F.lit(0.5)) - F.floor(rate * (F.col("_at") - 1) + F.lit(0.5))
    taken = F.coalesce("_n", by_rank).cast("long")
    return found.withColumns({"_taken": taken, "_block": -F.col("_at")}).drop("_s", "_p", "_n")


def _goals_of_rest(goals: DataFrame, long: DataFrame) -> DataFrame:
    """Size and target of each source without its long documents; the target as far as it can be reached."""
    of = long.groupBy(F.col("source").alias("_s")).agg(F.sum("_size").alias("_long"), F.sum(F.col("_size") * F.col("_taken")).alias("_got"))
    both = goals.join(of, F.col("_source").eqNullSafe(F.col("_s")), "left")
    size = F.col("source_size") - F.coalesce("_long", F.lit(0))
    left = F.col("target") - F.coalesce("_got", F.lit(0))
    target = F.greatest(F.lit(0.0), F.least(left, F.lit(float(MOST)) * size))
    return both.select("_source", size.alias("source_size"), target.alias("target"))


def _draws(taken: Column, all_left: Column, own: Column, *key: Column) -> Column:
    """How many of ``own`` blocks are among ``taken`` drawn from ``all_left``: a hypergeometric draw, block by block."""
    state = F.struct(taken.alias("want"), all_left.alias("left"), F.lit(0).cast("long").alias("got"))

    def step(s, i):
        hit = (unit(*key, i) * s["left"] < s["want"]).cast("long")
        return F.struct((s["want"] - hit).alias("want"), (s["left"] - 1).alias("left"), (s["got"] + hit).alias("got"))

    steps = F.when(own > 0, F.sequence(F.lit(1).cast("long"), own)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(steps, state, step, lambda s: s["got"])


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """Split ``source, quota`` among shards: ``shard, source, quota``, exact in every source and, but for one, in every shard.

    A node is a range of shards; its rows are one per source. Sources draw one after
    another for the left half of their node, each from what those before have left.
    """
    level = quotas.groupBy().agg(F.sort_array(F.collect_list(F.struct(F.col("source").isNull().alias("n"), "source", "quota"))).alias("_q"))
    level = level.select(F.lit(0).alias("_from"), F.lit(shards).alias("_to"), "_q")
    depth = 0
    while (1 << depth) < shards:
        depth += 1
        total = F.aggregate("_q", F.lit(0).cast("long"), lambda a, x: a + x["quota"])
        middle = F.floor((F.col("_from") + F.col("_to")) / 2).cast("int")
        share = F.round(total * (middle - F.col("_from")) / (F.col("_to") - F.col("_from"))).cast("long")
        start = F.struct(share.alias("want"), total.alias("left"), F.array().cast("array<bigint>").alias("got"))

        def draw(s, q):
            hit = _draws(s["want"], s["left"], q["quota"], F.lit(seed), F.col("_from"), F.col("_to"), q["source"])
            return F.struct(
                (s["want"] - hit).alias("want"), (s["left"] - q["quota"]).alias("left"), F.concat(s["got"], F.array(hit)).alias("got")
            )

        drawn = level.where("_to - _from > 1").select(
            "*", middle.alias("_middle"), F.aggregate("_q", start, draw, lambda s: s["got"]).alias("_hits")
        )
        left = F.zip_with("_q", "_hits", lambda q, h: q.withField("quota", h))
        right = F.zip_with("_q", "_hits", lambda q, h: q.withField("quota", q["quota"] - h))
        level = (
            drawn.select("_from", F.col("_middle").alias("_to"), left.alias("_q"))
            .unionByName(drawn.select(F.col("_middle").alias("_from"), "_to", right.alias("_q")))
            .unionByName(level.where("_to - _from = 1"))
        )
        level = materialise(level, "quotas")
    return level.select(F.col("_from").alias("shard"), F.explode("_q").alias("q")).select("shard", "q.source", "q.quota")


def placements(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, shards: int = SHARDS, seed: int = 7, block_words: int = BLOCK_WORDS
) -> tuple[DataFrame, DataFrame]:
    """All rows as ``doc_id, source, _row, _key, _size, source_size, target``, and the mix as ``_row, shard, shard_order``.

    A row stands in the mix as often as it is taken. A null or empty text has no
    words and may be taken or not. Repeated rows are rows of their own. A source
    without words has target 0; the null source is a source. An empty table gives
    empty results.
    """
    rows = materialise(sized(docs), "sized")
    goals = materialise(targets(rows, weights, share), "targets")
    goals = goals.select(F.col("source").alias("_source"), "source_size", "target")
    same = F.col("source").eqNullSafe(F.col("_source"))
    long = materialise(long_documents(rows.where(F.col("_size") > block_words).join(goals, same).drop("_source")), "long")
    rest = rows.where(F.col("_size") <= block_words)
    blocked = materialise(blocks_of(rest, _goals_of_rest(goals, long), seed, block_words).drop("_source"), "blocked")
    plan = materialise(block_plan(blocked, seed), "blocks")
    passes = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_taken") - 1)).alias("_pass")
    unit_rows = ["source", "_block", "_row", "_key", passes]
    copies = _taken_rows(blocked, plan, seed).where("_taken > 0").select(*unit_rows)
    copies = materialise(copies.unionByName(long.where("_taken > 0").select(*unit_rows)), "copies")
    rows = rows.join(goals, same).drop("_source")
    # One pass over one block is what the tree splits and deals.
    units = copies.groupBy("source", "_pass", "_block").agg(F.count(F.lit(1)).alias("_n"))
    units = materialise(units, "units")
    split = split_quotas(units.groupBy("source").agg(F.count(F.lit(1)).alias("quota")), shards, seed)
    upto = F.sum("quota").over(Window.partitionBy("source").orderBy("shard"))
    spans = materialise(split.select(F.col("source").alias("_s"), "shard", (upto - F.col("quota")).alias("_lo"), upto.alias("_hi")), "spans")
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 2), "source", "_pass", "_block"), "_pass", "_block")
    dealt = (
        units.withColumn("_at", F.row_number().over(order) - 1)
        .join(spans, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_at") >= F.col("_lo")) & (F.col("_at") < F.col("_hi")))
        .select(F.col("source").alias("_us"), F.col("_pass").alias("_up"), F.col("_block").alias("_ub"), "shard")
    )
    placed = copies.join(
        materialise(dealt, "dealt"),
        F.col("source").eqNullSafe(F.col("_us")) & (F.col("_pass") == F.col("_up")) & (F.col("_block") == F.col("_ub")),
    ).select("_row", "shard", F.xxhash64(F.lit(seed + 3), "_key", "_pass").alias("shard_order"))
    return rows, placed


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as ``placements`` takes them, with ``shard`` and ``shard_order``.

    These two replace columns of ``docs`` that have their names. Sorted by
    ``shard_order`` a shard is shuffled.
    """
    own = [c for c in docs.columns if c not in ("shard", "shard_order")]
    name = free_name(docs, "_row")
    stored = with_row_id(docs.select(*own), name)
    _, placed = placements(stored.select("doc_id", "source", "text", F.col(name).alias("_row")), **settings)
    placed = materialise(placed.withColumnRenamed("_row", name), "placed")
    return stored.join(small(placed, 24 * placed.count()), name).drop(name)

"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups, by size from the largest on, enter the fullest shard that still holds them,
found in a balanced tree of remaining capacities. If none does, a new shard opens; with
a fixed number of shards, the emptiest takes the group.

At scale packing is two-level: *large* groups, of which there are at most
``LARGE_PARTS``, are packed first and alone. What room is left in each shard is then
shared among packing tasks in proportion to the bytes of small groups each one has, and
every task packs its share in the same way. A task misses its share by less than one
small group, and a small group is less than the ``LARGE_PARTS``-th part of everything.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampertide.llm.common import by_value, small, text_or_empty
from ampertide.session import materialise, with_row_tie

SHARDS = 8
#: A group larger than this part of all bytes is large.
LARGE_PARTS = 4096
#: Groups that one packing task takes, on average.
GROUPS_PER_TASK = 200_000

by_value(__name__)


def best_fit(sizes: list[int], rooms: list[float], capacity: float | None = None) -> tuple[list[int], list[float]]:
    """Bin of each size, which come in decreasing order, and the room left in each bin.

    ``rooms``: what is free in the bins there are. With ``capacity`` a size that fits
    nowhere opens a bin (one of its own if it is larger than that); without, it enters
    the emptiest bin. Of bins with equal room the first is taken.
    """
    free = sorted((room, i) for i, room in enumerate(rooms))
    bins, rooms = [], list(rooms)
    for size in sizes:
        at = bisect_left(free, (size, -1))
        if at < len(free):
            room, i = free.pop(at)
        elif capacity is not None or not free:
            i, room = len(rooms), max(capacity or 0, size)
            rooms.append(room)
        else:
            at = bisect_left(free, (free[-1][0], -1))
            room, i = free.pop(at)
        rooms[i] = room - size
        insort(free, (rooms[i], i))
        bins.append(i)
    return bins, rooms


def level_capacity(sizes: list[int], total: int, shards: int) -> float:
    """What each shard should hold: an equal part, once groups above an equal part have shards of their own."""
    left, free = total, shards
    for size in sorted(sizes, reverse=True):
        if free <= 1 or size * free <= left:
            break
        left -= size
        free -= 1
    return left / max(1, free)


def pack_groups(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``key, shard`` for groups ``key, bytes`` (distinct keys), shard sizes as equal as best fit gets them."""
    spark = groups.sparkSession
    total, n = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    least = total // LARGE_PARTS
    large = groups.where(F.col("bytes") > least).orderBy(F.desc("bytes"), "key").limit(LARGE_PARTS).collect()
    assert len(large) <= LARGE_PARTS
    sizes = [row["bytes"] for row in large]
    capacity = level_capacity(sizes, total, shards)
    # Room for the largest group in its shard, although others stay at the common level.
    bins, rooms = best_fit(sizes, [capacity] * shards)
    packed = spark.createDataFrame([(row["key"], b) for row, b in zip(large, bins)], "key string, shard int")
    rooms = [max(0.0, r) for r in rooms]
    rest = groups.where(F.col("bytes") <= least)
    room_in_all = sum(rooms)
    tasks = max(1, -(-n // GROUPS_PER_TASK))
    in_small = total - sum(sizes)

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bytes", "key"], ascending=[False, True], kind="stable")
        share = frame["bytes"].sum() / max(1, in_small)
        scale = share * in_small / room_in_all if room_in_all else 0.0
        bins, _ = best_fit(frame["bytes"].tolist(), [r * scale for r in rooms])
        return pd.DataFrame({"key": frame["key"], "shard": bins})

    placed = rest.withColumn("task", F.pmod(F.xxhash64("key"), F.lit(tasks))).groupBy("task").applyInPandas(run, "key string, shard int")
    return materialise(packed.unionByName(placed), "packed")


def pack_capacity(groups: DataFrame, capacity: int) -> DataFrame:
    """``key, shard`` with as few shards of a fixed capacity as best fit opens.

    Groups above an eighth of the capacity are packed task by task like the rest, as
    tasks share no shards: shard numbers are gapless over tasks, and each task leaves at
    most one shard more than half empty. A group above the capacity has its own shard.
    """
    n = groups.count()
    tasks = max(1, -(-n // GROUPS_PER_TASK))

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bytes", "key"], ascending=[False, True], kind="stable")
        bins, _ = best_fit(frame["bytes"].tolist(), [], capacity)
        return pd.DataFrame({"key": frame["key"], "task": key[0], "bin": bins})

    placed = groups.withColumn("task", F.pmod(F.xxhash64("key"), F.lit(tasks))).groupBy("task").applyInPandas(run, "key string, task long, bin long")
    placed = materialise(placed, "bins")
    opened = placed.groupBy("task").agg((F.max("bin") + 1).alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = opened.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return placed.join(starts, "task").select("key", (F.col("start") + F.col("bin")).alias("shard"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the text's bytes in UTF-8 plus one, none for a null. Rows with equal
    texts, null and empty alike, share a shard. The law is ``bytes``: shards are near
    equal in size, as far as the largest group allows. Slots count the rows of a shard
    from 0. Repeated rows are rows of their own, other columns are ignored.
    """
    text = text_or_empty()
    rows = with_row_tie(docs.select("doc_id", "text"), "_row").select(
        "doc_id",
        "_row",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text.cast("binary"), 256).alias("key"),
    )
    rows = materialise(rows, "sized")
    groups = materialise(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    placed = rows.join(pack_groups(groups, shards), "key").select("doc_id", "_row", "size", "text_crc32", "shard")
    order = [F.col("shard"), F.col("doc_id").asc_nulls_first(), F.col("_row")]
    # Range partitions may hold several shards and a shard may span many: number inside, then add what comes before.
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ordered = materialise(ordered.withColumn("_part", F.shiftright("_at", 33)), "ordered")
    firsts = ordered.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = firsts.select("shard", "_part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("start"))
    # At most one row per range partition and shard.
    starts = materialise(starts, "starts")
    return ordered.join(small(starts, 24 * starts.count()), ["shard", "_part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("start") + F.col("_at")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

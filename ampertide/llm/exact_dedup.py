"""Exact dedup: two Bloom passes find the rows whose text may repeat; only those are grouped.

Pass 1 sets a filter bit for every position that at least two rows hit. Pass 2
looks each row up: a row with a bit missing is alone with its text and goes
straight to the result. The rest, true repeats and a few chance hits, are grouped
by their whole SHA-256. Texts themselves are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampertide.llm.common import BLANKS, small, text_or_empty
from ampertide.session import materialise

#: Filter bits per row and table; with two tables a lone row meets chance hits in about 1 of 250 cases.
BITS_PER_ROW = 16
TABLES = 2
_BUCKET_BITS = 1 << 15  # of one bitmap of Spark's bitmap functions


def normalised(col: str = "text") -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(text_or_empty(col), BLANKS, " ")


def _place(table: int, bits: int) -> Column:
    """Position from 1 in a filter table."""
    return F.pmod(F.xxhash64("text_sha256", F.lit(table)), F.lit(bits)) + 1


def repeated_bits(digests: DataFrame, table: int, bits: int) -> DataFrame:
    """Bitmaps (bucket, bitmap) of the positions that two rows or more hit."""
    hit = digests.groupBy(_place(table, bits).alias("_p")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return hit.groupBy(F.bitmap_bucket_number("_p").alias(f"_bucket{table}")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_p")).alias(f"_bitmap{table}")
    )


def _is_set(bitmap: str, position: Column) -> Column:
    byte = F.substring(F.col(bitmap), (position / 8).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (position % 8).cast("int")) == 1


def may_repeat(digests: DataFrame, rows: int) -> DataFrame:
    """Add ``_maybe``: false only for rows whose hash no other row has."""
    bits = _BUCKET_BITS
    while bits < BITS_PER_ROW * rows:
        bits *= 2
    maybe = F.lit(True)
    for table in range(TABLES):
        filled = small(repeated_bits(digests, table, bits), bits // 8)
        position = _place(table, bits)
        digests = digests.join(filled, F.bitmap_bucket_number(position) == F.col(f"_bucket{table}"), "left")
        maybe = maybe & F.coalesce(_is_set(f"_bitmap{table}", F.bitmap_bit_position(position)), F.lit(False))
    return digests.select("doc_id", "_row", "text_sha256", maybe.alias("_maybe"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they agree after ``normalised``; null counts as empty.
    Of equal texts the smallest ``doc_id`` stays, a null ``doc_id`` only if there is
    no other. Of rows that also share the ``doc_id`` exactly one has ``kept``. Other
    columns are ignored. An empty table gives an empty result.
    """
    digests = materialise(
        docs.select(
            "doc_id",
            F.monotonically_increasing_id().alias("_row"),
            F.sha2(normalised().cast("binary"), 256).alias("text_sha256"),
        ),
        "digests",
    )
    flagged = materialise(may_repeat(digests, digests.count()), "flagged")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    groups = materialise(
        flagged.where("_maybe").groupBy("text_sha256").agg(first.alias("_first"), F.count(F.lit(1)).alias("group_size")),
        "groups",
    )
    grouped = (
        flagged.where("_maybe")
        .join(groups, "text_sha256")
        .select(
            "doc_id",
            F.col("_first.doc_id").alias("keep_id"),
            "group_size",
            (F.col("_row") == F.col("_first._row")).alias("kept"),
            "text_sha256",
        )
    )
    alone = flagged.where("not _maybe").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    return alone.unionByName(grouped)

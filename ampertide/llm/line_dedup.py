"""Line dedup: repeated passages of lines are removed, whichever lines stand around them.

Every pair of neighbouring lines with words is a piece, and so is every line of over
``PASSAGE_WORDS`` words. A repeated run of lines consists of such pieces wherever it
stands in a text, so it goes from its first line to its last. Content-defined chunks,
which a rolling hash over the hashes of the last lines ends, are fewer pieces but lose
the outer lines of a run. Pieces are matched by hash first, as narrow rows; those with a
partner are then compared byte by byte with the first copy, and only equal ones go.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampertide.llm.common import WORD, small
from ampertide.session import materialise, with_row_id

#: Lines that the rolling hash sees; one in ``DIVISOR`` lines ends a chunk.
WINDOW = 2
DIVISOR = 2
#: A chunk of one line is a passage if it has more words than this.
PASSAGE_WORDS = 50


def _long(line: Column) -> Column:
    """Whether a line is a passage of its own; so many words are no shorter than twice their number."""
    return (F.length(line) > 2 * PASSAGE_WORDS) & (F.regexp_count(line, F.lit(WORD)) > PASSAGE_WORDS)


def _piece(lines: Column, at: Column, end: Column) -> Column:
    size = end - at + 1
    return F.struct(at.alias("at"), size.alias("n_lines"), F.array_join(F.slice(lines, at + 1, size), "\n").alias("body"))


def passage_array(text: Column) -> Column:
    """Pieces of a text as an array of (at, n_lines, body): neighbouring lines with words, and long lines.

    Lines without a word belong to the pair around them. Pieces of one body are in the order of the text.
    """

    def pieces(lines: Column, worded: Column) -> Column:
        pairs = F.transform(F.slice(worded, F.lit(2), F.size(worded)), lambda end, k: _piece(lines, F.get(worded, k), end))
        alone = F.filter(worded, lambda i: _long(F.get(lines, i)))
        return F.concat(pairs, F.transform(alone, lambda i: _piece(lines, i, i)))

    def worded(lines: Column) -> Column:
        return F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(WORD), i)), lambda i: i.isNotNull())

    return _bound(F.split(text, "\n", -1), lambda ls: _bound(worded(ls), lambda w: pieces(ls, w)))


def chunk_array(text: Column) -> Column:
    """Chunks of a text as an array of (at, n_lines, body); the bodies joined by line ends are the text again.

    A long line is a chunk.
    """
    lines = F.split(text, "\n", -1)

    def cut(lines: Column, hashes: Column, long: Column) -> Column:
        def rolled(i: Column) -> Column:
            return F.xxhash64(*(F.get(hashes, i - k) for k in range(WINDOW)))

        last = F.size(lines) - 1
        ends = F.filter(
            F.sequence(F.lit(0), last),
            lambda i: (i == last) | F.get(long, i) | F.get(long, i + 1) | (F.pmod(rolled(i), F.lit(DIVISOR)) == 0),
        )
        return _bound(
            ends,
            lambda ends: F.transform(
                ends,
                lambda end, k: _bound(
                    F.when(k > 0, F.get(ends, k - 1) + 1).otherwise(0),
                    lambda start: _piece(lines, start, end),
                ),
            ),
        )

    return _bound(
        lines,
        lambda ls: _bound(
            F.transform(ls, lambda x: F.xxhash64(x)),
            lambda hs: _bound(F.transform(ls, _long), lambda long: cut(ls, hs, long)),
        ),
    )


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _passages(rows: DataFrame, cut: Callable[[Column], Column]) -> DataFrame:
    """One row per piece that counts as a passage: ``doc_id, _row, at, body``, with its place among the pieces."""
    pieces = rows.where("text is not null").select("doc_id", "_row", F.posexplode(cut(F.col("text"))).alias("at", "piece"))
    long_line = F.when(F.col("piece.n_lines") == 1, _long(F.col("piece.body")))
    return pieces.where(F.coalesce(long_line, F.col("piece.body").rlike(WORD))).select("doc_id", "_row", "at", "piece.body")


def _without(lines: Column, gone: Column) -> Column:
    """The text of the lines but those at the places of ``gone``, which ascend."""

    def between(k: Column) -> Column:
        low = F.when(k > 0, F.get(gone, k - 1)).otherwise(-1)
        high = F.coalesce(F.get(gone, k), F.size(lines))
        return F.slice(lines, low + 2, high - low - 1)

    return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), between)), "\n")


def line_dedup(docs: DataFrame, cut: Callable[[Column], Column] = chunk_array) -> DataFrame:
    """Per row: ``doc_id, text, n_lines, removed_lines, removed_chunks``, the text without repeated passages.

    ``cut`` says what is compared. Of equal pieces the first by ``doc_id`` (null last) and
    place stays; a text that repeats its own piece loses the later one. With
    ``passage_array`` all lines of a repeated run go, if it has two lines with words or one
    of over ``PASSAGE_WORDS``; lines without a word at its ends stay. With ``chunk_array``
    only whole chunks go. Pieces without a word and one-line pieces of up to
    ``PASSAGE_WORDS`` words always stay. Every line that goes has an equal one before it
    that stays. ``removed_chunks`` counts removed chunks, or stretches of lines if pieces
    overlap. A null text stays null with no lines; a text of which everything goes is
    empty. Other columns are ignored.
    """
    rows = with_row_id(docs.select("doc_id", "text"), "_row")
    hashes = _passages(rows, cut).select("doc_id", "_row", "at", F.xxhash64("body").alias("hash"))
    hashes = materialise(hashes, "piece-hashes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row", "at"))
    repeated = hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), first.alias("first")).where("n > 1")
    repeated = materialise(repeated.select("hash", "first"), "repeated")
    found = hashes.join(repeated, "hash").select(
        "_row", F.struct("at", "hash", ((F.col("_row") == F.col("first._row")) & (F.col("at") == F.col("first.at"))).alias("keeps")).alias("piece")
    )
    # A list holds pieces of one text, so it is no longer than the text.
    lists = materialise(found.groupBy("_row").agg(F.collect_list("piece").alias("pieces")), "found")
    size = 32 * (lists.count() + (lists.agg(F.sum(F.size("pieces"))).first()[0] or 0))
    # Bodies are looked up before the lists are unfolded, so that a text is cut once.
    with_body = _bound(
        cut(F.col("text")), lambda c: F.transform("pieces", lambda p: F.struct(p["hash"], p["keeps"], F.get(c, p["at"]).alias("piece")))
    )
    bodies = rows.join(small(lists, size), "_row").select("_row", F.explode(with_body).alias("p")).select("_row", "p.hash", "p.keeps", "p.piece.*")
    bodies = materialise(bodies, "bodies")
    kept = materialise(bodies.where("keeps").select("hash", F.col("body").alias("first_body")), "first-bodies")
    equal = bodies.where("not keeps").join(kept, "hash").where(F.col("body") == F.col("first_body"))
    gone = equal.groupBy("_row").agg(F.collect_list(F.sequence(F.col("at"), F.col("at") + F.col("n_lines") - 1)).alias("pieces"))
    gone = gone.select("_row", F.sort_array(F.array_distinct(F.flatten("pieces"))).alias("gone"), F.size("pieces").alias("removed_pieces"))
    if cut is not chunk_array:
        starts = F.filter("gone", lambda i, k: (k == 0) | (F.get("gone", k - 1) < i - 1))
        gone = gone.withColumn("removed_pieces", F.size(starts))
    gone = materialise(gone, "gone")
    rest = _bound(F.split("text", "\n", -1), lambda lines: _without(lines, F.col("gone")))
    return rows.join(small(gone, size), "_row", "left").select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(rest).alias("text"),
        F.coalesce(F.regexp_count("text", F.lit("\n")) + 1, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("removed_lines"),
        F.coalesce("removed_pieces", F.lit(0)).cast("long").alias("removed_chunks"),
    )

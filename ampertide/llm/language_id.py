"""Language ID by cross-parsing: the language whose text explains a document in the fewest phrases.

Learned text of each language becomes a suffix automaton, which recognises every
substring of it. A document is cut from the left into phrases, each the longest piece
that the language's text holds; a letter it does not hold ends a phrase too. Phrases
over letters is the cross-parsing entropy up to a factor; it is divided by what held-in
text of the language itself needs, so that languages of different richness compare.

A document is parsed in pieces of ``PIECE`` letters, all pieces of a batch side by side in
numpy: every step moves each piece by one letter. So very long texts take no longer
per letter than short ones, at the cost of one phrase per piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampertide.llm.common import by_value, lean, slices, unit

UNKNOWN = "und"
#: Bounds of the learning sample: documents per language, and letters of automaton text and of held-in text per language.
SAMPLE_DOCUMENTS = 200
TEXT_LETTERS = 20_000
CHECK_LETTERS = 30_000
#: At most so many languages are told apart; more raise an error.
MOST_LANGUAGES = 100
PIECE = 2048
#: A language of more distinct letters has a list of transitions instead of a full table.
DENSE_LETTERS = 128
_BATCH_BYTES = 8 << 20
_LETTER = r"\p{L}"

by_value(__name__)


def letters_only(texts: pa.Array) -> pa.Array:
    """Lower-case letters, with one blank for each run of anything else."""
    lower = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.string()))
    return pc.utf8_trim(pc.replace_substring_regex(lower, r"\P{L}+", " "), " ")


def suffix_automaton(codes: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a text: per state, the next state by letter."""
    size = 2 * len(codes) + 2
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes.tolist():
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    assert len(step) <= size
    return step


class Parser:
    """Parsing steps of one language; a state is twice its number, odd if a phrase ended there."""

    def __init__(self, codes: np.ndarray, letters: int):
        """``codes``: the learned text in a common alphabet of ``letters``."""
        held = np.unique(codes)
        #: Common codes to own ones; 0 is any letter that the language does not hold.
        self.own = np.zeros(letters + 1, np.int32)
        self.own[held] = np.arange(1, len(held) + 1)
        self.width = len(held) + 1
        step = suffix_automaton(self.own[codes])
        # Without a transition the phrase ends and the letter starts the next one at the root.
        self.root = np.array([2 * step[0].get(c, 0) + 1 for c in range(self.width)], np.int32)
        at = np.array([s * self.width + c for s, edges in enumerate(step) for c in edges], np.int64)
        to = np.array([2 * t for edges in step for t in edges.values()], np.int32)
        self.dense = self.width <= DENSE_LETTERS
        if self.dense:
            self.to = np.tile(self.root, len(step))
            self.to[at] = to
        else:
            order = np.argsort(at)
            self.at, self.to = at[order], to[order]

    def move(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        key = (state >> 1) * self.width + codes
        if self.dense:
            return self.to[key]
        place = np.minimum(np.searchsorted(self.at, key), len(self.at) - 1)
        return np.where(self.at[place] == key, self.to[place], self.root[codes])


def equal_shares(texts: list[str], most: int) -> str:
    """The texts joined by blanks, up to ``most`` letters, for which the longest ones are cut to one length."""
    left = most
    for k, n in enumerate(sorted(len(t) + 1 for t in texts)):
        share = left // (len(texts) - k)
        if n > share:
            return " ".join(t[: max(1, share - 1)] for t in texts)[:most]
        left -= n
    return " ".join(texts)[:most]


class Languages:
    """One parser per language, which knows every letter of the text it learned."""

    def __init__(self, sample: pd.DataFrame):
        """``sample``: columns ``lang, text``; texts of a language in a fixed order."""
        own = {
            lang: [t for t in letters_only(pa.array(rows["text"], pa.string())).to_pylist() if t]
            for lang, rows in sample.groupby("lang", sort=True)
        }
        own = {lang: texts for lang, texts in own.items() if texts}
        self.names = sorted(own)
        # Every other document is held in to see what the language's own text needs.
        learned = {lang: equal_shares(own[lang][::2], TEXT_LETTERS) for lang in self.names}
        self.known = np.array(sorted(map(ord, set().union(*learned.values()))), np.uint32)
        self.parsers = [Parser(self.encode(learned[lang]), len(self.known)) for lang in self.names]
        self.base = []
        for k, lang in enumerate(self.names):
            text = equal_shares(own[lang][1::2] or own[lang], CHECK_LETTERS)
            self.base.append(max(self.phrases([text])[0, k] / max(1, len(text)), 1e-6))
        self.base = np.array(self.base)

    def encode(self, text: str) -> np.ndarray:
        """Letters as numbers of all learned ones, from 1; 0 is a letter that no language holds."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        known, code = self.known, np.arange(1, len(self.known) + 1, dtype=np.int32)
        low = np.zeros(1 << 13, np.int32)
        low[known[known < len(low)]] = code[known < len(low)]
        out = low[np.minimum(points, len(low) - 1)]
        far = points >= len(low) - 1
        if far.any():
            at = np.minimum(np.searchsorted(known, points[far]), max(len(known) - 1, 0))
            out[far] = np.where(known[at] == points[far], code[at], 0) if len(known) else 0
        return out

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of each text in each language."""
        sizes = np.array([len(t) for t in texts], np.int64)
        codes = self.encode("".join(texts))
        pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(texts)), pieces)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = (np.cumsum(sizes) - sizes)[owner] + number * PIECE
        length = np.minimum(sizes[owner] - number * PIECE, PIECE)
        order = np.argsort(-length, kind="stable")
        owner, start, length = owner[order], start[order], length[order]
        active = np.searchsorted(-length, -np.arange(PIECE), side="left")  # pieces longer than i
        out = np.zeros((len(texts), len(self.names)), np.int64)
        for k, parser in enumerate(self.parsers):
            own = parser.own[codes]
            state = np.zeros(len(owner), np.int64)
            count = np.ones(len(owner), np.int64)
            for i in range(int(length[0]) if len(length) else 0):
                n = active[i]
                moved = parser.move(state[:n], own[start[:n] + i])
                state[:n] = moved
                count[:n] += moved & 1
            out[:, k] = np.bincount(owner, count, len(texts)).astype(np.int64)
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score per text: the score is the share of the winner under a softmax of the entropies."""
        clean = letters_only(texts).to_pylist()
        sizes = np.array([max(1, len(t)) for t in clean])
        rate = self.phrases(clean) / sizes[:, None] / self.base[None, :]
        rate = rate if len(self.names) else np.zeros((len(clean), 1))
        best = rate.argmin(axis=1)
        spread = np.exp(-SHARPNESS * (rate - rate.min(axis=1, keepdims=True)))
        score = 1 / spread.sum(axis=1)
        known = np.array([bool(t) and bool(self.names) for t in clean])
        names = [self.names[b] if ok else UNKNOWN for b, ok in zip(best, known)]
        return names, np.where(known, score, 0.0)


#: How fast the score falls with the distance of the entropies.
SHARPNESS = 12.0


def learning_sample(docs: DataFrame) -> pd.DataFrame:
    """A bounded sample of labelled documents, the same for the same rows.

    Documents are drawn by a hash of their id at a rate that gives each language about
    ``SAMPLE_DOCUMENTS``; the driver receives at most twice as many texts.
    """
    labelled = docs.where("lang is not null and text is not null and text rlike '\\\\p{L}'")
    labelled = labelled.where(~held_out())
    counts = labelled.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    rate = F.lit(0.0)
    for row in counts:
        rate = F.when(F.col("lang") == row["lang"], min(1.0, SAMPLE_DOCUMENTS / row["count"])).otherwise(rate)
    place = unit("lang id", F.col("doc_id"))
    drawn = labelled.where(place < rate).select("lang", F.col("text"), place.alias("place"))
    most = 2 * SAMPLE_DOCUMENTS * max(1, len(counts))
    return drawn.orderBy("place", "text").limit(most).toPandas().sort_values(["lang", "place", "text"])


def held_out():
    """Documents that are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, model: Languages) -> DataFrame:
    """Rows of ``docs`` with ``lang_pred`` and ``score``; these replace columns of the same names.

    A text that is null or has no letter gets ``und`` and score 0, as does every text if
    nothing could be learned. Every letter of every text is parsed.
    """
    own = [c for c in docs.columns if c not in ("lang_pred", "score")]
    docs = docs.select(*own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _BATCH_BYTES):
            names, scores = model.predict(batch.column("text"))
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "lang_pred", "score"])

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return docs.mapInArrow(lean(run), T.StructType([*docs.schema.fields, *added]))


def fit(docs: DataFrame) -> Languages:
    """A model of the labelled documents that are not held out."""
    return Languages(learning_sample(docs))

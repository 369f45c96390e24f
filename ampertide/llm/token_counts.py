"""Token counts by a unigram tokenizer over a trie of pre-tokens.

Pre-tokens (words with a mark for the space before) of a batch are inserted in a trie. The
forward score of a node is the best sum of piece scores over all ways to cut the
path from the root into pieces; it depends on the path only, so it is computed once for
all words that share the prefix. Nodes where a word ends store its number of pieces.
Words are distinct per batch and documents are never shuffled.

Pieces come from a public vocabulary. Their scores follow Zipf's law in the order of
the vocabulary, as its own scores are just that order. A letter that no piece holds is
one piece per UTF-8 byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampertide.llm.common import Words, by_value, lean, slices, worker_kept

SPACE = "▁"
_BATCH_BYTES = 16 << 20
#: Words whose counts a Python worker remembers, and the most letters of one; together some 60 MB.
_CACHE_WORDS = 400_000
_CACHE_LENGTH = 64
#: Longer words are no part of the trie: their path would be held letter by letter.
_SHARED_LENGTH = 1000

by_value(__name__)


def piece_scores(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece vocabulary with their scores; control and byte pieces are none."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [i for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return {model.id_to_piece(i): -log(rank + 2) for rank, i in enumerate(pieces)}


class PieceTrie:
    """Pieces as a trie of dictionaries: ``nodes[n]`` maps a letter to the next node, ``score[n]`` is a piece's or None."""

    def __init__(self, scores: dict[str, float]):
        self.nodes: list[dict[str, int]] = [{}]
        self.score: list[float | None] = [None]
        for piece, value in scores.items():
            at = 0
            for c in piece:
                nxt = self.nodes[at].get(c)
                if nxt is None:
                    nxt = self.nodes[at][c] = len(self.nodes)
                    self.nodes.append({})
                    self.score.append(None)
                at = nxt
            self.score[at] = value
        #: Worse than any piece, per byte.
        self.byte_score = min(scores.values(), default=0.0) - 10.0
        self.known: dict[str, int] = {}

    def sizes(self, words: list[str]) -> np.ndarray:
        """Pieces of each of the distinct ``words``; only those not met lately enter the trie, long ones are not remembered."""
        if len(self.known) + len(words) > _CACHE_WORDS:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        found = dict(zip(new, self.counts(new).tolist()))
        out = np.array([found[w] if w in found else self.known[w] for w in words], np.int64)
        self.known.update((w, n) for w, n in found.items() if len(w) <= _CACHE_LENGTH)
        return out

    def counts(self, words: list[str]) -> np.ndarray:
        """Pieces of each of the distinct ``words``.

        The words' trie is walked in sorted order, so the path from the root to the
        current node is all that is held: per node the best score, its pieces, and the
        piece-trie nodes of the pieces that may go on.
        """
        nodes, score, byte_score = self.nodes, self.score, self.byte_score
        out = np.zeros(len(words), np.int64)
        order = []
        for w, word in enumerate(words):
            if len(word) > _SHARED_LENGTH:
                out[w] = self.alone(word)
            else:
                order.append(w)
        order.sort(key=words.__getitem__)
        best, pieces, running = [0.0], [0], [[(0, 0)]]
        path = ""
        for w in order:
            word = words[w]
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del best[shared + 1 :], pieces[shared + 1 :], running[shared + 1 :]
            for i in range(shared, len(word)):
                c = word[i]
                # Fallback bytes first, then every piece that ends here; the first of equal scores stays.
                size = len(c.encode("utf-8", "surrogatepass"))
                top, count = best[i] + size * byte_score, pieces[i] + size
                open_pieces = []
                for start, node in running[i]:
                    node = nodes[node].get(c)
                    if node is None:
                        continue
                    open_pieces.append((start, node))
                    value = score[node]
                    if value is not None and best[start] + value > top:
                        top, count = best[start] + value, pieces[start] + 1
                open_pieces.append((i + 1, 0))
                best.append(top)
                pieces.append(count)
                running.append(open_pieces)
            path = word
            out[w] = pieces[len(word)]
        return out

    def alone(self, word: str) -> int:
        """Pieces of a word by the same scores, holding no more than the longest piece reaches back."""
        nodes, score, byte_score = self.nodes, self.score, self.byte_score
        # (best score up to its start, pieces up to it, piece-trie node) of each piece that may go on.
        running, best, pieces = [(0.0, 0, 0)], 0.0, 0
        for c in word:
            size = len(c.encode("utf-8", "surrogatepass"))
            top, count = best + size * byte_score, pieces + size
            going = []
            for before, n, node in running:
                node = nodes[node].get(c)
                if node is None:
                    continue
                going.append((before, n, node))
                value = score[node]
                if value is not None and before + value > top:
                    top, count = before + value, n + 1
            best, pieces = top, count
            going.append((best, pieces, 0))
            running = going
        return pieces


def token_counts(docs: DataFrame, scores: dict[str, float]) -> DataFrame:
    """Per row: ``doc_id, n_words, n_tokens``.

    Null, empty and blank texts have none. Repeated rows give repeated results, other
    columns are ignored.
    """

    key = f"piece trie {hash(frozenset(scores.items()))}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = worker_kept(key, lambda: PieceTrie(scores))
        for batch in slices(batches, _BATCH_BYTES):
            words = Words(batch.column("text"), lower=False)
            sizes = trie.sizes([SPACE + w for w in words.table.to_pylist()])
            sums = np.concatenate([[0], np.cumsum(sizes[words.codes])])[words.starts]
            columns = [batch.column("doc_id"), pa.array(words.counts, pa.int64()), pa.array(np.diff(sums), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_tokens"])

    return docs.select("doc_id", F.col("text")).mapInArrow(lean(run, key), "doc_id long, n_words long, n_tokens long")

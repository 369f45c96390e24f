"""Trie counts against a forward pass over every word alone."""

from __future__ import annotations

import random

import public_tokenizers

from ampertide.llm import token_counts as tc

SCORES = tc.piece_scores(public_tokenizers.path("piece_bpe_32k.model"))


def alone(word, scores):
    """Best score and its pieces for one word, cut by cut."""
    floor = min(scores.values()) - 10.0
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        top = (best[end - 1][0] + size * floor, best[end - 1][1] + size)
        for start in range(end):
            value = scores.get(word[start:end])
            if value is not None and best[start][0] + value > top[0]:
                top = (best[start][0] + value, best[start][1] + 1)
        best.append(top)
    return best[-1][1]


def test_counts_of_words():
    rng = random.Random(1)
    words = {"".join(rng.choice("aeithnsé語▁.") for _ in range(rng.randint(0, 14))) for _ in range(3000)}
    words = sorted(words | {tc.SPACE + w for w in ("the", "there", "thereof", "internationalization", "日本")}, key=hash)
    trie = tc.PieceTrie(SCORES)
    assert trie.counts(words).tolist() == [alone(w, SCORES) for w in words]


def test_documents(spark):
    rows = [(1, "the house the\thouse", 0), (2, None, 0), (3, " \n", 0), (4, "", 0), (None, "É é", 0), (5, "the " * 100_000, 0), (5, "x", 0)]
    result = tc.token_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"), SCORES).collect()
    count = lambda text: sum(alone(tc.SPACE + w, SCORES) for w in (text or "").split(" "))
    wanted = [(1, 4, count("the house the house")), (2, 0, 0), (3, 0, 0), (4, 0, 0), (None, 1, count("É é"))]
    wanted += [(5, 100_000, 100_000 * count("the")), (5, 1, count("x"))]
    assert [tuple(r) for r in result] == wanted
    assert tc.token_counts(spark.createDataFrame([], "doc_id long, text string"), SCORES).collect() == []


def test_long_words_alone():
    rng = random.Random(4)
    trie = tc.PieceTrie(SCORES)
    words = ["".join(rng.choice("the inationalsé語") for _ in range(n)) for n in (1, 30, 999, 1001, 3000)]
    assert [trie.alone(w) for w in words] == trie.counts(words).tolist() == [alone(w, SCORES) for w in words]


def test_text_without_blanks_is_not_remembered():
    rng = random.Random(5)
    letters = [chr(c) for c in range(0x4E00, 0x5200)]
    trie = tc.PieceTrie(SCORES)
    trie.sizes(["".join(rng.choices(letters, k=2000)) for _ in range(50)] + ["short"])
    assert list(trie.known) == ["short"]


def test_word_of_a_million_letters_holds_little():
    import tracemalloc

    trie, word = tc.PieceTrie(SCORES), "international" * 40_000
    tracemalloc.start()
    found = trie.counts([word])
    assert tracemalloc.get_traced_memory()[1] < 20 << 20
    tracemalloc.stop()
    assert found[0] > 0

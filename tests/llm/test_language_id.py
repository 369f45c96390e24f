"""Cross-parsing against string search, and held-out accuracy."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pyarrow as pa

from ampertide.llm import language_id as li

FOLDER = "/root/testdata/sf0.01"


def test_phrases_against_string_search():
    rng = random.Random(1)
    words = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(n))
    sample = pd.DataFrame([("x", words("abcé", 300)), ("x", words("abcé", 50)), ("y", words("cdeß", 300)), ("y", words("cdeß", 50))], columns=["lang", "text"])
    model = li.Languages(sample)
    learned = {"x": sample.text[0], "y": sample.text[2]}
    texts = [words("abcdeéßq", 40) for _ in range(30)] + ["", "q", words("abc", 3000)]
    found = model.phrases(texts)
    for t, text in enumerate(texts):
        for k, lang in enumerate(model.names):
            assert found[t, k] == parsed(text, learned[lang]), (t, lang)
    names, scores = model.predict(pa.array([words("abc", 20), words("de", 20), None, "", "12 !?", "é"]))
    assert names == ["x", "y", "und", "und", "und", "x"]
    assert (scores >= 0).all() and (scores <= 1).all() and list(scores[2:5]) == [0, 0, 0]


def parsed(text, learned):
    """Phrases counted as breaks: a phrase also ends at each piece of the text."""
    total = 0
    for start in range(0, len(text), li.PIECE):
        piece, current, count = text[start : start + li.PIECE], "", 1
        for c in piece:
            if current + c in learned:
                current += c
            else:
                count += 1
                current = c if c in learned else ""
        total += count
    return total


def test_many_scripts():
    """Languages of thousands of letters each, beside Latin ones, are told apart and parsed exactly."""
    rng = random.Random(2)
    alphabets = {"en": "abcdefgh", "fr": "abcdeéèç", "ko": [chr(0xAC00 + k) for k in range(0, 2000, 2)], "kp": [chr(0xAC01 + k) for k in range(0, 2000, 2)]}
    alphabets["zh"] = [chr(0x4E00 + k) for k in range(3000)]
    words = {lang: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 5))) for _ in range(400)] for lang, letters in alphabets.items()}
    text = lambda lang, n: "".join(rng.choice(words[lang]) for _ in range(n))
    sample = pd.DataFrame([(lang, text(lang, 1000)) for lang in alphabets for _ in range(8)], columns=["lang", "text"])
    model = li.Languages(sample)
    assert not model.parsers[model.names.index("zh")].dense
    names = [lang for lang in alphabets for _ in range(10)]
    texts = [text(lang, 20) for lang in names]
    assert model.predict(pa.array(texts))[0] == names
    learned = " ".join(sample[sample.lang == "zh"].text[::2])
    mixed = [learned[100:160] + texts[-1] + learned[900:930], texts[0]]
    assert list(model.phrases(mixed)[:, model.names.index("zh")]) == [parsed(t, learned) for t in mixed]


def test_every_sampled_document_is_learned_from():
    long = "a" * 2 * li.TEXT_LETTERS
    shares = li.equal_shares([long, "bcd", long, "e" * 5000], li.TEXT_LETTERS)
    assert len(shares) <= li.TEXT_LETTERS < len(shares) + 5 and "bcd" in shares
    assert shares.count("e") == 5000 and [len(x) for x in shares.split(" ")][::2] == [shares.count("a") // 2] * 2
    assert li.equal_shares(["ab", "c"], 10) == "ab c" and li.equal_shares([], 10) == ""
    # The language's words come after a very long document that holds none of them.
    sample = pd.DataFrame([("x", long), ("x", long), ("x", "word text " * 100), ("x", "word text " * 100), ("y", "worn test " * 100), ("y", "worn test " * 100)], columns=["lang", "text"])
    assert li.Languages(sample).predict(pa.array(["text word text"]))[0] == ["x"]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = li.identify(docs.withColumn("out", li.held_out()), li.fit(docs)).toPandas()
    assert len(rows) == 1000
    out = rows[rows.out & (rows.n_chars > 20)]
    assert (out.lang == out.lang_pred).mean() > 0.97
    assert np.isfinite(rows.score).all()


def test_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, score string, lang_pred long"
    empty = spark.createDataFrame([], schema)
    model = li.fit(empty)
    assert li.identify(empty, model).collect() == []
    rows = spark.createDataFrame([(None, "abc", None, None, "s", 1), (2, None, "en", None, "s", 1)], schema)
    assert {(r.lang_pred, r.score) for r in li.identify(rows, li.fit(rows)).collect()} == {("und", 0.0)}

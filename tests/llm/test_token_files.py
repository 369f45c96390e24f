"""Token files: exact round trip and ids of the tokenizer on whole texts."""

from __future__ import annotations

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from ampertide.llm import token_files as tf
from ampertide.llm.common import joined

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "It's a dog.It,is...A.b,c", "a.'s b,'ll c.'", "É́a. ́b", "ΑΣ ΑΣ. ΣΑ", "x\x01y \x01 z", "a b\x1cc d",
    "<|endoftext|> and <|ENDOFTEXT|>", "日本語 テキスト.", "%%% &&&.,", "İstanbul ǅ ﬁ", "a‍b̀.", "w" * 5000, "9.5,3 2nd,3rd a1.",
]


TOKENIZER = Tokenizer.from_file(PATH)


def wanted(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def test_words_give_the_ids_of_whole_texts():
    rng = random.Random(2)
    alphabet = "abcZÉéßσΣ.,'’! \n\t 9<|\x01́"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    encoder = tf.Encoder(PATH)
    for _ in range(2):
        ids, counts = encoder.encode(pa.array(texts))
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for text, part in zip(texts, parts):
            assert part.tolist() == wanted(text), repr(text)


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, n, at):
        return self.getvalue()[at : at + n]


@pytest.mark.parametrize("sizes", [[], [1], [tf.BLOCK], [3, tf.BLOCK * 2, 5, 1], [tf.BLOCK - 1, 1, 1]])
def test_round_trip(sizes):
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 1 << 32, n, np.uint32) for n in sizes]
    out = Source()
    writer = tf.Writer(out)
    for i, ids in enumerate(docs):
        writer.add([None if i == 1 else -i], ids, np.array([len(ids)]))
    writer.close()
    reader = tf.Reader(out)
    found = list(reader.documents())
    assert [d for d, _ in found] == [None if i == 1 else -i for i in range(len(docs))]
    assert all((a == b).all() for (_, a), b in zip(found, docs))
    assert reader.total == sum(sizes)


def test_files_of_documents(spark):
    schema = "doc_id long, text string, start long, part string"
    rows = [(i * 7 % 101 - 5, t, None, "x") for i, t in enumerate(ODD * 3)] + [(None, "null id", 1, ""), (3, "again", 1, ""), (3, "again", 1, "")]
    result = tf.read_tokens(tf.write_tokens(spark.createDataFrame(rows, schema), PATH)).collect()
    signed = lambda t: 42 if t is None else int(np.int64(np.uint64(xxhash.xxh64_intdigest(t.encode(), 42))))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1])))
    start, expected = 0, []
    for doc_id, text, *_ in order:
        ids = wanted(text)
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, result), key=lambda r: r[1]) == expected
    assert tf.read_tokens(tf.write_tokens(spark.createDataFrame([], schema), PATH)).collect() == []


def test_text_without_blanks_is_not_remembered():
    rng = random.Random(3)
    letters = [chr(c) for c in range(0x4E00, 0x6000)]
    texts = ["".join(rng.choices(letters, k=3000)) + " and words" for _ in range(40)] + ["x" * 100_000]
    encoder = tf.Encoder(PATH)
    ids, counts = encoder.encode(pa.array(texts))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert all(part.tolist() == wanted(text) for text, part in zip(texts, parts))
    assert set(encoder.known) == {"and", "words"}


def test_plain_words_need_no_mark_between_them():
    encoder, seen = tf.Encoder(PATH), []
    whole = encoder._whole
    encoder._whole = lambda texts: seen.extend(texts) or whole(texts)
    texts = ["Né. It's a dog's (3rd) día, 42 x-ray... мир.", "naïve\u00a0word e\u0301. 日本 \u0915\u093c."]
    ids, counts = encoder.encode(pa.array(texts))
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [wanted(t) for t in texts]
    marked = {w for t in seen if tf._MARK in t for w in t.split(f" {tf._MARK} ")}
    assert marked == {"naïve\u00a0word", "e\u0301.", "日本", "\u0915\u093c."}
    # Sentences end behind accented letters, too.
    assert {"né", "día", "мир"} <= set(encoder.known) and not {"né.", "día,", "мир."} & set(encoder.known)


def test_every_plain_letter_keeps_its_place():
    letters = [c for c in map(chr, range(0x21, 0x530)) if pc.match_substring_regex(pa.array([c]), tf._PLAIN)[0].as_py()]
    assert "\u0130" not in letters and {"é", "Я", "~"} <= set(letters) and len(letters) > 500
    rng = random.Random(4)
    texts = [f"{c} {c}. {c},{c} a{c}'s '{c} 1{c}{c}2" for c in letters]
    texts += [" ".join("".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(30)) for _ in range(300)]
    encoder = tf.Encoder(PATH)
    ids, counts = encoder.encode(pa.array(texts))
    for text, part in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert part.tolist() == wanted(text), repr(text)


def test_words_of_letters_pass_by_the_normaliser():
    encoder, seen = tf.Encoder(PATH), []
    whole = encoder._whole
    encoder._whole = lambda texts: seen.extend(texts) or whole(texts)
    texts = ["the día: naïve! мир; (über) it's", "É día x2 the; e\u0301 the", "straße ÿ ı ſ ǆ ҁ"]
    ids, counts = encoder.encode(pa.array(texts))
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [wanted(t) for t in texts]
    assert not {"the", "día", "naïve", "мир", "it", "straße"} & {w for t in seen for w in t.split(" ")}
    # What is behind a letter is a word of its own.
    assert {"día", "naïve", "мир", "it", "'s", "!"} <= set(encoder.known) and not {"día:", "naïve!", "it's"} & set(encoder.known)


def test_words_at_hand_stay_when_others_are_forgotten(monkeypatch):
    monkeypatch.setattr(tf, "_CACHE_WORDS", 6)
    encoder, learned = tf.Encoder(PATH), []
    learn = encoder._learn
    encoder._learn = lambda words: learned.append(pa.array(words).to_pylist()) or learn(words)
    for text in ["one two 3rd 日本 -- five", "日本 six -- two", "seven two " + "x" * 100, "one two six seven nine ten 8 -- é"]:
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == wanted(text)
    assert [sorted(words) for words in learned] == [["--", "3rd", "five", "one", "two", "日本"], ["six"], ["seven"], ["8", "nine", "one", "ten", "é"]]


def test_short_batches_are_joined():
    rows = [{"doc_id": [i], "text": [t]} for i, t in enumerate(["ab", None, "", "c" * 500, "d", "ef", "g" * 60, "h"])]
    batches = [pa.RecordBatch.from_pydict(r, pa.schema({"doc_id": pa.int64(), "text": pa.string()})) for r in rows]
    out = list(joined(iter(batches), 100))
    assert [r for b in out for r in b.to_pylist()] == [r for b in batches for r in b.to_pylist()]
    assert len(out) == 4 and all(b.nbytes <= 100 or b.num_rows == 1 for b in out)
    assert list(joined(iter([]), 100)) == []


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, tokenizer = tf.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.by_words and tf.Encoder(PATH).by_words
    texts = ["Two  Words, here.", "", "a<|endoftext|>b"]
    ids, counts = encoder.encode(pa.array(texts))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]

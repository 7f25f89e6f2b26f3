import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from postsieve.llm import tokens
from postsieve.llm import words as w
from postsieve.llm.tokens import TextEncoder


@pytest.mark.parametrize("chunk", [5, 17, 1 << 20])
def test_word_hashes_are_equal_for_equal_words_only(monkeypatch, chunk):
    monkeypatch.setattr(w.pieces, "__defaults__", (chunk,))
    rng, seen, words_of = random.Random(chunk), {}, {}
    for _ in range(150):
        texts = [
            None if rng.random() < 0.1 else "".join(rng.choices("aAbé \n\t\x0b", k=rng.choice([0, 1, 5, 30, 60])))
            for _ in range(rng.randint(0, 6))
        ]
        hashes, _, counts = w.word_hashes(pa.array(texts, pa.string()), lower=True)
        expected = [(t or "").encode().lower().split() for t in texts]
        assert list(counts) == [len(x) for x in expected]
        for h, word in zip(hashes.tolist(), [y for x in expected for y in x]):
            assert seen.setdefault(word, h) == h and words_of.setdefault(h, word) == word
        grams, per_text = w.windows(hashes, counts, 3)
        runs = [tuple(x[i : i + 3]) for x in expected for i in range(len(x) - 2)]
        assert list(per_text) == [max(len(x) - 2, 0) for x in expected]
        assert len(grams) == len(runs) and len(set(grams.tolist())) == len(set(runs))


def test_small_batches_cover_all_rows_in_order():
    texts = ["x" * n for n in (0, 5, 900, 1, 1, 2000, 3)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = list(w.small_batches(batch, size=1000))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts and len(parts) == 2


PARTS = [
    "a", "B", "é", "É", "́", " ", "  ", "\n", "\t", " ", "'s", "12", "3", ".", "!!", "<|endoftext|>",
    "<|startoftext|>", "the", "\x1c", "日本", "\U0001f600", "\u0085", " x", "İ", "ǅ",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("remembered", [20, 10_000])
def test_pieces_encode_like_whole_texts(name, remembered):
    encoder, rng = TextEncoder(public_tokenizers.path(name), remembered), random.Random(4)
    for _ in range(1500):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 14)))
        assert encoder.encode(text) == encoder.whole(text), repr(text)
    assert encoder.encode(None) == b"" and encoder.dtype == np.dtype("<u2")


def test_hashing_words_gives_up_remembered_pieces():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokens.encoder(path).encode("some words to remember")
    assert tokens.encoder.cache_info().currsize == 1
    w.word_hashes(pa.array(["other words"]))
    assert tokens.encoder.cache_info().currsize == 0

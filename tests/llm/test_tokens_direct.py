"""Words of letters go to the library's merges directly, with the ids that whole texts get."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from shelfspark.llm import tokens


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_and_memory_of_new_words(name):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("aeioustnrXQ'.-7é"), rng.integers(1, 14))) for _ in range(4000)]
    texts = [" ".join(words[k : k + 40]) for k in range(0, 4000, 40)] + ["", " ", "so", " so", "sO\n so\tso"]
    encoder = tokens.ChunkEncoder(public_tokenizers.path(name), memo_chunks=500)
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(pa.array(texts))):
            assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.direct == (name == "byte_bpe_50k.json")
    assert tokens.BATCH_BYTES <= 6 << 20 and tokens.ChunkEncoder(public_tokenizers.path(name)).memo_chunks <= 120_000


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_are_remembered_without_the_marks_beside_them(name):
    encoder = tokens.ChunkEncoder(public_tokenizers.path(name), memo_chunks=500)
    assert encoder.in_chunks and encoder.fine
    list(encoder.encode(pa.array(["one two\nthree", "One, (two) three!", "one"])))
    seen = len(encoder.names)
    list(encoder.encode(pa.array(["one, two!\nthree", "three (two)"])))
    assert len(encoder.names) == seen  # new sentences of the same words and marks


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_texts_cut_beside_marks_and_lines(name):
    rng = np.random.default_rng(2)
    symbols = [*"abcSTEéßÿÀ×÷ñµ", *"'''.,!?()-$#~|_12", *"    \n\n\n\t\r", "'s", "'re", " ", "́", "̸", "漢", "ж", " ", "　", "​", "“", "\u0085", "😀", "ſ", "İ", "Ñ"]
    texts = ["".join(rng.choice(symbols, rng.integers(0, 40))) for _ in range(6000)]
    encoder = tokens.ChunkEncoder(public_tokenizers.path(name), memo_chunks=300)
    for _ in range(2):
        for start in range(0, len(texts), 1500):
            part = pa.array(texts).slice(start, 1500)
            for text, ids in zip(part.to_pylist(), encoder.encode(part)):
                assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text
    assert len(encoder.names) <= 4 * 300

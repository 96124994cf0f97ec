import random

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import langid
from tests.llm.helpers import EDGES, documents, empty

SYLLABLES = {"xx": ["ba", "ko", "ti", "ra", "un"], "yy": ["sch", "ung", "er", "ein", "ge"], "zz": ["eau", "ion", "que", "oi", "é"]}


def sentence(rng, lang, n=12):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def naive_phrases(train, symbols):
    """Greedy longest phrases of ``symbols`` that occur in ``train``; an unseen symbol is a phrase."""
    n, i = 0, 0
    while i < len(symbols):
        j = i
        while j < len(symbols) and symbols[i : j + 1] in train:
            j += 1
        n, i = n + 1, max(j, i + 1)
    return n


@pytest.mark.parametrize("seed", range(6))
def test_automaton_parses_like_substring_search(seed):
    rng = random.Random(seed)
    train = {lang: sentence(rng, lang, 60) for lang in SYLLABLES}
    model = langid.build_model(train, dense=(langid.DENSE, 4)[seed % 2])
    text = "".join(sentence(rng, rng.choice("xyz") * 2, 3) + rng.choice([" ", "Q! ", "ñ"]) for _ in range(120))
    assert len(text) > 8 * langid.BLOCK
    symbols = "".join(chr(c) if c else " " for c in langid.letters(text))
    (h,) = langid.entropies(model, [text])
    counts = h * len(symbols) / model.log_sizes
    assert [round(c) for c in counts] == [naive_phrases(train[lang], symbols) for lang in model.languages]


def parsed(model, train, texts):
    """Each text's phrases by the model and by substring search."""
    out = list(langid.entropies(model, texts))
    for text, h in zip(texts, out):
        symbols = "".join(chr(c) if c else " " for c in langid.letters(text))
        yield [round(c) for c in h * len(symbols) / model.log_sizes], [naive_phrases("".join(chr(c) if c else " " for c in langid.letters(train[k])), symbols) for k in model.languages]


def test_phrases_run_on_from_block_to_block():
    """Parses that never meet (periodic texts), texts that are training text, and several long texts at once."""
    rng = random.Random(3)
    train = {"xx": "ha" * 31 + sentence(rng, "xx", 90), "yy": "haha " * 7 + "aha" * 20, "zz": sentence(rng, "zz", 200)}
    texts = ["ha" * 3000, "a" + "ha" * 700, "haha " * 400, train["zz"], train["zz"][17:] * 3, "aha" * 555, sentence(rng, "yy", 300), "x"]
    for at_once in (1, 1 << 22):
        model = langid.build_model(train)
        assert len(list(langid.entropies(model, texts, at_once))) == len(texts)
    for ours, naive in parsed(model, train, texts):
        assert ours == naive


def test_memory_does_not_grow_with_the_alphabet():
    rng = random.Random(4)
    han = [chr(0x4E00 + k) for k in range(4000)]
    train = {"en": sentence(rng, "xx", 800), "zh": "".join(rng.choice(han) for _ in range(8000))}
    model = langid.build_model(train)
    assert len(model.alphabet) > 3000 and model.table.nbytes + 2 * model.rare_keys.nbytes < 20_000_000
    texts = [train["zh"][100:900] + sentence(rng, "xx", 40), "".join(rng.choice(han) for _ in range(500)), train["en"][5:700]]
    for ours, naive in parsed(model, train, texts):
        assert ours == naive


def test_held_out_accuracy_and_edges(spark):
    rng = random.Random(1)
    rows = [(100 + i, sentence(rng, lang, rng.randint(5, 60)).upper() if i % 5 == 0 else sentence(rng, lang, rng.randint(5, 60)), lang) for i, lang in enumerate(rng.choice(list(SYLLABLES)) for _ in range(200))]
    docs = documents(spark, rows + [(d, t, None) for d, t in EDGES])
    out = langid.identify(docs, train=F.col("doc_id") % 3 != 1).collect()
    truth = {d: lang for d, _, lang in rows}
    held = [r for r in out if r.doc_id in truth and r.doc_id % 3 == 1]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    by_id = {r.doc_id: r for r in out}
    assert all(by_id[d].lang_pred == "und" and by_id[d].score == 0 for d in (1, 2, 3, 8)) and all(0 <= r.score <= 1 for r in out)
    assert len(out) == docs.count()
    nothing = langid.identify(docs, train=F.lit(False)).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert langid.identify(empty(spark), train=F.lit(True)).count() == 0
    one = langid.identify(docs.where("lang = 'xx'"), train=F.lit(True)).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("xx", 1.0)}

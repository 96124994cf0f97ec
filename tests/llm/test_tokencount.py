import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shelfspark.llm import tokencount, tokens
from shelfspark.llm.tokencount import MergeTable, TokenCounter, surviving_symbols
from tests.llm.helpers import EDGES, documents, empty

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(BYTE)  # as it is opened: the strings of special tokens are special
    return lambda text: len(t.encode(text or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counter():
    return TokenCounter(BYTE)


def test_counts_equal_the_library(counter, library):
    rng = random.Random(13)
    letters = "ab AB'sé,.\n\t !?~|^²½ñ漢字　 ́ \x1c\x85​՘⃁\U00030000\U000323b00123\xa0᠎"
    words = ["<|endoftext|>", " ", "  ", "\n", "\r\n", "a", "don't", "'s", "xx", "aaaaaaa", "漢字", " the", "<|endoftext", "|>"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    texts += ["", None, "a" * 5000, "ab" * 3000, "x" * 20 + " " * 300 + "y", "".join(rng.choice("abcdefgh") for _ in range(20000))]
    assert counter.count(pa.array(texts)).tolist() == [library(t) for t in texts]


def test_long_texts_are_cut_where_tokens_end(counter, library, monkeypatch):
    monkeypatch.setattr(tokens, "BATCH_BYTES", 64)
    rng = random.Random(14)
    words = ["over", "don't", "\n", "  ", " ", ",", "漢字", "x1", "\xa0", "<|endoftext|>", "\x1c", " "]
    texts = ["".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randint(0, 150))) for _ in range(400)]
    assert counter.count(pa.array(texts)).tolist() == [library(t) for t in texts]


def one_by_one(symbols, table):
    """The vocabulary's order: the leftmost pair of lowest rank, one merge at a time."""
    symbols = list(symbols)
    while len(symbols) > 1:
        ranks = table.ranks(np.array(symbols[:-1]), np.array(symbols[1:])).tolist()
        at = int(np.argmin(ranks))
        if ranks[at] >= tokencount.NONE:
            break
        symbols[at : at + 2] = [int(table.made[ranks[at]])]
    return len(symbols)


def test_all_sequences_merge_as_each_alone(counter):
    rng, table = random.Random(15), counter.table
    for _ in range(20):
        rows = [[int(table.bytes[ord(rng.choice("aaethin "))]) for _ in range(rng.choice([0, 1, 2, 3, 9, 40]))] for _ in range(30)]
        flat = np.array([s for r in rows for s in r], np.int64)
        assert surviving_symbols(flat, np.array([len(r) for r in rows]), table).tolist() == [one_by_one(r, table) for r in rows]
    assert surviving_symbols(np.zeros(0, np.int64), np.zeros(0, np.int64), table).tolist() == []


def test_files_of_other_kinds_are_refused(tmp_path):
    with pytest.raises(ValueError):
        MergeTable(WORD)
    with open(BYTE, encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    (tmp_path / "reversed.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        MergeTable(str(tmp_path / "reversed.json"))


def test_edge_rows(spark, library):
    out = tokencount.token_counts(documents(spark, EDGES), BYTE, limit=5)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in out.collect())
    assert got == sorted((d or -1, len((t or "").encode()), n := library(t), n > 5) for d, t in EDGES)
    assert tokencount.token_counts(empty(spark), BYTE).count() == 0


def test_query_on_whole_table(spark, library):
    from shelfspark.llm.queries import QUERIES

    out = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op13_token_counts"](spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert out == {r.doc_id: (len((r.text or "").encode()), n := library(r.text), n > 1024) for r in rows}

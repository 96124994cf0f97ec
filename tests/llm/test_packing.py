import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer, models

from shelfspark.llm import packing, tokens
from shelfspark.llm.tokens import ChunkEncoder
from tests.llm.helpers import EDGES, documents, empty

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def plain(path):
    t = Tokenizer.from_file(path)  # as it is opened: the strings of special tokens are special
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_chunk_encoder_is_exact(path, monkeypatch):
    rng, own = random.Random(5), plain(path)
    alphabet = "ab AB'sé,.\n\t !?~|^²½ñ漢字 ́  \x1c0123<|endoftext|>"
    words = ["<|endoftext|>", "<|startoftext|>", "<|endoftext", " ", "  ", "\n", "a", "don't", "'s", "漢字", " the", "END.", "~", " | "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(1500)] + ["don't stop. Don't", "x" * 3000, " ~ ~ | ", None, "it ends <|endoftext|> here"]
    monkeypatch.setattr(tokens, "BATCH_BYTES", 500)
    encoder = ChunkEncoder(path, memo_chunks=500)
    assert encoder.in_chunks
    assert [ids.tolist() for ids in encoder.encode(pa.array(texts))] == [own(t) for t in texts]


def test_long_texts_in_parts_and_files_that_join_words(monkeypatch, tmp_path):
    monkeypatch.setattr(tokens, "BATCH_BYTES", 40)
    rng, own = random.Random(6), plain(BYTE)
    texts = ["".join(rng.choice(["over ", "don't", "\n", "  ", ", ", "漢字 ", "\xa0", "<|endoftext|>"]) for _ in range(rng.randint(0, 100))) for _ in range(200)]
    assert [ids.tolist() for ids in ChunkEncoder(BYTE).encode(pa.array(texts))] == [own(t) for t in texts]
    joined = Tokenizer(models.BPE({c: n for n, c in enumerate(["a", "b", " ", "a "])}, [("a", " ")]))  # a merge across a space
    joined.save(str(tmp_path / "joined.json"))
    encoder, own = ChunkEncoder(str(tmp_path / "joined.json")), plain(str(tmp_path / "joined.json"))
    assert not encoder.in_chunks
    assert [ids.tolist() for ids in encoder.encode(pa.array(["a b a", None, " aa b"]))] == [own(t) for t in ("a b a", None, " aa b")]


@pytest.mark.parametrize("seed", range(40))
def test_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 7, 8, 100, 2048])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 80))]
    bins, offsets = packing.best_fit_decreasing(lengths, capacity)
    rooms = []  # brute force: scan all open bins for the tightest
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        room = min(fits) if fits else capacity
        if fits:
            rooms.remove(room)
        rooms.append(room - length)
    assert len(set(bins.tolist())) == len(rooms)
    content = defaultdict(list)
    for length, b, o in zip(lengths, bins.tolist(), offsets.tolist()):
        content[b].append((o, length))
    assert sorted(capacity - sum(n for _, n in c) for c in content.values()) == sorted(rooms)
    for c in content.values():
        assert [o for o, _ in sorted(c)] == np.cumsum([0] + [n for _, n in sorted(c)])[:-1].tolist()


def check(rows, out, path, capacity):
    own, pieces, sequences = plain(path), [], defaultdict(list)
    for d, t, *_ in rows:
        ids = own(t) + [0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            pieces.append((d if d is not None else -1, k, a, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())))
    got = [(r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.length, r.ids_crc32) for r in out]
    assert sorted(got) == sorted(pieces)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        assert [o for o, _ in sorted(s)] == np.cumsum([0] + [n for _, n in sorted(s)])[:-1].tolist() and sum(n for _, n in s) <= capacity
    return len(sequences), sum(p[3] for p in pieces)


def test_edge_rows(spark):
    docs = documents(spark, EDGES)
    n, tokens = check(EDGES, packing.pack_documents(docs, WORD, capacity=64).collect(), WORD, 64)
    assert n <= tokens // 64 + 2
    check(EDGES, packing.pack_documents(docs, WORD, capacity=64, group_pieces=2).collect(), WORD, 64)
    assert packing.pack_documents(empty(spark), WORD).count() == 0
    ids = {(r.doc_id, r.piece): r.ids for r in packing.pack_documents(docs, WORD, 64, with_ids=True).collect()}
    assert np.frombuffer(ids[(4, 0)], "<u4").tolist() == plain(WORD)("x") + [0]


def test_query_on_whole_table(spark):
    from shelfspark.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    n, tokens = check(rows, QUERIES["op2_best_fit_packing"](spark, "/root/testdata/sf0.001").collect(), WORD, 2048)
    assert n <= -(-tokens // 2048) + 1

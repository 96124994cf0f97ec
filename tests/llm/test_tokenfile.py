import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfspark.llm import tokenfile
from shelfspark.session import ensure_checkpoint_dir
from tests.llm.helpers import EDGES, documents, empty

BYTE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1000])
@pytest.mark.parametrize("top", [0, 5, 10**6, 2**45])
def test_elias_fano(n, top):
    rng = random.Random(n + top)
    values = np.sort(np.array([rng.randint(0, top) for _ in range(n)], np.uint64))
    head, raw = tokenfile.elias_fano(values)
    stored = tokenfile.EliasFano(raw, *head)
    for _ in range(8):
        a = rng.randint(0, n)
        b = rng.randint(a, n)
        assert (stored.values(a, b) == values[a:b]).all()
    if n == 1000 and top == 10**6:
        assert 8 * len(raw) < n * (3 + np.log2(top / n)) + 32 * (n // tokenfile.SAMPLE + 1) + 64


def expected(rows):
    t = Tokenizer.from_file(BYTE)
    out, start = [], 0
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((d, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip(spark):
    rows = EDGES + [(-5, "negative"), (2**62, "far away")] + [(1000 + i, f"text number {i}") for i in range(600)] + [(3000, "it ends <|endoftext|> here"), (3001, "<|endoftext|>")]
    folder = f"{ensure_checkpoint_dir(spark)}/token-test-{random.random()}"
    files = tokenfile.write_token_files(documents(spark, rows), folder, BYTE, files=3)
    got = [tuple(r) for r in tokenfile.read_token_files(files, folder).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(rows)
    wide = tokenfile.write_token_files(documents(spark, rows), folder + "-wide", BYTE, files=2, id_bytes=4)
    assert sorted(tuple(r) for r in tokenfile.read_token_files(wide, folder + "-wide").where("doc_id is not null").collect()) == sorted(r for r in got if r[0] is not None)
    none = tokenfile.write_token_files(empty(spark), folder + "-none", BYTE)
    assert none.count() == 0 and tokenfile.read_token_files(none, folder + "-none").count() == 0


def test_ids_that_do_not_fit_are_refused():
    import io

    writer = tokenfile.TokenFileWriter(io.BytesIO(), 2)
    writer.add(1, np.array([65535], "<u4"))
    with pytest.raises(ValueError):
        writer.add(2, np.array([65536], "<u4"))


def test_query_on_whole_table(spark):
    from shelfspark.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op10_token_id_output"](spark, "/root/testdata/sf0.001").collect()), key=lambda r: r[1])
    assert got == expected(rows)

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfspark.llm import suffix_dedup
from tests.llm.helpers import EDGES, documents, empty


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        cover = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                cover[i : i + length] = True
        kept = bytes(b for b, c in zip(d, cover) if not c)
        out.append((len(d), int(cover.sum()), int((np.diff(cover.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", range(30))
def test_deep_shallow_sort(seed):
    rng = random.Random(seed)
    length = rng.choice([8, 16, 40, 200])
    data = bytes(rng.choice(b"ab") if rng.random() < 0.05 else 97 for _ in range(rng.randint(length, 1200)))
    data = data + data[:300] + bytes(rng.choice(b"abcd") for _ in range(100)) + data
    starts = np.sort(np.array(rng.sample(range(len(data) - length + 1), min(400, len(data) - length + 1))))
    seen = Counter(data[p : p + length] for p in starts.tolist())
    assert suffix_dedup.repeated_suffixes(data, starts, length).tolist() == [seen[data[p : p + length]] > 1 for p in starts.tolist()]


@pytest.mark.parametrize("seed", range(40))
def test_order_of_suffixes(seed):
    """Neighbours in the order are as in Python's own sort; small and large inputs, with and without equal ones."""
    rng = random.Random(seed)
    length, letters = rng.choice([40, 60, 200]), rng.choice([b"ab", b"abcdefghijklmnop", bytes(range(256))])
    part = bytes(rng.choice(letters) for _ in range(rng.randint(length, 500)))
    data = b"".join(part[: rng.randint(0, len(part))] + bytes(rng.choice(letters) for _ in range(rng.randint(0, 90))) for _ in range(rng.randint(1, 8))) + part
    starts = np.array(rng.sample(range(len(data) - length + 1), rng.randint(0, len(data) - length + 1)), np.int64)
    order, equal = suffix_dedup.sorted_suffixes(data, starts, length)
    strings = [data[p : p + length] for p in starts[order].tolist()]
    assert sorted(order.tolist()) == list(range(len(starts))) and strings == sorted(strings)
    assert equal.tolist() == [n > 0 and strings[n] == strings[n - 1] for n in range(len(strings))]


def test_all_told_apart_before_the_shallow_depth():
    data = bytes(range(65, 91)) * 8 + b"0123456789" * 20
    assert suffix_dedup.repeated_suffixes(data, np.array([0, 200]), 200).tolist() == [False, False]
    assert suffix_dedup.repeated_suffixes(data, np.array([0]), 200).tolist() == [False]
    assert suffix_dedup.repeated_suffixes(data, np.zeros(0, np.int64), 200).tolist() == []


def test_many_small_flushes():
    """Contexts of a thousand small tables, as a task's last flush holds them."""
    rng = random.Random(11)
    letter = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)).encode()
    run = suffix_dedup._sorted_contexts(60)
    for _ in range(1000):
        shared, docs = letter(rng.randint(32, 90)), []
        for _ in range(rng.randint(1, 3)):
            docs.append(letter(rng.randint(0, 90)) + shared + letter(rng.randint(0, 90)))
        rows = [(n, n, int(f), 1, int(np.int64(np.uint64(a).view(np.int64))), d[f : f + c + 59]) for n, d in enumerate(docs) for a, _, f, c in zip(*suffix_dedup.contexts_of(d, 60))]
        rows.sort(key=lambda r: r[4])
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["k1", "k2", "first", "times", "anchor", "bytes"])
        windows = {n: set() for n in range(len(docs))}
        for out in run(iter([batch])):
            for r in out.to_pylist():
                windows[r["k1"]] |= set(range(r["first"], r["last"]))
        seen = Counter(d[i : i + 60] for d in docs for i in range(len(d) - 59))
        assert windows == {n: {i for i in range(len(d) - 59) if seen[d[i : i + 60]] > 1} for n, d in enumerate(docs)}


@pytest.mark.parametrize("seed", range(3))
def test_small_tables(spark, seed):
    rng = random.Random(100 + seed)
    letter = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    shared = letter(rng.randint(32, 60))
    rows = [(n, letter(rng.randint(0, 250)) + shared + letter(rng.randint(0, 250))) for n in range(2)]
    out = suffix_dedup.remove_repeats(documents(spark, rows), length=(200, 50, 40)[seed]).collect()
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out)
    assert got == sorted((d, *w) for (d, _), w in zip(rows, brute([t for _, t in rows], (200, 50, 40)[seed])))


@pytest.mark.parametrize("anchor_contexts", [4096, 1])
def test_matches_brute_force(spark, anchor_contexts):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = text(40), text(12)
    rows = [(i, t) for i, t in EDGES]
    rows += [(100 + i, text(30) + passage[: rng.randint(50, len(passage))] + text(30)) for i in range(15)]
    rows += [(200 + i, text(10) + line + text(rng.randint(0, 8)) + passage) for i in range(10)]
    rows += [(300, "ab" * 400), (301, "é" * 150), (302, passage + "x" + passage), (303, text(200)), (304, rows[-1][1][:-1] + "?")]
    out = suffix_dedup.remove_repeats(documents(spark, rows), length=60, anchor_contexts=anchor_contexts).collect()
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out)
    assert got == sorted((d or -1, *w) for (d, _), w in zip(rows, brute([t for _, t in rows], 60)))
    for r in out:
        assert sum(s.last - s.first for s in r.spans or []) == r.n_removed


def test_long_documents_in_blocks(spark, monkeypatch):
    rng = random.Random(9)
    data = "".join(rng.choice("abcdefghij ") for _ in range(5000))
    whole = suffix_dedup.contexts_of(data.encode(), 200)
    assert whole[3].sum() == 4801
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1 << 10)
    cut = suffix_dedup.contexts_of(data.encode(), 200)
    assert cut[3].sum() == 4801 and (np.diff(cut[2]) > 0).all()


def test_empty_table_and_query(spark):
    from shelfspark.llm.queries import QUERIES

    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: w for r, w in zip(rows, brute([r.text for r in rows], 200))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op3_suffix_dedup"](spark, "/root/testdata/sf0.001").collect()}
    assert got == want

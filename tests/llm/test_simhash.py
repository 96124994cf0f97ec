import random

import numpy as np
import pytest
import xxhash

from shelfspark.llm import simhash
from shelfspark.llm.components import connected_components
from tests.llm.helpers import EDGES, documents, empty


def brute_fingerprint(text):
    words = [w for w in bytes((text or ""), "utf8").lower().split()]
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, tau):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= tau:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", ["", "one", "one two", "one two three", "One TWO three\tfour\nfive " * 30, "é İ ẞ x y z"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode(), 3) == brute_fingerprint(text)


@pytest.mark.parametrize("n,tau", [(10, 2), (10**6, 2), (10**9, 2), (10**10, 3), (1000, 0), (1000, 5)])
def test_thresholds_keep_the_pigeonhole_sum(n, tau):
    joint = np.full((64, 64), n / 4)
    np.fill_diagonal(joint, n / 2)
    groups = simhash.plan_groups(n, joint, tau)
    left_out = [m for m in range(1, 5) if sum(t for _, t in groups) - (m - len(groups)) == tau - m + 1]
    assert left_out and all(t >= 0 for _, t in groups)
    assert sum(mask for mask, _ in groups).bit_count() == sum(mask.bit_count() for mask, _ in groups)


@pytest.mark.parametrize("tau,bucket_rows", [(0, 2048), (1, 2048), (2, 2048), (2, 1), (3, 2)])
def test_components_match_brute_force(spark, tau, bucket_rows):
    rng = random.Random(tau)
    fps = {0}
    for _ in range(12):  # clusters of strings a few flips apart
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(12)}
    fps = sorted(fps)
    rows = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    found = {r.node: r.root for r in connected_components(simhash.similar_edges(rows, tau, bucket_rows)).collect()}
    own = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = brute_components(fps, tau)
    groups = {}
    for f, w in zip(own, want):
        groups.setdefault(w, set()).add(found.get(f, f))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_chain_is_one_component(spark):
    rows = [(i, i + 1) for i in range(300)] + [(1000, 1001), (7, 7)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(rows, "src long, dst long")).collect()}
    assert {found[i] for i in range(301)} == {0} and found[1001] == found[1000] == 1000


def test_edge_rows(spark):
    rows = EDGES + [(20, "ONE two three four five six"), (21, "one TWO three four five six"), (22, "A Kelvin K stays")]
    out = simhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.fp) for r in out) == sorted((d or -1, f - (1 << 64) if (f := brute_fingerprint(t)) >> 63 else f) for d, t in rows)
    by_id = {r.doc_id: r.component_id for r in out}
    assert by_id[1] == by_id[2] == by_id[3] == 1 and by_id[21] == 20 and by_id[None] is None


def test_one_of_each(spark):
    docs = documents(spark, EDGES + [(20, "ONE two three four five six"), (21, "one TWO three four five six")])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=lambda d: d or -1) == [None, 1, 4, 5, 7, 8, 9, 20]
    assert simhash.one_of_each(empty(spark)).count() == 0 and simhash.near_duplicates(empty(spark)).count() == 0


def test_query_on_whole_table(spark):
    from shelfspark.llm.queries import QUERIES

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    fps = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    ids = sorted(fps)
    roots = brute_components([fps[d] for d in ids], 2)
    want = {d: (f"{fps[d]:016x}", ids[r]) for d, r in zip(ids, roots)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash_near_dedup"](spark, "/root/testdata/sf0.001").collect()}
    assert got == want

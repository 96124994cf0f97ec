import random

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from shelfspark.llm import topk
from shelfspark.llm.queries import QUERIES, SQL
from tests.llm.helpers import EDGES, documents, empty


def oracle(table, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    return con.sql(SQL["op8_exact_top_k"]).fetchall()


@pytest.mark.parametrize("seed", range(25))
def test_block_max_wand_is_exact(seed):
    """A shard's walk gives the best of all scores, whatever is known before, and reads less than all blocks."""
    rng = random.Random(seed)
    n_terms, n_docs = rng.randint(1, 6), rng.choice([1, 100, 900, 5000])
    rows = sorted((t, d) for t in range(n_terms) for d in rng.sample(range(n_docs), rng.randint(0, n_docs)))
    scores = np.array([round(rng.choice([0.5, 1.0, rng.random() * 3]) * (1 + 3 * (d < 50)), 3) for _, d in rows])
    term, doc = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
    shard = topk.Shard(doc, scores, term, n_terms, n_docs)
    asked = np.array(sorted(rng.sample(range(n_terms), rng.randint(1, n_terms))))
    total = {}
    for t, d, s in zip(term.tolist(), doc.tolist(), scores.tolist()):
        if t in asked:
            total[d] = total.get(d, 0) + s
    want = sorted(((round(s, 6), d) for d, s in total.items()), key=lambda x: (-x[0], x[1]))[:10]
    found, least, walk = [], 0.0, shard.best(asked, 0.0, 10)
    try:
        docs, values = next(walk)
        while True:
            found = sorted(found + list(zip(values.tolist(), docs.tolist())), key=lambda x: (-x[0], x[1]))[:10]
            docs, values = walk.send(found[-1][0] if len(found) == 10 else 0.0)
    except StopIteration:
        pass
    assert found == [(pytest.approx(s, abs=1.1e-6), d) for s, d in want]


@pytest.mark.parametrize("seed", range(12))
def test_queries_scored_together_match_the_walk(seed, monkeypatch):
    """Bits of the scores and documents are those of each query's own walk, by products, postings or both."""
    monkeypatch.setattr(topk, "PRODUCT_SHARE", [0.0, 0.2, 2.0][seed % 3])
    monkeypatch.setattr(topk, "POSTINGS_AT_ONCE", [40, 2_000_000][seed % 2])
    rng = random.Random(seed)
    n_terms, n_docs, k = rng.randint(2, 40), rng.choice([3, 150, 900]), rng.choice([1, 4, 10])
    rows = sorted((t, d) for t in range(n_terms) for d in rng.sample(range(n_docs), rng.randint(0, n_docs) // rng.choice([1, 10])))
    scores = np.array([rng.choice([0.5, 1.0, rng.random() * 3]) for _ in rows])
    term, doc = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
    shard = topk.Shard(doc, scores, term, n_terms, n_docs)
    asked = [np.array(sorted(rng.sample(range(n_terms), rng.randint(1, n_terms)))) for _ in range(9)]
    least = np.array([rng.choice([0.0, 0.0, 1.0, 5.0]) for _ in asked])
    found = list(zip(*(c.tolist() for c in shard.best_of_all(np.concatenate(asked), np.array([len(a) for a in asked]), least, k))))
    for q, terms in enumerate(asked):
        want = [(-s, d) for part in shard.best(terms, least[q], k) for d, s in zip(*(c.tolist() for c in part))]
        assert sorted((-s, d) for n, d, s in found if n == q)[:k] == sorted(want)[:k]


def test_long_queries_read_no_posting_list_a_query(monkeypatch):
    """Queries of hundreds of common words don't walk the lists one query at a time."""
    rng = np.random.default_rng(1)
    pairs = np.flatnonzero(rng.random(300 * 2000) < 0.2)
    shard = topk.Shard(pairs % 2000, rng.random(len(pairs)) + 0.1, pairs // 2000, 300, 2000)
    monkeypatch.setattr(topk.Shard, "best", lambda *a: pytest.fail("walked alone"))
    kept = tuple(np.zeros(0, t) for t in (int, float, bool, int))
    query, _, _ = topk._best_of_group(shard, np.tile(np.arange(300), 5), np.repeat(np.arange(5), 300), 5, kept, 10)
    assert (np.bincount(query, minlength=5) >= 10).all() and len(query) < 5 * 50


def test_blocks_below_the_threshold_are_not_read():
    doc = np.arange(10_000)
    shard = topk.Shard(doc, np.where(doc < 20, 9.0, 1.0), np.zeros(10_000, np.int64), 1, 10_000)
    walk = shard.best(np.array([0]), 5.0, 10)
    docs, _ = next(walk)
    assert docs.tolist() == list(range(20))
    with pytest.raises(StopIteration):
        walk.send(9.0)


@pytest.mark.parametrize("shard_docs,at_once", [(8192, 500_000), (7, 40)])
def test_matches_sql(spark, shard_docs, at_once, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_TERMS_AT_ONCE", at_once)
    monkeypatch.setattr(topk, "BLOCK_DOCS", 3 if shard_docs == 7 else 128)
    rng = random.Random(2)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 4))) for _ in range(80)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))) for i in range(20, 160)]
    rows += [(d, t) for d, t in EDGES if d is not None] + [(i, rows[20][1]) for i in range(200, 230)]
    docs = documents(spark, rows)
    got = topk.search(docs, docs.where("doc_id % 20 = 0"), shard_docs=shard_docs)
    assert sorted(tuple(r) for r in got.collect()) == sorted(oracle("documents", rows))


def test_query_and_empty(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = QUERIES["op8_exact_top_k"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(tuple(r) for r in got) == sorted(oracle("documents", rows))
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") not in ("", "-1")  # index rows are large
    none = empty(spark)
    assert topk.search(none, none).count() == 0 and topk.search(documents(spark, EDGES), none).count() == 0


def test_a_search_holds_one_shard_at_a_time(spark, monkeypatch):
    seen, plain = spark.sparkContext.accumulator(0), topk._searcher

    def watched(*args):
        run, shared = plain(*args)

        def counted(batches):
            def one(batch):
                seen.add(batch.num_rows > 1)
                return batch

            yield from run(map(one, batches))

        return counted, shared

    monkeypatch.setattr(topk, "_searcher", watched)
    before = spark.conf.get(topk.BATCH_ROWS)
    docs = spark.range(60).selectExpr("id AS doc_id", "concat('w', id % 7, ' all') AS text").coalesce(1)
    found = topk.search(docs, docs.where("doc_id < 3"), k=2, shard_docs=10)
    assert found.count() == 6 and seen.value == 0 and spark.conf.get(topk.BATCH_ROWS) == before


def test_each_shard_is_a_row_group(spark):
    words = [f"w{i}" for i in range(4000)]
    docs = spark.createDataFrame([(i, " ".join(words[i : i + 2000])) for i in range(1200)], "doc_id long, text string").coalesce(1)
    index = topk.build_index(docs, shard_docs=100)
    groups = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in index.inputFiles()]
    sizes = [m.row_group(k).num_rows for m in groups for k in range(m.num_row_groups)]
    assert sum(sizes) == index.count() == 12 and max(sizes) <= 2

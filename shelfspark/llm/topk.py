"""Exact top-k search: BM25 over an inverted index in shards, with block-max WAND.

*Index.*  Each task cuts its documents into shards of at most ``shard_docs`` and inverts them: one row for each shard with its
documents' ids and lengths, its terms in order, and their postings (numbers and term counts).  The index is written once.

*Global statistics.*  Number of documents, mean length and document frequencies are aggregates over all shards, so a
document's score is the same in whichever shard it lies, and the tasks' best lists merge exactly.

*Search.*  Queries go over all shards in blocks of bounded size.  Posting lists are cut into blocks at the same documents
(``BLOCK_DOCS`` numbers each), and the largest score of each list's block is kept.  A query's weak AND is taken block by
block: only where the block maxima of its terms together can pass the k-th best score so far are the postings read at all,
blocks with the largest bounds first, so that the k-th best rises early.  Long queries leave most blocks open; those are
scored together, terms that many of them and many documents have by a matrix product in single precision, the others by
their postings, and each document that its score and the product's largest error leave open is scored again from its own
postings in double precision.  The k best go on from shard to shard within a task; a task returns k rows a query however
many shards it reads, and tasks' lists are merged by a window."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import text_rows
from shelfspark.session import cut_lineage

WORD = re.compile(r"[^\W_]+")
BLOCK_DOCS = 128
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Scores are compared after rounding to this many decimals; equal scores go to the smaller id.
DECIMALS = 6
#: (query, term) rows that are searched at a time.
QUERY_TERMS_AT_ONCE = 500_000
SHARD_WORDS = 2_000_000
#: Queries, and their terms, whose scores over a shard are held at a time.
BATCH_QUERIES, BATCH_TERMS = 128, 50_000
#: A query with a larger share of open blocks is scored in a batch.
OPEN_SHARE = 0.125
#: A term goes into the matrix product if more than this share of the batch's (query, document) pairs have it; at most so many do.
PRODUCT_SHARE, PRODUCT_TERMS = 0.002, 1024
POSTINGS_AT_ONCE = 200_000
#: Each shard is a row group of its own.  The writer holds 100 rows before it looks at their bytes, and the reader a whole row group.
ROW_GROUPS = {"parquet.block.size": 1 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1}
INDEX = "shard long, ids array<long>, lengths array<int>, terms array<string>, df array<int>, docs array<int>, counts array<int>"


def terms_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _inverted(shard: int, rows: list[tuple], vocabulary: dict[str, int]) -> pa.RecordBatch:
    """The index row of one shard; ``rows``: (id, words as numbers of ``vocabulary``)."""
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    n, lengths = len(rows), np.array([len(w) for _, w in rows], np.int64)
    names = sorted(vocabulary)
    place = np.empty(len(names), np.int64)
    place[[vocabulary[t] for t in names]] = np.arange(len(names))
    words = place[np.concatenate([w for _, w in rows])] if len(names) else np.zeros(0, np.int64)
    pair, counts = np.unique(words * n + np.repeat(np.arange(n), lengths), return_counts=True)
    df = np.bincount(pair // n, minlength=len(names))
    cells = [[shard], [[d for d, _ in rows]], [lengths], [names], [df], [pair % n], [counts]]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string()), *[pa.list_(pa.int32())] * 3]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, kinds)], [c.split()[0] for c in INDEX.split(", ")])


def build_index(docs: DataFrame, shard_docs: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index rows.  A shard ends after ``shard_docs`` documents or ``SHARD_WORDS`` words.  Its number holds the task's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        numbers, base = count(), TaskContext.get().partitionId() << 24
        rows, vocabulary, held = [], defaultdict(count().__next__), 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = terms_of(text)
                rows.append((doc_id, np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words))))
                held += len(words)
                if len(rows) >= shard_docs or held >= SHARD_WORDS:
                    yield _inverted(base + next(numbers), rows, vocabulary)
                    rows, vocabulary, held = [], defaultdict(count().__next__), 0
        if rows:
            yield _inverted(base + next(numbers), rows, vocabulary)

    return cut_lineage(text_rows(docs, id_col, text_col).mapInArrow(run, INDEX), "index", **ROW_GROUPS)


def query_terms(queries: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``query_id``, ``term``: the distinct words of each query's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own = sorted(set(terms_of(text)))
                yield pa.RecordBatch.from_arrays([pa.array([query] * len(own), pa.int64()), pa.array(own, pa.string())], ["query_id", "term"])

    return text_rows(queries, id_col, text_col).mapInArrow(run, "query_id long, term string").distinct()


class Shard:
    """The postings of the wanted terms of one shard, with the largest score of each list's blocks."""

    def __init__(self, docs: np.ndarray, scores: np.ndarray, term: np.ndarray, n_terms: int, n_docs: int):
        self.docs, self.scores, self.term, self.n_terms, self.n_docs = docs, scores, term, n_terms, n_docs
        self.blocks = -(-n_docs // BLOCK_DOCS)
        key = term * self.blocks + docs // BLOCK_DOCS
        self.begin = np.searchsorted(key, np.arange(n_terms * self.blocks + 1)).astype(np.int32)
        full = np.flatnonzero(np.diff(self.begin))
        most = np.zeros(n_terms * self.blocks)
        most[full] = np.maximum.reduceat(scores, self.begin[full]) if len(full) else 0
        self.most = most.reshape(n_terms, self.blocks)

    @cached_property
    def by_document(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms and scores of each document's postings, in the order of the terms, and where each document's begin."""
        order = np.argsort(self.docs.astype(np.uint16) if self.n_docs < 65_536 else self.docs, kind="stable")
        return self.term[order], self.scores[order], np.append(0, np.cumsum(np.bincount(self.docs, minlength=self.n_docs)))

    @cached_property
    def present(self) -> np.ndarray:
        """Room for whether a query of a batch has a term; all False between batches."""
        return np.zeros(BATCH_QUERIES * self.n_terms, bool)

    def open_blocks(self, terms: np.ndarray, size: np.ndarray, least: np.ndarray) -> np.ndarray:
        """(query, block): whether the block's maxima can reach ``least``; ``size``: the terms of each query, none 0."""
        bound = np.add.reduceat(self.most[terms], np.cumsum(size) - size, axis=0) + 10.0**-DECIMALS
        return (bound >= least[:, None]) & (bound > 2 * 10.0**-DECIMALS)

    def best_of_all(self, terms: np.ndarray, size: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries (numbers), documents and rounded scores of at least ``least``, the ``k`` best of each query among them."""
        n, owner = len(size), np.repeat(np.arange(len(size)), size)
        first, last = self.begin[terms * self.blocks].astype(np.int64), self.begin[(terms + 1) * self.blocks].astype(np.int64)
        wanted = np.bincount(terms, minlength=self.n_terms) * np.diff(self.begin[:: self.blocks])
        common = np.flatnonzero(wanted > PRODUCT_SHARE * n * self.n_docs)
        common = common[np.argsort(-wanted[common], kind="stable")[:PRODUCT_TERMS]]
        column = np.full(self.n_terms, -1)
        column[common] = np.arange(len(common))
        asked, inside = np.zeros((n, len(common)), np.float32), column[terms] >= 0
        asked[owner[inside], column[terms[inside]]] = 1
        held = np.zeros((len(common), self.n_docs), np.float32)
        which, size_of = _ranges(self.begin[common * self.blocks].astype(np.int64), self.begin[(common + 1) * self.blocks].astype(np.int64))
        held[np.repeat(np.arange(len(common)), size_of), self.docs[which]] = self.scores[which]
        total = np.zeros(n * self.n_docs)
        owner_left, first, last = owner[~inside], first[~inside], last[~inside]
        for at, end in _pieces(last - first):
            which, size_of = _ranges(first[at:end], last[at:end])
            low, high = owner_left[at] * self.n_docs, (owner_left[end - 1] + 1) * self.n_docs  # entries are in the queries' order
            total[low:high] += np.bincount(np.repeat(owner_left[at:end] * self.n_docs - low, size_of) + self.docs[which], self.scores[which], high - low)
        total = total.reshape(n, self.n_docs)
        total += asked @ held
        # no score is negative, so a sum's error is at most its terms' number times that of one rounding
        slack, unit = (len(common) + 8) * 2.0**-23, 10.0**-DECIMALS
        limit = np.maximum((least - unit) / (1 + slack), 1e-30)
        chosen = total >= limit[:, None]
        many = np.flatnonzero(chosen.sum(axis=1) > 4 * k)
        if len(many) and self.n_docs > k:
            kth = np.partition(total[many], self.n_docs - k, axis=1)[:, self.n_docs - k]
            limit[many] = np.maximum(limit[many], (kth * (1 - slack) - 2 * unit) / (1 + slack))
            chosen[many] = total[many] >= limit[many][:, None]
        query, doc = np.nonzero(chosen)
        score = self._exact(query, doc, owner, terms)
        found = (score >= least[query]) & (score > 0)
        return query[found], doc[found], score[found]

    def _exact(self, query: np.ndarray, doc: np.ndarray, owner: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Rounded scores of pairs, summed in the order of the terms."""
        of, scores, begin = self.by_document
        marks, out = owner * self.n_terms + terms, np.zeros(len(query))
        self.present[marks] = True
        for at, end in _pieces(begin[doc + 1] - begin[doc]):
            which, size = _ranges(begin[doc[at:end]], begin[doc[at:end] + 1])
            hit = self.present[np.repeat(query[at:end] * self.n_terms, size) + of[which]]
            out[at:end] = np.bincount(np.repeat(np.arange(end - at), size)[hit], scores[which[hit]], end - at)
        self.present[marks] = False
        return np.round(out, DECIMALS)

    def best(self, terms: np.ndarray, least: float, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Documents (numbers) and rounded scores of at least ``least``, which the caller may raise by ``send``."""
        bound = self.most[terms].sum(axis=0) + 10.0**-DECIMALS
        order, at, step = np.argsort(-bound, kind="stable"), 0, 2
        while at < len(order):
            chosen = order[at : at + step]
            chosen = chosen[(bound[chosen] >= least) & (bound[chosen] > 2 * 10.0**-DECIMALS)]
            if not len(chosen):
                return
            at, step = at + step, step * 4
            cell = (terms[:, None] * self.blocks + chosen).ravel()
            begin, size = self.begin[cell].astype(np.int64), (self.begin[cell + 1] - self.begin[cell]).astype(np.int64)
            which = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
            score = np.round(np.bincount(self.docs[which], self.scores[which], self.n_docs), DECIMALS)
            found = np.flatnonzero((score >= least) & (score > 0))
            least = (yield found, score[found]) or least


def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after another, and the ranges' sizes."""
    size = end - begin
    return np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size), size


def _pieces(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of entries with about ``POSTINGS_AT_ONCE`` postings together, one entry at least."""
    ends, at = np.cumsum(size), 0
    while at < len(size):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + POSTINGS_AT_ONCE, "right")))
        yield at, end
        at = end


def search(docs: DataFrame, queries: DataFrame, k: int = 10, k1: float = 1.2, b: float = 0.75, shard_docs: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``query_id``, ``rank``, ``doc_id``, ``score``: the ``k`` documents of ``docs`` with the largest BM25 scores for each row of
    ``queries``, all distinct words of whose whole text are the query, each once.

    Scores are rounded to 6 decimals, equal ones ranked by id (NULL last).  A query without a word that a document has, or
    NULL, finds nothing; NULL and empty documents count as documents without words; repeated rows are documents of their
    own; repeated query ids (and all NULL ids) are one query of all their words."""
    spark, index = docs.sparkSession, build_index(docs, shard_docs, id_col, text_col)
    total = index.agg(F.sum(F.size("ids")).alias("n"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("words")).first()
    n_docs, mean = total.n or 0, (total.words or 0) / max(total.n or 0, 1) or 1.0
    frequencies = index.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).groupBy("t.terms").agg(F.sum("t.df").alias("df"))
    asked = query_terms(queries, id_col, text_col).join(frequencies, F.col("term") == F.col("terms"))
    idf = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    asked = cut_lineage(asked.select("query_id", "term", idf.alias("idf"), F.xxhash64("query_id").alias("hash")), "asked")
    blocks = max(1, -(-asked.count() // QUERY_TERMS_AT_ONCE))
    tasks = max(1, spark.sparkContext.defaultParallelism)
    dealt = index.coalesce(tasks)  # a task reads several shards, so that what it returns doesn't grow with their number
    found = None
    for block in range(blocks):
        rows = asked.where(F.pmod("hash", F.lit(blocks)) == block).select("query_id", "term", "idf").toArrow()  # bounded by QUERY_TERMS_AT_ONCE on average
        run, shared = _searcher(spark, rows, k, k1, b, mean)
        with _rows_at_a_time(spark, 1):  # a shard's row has millions of numbers
            part = cut_lineage(dealt.mapInArrow(run, "query_id long, doc_id long, score double"), "found")
        shared.destroy()
        found = part if found is None else found.unionAll(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())  # at most k rows a task
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


@contextmanager
def _rows_at_a_time(spark, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows in jobs that run inside."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def _searcher(spark, rows: pa.Table, k: int, k1: float, b: float, mean: float):
    """The search of one block of queries over the shards of a task, and what it shares with all tasks."""
    rows = rows.combine_chunks().sort_by([("query_id", "ascending"), ("term", "ascending")])
    coded = rows.column("term").combine_chunks().dictionary_encode() if rows.num_rows else pa.array([], pa.string()).dictionary_encode()
    names = coded.dictionary
    weight = np.zeros(len(names))
    code = coded.indices.to_numpy().astype(np.int64)
    weight[code] = rows.column("idf").to_numpy()
    query, none = rows.column("query_id").fill_null(0).to_numpy(), rows.column("query_id").is_null().to_numpy(zero_copy_only=False) if rows.num_rows else np.zeros(0, bool)
    begin = np.flatnonzero(np.append(True, (query[1:] != query[:-1]) | (none[1:] != none[:-1]))) if rows.num_rows else np.zeros(0, np.int64)
    shared = spark.sparkContext.broadcast((names, weight, code, begin, [None if none[i] else int(query[i]) for i in begin]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weight, code, begin, query_ids = shared.value
        ends = np.append(begin[1:], len(code))
        ends_at = np.cumsum(ends - begin)
        groups, first = [], 0  # queries that go together
        while first < len(begin):
            end = int(np.searchsorted(ends_at, (ends_at[first - 1] if first else 0) + BATCH_TERMS, "right"))
            groups.append((first, max(first + 1, min(end, first + BATCH_QUERIES))))
            first = groups[-1][1]
        # a group's best so far: numbers of queries, scores, whether the id is NULL, ids, in this order
        kept = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in groups]
        for batch in (whole.slice(i, 1) for whole in batches for i in range(whole.num_rows)):
            ids, lengths, terms, df, docs, counts = (batch.column(c).flatten() for c in ("ids", "lengths", "terms", "df", "docs", "counts"))
            none, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            own = pc.index_in(terms, value_set=names).fill_null(-1).to_numpy().astype(np.int64)
            wanted = own >= 0
            local = np.full(len(names), -1)
            local[own[wanted]] = np.arange(wanted.sum())
            size = df.to_numpy()
            inside = np.repeat(wanted, size)
            doc, tf = docs.to_numpy()[inside].astype(np.int64), counts.to_numpy()[inside].astype(float)
            term = np.repeat(np.arange(wanted.sum()), size[wanted])
            score = np.repeat(weight[own[wanted]], size[wanted]) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths.to_numpy()[doc] / mean))
            shard = Shard(doc, score, term, int(wanted.sum()), len(ids))
            del terms, df, docs, counts, inside, doc, tf, term, score
            for n, (first, end) in enumerate(groups):
                at = local[code[begin[first] : ends[end - 1]]]
                owner = np.repeat(np.arange(end - first), ends[first:end] - begin[first:end])[at >= 0]
                at = at[at >= 0]
                if len(at):
                    query, doc, value = _best_of_group(shard, at, owner, end - first, kept[n], k)
                    kept[n] = _first_k(*(np.concatenate(c) for c in zip(kept[n], (query, value, none[doc], ids[doc]))), k)
            del shard, batch  # not held beside the next one
        out = [(query_ids[first + q], None if missing else i, s) for (first, _), best in zip(groups, kept) for q, s, missing, i in zip(*(c.tolist() for c in best))]
        for at in range(0, len(out), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[at : at + 50_000]), (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "doc_id", "score"])

    return run, shared


def _first_k(query: np.ndarray, score: np.ndarray, none: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` best rows of each query."""
    order = np.lexsort((ids, none, -score, query))
    query = query[order]
    best = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[best], *(c[order][best] for c in (score, none, ids))


def _best_of_group(shard: Shard, terms: np.ndarray, owner: np.ndarray, n: int, kept: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """Queries, documents and rounded scores of one shard that may be among the k best, given those ``kept``: queries that most
    blocks may serve are scored together, the others by their open blocks."""
    begin = np.searchsorted(kept[0], np.arange(n + 1))
    least = np.zeros(n)
    full = np.flatnonzero(np.diff(begin) == k)
    least[full] = kept[1][begin[full + 1] - 1]
    size = np.bincount(owner, minlength=n)
    asked = np.flatnonzero(size)
    share = shard.open_blocks(terms, size[asked], least[asked]).mean(axis=1)
    together, alone = asked[share > OPEN_SHARE], asked[(share > 0) & (share <= OPEN_SHARE)]
    found = []
    if len(together):
        inside = np.isin(owner, together)
        query, doc, value = shard.best_of_all(terms[inside], size[together], least[together], k)
        found.append((together[query], doc, value))
    start = np.cumsum(size) - size
    for q in alone.tolist():
        best, walk = kept[1][begin[q] : begin[q + 1]], shard.best(terms[start[q] : start[q] + size[q]], least[q], k)
        try:
            doc, value = next(walk)
            while True:
                found.append((np.full(len(doc), q), doc, value))
                best = -np.sort(-np.concatenate([best, value]))[:k]
                doc, value = walk.send(best[-1] if len(best) == k else 0.0)
        except StopIteration:
            pass
    return tuple(np.concatenate(c) for c in zip((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), *found))

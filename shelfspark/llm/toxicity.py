"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A document is a bag of sentences (runs without ``. ! ?`` or a line break, cut after ``SENTENCE_WORDS`` words).  A sentence
causes a toxic label with probability ``hit * sigmoid(bias + sum of the weights of its distinct words)``, and one without a
word of the model causes none; causes combine by noisy-or with a leak for labels that no sentence explains::

    P(toxic) = 1 - (1 - leak) * product over sentences of (1 - p)

Weights, bias and leak are fitted by the likelihood of the document labels alone; the same sentence probabilities then tell
which sentences offend."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import text_rows
from shelfspark.session import cut_lineage

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
SENTENCE_WORDS = 40
#: A toxic sentence leads to the label this often; the rest is label noise.
HIT = 0.95


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    bias: float
    leak: float


def sentences(text: str) -> Iterator[tuple[int, int, set[str]]]:
    """(start, end, distinct lower-cased words) of each instance of a text that has words."""
    for m in SENTENCE.finditer(text):
        words = WORD.findall(m[0].lower())
        if len(words) <= SENTENCE_WORDS:
            if words:
                yield m.start(), m.end(), set(words)
            continue
        spans = [w.span() for w in WORD.finditer(m[0])]
        for k in range(0, len(spans), SENTENCE_WORDS):
            part = spans[k : k + SENTENCE_WORDS]
            yield m.start() + part[0][0], m.start() + part[-1][1], {m[0][a:b].lower() for a, b in part}


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(bags: list[list[list[int]]], labels: np.ndarray, names: list[str], penalty: float = 0.02, steps: int = 300) -> ToxicityModel:
    """Full-batch Adam with an L1 proximal step on the negative log-likelihood; deterministic.  ``bags``: for each document
    the model words (numbers in ``names``) of each of its sentences that has any."""
    n = len(labels)
    if not n or labels.min() == labels.max():
        return ToxicityModel({}, 0.0, float(labels[0]) if n else 0.0)
    items, per_instance, doc_of = [], [], []
    for d, bag in enumerate(bags):
        for hits in bag:
            items += hits
            per_instance.append(len(hits))
            doc_of.append(d)
    items, per_instance, doc_of = np.array(items, np.int64), np.array(per_instance, np.int64), np.array(doc_of, np.int64)
    instance_of = np.repeat(np.arange(len(per_instance)), per_instance)
    theta = np.concatenate([np.zeros(len(names)), [-3.0, np.log(labels.mean() / (1 - labels.mean())) - 1]])  # weights, bias, logit of the leak
    m, v, rate = np.zeros_like(theta), np.zeros_like(theta), 0.1
    for t in range(1, steps + 1):
        z = theta[-2] + np.bincount(instance_of, theta[items], len(per_instance))
        s, leak = _sigmoid(z), _sigmoid(theta[-1])
        clean = np.bincount(doc_of, np.log1p(-HIT * s), n) + np.log1p(-leak)  # log P(no cause)
        p = np.maximum(-np.expm1(clean), 1e-9)
        pull = np.where(labels, -(1 - p) / p, 1.0)  # d loss / d log-odds mass of a cause
        g_instance = pull[doc_of] * HIT * s * (1 - s) / (1 - HIT * s)
        grad = np.concatenate([np.bincount(items, g_instance[instance_of], len(names)), [g_instance.sum(), pull.sum() * leak]]) / n
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w = theta[:-2]
        theta[:-2] = np.sign(w) * np.maximum(np.abs(w) - rate * penalty, 0)
    kept = {w: float(x) for w, x in zip(names, theta[:-2]) if abs(x) > 0.1}
    return ToxicityModel(kept, float(theta[-2]), float(_sigmoid(theta[-1])))


def score(model: ToxicityModel, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
    """Probability of a toxic label, and (start, end, probability) of each sentence that has a word of the model."""
    found, clean = [], 1 - model.leak
    known = model.weights.keys()
    if text and not known.isdisjoint(WORD.findall(text.lower())):
        for start, end, words in sentences(text):
            if hits := words & known:
                p = HIT * float(_sigmoid(np.float64(model.bias + sum(model.weights[w] for w in sorted(hits)))))
                clean *= 1 - p
                found.append((start, end, p))
    return min(1.0, max(0.0, 1 - clean)), found


def associated_words(sample: DataFrame, words: int, least_docs: int, least_ratio: float = 8.0) -> list[str]:
    """The words of ``sample`` (label, text) most associated with the label, by the log likelihood ratio of document counts;
    words below ``least_ratio`` could be chance among some thousand words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                own = sorted(set(WORD.findall(text.lower())))
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([label] * len(own), pa.int32())], ["word", "label"])

    total = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("k")).first()
    if not total.n or total.k in (0, total.n):
        return []
    n, k, base = F.col("n"), F.col("k"), total.k / total.n
    counts = sample.select("label", "text").mapInArrow(run, "word string, label int").groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("k")).where(n >= least_docs)
    ratio = F.when(k > 0, k * F.log(k / (n * base))).otherwise(0.0) + F.when(k < n, (n - k) * F.log((n - k) / (n * (1 - base)))).otherwise(0.0)
    return [r.word for r in counts.where(ratio >= least_ratio).orderBy(ratio.desc(), "word").limit(words).collect()]


def learn(docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", fit_rows: int = 8000, words: int = 2000, least_docs: int = 4) -> ToxicityModel:
    """Fits on at most ``fit_rows`` labelled documents with ``train`` true (an expression of ``doc_id``), those whose ids
    hash lowest.  What reaches the driver is the ``words`` words and the sample's sentences as numbers of such words.
    Conflicting labels of an id count as toxic, of several texts the smallest is taken; rows with NULL label, id or text are
    not learned from.  One class only, or no labels: the score is that class for all."""
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label")).where("doc_id is not null and label is not null").where(train)
    rows = text_rows(docs, id_col, text_col).where("text is not null")
    present = known.groupBy("doc_id").agg(F.max("label").alias("label")).join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    picked = present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    sample = cut_lineage(rows.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text")), "toxicity-sample")
    names = associated_words(sample, words, least_docs)
    number = {w: k for k, w in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [[sorted(number[w] for w in own & number.keys()) for *_, own in sentences(t) if not own.isdisjoint(number)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(bags, pa.list_(pa.list_(pa.int32())))], ["doc_id", "label", "bag"])

    table = sample.mapInArrow(run, "doc_id long, label int, bag array<array<int>>").toArrow().sort_by("doc_id")
    return fit(table.column("bag").to_pylist(), np.array(table.column("label").to_pylist(), np.int64), names)


def toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", offending: float = 0.3) -> DataFrame:
    """``doc_id``, ``score`` and ``sentences``, an array of (start, end, score) of the sentences of at least ``offending``
    (offsets in characters): one row for each row of ``docs``.  NULL and empty texts have the leak as score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            out = [score(model, t) for t in batch.column("text").to_pylist()]
            spans = [[{"start": a, "end": b, "score": p} for a, b, p in found if p >= offending] for _, found in out]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s for s, _ in out], pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "sentences"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, sentences array<struct<start:int,end:int,score:double>>")


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, all columns; no shuffle."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([score(model, t)[0] < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

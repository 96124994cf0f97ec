import random

from pyspark.sql import functions as F

from shelfspark.llm import toxicity
from shelfspark.llm.common import crc_fold
from tests.llm.helpers import EDGES, documents, empty

BAD = ["scoundrel", "rotter", "cad"]


def corpus(n=400):
    rng, rows, labels = random.Random(1), [], []
    words = ["".join(rng.choice("aeioubcdfg") for _ in range(5)) for _ in range(400)]
    for d in range(n):
        lines = [" ".join(rng.choice(words) for _ in range(8)) for _ in range(rng.randint(1, 12))]
        toxic = rng.random() < 0.25
        if toxic:
            at = rng.randrange(len(lines))
            lines[at] += f" {rng.choice(BAD)} {rng.choice(BAD)} you"
        rows.append((1000 + d, ". ".join(lines)))
        labels.append((1000 + d, int(toxic if rng.random() > 0.03 else not toxic)))
    return rows, labels


def test_learns_from_documents_and_locates_sentences(spark):
    rows, labels = corpus()
    docs, known = documents(spark, rows + EDGES), spark.createDataFrame(labels + [(1, 0), (None, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, known, crc_fold(F.col("doc_id"), 4) != 2)
    assert all(model.weights.get(w, 0) > 1 for w in BAD)
    out = toxicity.toxicity(docs, model).collect()
    assert len(out) == len(rows) + len(EDGES) and all(0 <= r.score <= 1 for r in out)
    truth = {d: any(w in t for w in BAD) for d, t in rows}
    held = [r for r in out if r.doc_id in truth and crc32(r.doc_id) % 4 == 2]
    assert sum((r.score >= 0.3) == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    texts = dict(rows)
    for r in out:
        for s in r.sentences:
            assert any(w in texts[r.doc_id][s.start : s.end] for w in BAD)
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.score < 0.3 for r in out)


def crc32(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode())


def test_one_class_and_empty_tables(spark):
    docs = documents(spark, EDGES)
    model = toxicity.learn(docs, spark.createDataFrame([(4, 1), (5, 1)], "doc_id long, toxic int"), F.lit(True))
    assert {r.score for r in toxicity.toxicity(docs, model).collect()} == {1.0}
    none = toxicity.learn(empty(spark), spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    assert {r.score for r in toxicity.toxicity(docs, none).collect()} == {0.0} and toxicity.toxicity(empty(spark), none).count() == 0


def test_long_sentences_are_cut_with_places():
    text = "w1 " * 0 + " ".join(f"word{chr(97 + k % 26)}" for k in range(100)) + "! short one"
    spans = list(toxicity.sentences(text))
    assert len(spans) == 4 and text[spans[-1][0] : spans[-1][1]].strip() == "short one"
    assert all(len(words) <= toxicity.SENTENCE_WORDS for *_, words in spans)

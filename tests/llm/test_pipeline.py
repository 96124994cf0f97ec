import corpus_pipeline
from pyspark.sql import functions as F

from shelfspark.llm.common import crc_fold
from shelfspark.llm.queries import QUERIES
from shelfspark.session import cut_lineage
from tests.llm.helpers import documents
from tests.llm.test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_on_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "best_fit_packing"]
    scored = {r.doc_id: r.predicted for r in QUERIES["op4_toxicity"](spark, SF).collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = cut_lineage(stage(spark, docs, SF), name)
        if name != "best_fit_packing":
            assert docs.columns == columns
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
        if name == "toxicity":
            assert set(kept[name]) == {d for d, p in scored.items() if not p}
        if name == "simhash_near_dedup":
            ids = sorted(kept["toxicity"])
            roots = brute_components([brute_fingerprint(kept["toxicity"][d]) for d in ids], 2)
            assert set(kept[name]) == {ids[r] for r in roots}
        if name == "benchmark_decontamination":
            bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            dirty = {d for d, t in kept["simhash_near_dedup"].items() if any(b in t for b in bench)}
            assert not dirty & set(kept[name]) and len(kept["simhash_near_dedup"]) - len(kept[name]) <= len(dirty) + 1
        if name == "secret_scans":
            assert set(kept[name]) == set(kept["benchmark_decontamination"]) and not any("AKIA" in t for t in kept[name].values())
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == set(kept["secret_scans"])
    run = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, docs.select(run.columns).collect()))


def test_folds(spark):
    import zlib

    rows = documents(spark, [(1, "a"), (123456789, "b"), (None, "c")]).select("doc_id", crc_fold(F.col("doc_id"), 4).alias("f")).collect()
    assert {r.doc_id: r.f for r in rows} == {1: zlib.crc32(b"1") % 4, 123456789: zlib.crc32(b"123456789") % 4, None: None}

"""The corpus pipeline: documents go through five operators in turn, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm import decontam, packing, secrets, simhash, toxicity
from shelfspark.llm.common import read_table
from shelfspark.llm.queries import TOXIC_FROM, toxicity_model
from shelfspark.session import cut_lineage


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the threshold."""
    return toxicity.without_toxic(docs, toxicity_model(spark, docs, sf_dir), TOXIC_FROM)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (3-word shingles, 2 bits), the one with the smallest id."""
    return simhash.one_of_each(docs, shingle=3, tau=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, re-parameterised or not."""
    return decontam.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the packed sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scans", secrets_stage),
    ("best_fit_packing", packing_stage),
]
#: Learned models, fingerprints and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

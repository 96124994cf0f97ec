"""The registered queries of this subpackage: ``opN_<name>`` applies operator N to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import clustering, conversations, decontam, langid, licenses, packing, secrets, simhash, suffix_dedup, tokencount, tokenfile, topk, toxicity
from shelfspark.llm.common import crc_fold, read_table
from shelfspark.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near copies (2 bits or fewer apart) of every document; texts without words have fingerprint 0."""
    out = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, tau=2)
    return out.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in sequences of 2,048 tokens; a NULL text is its end id alone."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the bytes of 200-byte strings that start elsewhere too; NULL is empty."""
    out = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), length=200)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


TOXIC_FROM = 0.3


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    """Learned from labelled rows outside fold 2 of 4."""
    return toxicity.learn(docs, read_table(spark, sf_dir, "labels"), crc_fold(F.col("doc_id"), 4) != 2)


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled ones outside fold 2 of 4; NULL and empty texts are scored too."""
    docs = read_table(spark, sf_dir, "documents")
    out = toxicity.toxicity(docs, toxicity_model(spark, docs, sf_dir))
    held_out = F.coalesce(crc_fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), F.size("sentences").alias("n_offending"))


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document; NULL is empty, without phrases the places are NULL."""
    return licenses.scan(read_table(spark, sf_dir, "documents")).drop("spans")


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept findings: ``word`` is the finding's place among the document's words, ``value_sha256`` its value's hash."""
    out = secrets.scan(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "word", F.length("value").alias("n_chars"), F.sha2("value", 256).alias("value_sha256"), "probability")


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside fold 1 of 3; NULL and texts without a letter are ``und``."""
    docs, fold = read_table(spark, sf_dir, "documents"), crc_fold(F.col("doc_id"), 3)
    out = langid.identify(docs, train=fold != 1)
    return out.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair whose passage the document holds, re-parameterised or not."""
    return decontam.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op10_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, number and checksum of every document's ids, read back from the written token files; NULL is empty."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    files = tokenfile.write_token_files(read_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenfile.read_token_files(files, folder)


@query
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector of 64 components after 5 rounds with 40 centroids, in integers."""
    return clustering.with_inertia(clustering.cluster_vectors(read_table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256, salt="2:"))


def clustering_sql(k: int, rounds: int, dims: int, scale: int, salt: str) -> str:
    """The same rounds in SQL, each vector compared with each centroid."""
    steps = [
        f"""kept AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings
    WHERE len(embedding) = {dims} AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
        f"part AS (SELECT r, i, CAST(floor({scale} * x) AS BIGINT) AS x FROM (SELECT r, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM kept))",
        f"first AS (SELECT r, row_number() OVER (ORDER BY sha256('{salt}' || CAST(vec_id AS VARCHAR)) NULLS LAST, vec) - 1 AS c FROM kept QUALIFY c < {k})",
        "c0 AS (SELECT c, i, x AS m FROM first JOIN part USING (r))",
    ]
    for n in range(rounds + 1):
        steps.append(f"d{n} AS (SELECT r, c, sum((x - m) * (x - m)) AS d FROM part JOIN c{n} USING (i) GROUP BY r, c)")
        steps.append(f"a{n} AS (SELECT r, c, d FROM d{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)")
        if n < rounds:
            steps.append(f"s{n} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM a{n} JOIN part USING (r) GROUP BY c, i)")
            steps.append(f"c{n + 1} AS (SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, m) AS m FROM c{n} LEFT JOIN s{n} USING (c, i))")
    shas = f"sha AS (SELECT c, sha256(string_agg(CAST(CAST(m AS BIGINT) AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)"
    steps = [s.replace(" AS (", " AS MATERIALIZED (", 1) for s in [*steps, shas]]
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
    CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN sha USING (c)"""


SQL["op11_centroid_clustering"] = clustering_sql(k=40, rounds=5, dims=64, scale=256, salt="2:")


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of every conversation after planted damage."""
    rows = read_table(spark, sf_dir, "conversations")
    return conversations.repair_report(rows, conversations.damage(rows))


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents under the byte-level vocabulary; over the limit are those of more than 1,024 tokens."""
    return tokencount.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


#: Query documents: ids divisible by this; results for each.
QUERY_EVERY, TOP = 20, 10


@query
def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents by BM25 for every document whose id is divisible by 20, all its words being the query."""
    docs = read_table(spark, sf_dir, "documents")
    return topk.search(docs, docs.where(F.col("doc_id") % QUERY_EVERY == 0), k=TOP)


SQL["op8_exact_top_k"] = f"""
WITH words AS (SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
size AS (SELECT count(*) AS n, sum(len(w)) / count(*) AS mean FROM words),
tf AS (SELECT place, doc_id, len(w) AS length, unnest(w) AS term FROM words),
counts AS (SELECT place, doc_id, length, term, count(*) AS tf FROM tf GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
asked AS (SELECT q.doc_id AS query_id, q.term, df.df FROM (SELECT DISTINCT doc_id, term FROM counts WHERE doc_id % {QUERY_EVERY} = 0) q JOIN df USING (term)),
scored AS (SELECT a.query_id, c.place, c.doc_id, round(sum(ln(1 + (size.n - a.df + 0.5) / (a.df + 0.5)) * c.tf * 2.2 / (c.tf + 1.2 * (0.25 + 0.75 * c.length / size.mean))), 6) AS score
    FROM asked a JOIN counts c USING (term), size GROUP BY a.query_id, c.place, c.doc_id)
SELECT query_id, rank, doc_id, score FROM (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id NULLS LAST, place) AS INTEGER) AS rank, doc_id, score FROM scored)
WHERE rank <= {TOP}"""

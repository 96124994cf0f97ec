"""SimHash near-duplicates by the generalised pigeonhole principle.

A document's fingerprint has bit ``b`` set when more than half of the 64-bit hashes of its word shingles have it set.
Two fingerprints are linked when they differ in at most ``tau`` bits.

If the 64 bits are cut into m groups with thresholds t_1..t_m that sum to ``tau - m + 1`` (each at least -1), two
fingerprints within ``tau`` bits agree within t_i bits on at least one group i: were they more than t_i apart on each
group, they would differ in at least sum(t_i + 1) = tau + 1 bits.  So it is enough to look up, for each group with
t_i >= 0, the values within t_i bits.

* *Grouping.*  The 64 x 64 table of joint bit counts over **all** distinct fingerprints is one aggregate.  Bits are
  chained by correlation and the chain is cut into groups, so that correlated bits share a group.
* *Thresholds.*  For m = 1..4 groups a dynamic programme over the groups spends the sum of thresholds where the sum of
  looked-up signatures and estimated candidates is least.  With few fingerprints three exact groups win; as their
  number grows the plan moves to fewer and wider groups, whose lookups cost more but meet fewer strangers.
* *Probing and verifying.*  Index and probe rows meet by (group, value).  A bucket of at most ``bucket_rows`` rows is
  verified in blocks by bit counts and reduced to one edge for each member, never to all pairs.
* *Large buckets* (copies with small edits may put a third of all fingerprints in one) are not verified pair by pair.
  Fingerprints within ``tau`` bits share a centre within floor(tau/2) bits of one and ceil(tau/2) of the other, so each
  member of a large bucket is sent to its centres and linked with the smallest of those nearest: exact as well, and
  linear in the members.  The switch changes the work, not the result.

Connected components then run on the edges.  Nothing but the 64 x 64 table reaches the driver."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import text_rows
from shelfspark.llm.components import connected_components
from shelfspark.session import cut_lineage

BITS = 64
#: Relative cost of one looked-up signature (a shuffled row) and one verified candidate (an xor).
SIGNATURE_COST, CANDIDATE_COST = 1.0, 0.02


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Unsigned fingerprint of UTF-8 ``text``: words are runs without ASCII white space, A-Z in lower case, shingles are
    space-joined runs of ``shingle`` words (fewer words: all of them), hashed with XXH64 (seed 42).  No word: 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)))) if len(words) > shingle else iter([b" ".join(words)])
    hashes, total, ones = (xxhash.xxh64_intdigest(g, 42) for g in grams), 0, np.zeros(BITS, np.int64)
    while len(block := np.fromiter(islice(hashes, 65536), np.dtype("<u8"))):
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(block)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``key`` (hash of the text), ``fp`` (the fingerprint as a signed long): one row for each row of ``docs``; a
    NULL, empty or blank text has 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column("text")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(fps.view(np.int64))], ["doc_id", "key", "fp"])

    rows = text_rows(docs, id_col, text_col, binary=True)
    return rows.select("doc_id", F.xxhash64("text").alias("key"), "text").mapInArrow(run, "doc_id long, key long, fp long")


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows of ``fps`` and the 64 x 64 counts of rows with both bits set (the only thing collected)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            x = _bits(batch.column(0).to_numpy()).astype(np.float64)
            both, n = both + x.T @ x, n + len(x)
        if n:
            i, j = np.triu_indices(BITS)
            cells = [i, j, both[i, j].astype(np.int64), np.full(len(i), n)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cells], ["i", "j", "c", "n"])

    rows = fps.select("fp").mapInArrow(run, "i long, j long, c long, n long").groupBy("i", "j").agg(F.sum("c").alias("c"), F.sum("n").alias("n")).collect()
    joint = np.zeros((BITS, BITS))
    for r in rows:
        joint[r.i, r.j] = joint[r.j, r.i] = r.c
    return (rows[0].n if rows else 0), joint


def _agreement(n: int, joint: np.ndarray) -> np.ndarray:
    """Chance that two random rows agree on bit i and on bit j (diagonal: on bit i)."""
    p11 = joint / max(n, 1)
    p = np.diag(p11)
    p10, p01 = p[:, None] - p11, p[None, :] - p11
    p00 = 1 - p[:, None] - p[None, :] + p11
    both = p11**2 + p10**2 + p01**2 + p00**2
    np.fill_diagonal(both, p**2 + (1 - p) ** 2)
    return both


def _chain(n: int, joint: np.ndarray) -> list[int]:
    """All bits, each followed by the unused bit that is most correlated with it."""
    p11 = joint / max(n, 1)
    p = np.diag(p11)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((p11 - np.outer(p, p)) / np.outer(spread, spread))
    order, left = [int(np.argmin(spread))], set(range(BITS))
    left.discard(order[0])
    while left:
        order.append(max(left, key=lambda b: (corr[order[-1], b], -b)))
        left.discard(order[-1])
    return order


def _within(group: list[int], agree: np.ndarray, tau: int) -> list[float]:
    """Estimated chance that two random rows differ in at most t bits of the group, for t = -1..tau: agreement along the
    chain for equal values, and its elementary symmetric sums over the bits for each further difference."""
    equal = agree[group[0], group[0]] * np.prod([agree[a, b] / agree[a, a] for a, b in zip(group, group[1:])])
    sums = [1.0] + [0.0] * max(tau, 0)
    for b in group:
        odds = (1 - agree[b, b]) / agree[b, b]
        for k in range(len(sums) - 1, 0, -1):
            sums[k] += sums[k - 1] * odds
    return [0.0] + [min(1.0, float(equal * s)) for s in np.cumsum(sums)]


def _signatures(width: int, t: int) -> int:
    out = term = 1 if t >= 0 else 0
    for k in range(1, t + 1):
        term = term * (width - k + 1) // k
        out += term
    return out


def plan_groups(n: int, joint: np.ndarray, tau: int, most_groups: int = 4) -> list[tuple[int, int]]:
    """(bit mask, threshold) of the groups to look up; groups with threshold -1 are left out."""
    agree, chain, best = _agreement(n, joint), _chain(n, joint), None
    for m in range(1, most_groups + 1):
        cuts = [BITS * k // m for k in range(m + 1)]
        groups = [chain[a:b] for a, b in zip(cuts, cuts[1:])]
        table = {0: (0.0, ())}  # sum of thresholds so far -> least cost and the thresholds
        for g in groups:
            chance = _within(g, agree, tau)
            cost = {t: SIGNATURE_COST * n * _signatures(len(g), t) + CANDIDATE_COST * n * n / 2 * chance[t + 1] for t in range(-1, tau + 1)}
            step: dict = {}
            for spent, (total, ts) in table.items():
                for t, c in cost.items():
                    if total + c < step.get(spent + t, (float("inf"),))[0]:
                        step[spent + t] = (total + c, (*ts, t))
            table = step
        total, ts = table[tau - m + 1]
        if best is None or total < best[0]:
            best = (total, [(sum(1 << b for b in g), t) for g, t in zip(groups, ts) if t >= 0])
    return best[1]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _flips(mask: int, most: int) -> list[int]:
    bits = [b for b in range(BITS) if mask >> b & 1]
    return [_signed(sum(1 << b for b in c)) for k in range(most + 1) for c in combinations(bits, k)]


def _neighbours(fps: DataFrame, flips: list[int], key: str) -> DataFrame:
    return fps.withColumn(key, F.explode(F.array(*[F.lit(f).cast("long") for f in flips]))).withColumn(key, F.col("fp").bitwiseXOR(F.col(key)))


def _bucket_edges(tau: int):
    """Each bucket's members that are linked, as edges to the smallest member of their cluster in the bucket."""

    def clusters(fps: np.ndarray, probe: np.ndarray) -> np.ndarray:
        index = np.flatnonzero(~probe)
        src, dst = [], []
        for block in np.array_split(index, max(1, len(index) * len(fps) // 1_000_000)):
            i, j = np.nonzero(np.bitwise_count(fps[block][:, None] ^ fps[None, :]) <= tau)
            src.append(block[i]), dst.append(j)
        i, j = np.concatenate(src), np.concatenate(dst)
        label = np.arange(len(fps))
        while True:  # smallest label over the links, then label of label
            new = label.copy()
            np.minimum.at(new, i, label[j])
            np.minimum.at(new, j, label[i])
            new = new[new]
            if (new == label).all():
                return label
            label = new

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for members in batch.column("members"):
                rows = members.values
                fps, probe = rows.field(0).to_numpy().view(np.uint64), rows.field(1).to_numpy(zero_copy_only=False)
                label = clusters(fps, probe)
                at = np.flatnonzero(fps[label] != fps)
                if len(at):
                    out.append(np.stack([fps[at], fps[label[at]]]).view(np.int64))
            src, dst = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], ["src", "dst"])

    return run


def _centre_edges(fps: DataFrame, tau: int) -> DataFrame:
    """Links among ``fps`` by shared centres: those within floor(tau/2) bits of a centre are linked with one another and
    with those within ceil(tau/2), so a star around the smallest of the former holds every link of the centre."""
    everything = (1 << BITS) - 1
    near = _neighbours(fps, _flips(everything, tau // 2), "centre")
    far = near if tau % 2 == 0 else _neighbours(fps, _flips(everything, tau // 2 + 1), "centre")
    hub = near.groupBy("centre").agg(F.min("fp").alias("dst"))
    return far.withColumnRenamed("fp", "src").join(hub, "centre").where("src != dst").select("src", "dst").distinct()


def similar_edges(fps: DataFrame, tau: int = 2, bucket_rows: int = 2048) -> DataFrame:
    """Edges ``src``, ``dst`` whose connected components are those of the links within ``tau`` bits among the distinct
    fingerprints ``fps`` (column ``fp``, no repeats).  ``bucket_rows`` chooses how a bucket is verified, see above."""
    n, joint = bit_statistics(fps)
    if n < 2:
        return fps.sparkSession.createDataFrame([], "src long, dst long")
    parts = []
    for k, (mask, t) in enumerate(plan_groups(n, joint, tau)):
        own = F.col("fp").bitwiseAND(F.lit(_signed(mask)).cast("long"))
        rows = _neighbours(fps.select("fp"), _flips(mask, t), "value")
        parts.append(rows.select(F.lit(k).alias("part"), F.col("value").bitwiseAND(F.lit(_signed(mask)).cast("long")).alias("value"), "fp", (F.col("value").bitwiseAND(F.lit(_signed(mask)).cast("long")) != own).alias("probe")))
    rows = reduce(DataFrame.unionAll, parts)
    sizes = rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"), F.bool_and("probe").alias("strangers")).where("n > 1 and not strangers")
    met = cut_lineage(rows.join(sizes.drop("strangers"), ["part", "value"]), "buckets")
    small = met.where(F.col("n") <= bucket_rows).groupBy("part", "value").agg(F.sort_array(F.collect_list(F.struct("fp", "probe"))).alias("members"))
    edges = small.select("members").mapInArrow(_bucket_edges(tau), "src long, dst long")
    return edges.unionAll(_centre_edges(met.where(F.col("n") > bucket_rows).select("fp").distinct(), tau))


def near_duplicates(docs: DataFrame, shingle: int = 3, tau: int = 2, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 2048) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id``: one row for each row of ``docs``; ``component_id`` is the smallest id that is
    reachable over links of at most ``tau`` differing bits, the row's own included.

    NULL, empty and blank texts have fingerprint 0 and link like any other; a NULL id takes no part in the minimum
    (a component of NULL ids alone has NULL); repeated rows come out as often as they went in; an empty table gives an
    empty result."""
    return _grouped(docs, shingle, tau, id_col, text_col, bucket_rows).select("doc_id", "fp", "component_id")


def _grouped(docs: DataFrame, shingle: int, tau: int, id_col: str, text_col: str, bucket_rows: int) -> DataFrame:
    """``doc_id``, ``key``, ``fp``, ``root`` (a fingerprint that names the component), ``component_id``."""
    fps = cut_lineage(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("low_id"))
    roots = connected_components(similar_edges(nodes, tau, bucket_rows))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low_id", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low_id").alias("component_id"))
    return fps.join(rooted.join(lowest, "root").select("fp", "root", "component_id"), "fp").select("doc_id", "key", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, tau: int = 2, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 2048) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of each component the row with the smallest id (NULL ids last, then the
    smallest hash of the text), once if it is repeated."""
    rows = _grouped(docs, shingle, tau, id_col, text_col, bucket_rows)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key"))
    kept = cut_lineage(rows.groupBy("root").agg(first.alias("row")).select(F.col("row.doc_id").alias("kept_id"), F.col("row.key").alias("kept_key")), "kept-rows")
    names = [f"c{k}" for k in range(len(docs.columns))]  # columns of docs may have any names
    own = docs.toDF(*names)
    text, doc_id = names[docs.columns.index(text_col)], names[docs.columns.index(id_col)]
    own = own.withColumn("own_id", F.col(doc_id).cast("long")).withColumn("own_key", F.xxhash64(F.col(text).cast("string").cast("binary")))
    stay = own.join(kept, own["own_id"].eqNullSafe(kept["kept_id"]) & (own["own_key"] == kept["kept_key"]), "left_semi")
    return stay.dropDuplicates(["own_id", "own_key"]).select(*names).toDF(*docs.columns)


def hex_fingerprint(fp):
    """A signed fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))

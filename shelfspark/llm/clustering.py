"""Exact k-means of integer vectors with geometrically tightened bounds.

A vector keeps a lower bound of its distance to every centroid but its own.  When centroids move, the usual loosening of that
bound is the longest drift.  Here all vectors of a cluster lie in a sphere around their old centroid, and the loosening is the
most that *any place of that sphere* can have come nearer to a moved centroid.  In the plane through the sphere's centre and
the drift from ``c`` to ``c'``, with the drift's length p, its middle m and an angle v at m between the drift's direction
and a place x,

    |x - c| - |x - c'| = 2 p t / (|x - c| + |x - c'|)   with t = |x - m| cos v, and 2 |x - m| <= |x - c| + |x - c'|,

so it is at most p cos v, and v is at least the angle of the sphere's centre less the half angle under which m sees the sphere.
A centroid that moves away from the sphere even tightens the bound.  A vector whose own distance (computed exactly) is below
its bound keeps its cluster; the others are ambiguous and are compared with all centroids, exactly.

Each round is one pass over a written table of vectors and bounds, which also writes each task's sums by cluster; only the sums
of k clusters reach the driver.  The table of the round before goes when the next one is complete, so that at most two are
kept, and a lost executor costs tasks of one round."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from shelfspark.session import ensure_checkpoint_dir

#: Components beyond this are refused: the square of a distance would not fit a long.
LARGEST = 1 << 26
#: Vectors compared with all centroids at a time.
SCAN = 4096
ROWS = "vec_id long, vec binary, cluster int, lower double, distance long"
SUMS = "n long, sums array<long>, far long, inertia decimal(38,0), scanned long"


class Clustering(NamedTuple):
    """``assigned``: ``vec_id``, ``cluster``, ``distance`` (squared) of each kept vector; ``clusters``: of each cluster its number,
    ``n`` vectors and ``inertia``; ``centroids``: lists of integers; ``scanned``: vectors compared with all centroids, by pass."""

    assigned: DataFrame
    clusters: list[Row]
    centroids: list[list[int]]
    scanned: list[int]


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact, of rows of integers ``x`` to all ``centroids``."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * x.shape[1] * largest * largest < 1 << 53:  # sums of products are integers that doubles hold
        a, b = x.astype(float), centroids.astype(float)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], axis=1)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """The most by which any place within ``radius[i]`` of ``old[i]`` can have come nearer to any centroid but ``i``, when the
    centroids move from ``old`` to ``new`` (negative where all of them move away; -inf if there is no other centroid)."""
    old, new = old.astype(float), new.astype(float)
    move, middle = new - old, (old + new) / 2
    drift = np.sqrt((move * move).sum(1))
    axis = move / np.where(drift > 0, drift, 1)[:, None]
    to = old[:, None, :] - middle[None, :, :]
    apart = np.sqrt((to * to).sum(2))
    inside = radius[:, None] >= apart * (1 - 1e-9)
    safe = np.where(inside, 1, apart)
    angle = np.arccos(np.clip((to * axis).sum(2) / safe, -1, 1)) - np.arcsin(np.where(inside, 0, radius[:, None] / safe))
    nearer = np.cos(np.clip(angle, 0, np.pi))
    room = safe - radius[:, None]
    nearer = np.where(nearer < 0, nearer * np.maximum(room, 0) / (np.maximum(room, 0) + drift / 2 + 1e-300), nearer)
    nearer = np.where(inside, 1, np.minimum(nearer + 1e-6, 1)) * drift  # a rounding margin, the angle's sine loses half the digits
    np.fill_diagonal(nearer, -np.inf)
    return nearer.max(axis=1) if len(old) else np.zeros(0)


def _scan(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (of equals the smaller number), its squared distance, and the distance of the second."""
    cluster, distance, lower = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64), np.full(len(x), np.inf)
    for at in range(0, len(x), SCAN):
        rows, d = slice(at, at + SCAN), squared_distances(x[at : at + SCAN], centroids)
        cluster[rows] = d.argmin(1)
        distance[rows] = d.min(1)
        if len(centroids) > 1:
            lower[rows] = np.sqrt(np.partition(d, 1, axis=1)[:, 1].astype(float))
    return cluster, distance, lower


def assign(x: np.ndarray, centroids: np.ndarray, cluster: np.ndarray | None = None, lower: np.ndarray | None = None, loose: np.ndarray | None = None) -> tuple:
    """New (cluster, squared distance, lower bound, whether scanned) of the rows ``x``; without bounds all are scanned."""
    if cluster is None:
        return *_scan(x, centroids), np.ones(len(x), bool)
    distance = ((x - centroids[cluster]) ** 2).sum(1)
    lower = lower - loose[cluster]
    open_ = np.sqrt(distance.astype(float)) * (1 + 1e-9) + 1e-6 >= lower * (1 - 1e-9)
    cluster = cluster.copy()
    cluster[open_], distance[open_], lower[open_] = _scan(x[open_], centroids)
    return cluster, distance, lower, open_


def kept_vectors(vectors: DataFrame, dims: int, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id``, ``vec`` (array of doubles) of the rows with ``dims`` components, none NULL or non-finite."""
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    fine = F.forall(vec, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return vectors.where(F.coalesce((F.size(vec) == dims) & fine, F.lit(False))).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vec.alias("vec"))


def _pass(table: DataFrame, path: str, width: int, centroids: np.ndarray, loose: np.ndarray | None, scale: int) -> tuple[DataFrame, list[Row]]:
    """One assignment of all vectors, written to ``path``: the vectors with their bounds, and the sums by cluster."""
    first, dims = loose is None, centroids.shape[1]
    kind = np.dtype(f"<i{width}")
    names = [c.split()[0] for c in f"{ROWS}, {SUMS}, part string".split(", ")]
    schema = pa.schema([("vec_id", pa.int64()), ("vec", pa.binary()), ("cluster", pa.int32()), ("lower", pa.float64()), ("distance", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("far", pa.int64()), ("inertia", pa.decimal128(38, 0)), ("scanned", pa.int64()), ("part", pa.string())])

    def batch_of(rows: int, part: str, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part] * rows) if c == "part" else columns.get(c, pa.nulls(rows, schema.field(c).type)) for c in names], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        n, far, scanned = (np.zeros(k, np.int64) for _ in range(3))
        inertia, sums = [0] * k, [[0] * dims for _ in range(k)]
        for batch in batches:
            if not batch.num_rows:
                continue
            if first:
                x = np.floor(batch.column("vec").flatten().to_numpy() * scale).astype(np.int64).reshape(-1, dims)
                cluster, distance, lower, open_ = assign(x, centroids)
            else:
                x = np.frombuffer(b"".join(batch.column("vec").to_pylist()), kind).astype(np.int64).reshape(-1, dims)
                cluster, distance, lower, open_ = assign(x, centroids, batch.column("cluster").to_numpy().astype(np.int64), batch.column("lower").to_numpy(), loose)
            for c in np.unique(cluster).tolist():
                own = cluster == c
                n[c] += own.sum()
                far[c] = max(far[c], distance[own].max())
                scanned[c] += open_[own].sum()
                inertia[c] += (int((distance[own] >> 30).sum()) << 30) + int((distance[own] & ((1 << 30) - 1)).sum())
                sums[c] = [a + b for a, b in zip(sums[c], x[own].sum(0).tolist())]
            raw = x.astype(kind)
            vec = pa.array([r.tobytes() for r in raw], pa.binary()) if first else batch.column("vec")
            yield batch_of(len(x), "rows", vec_id=batch.column("vec_id"), vec=vec, cluster=pa.array(cluster.astype(np.int32)), lower=pa.array(lower), distance=pa.array(distance))
        at = np.flatnonzero(n)
        if len(at):
            yield batch_of(
                len(at), "sums", cluster=pa.array(at.astype(np.int32)), n=pa.array(n[at]), far=pa.array(far[at]), scanned=pa.array(scanned[at]),
                sums=pa.array([sums[c] for c in at], pa.list_(pa.int64())), inertia=pa.array([inertia[c] for c in at], pa.decimal128(38, 0)),
            )

    table.mapInArrow(run, f"{ROWS}, {SUMS}, part string").write.partitionBy("part").parquet(path)
    spark = table.sparkSession
    written = spark.read.schema(f"{ROWS}, {SUMS}, part string").parquet(path)
    total = [F.sum("n").alias("n"), F.max("far").alias("far"), F.sum("inertia").cast("decimal(38,0)").alias("inertia"), F.sum("scanned").alias("scanned")]
    total += [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
    found = written.where("part = 'sums'").groupBy("cluster").agg(*total).orderBy("cluster").collect()  # at most k rows
    return written.where("part = 'rows'").select("vec_id", "vec", "cluster", "lower", "distance"), found


def _drop(table: DataFrame, path: str) -> None:
    spark = table.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, salt: str = "2:", id_col: str = "vec_id", vec_col: str = "embedding") -> Clustering:
    """k-means of the vectors ``floor(scale * x)``, in integers: ``rounds`` times every vector goes to its nearest centroid (of
    equals the smaller number) and every non-empty centroid to ``floor(sum / count)`` of its vectors; then all are assigned
    once more.  Centroids start as the ``k`` vectors with the smallest SHA-256 of ``salt`` and the id in decimal.

    Vectors with another number of components, or with a NULL or non-finite one, are left out.  Repeated rows count as often
    as they come and may be centroids of their own (equal hashes in order of the vectors; NULL ids last); a centroid that
    has an equal one of smaller number stays empty and where it is.  With fewer than ``k`` vectors each is a centroid, with
    none the result is empty.  A component beyond 2^26 after scaling is an error: its squares don't fit a long."""
    spark, base = vectors.sparkSession, f"{ensure_checkpoint_dir(vectors.sparkSession).rstrip('/')}/clusters-{uuid.uuid4().hex}"
    kept = kept_vectors(vectors, dims, id_col, vec_col)
    largest = kept.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x))))).first()[0]
    if largest is None:
        return Clustering(kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), [], [], [])
    if largest * scale >= LARGEST:
        raise ValueError(f"a component of {largest} is too large to cluster exactly")
    width = 2 if largest * scale < (1 << 15) - 1 else 4
    digest = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256)
    start = kept.orderBy(digest.asc_nulls_last(), "vec").limit(k).collect()
    centroids = np.floor(np.array([r.vec for r in start]) * scale).astype(np.int64)
    table, loose, path, scanned = kept, None, None, []
    for done in range(rounds + 1):
        before, path = path, f"{base}/pass-{done}"
        table, found = _pass(table, path, width, centroids, loose, scale)
        scanned.append(sum(r.scanned for r in found))
        if before:
            _drop(table, before)
        if done < rounds:
            moved, radius = centroids.copy(), np.zeros(len(centroids))
            for r in found:
                moved[r.cluster] = [int(r[f"s{i}"]) // r.n for i in range(dims)]
                radius[r.cluster] = np.sqrt(float(r.far)) * (1 + 1e-9)
            loose, centroids = loosening(centroids, moved, radius), moved
    return Clustering(table.select("vec_id", "cluster", "distance"), found, centroids.tolist(), scanned)


def centroid_sha256(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def with_inertia(result: Clustering) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of each vector."""
    total = int(sum(r.inertia for r in result.clusters))
    rows = [(r.cluster, int(r.inertia), total, centroid_sha256(result.centroids[r.cluster])) for r in result.clusters]
    per = result.assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return result.assigned.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # one row a cluster

import hashlib
import random

import numpy as np
import pytest

from shelfspark.llm import clustering
from shelfspark.llm.clustering import assign, centroid_sha256, cluster_vectors, loosening, with_inertia

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, lower string, part string, vec string, n string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], 0, "c", "l", "p", "v", "n") for i, v in rows], SCHEMA)


def brute(rows, k, rounds, dims, scale):
    """The definition, in Python integers."""
    kept = [(i, tuple(float(np.float32(x)) for x in v)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    whole = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in kept]
    centroids = [[int(np.floor(scale * x)) for x in v] for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in whole]
        for j in range(len(centroids)):
            mine = [v for (_, v), c in zip(whole, own) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [(i, *reversed(nearest(v))) for i, v in whole]
    inertia = {j: sum(d for _, c, d in found if c == j) for j in range(len(centroids))}
    return sorted(((i is None, i or 0), c, d, inertia[c], sum(inertia.values()), centroid_sha256(centroids[c])) for i, c, d in found)


def rows_of(frame):
    return sorted(((r.vec_id is None, r.vec_id or 0), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in frame.collect())


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(3)] for _ in range(6)]
    rows = [(n, [x + rng.gauss(0, 0.2) for x in rng.choice(centres)]) for n in range(150)]
    rows += [(n, [0.25, -0.5, 1.0]) for n in range(150, 230)]  # a third are equal
    rows += [rows[0], rows[0], (None, [0.1, 0.2, 0.3]), (None, [0.1, 0.2, 0.3])]  # repeated rows, ids that are NULL
    rows += [(500, None), (501, []), (502, [1.0, 2.0]), (503, [1.0, None, 2.0]), (504, [1.0, float("nan"), 2.0]), (505, [1.0, float("inf"), 2.0]), (506, [1.0] * 4)]
    k, scale = rng.choice([1, 2, 7, 40]), rng.choice([2, 256, 300_000])
    result = cluster_vectors(table(spark, rows), k=k, rounds=4, dims=3, scale=scale)
    assert rows_of(with_inertia(result)) == brute(rows, k, 4, 3, scale)
    assert result.scanned[0] == 234 and all(n <= 234 for n in result.scanned)


def test_few_vectors_and_none(spark):
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0])]
    assert rows_of(with_inertia(cluster_vectors(table(spark, rows), k=9, rounds=2, dims=2))) == brute(rows, 9, 2, 2, 256)
    nothing = with_inertia(cluster_vectors(table(spark, rows), k=9, rounds=2, dims=5))
    assert nothing.count() == 0 and nothing.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(ValueError):
        cluster_vectors(table(spark, [(1, [1e30, 0.0])]), dims=2)


@pytest.mark.parametrize("seed", range(30))
def test_loosening_holds_in_the_whole_sphere_and_is_less_than_the_drift(seed):
    rng = np.random.default_rng(seed)
    dims, k = int(rng.integers(1, 6)), int(rng.integers(2, 6))
    old = rng.integers(-100, 100, (k, dims))
    new = old + rng.integers(-20, 20, (k, dims)) * rng.integers(0, 2, (k, 1))
    radius = rng.uniform(0, 60, k)
    loose = loosening(old, new, radius)
    for i in range(k):
        way = rng.normal(size=(4000, dims))
        x = old[i] + way / np.linalg.norm(way, axis=1)[:, None] * radius[i] * rng.uniform(0, 1, (4000, 1)) ** 0.2
        x = np.concatenate([x, old[i][None, :]])
        nearer = [np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1) for j in range(k) if j != i]
        assert np.max(nearer) <= loose[i] + 1e-9
        assert loose[i] <= max(np.linalg.norm((new - old)[j]) for j in range(k) if j != i) + 1e-9


def test_loosening_spares_scans():
    """On separated clusters the bound loosened by geometry leaves fewer vectors ambiguous than that loosened by the drift."""
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(12, 16)) * 80)[rng.integers(0, 12, 4000)] + rng.normal(size=(4000, 16)) * 20
    x = x.astype(np.int64)
    centroids = x[:12].copy()
    cluster, distance, lower, _ = assign(x, centroids)
    by_geometry, by_drift, full = 0, 0, lower.copy()
    for _ in range(6):
        radius = np.array([np.sqrt(distance[cluster == c].max(initial=0)) for c in range(12)])
        moved = np.array([x[cluster == c].sum(0) // max((cluster == c).sum(), 1) if (cluster == c).any() else centroids[c] for c in range(12)])
        loose = loosening(centroids, moved, radius)
        drift = np.linalg.norm((moved - centroids).astype(float), axis=1)
        most = np.array([np.delete(drift, c).max() for c in range(12)])
        full -= most[cluster]
        own = ((x - moved[cluster]) ** 2).sum(1)
        unsure = np.sqrt(own) >= full
        by_drift += unsure.sum()
        cluster, distance, lower, scanned = assign(x, moved, cluster, lower, loose)
        exact = clustering.squared_distances(x, moved)
        assert (cluster == exact.argmin(1)).all() and (distance == exact.min(1)).all()
        full[unsure] = np.sqrt(np.partition(exact, 1, axis=1)[unsure, 1])
        by_geometry, centroids = by_geometry + scanned.sum(), moved
    assert by_geometry < by_drift


def test_large_components_are_exact():
    x = np.array([[(1 << 26) - 1, -(1 << 26) + 1], [5, 7]])
    d = clustering.squared_distances(x, np.array([[-(1 << 26) + 1, (1 << 26) - 1], [5, 8]]))
    assert d.tolist() == [[sum((a - b) ** 2 for a, b in zip(r, c)) for c in [[-(1 << 26) + 1, (1 << 26) - 1], [5, 8]]] for r in x.tolist()]


def test_query_equals_sql(spark):
    import duckdb

    from shelfspark.llm.queries import QUERIES, SQL

    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet'")
    cur = con.execute(SQL["op11_centroid_clustering"])
    want = cur.fetchall()
    out = QUERIES["op11_centroid_clustering"](spark, "/root/testdata/sf0.001")
    assert [d[0] for d in cur.description] == out.columns
    assert sorted(map(tuple, out.collect())) == sorted(want) and want

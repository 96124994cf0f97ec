"""Nearest neighbours at size: nearest cells without a whole sort, work dealt to all cores."""

from __future__ import annotations

import numpy as np

from shelfspark.operators import neighbours
from shelfspark.sources import retail_view


def test_first_cells_are_those_of_a_whole_sort():
    rng = np.random.default_rng(8)
    for _ in range(20):
        d, held = rng.integers(0, 12, (50, 90)).astype(float), rng.integers(0, 3, 90)  # ties, empty cells
        for k in (1, 5, 40, 1000):
            order = np.argsort(d, axis=1, kind="stable")
            before = np.cumsum(held[order], axis=1) - held[order]
            wanted = np.zeros(d.shape, bool)
            np.put_along_axis(wanted, order, before < k, axis=1)
            assert (neighbours._first_cells(d, held, k) == wanted).all()


def test_few_bytes_of_rows_are_dealt_to_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    assert neighbours._dealt(spark.range(100).coalesce(1), 100).rdd.getNumPartitions() == cores
    assert neighbours._dealt(spark.range(100).coalesce(1), neighbours.PIVOT_ROWS * (cores + 3)).rdd.getNumPartitions() == cores + 3


def test_a_small_table_of_one_row_group_is_dealt_to_all_cores(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t.parquet")
    spark.range(1000).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    assert retail_view.over_cores(df, df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r.id for r in retail_view.over_cores(df, df).collect()) == list(range(1000))
    monkeypatch.setattr(retail_view, "FEW_BYTES", 1)
    assert retail_view.over_cores(df, df) is df

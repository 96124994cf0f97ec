"""L2-regularised logistic regression by Newton steps (M2).

Minimises sum of log-losses + |w|² / (2 C) (the intercept is free) over all training rows.  Every step is one pass: each task
multiplies its rows into a gradient and a Hessian of (features + 1) numbers a side, Spark adds them up by place, and only that
small matrix reaches the driver, which solves for the step.  The loss is strictly convex, so a handful of steps reach the
optimum; a step that does not lower the loss is halved.  NULL features are filled with the training median; features are
centred and scaled inside the solver for its numbers' sake only, the penalty is that of the given columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark import config as C
from shelfspark.operators.ranks import quantiles_wide
from shelfspark.session import cut_lineage


@dataclass
class Logistic:
    features: list[str]
    medians: list[float]
    coefficients: list[float]
    intercept: float
    steps: int
    #: Largest component of the penalised loss's gradient, per row.
    gradient: float

    def filled(self, feature: str) -> Column:
        value = F.col(feature).cast("double")
        return F.coalesce(F.when(~F.isnan(value), value), F.lit(self.medians[self.features.index(feature)]))

    def margin(self) -> Column:
        return sum((F.lit(w) * self.filled(f) for f, w in zip(self.features, self.coefficients)), F.lit(self.intercept))

    def score(self, df: DataFrame) -> DataFrame:
        """M7: ``df`` with ``p1`` (probability of class 1) and ``prediction`` (1 from 0.5 on)."""
        missing = [c for c in self.features if c not in df.columns]
        if missing:
            raise ValueError(f"scoring frame is missing expected columns: {missing}")
        return df.withColumn("p1", 1 / (1 + F.exp(-self.margin()))).withColumn("prediction", (F.col("p1") >= 0.5).cast("double"))


def _sums(rows: DataFrame, names: Sequence[str], weights: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and Hessian of all rows at ``weights`` (the intercept last), without the penalty."""
    n = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, gradient, hessian = 0.0, np.zeros(n), np.zeros((n, n))
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1)
            x = np.column_stack([(x - centre) / scale, np.ones(len(x))])
            y = batch.column("y").to_numpy(zero_copy_only=False)
            z = x @ weights
            p = np.exp(-np.logaddexp(0, -z))
            loss += float((np.logaddexp(0, z) - y * z).sum())
            gradient += x.T @ (p - y)
            hessian += (x * (p * (1 - p))[:, None]).T @ x
        values = np.concatenate([[loss], gradient, hessian[np.triu_indices(n)]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)).astype(np.int32)), pa.array(values)], ["place", "value"])

    found = rows.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    values = np.zeros(1 + n + n * (n + 1) // 2)
    values[found.column("place").to_numpy()] = found.column("value").to_numpy()
    hessian = np.zeros((n, n))
    hessian[np.triu_indices(n)] = values[1 + n :]
    return float(values[0]), values[1 : 1 + n], hessian + np.triu(hessian, 1).T


def fit_logistic(train: DataFrame, features: Sequence[str], c: float = 1.0, target: str = C.TARGET, tolerance: float = 1e-9, max_steps: int = 50) -> Logistic:
    """The optimum over all rows of ``train`` with a target.  A constant or all-NULL feature gets coefficient 0; without rows
    all are 0."""
    features, names = list(features), [f"x{i}" for i in range(len(features))]
    found = {r["column"]: r["median"] for r in quantiles_wide(train, features, {"median": 0.5}).collect()}  # one row a feature
    model = Logistic(features, [float(found.get(f) or 0.0) for f in features], [0.0] * len(features), 0.0, 0, 0.0)
    rows = train.where(F.col(target).isNotNull()).select(*[model.filled(f).alias(n) for f, n in zip(features, names)], F.col(target).cast("double").alias("y"))
    rows = cut_lineage(rows, "logistic-rows")
    moments = rows.agg(F.count(F.lit(1)).alias("n"), *[g(n).alias(f"{k}{n}") for n in names for k, g in (("m", F.avg), ("s", F.stddev_pop))]).first()
    if not moments.n:
        return model
    centre = np.array([moments[f"m{n}"] for n in names])
    spread = np.array([moments[f"s{n}"] for n in names])
    scale = np.where(spread > 1e-12 * (1 + np.abs(centre)), spread, np.inf)  # infinite: the column is left out
    penalty = np.append(np.where(np.isinf(scale), 1.0, 1.0 / (c * np.where(np.isinf(scale), 1.0, scale) ** 2)), 0.0)
    weights, step = np.zeros(len(names) + 1), None
    loss, gradient, hessian = _sums(rows, names, weights, centre, scale)
    for steps in range(1, max_steps + 1):
        slope = gradient + penalty * weights
        model.gradient = float(np.abs(slope).max() / moments.n)
        if model.gradient <= tolerance:
            break
        step, size = np.linalg.solve(hessian + np.diag(penalty + 1e-12), slope), 1.0
        before = loss + 0.5 * float(penalty @ weights**2)
        while True:
            moved = weights - size * step
            loss, gradient, hessian = _sums(rows, names, moved, centre, scale)
            if loss + 0.5 * float(penalty @ moved**2) <= before + 1e-12 * abs(before) or size < 1e-6:
                break
            size /= 2
        weights, model.steps = moved, steps
    model.coefficients = [float(w) for w in weights[:-1] / scale]
    model.intercept = float(weights[-1] - (weights[:-1] / scale) @ centre)
    return model


def gradient_at(df: DataFrame, model: Logistic, c: float = 1.0, target: str = C.TARGET) -> DataFrame:
    """(feature, gradient): the penalised loss's gradient per row, by Spark's own aggregates (the intercept is ``(intercept)``)."""
    error = 1 / (1 + F.exp(-model.margin())) - F.col(target)
    parts = [(f, F.sum(error * model.filled(f)) + F.lit(w / c)) for f, w in zip(model.features, model.coefficients)] + [("(intercept)", F.sum(error))]
    row = df.where(F.col(target).isNotNull()).agg(F.count(F.lit(1)).alias("n"), *[g.alias(f"g{i}") for i, (_, g) in enumerate(parts)])
    return row.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), (F.col(f"g{i}") / F.col("n")).alias("gradient")) for i, (f, _) in enumerate(parts)])).alias("r")).select("r.*")

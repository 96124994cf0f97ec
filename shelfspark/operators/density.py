"""Kernel density curves (the points behind the density plots).

Values are spread over a fine grid by linear binning in one aggregate; the curve is the convolution of that grid with the
Gaussian kernel, a join of bins with the points within reach, whose rows are bounded by the grid, whatever the table's size."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.operators.ranks import unpivot_numeric

WHOLE = "all"


def density_curves(df: DataFrame, columns: Sequence[str], by: str | None = None, points: int = 200, bins: int = 262_144, cut: float = 3.0, reach: float = 9.0) -> DataFrame:
    """(column, group, point, x, density, scaled): Gaussian kernel density of each column at ``points`` places, of the whole table
    (group ``all``) and of each value of ``by``.

    The bandwidth is Scott's (sample standard deviation · n^(-1/5)) of the group; places go from ``cut`` bandwidths of the whole
    below the least value to as many above the largest.  ``scaled`` is the density times the whole's standard deviation.
    The error of binning is about (bin / bandwidth)² / 8 of the density; kernels end at ``reach`` bandwidths.  NULLs are left
    out; rows with a NULL ``by`` belong to the whole only; a group of one value or one row has no curve."""
    ids = [by] if by else []
    label = F.col(by).cast("string") if by else F.lit(None).cast("string")
    long = unpivot_numeric(df, columns, ids).where("value IS NOT NULL").select("column", label.alias("own"), "value")
    stats = long.rollup("column", "own").agg(F.grouping_id().alias("level"), F.count("value").alias("n"), F.stddev_samp("value").alias("sd"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    stats = stats.where("level = 1 OR (level = 0 AND own IS NOT NULL)").withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    whole = stats.where("level = 1").where("h > 0").select("column", (F.col("lo") - cut * F.col("h")).alias("start"), (F.col("hi") - F.col("lo") + 2 * cut * F.col("h")).alias("width"), F.col("sd").alias("whole_sd"))
    groups = stats.where("h > 0").select("column", F.when(F.col("level") == 1, WHOLE).otherwise(F.col("own")).alias("group"), "n", "h")
    groups = groups.join(whole, "column")

    place = (F.col("value") - F.col("start")) / F.col("width") * (bins - 1)
    low = F.least(F.floor(place), F.lit(bins - 2))
    sides = F.array(F.struct(low.alias("bin"), (1 - (place - low)).alias("weight")), F.struct((low + 1).alias("bin"), (place - low).alias("weight")))
    binned = long.join(whole, "column").select("column", "own", F.explode(sides).alias("s")).groupBy("column", "own", F.col("s.bin").alias("bin")).agg(F.sum("s.weight").alias("weight"))
    own = F.array_compact(F.array(F.lit(WHOLE), F.col("own")))
    binned = binned.select("column", "bin", "weight", F.explode(own).alias("group"))

    gap = F.col("width") / (points - 1)
    x = F.col("bin") / (bins - 1) * F.col("width")
    first = F.greatest(F.ceil((x - reach * F.col("h")) / gap), F.lit(0))
    last = F.least(F.floor((x + reach * F.col("h")) / gap), F.lit(points - 1))
    met = binned.join(groups, ["column", "group"]).withColumn("x", x).where(first <= last).withColumn("point", F.explode(F.sequence(first, last)))
    kernel = F.col("weight") * F.exp(-0.5 * F.pow((F.col("point") * gap - F.col("x")) / F.col("h"), F.lit(2.0)))
    none = groups.select("column", "group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))).alias("point"), F.lit(0.0).alias("mass"))
    mass = met.select("column", "group", "point", kernel.alias("mass")).unionByName(none).groupBy("column", "group", "point").agg(F.sum("mass").alias("mass"))
    density = F.col("mass") / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))
    out = mass.join(groups, ["column", "group"]).select("column", "group", F.col("point").cast("int").alias("point"), (F.col("start") + F.col("point") * gap).alias("x"), density.alias("density"), (density * F.col("whole_sd")).alias("scaled"))
    return out

"""Numbers of the reports: profiles, histograms, slices, summaries."""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reciprospark.operators import quantiles
from reciprospark.operators.grid import Grid

FINITE = "not isnan({0}) and {0} is not null and abs({0}) < double('infinity')"


def finite(*names: str) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & F.expr(FINITE.format(n))
    return out


def _ranged(rows: DataFrame, value: str, n_bins: int) -> DataFrame:
    """rows with bin: equal bins on [min, max], the last closed; one pass for the range, one row of it broadcast."""
    ends = rows.agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    ends = ends.withColumn("_high", F.when(F.col("_high") == F.col("_low"), F.col("_low") + 1e-6).otherwise(F.col("_high")))
    rows = rows.crossJoin(F.broadcast(ends))  # one row
    at = F.floor((F.col(value) - F.col("_low")) / (F.col("_high") - F.col("_low")) * n_bins)
    return rows.withColumn("bin", F.least(at, F.lit(n_bins - 1)).cast("int")).withColumn("_centre", F.col("_low") + (F.col("bin") + 0.5) * (F.col("_high") - F.col("_low")) / n_bins)


def radial_average(rows: DataFrame, q: str = "q", value: str = "intensity", sigma: str | None = "sigma", n_bins: int = 50) -> DataFrame:
    """bin, q_mid, mean, error, n of the bins of |q| that have rows: plain means; errors from sigmas, else of the mean."""
    rows = _ranged(rows.where(finite(q, value, *([sigma] if sigma else []))), q, n_bins)
    error = F.lit(1.0) / F.sqrt(F.sum(F.lit(1.0) / F.nullif(F.col(sigma) * F.col(sigma), F.lit(0.0)))) if sigma else F.stddev_pop(value) / F.sqrt(F.count("*"))
    return rows.groupBy("bin").agg(F.min("_centre").alias("q_mid"), F.avg(value).alias("mean"), error.alias("error"), F.count("*").alias("n"))


def histogram(rows: DataFrame, value: str, n_bins: int = 50) -> DataFrame:
    return _ranged(rows.where(finite(value)), value, n_bins).groupBy("bin").agg(F.min("_centre").alias("centre"), F.count("*").alias("n"))


def log_histogram(rows: DataFrame, value: str, low: float, high: float, n_bins: int) -> DataFrame:
    """Bins of equal ratio on [low, high] of positive values, the last closed."""
    at = F.floor(F.log(F.col(value) / low) / math.log(high / low) * n_bins)
    return rows.where(F.col(value).between(low, high)).groupBy(F.least(at, F.lit(n_bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def occupancy(voxels: DataFrame, n: str = "num_observations") -> DataFrame:
    c, middle = F.col(n), quantiles.of(voxels, n, [0.5])[0]
    return voxels.agg(F.min(c).alias("n_min"), F.max(c).alias("n_max"), F.avg(c).alias("n_mean"), F.max(F.lit(middle).cast("double")).alias("n_median"), F.sum(c).alias("n_total"), F.count_if(c > 0).alias("n_filled"), (100.0 * F.count_if(c < 3) / F.count("*")).alias("percent_under_3"))


def positive_statistics(voxels: DataFrame, value: str = "I_merged_relative") -> DataFrame:
    v = F.col(value)
    middle = quantiles.of(voxels.where(v > 0), value, [0.5])[0]
    return voxels.agg(F.count("*").alias("n"), F.count_if(v > 0).alias("n_positive"), F.avg(F.when(v > 0, v)).alias("mean"), F.max(F.lit(middle).cast("double")).alias("median"))


def slice_of(voxels: DataFrame, grid: Grid, axis: str, at: int | None = None) -> DataFrame:
    """Voxels of one plane (the middle one by default) with their steps and I over sigma, 0 where sigma is not positive."""
    k = "HKL".index(axis)
    at = (grid.low[k] + grid.high[k]) // 2 if at is None else at
    steps = {f"{c.lower()}_step": F.rint(F.col(f"{c}_center") * n).cast("long") for c, n in zip("HKL", grid.ndiv, strict=True)}
    out = voxels.withColumns(steps).where(F.col(f"{axis.lower()}_step") == at)
    s = F.col("Sigma_merged_relative")
    return out.withColumn("i_over_sigma", F.when(s > 0, F.col("I_merged_relative") / F.when(s > 0, s).otherwise(1.0)).otherwise(0.0))


def orthogonal_slices(voxels: DataFrame, grid: Grid) -> DataFrame:
    """The middle planes of the three axes: axis, steps, intensity, sigma, i_over_sigma and occupancy of their voxels."""
    out = None
    for axis in "HKL":
        one = slice_of(voxels, grid, axis)
        one = one.select(F.lit(axis).alias("axis"), "voxel_idx", "h_step", "k_step", "l_step", F.col("I_merged_relative").alias("intensity"), F.col("Sigma_merged_relative").alias("sigma"), "i_over_sigma", F.col("num_observations").alias("occupancy"))
        out = one if out is None else out.unionByName(one)
    return out


def sigma_by_intensity(obs: DataFrame, n_bins: int = 50) -> DataFrame:
    """bin of the intensity, its centre, mean sigma and n."""
    rows = _ranged(obs.where(finite("intensity", "sigma")), "intensity", n_bins)
    return rows.groupBy("bin").agg(F.min("_centre").alias("centre"), F.avg("sigma").alias("sigma"), F.count("*").alias("n"))


def q_projections(obs: DataFrame, width: float) -> DataFrame:
    """Counts and mean intensity in squares of the three planes of q: plane, i, j, n, mean."""
    rows = obs.where(finite("qx", "qy", "qz"))
    at = {c: F.floor(F.col(c) / width).cast("int") for c in ("qx", "qy", "qz")}
    planes = F.array(*[F.struct(F.lit(a[1] + b[1]).alias("plane"), at[a].alias("i"), at[b].alias("j")) for a, b in (("qx", "qy"), ("qx", "qz"), ("qy", "qz"))])
    return rows.select(F.explode(planes).alias("p"), "intensity").groupBy("p.plane", "p.i", "p.j").agg(F.count("*").alias("n"), F.avg("intensity").alias("mean"))


def evaluated(rows: DataFrame, f: Callable[[float], float], q: str = "q", n: int = 100) -> DataFrame:
    """q and scale: any Python function of one |q|, at n places over the range of a table's |q|."""

    @F.pandas_udf("double")
    def scale(x: pd.Series) -> pd.Series:
        return x.map(lambda v: float(f(v)))

    return places(rows, q, n).select("q", scale("q").alias("scale"))


def phase_summary(phases: dict[str, DataFrame]) -> DataFrame:
    """phase, n (rows) and columns with nulls among them, of each named table: one aggregation for each."""
    out = None
    for name, df in phases.items():
        one = df.agg(F.lit(name).alias("phase"), F.count("*").alias("n"), F.count_if(F.lit(False) if not df.columns else F.greatest(*[F.col(c).isNull() for c in df.columns], F.lit(False))).alias("n_with_null"))
        out = one if out is None else out.unionByName(one)
    return out


def scale_summary(scales: DataFrame, value: str = "multiplicative_scale") -> DataFrame:
    v = F.col(value)
    return scales.agg(F.count("*").alias("n"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("low"), F.max(v).alias("high"), (F.avg(v) - F.stddev_pop(v)).alias("mean_less_std"), (F.avg(v) + F.stddev_pop(v)).alias("mean_plus_std"))


def interpolated(points: list[tuple[float, float]], x: Column) -> Column:
    """Linear interpolation of control points, held at both ends."""
    points = sorted(points)
    y = F.lit(points[-1][1])
    for (x0, y0), (x1, y1) in reversed(list(zip(points, points[1:], strict=False))):
        y = F.when(x < x1, F.lit(y0) + (x - x0) * ((y1 - y0) / (x1 - x0))).otherwise(y)
    return F.when(x < points[0][0], F.lit(points[0][1])).otherwise(y)


def places(rows: DataFrame, q: str = "q", n: int = 100) -> DataFrame:
    """n places (q) at equal steps over the range that a table has; none for an empty one."""
    ends = rows.agg(F.min(q).alias("low"), F.max(q).alias("high")).where("low is not null")
    return ends.select("low", "high", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k")).select((F.col("low") + (F.col("high") - F.col("low")) * F.col("k") / max(n - 1, 1)).alias("q"))


def smoother_curve(rows: DataFrame, points: list[tuple[float, float]], q: str = "q", n: int = 100) -> DataFrame:
    """q and scale at n places over the range of a table's |q|."""
    return places(rows, q, n).select("q", interpolated(points, F.col("q")).alias("scale"))


def extraction_summary(obs: DataFrame) -> DataFrame:
    i, s = F.col("intensity"), F.col("sigma")
    return obs.agg(F.count("*").alias("n"), F.min(i).alias("i_min"), F.max(i).alias("i_max"), F.avg(i).alias("i_mean"), F.avg(s).alias("sigma_mean"), F.avg(F.when(s > 0, i / F.when(s > 0, s).otherwise(1.0)).otherwise(0.0)).alias("i_over_sigma_mean"))


def signal_to_noise(obs: DataFrame) -> DataFrame:
    """obs with snr where it is finite."""
    s = F.col("sigma")
    return obs.withColumn("snr", F.when(s != 0, F.col("intensity") / F.when(s != 0, s).otherwise(1.0))).where(finite("snr"))


def colour_limits(rows: DataFrame, value: str, low: float = 0.01, high: float = 0.999) -> DataFrame:
    """Exact percentiles of finite values; a range that is empty is widened by one."""
    a, b = quantiles.of(rows.where(finite(value)), value, [low, high])
    out = rows.sparkSession.createDataFrame([(a, b)], "low double, high double")
    return out.withColumn("high", F.when(F.col("high") <= F.col("low"), F.col("low") + 1.0).otherwise(F.col("high")))


def heat_map(obs: DataFrame, order: str) -> DataFrame:
    """The last value, by the given order, of each pixel."""
    return obs.groupBy("panel_id", "slow", "fast").agg(F.max_by("intensity", order).alias("intensity"))


def spread_of(rows: DataFrame, value: str) -> DataFrame:
    v = F.col(value)
    return rows.agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.min(v).alias("low"), F.max(v).alias("high"))


def map_summary(voxels: DataFrame) -> DataFrame:
    i, s = F.col("I_merged_relative"), F.col("Sigma_merged_relative")
    snr = F.when(s > 0, i / F.when(s > 0, s).otherwise(1.0))
    return voxels.agg(F.count("*").alias("n_voxels"), (100.0 * F.count_if(i > 0) / F.count("*")).alias("percent_positive"), F.avg(snr).alias("snr_mean"), F.stddev_pop(snr).alias("snr_std"), F.sum("num_observations").alias("n_observations"))

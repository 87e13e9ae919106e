"""Outlier rejection, merging into voxels, and statistics of the merged map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reciprospark.functions.vec import ratio
from reciprospark.operators import quantiles
from reciprospark.operators.grid import Grid, with_centres
from reciprospark.operators.symmetry import reduced
from reciprospark.operators.validation import enough_partiality
from reciprospark.sources.shared import scratch

TINY = 1e-10
MAD_TO_SIGMA = 1.4826


def flattened(nested: DataFrame) -> DataFrame:
    """One row for each observation of rows (voxel_idx, intensities, sigmas, still_ids): arrays of equal length."""
    return nested.select("voxel_idx", F.inline(F.arrays_zip("intensities", "sigmas", "still_ids"))).withColumnsRenamed({"intensities": "intensity", "sigmas": "sigma", "still_ids": "still_id"})


def nested(flat: DataFrame, most: int = 100_000) -> DataFrame:
    """The inverse of flattened, for export: voxel_idx, part, and arrays in order of still_id, intensity and sigma. A voxel of over about ``most``
    observations comes in several rows (part 0, 1, ...), so no row grows without a bound; which part an observation is in depends on itself alone."""
    sizes = flat.groupBy("voxel_idx").agg(F.ceil(F.count("*") / most).cast("int").alias("_parts"))
    salt = F.pmod(F.xxhash64("still_id", "intensity", "sigma", *[c for c in ("obs_id", "image_id", "slow", "fast") if c in flat.columns]), F.col("_parts"))
    rows = flat.join(sizes, "voxel_idx").withColumn("part", F.when(F.col("_parts") == 1, 0).otherwise(salt).cast("int"))
    rows = rows.groupBy("voxel_idx", "part").agg(F.sort_array(F.collect_list(F.struct("still_id", "intensity", "sigma"))).alias("o"))
    return rows.select("voxel_idx", "part", F.col("o.intensity").alias("intensities"), F.col("o.sigma").alias("sigmas"), F.col("o.still_id").alias("still_ids"))


def observed_enough(obs: DataFrame, least: int) -> DataFrame:
    """Observations of voxels that have at least so many. Counts are partial sums, so a crowded voxel meets in no task."""
    if least <= 1:
        return obs
    enough = obs.groupBy("voxel_idx").agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select("voxel_idx")
    return obs.join(enough, "voxel_idx", "left_semi")


def without_outliers(obs: DataFrame, threshold: float = 3.0, hot: int = quantiles.MOST, least: int = 1) -> DataFrame:
    """Within threshold robust sigmas of the voxel's median; all of a voxel of up to two, or if none were left.

    A voxel with an intensity that is null or NaN, or whose median is infinite, keeps all. Voxels of fewer than ``least`` go. The rule is
    the same for voxels of any size: medians are windows over voxels, but a voxel of over ``hot`` observations is not brought into one
    task (see quantiles.medians). Partial counts tell which voxels are.
    """
    crowded = F.col("n") > max(hot, least, 2)
    sizes = obs.groupBy("voxel_idx").agg(F.count("*").alias("n"), F.max(~finite_or_infinite(F.col("intensity"))).alias("odd"))
    large = sizes.where(crowded)
    if large.isEmpty():
        return _by_window(obs, threshold, least)
    large = obs.sparkSession.read.schema(large.schema).parquet(_written(large))
    rest = _by_window(obs.join(large, "voxel_idx", "left_anti"), threshold, least)
    return rest.unionByName(_by_table(obs.join(large.select("voxel_idx"), "voxel_idx", "left_semi"), large, threshold).select(*obs.columns))


def _written(table: DataFrame) -> str:
    path = scratch(table.sparkSession, "crowded")
    table.write.parquet(path)
    return path


def finite_or_infinite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value.cast("double"))


def _sound(median: Column) -> Column:
    """A median that outliers can be measured against, else null."""
    return F.when(F.abs(median) < float("inf"), median)


def _by_window(obs: DataFrame, threshold: float, least: int) -> DataFrame:
    over = Window.partitionBy("voxel_idx")
    x = F.col("intensity").cast("double")
    out = obs.withColumns({"_n": F.count("*").over(over), "_odd": F.max(~finite_or_infinite(x)).over(over), "_median": F.median(x).over(over)})
    out = out.where(F.col("_n") >= least) if least > 1 else out
    out = out.withColumn("_off", F.when(~F.col("_odd"), F.abs(x - _sound(F.col("_median")))))
    out = out.withColumns({"_mad": F.median("_off").over(over), "_low": F.min("_off").over(over)})
    bound = threshold * MAD_TO_SIGMA * F.col("_mad")
    apart = (F.col("_n") > 2) & (F.col("_low") <= bound) & (F.col("_off") > bound)
    return out.where(~F.coalesce(apart, F.lit(False))).drop("_n", "_odd", "_median", "_off", "_mad", "_low")


def _by_table(obs: DataFrame, crowded: DataFrame, threshold: float) -> DataFrame:
    """The same of crowded voxels (voxel_idx, n, odd), by joins with a row for each of them."""
    x = F.col("intensity").cast("double")
    key = F.col("voxel_idx").alias("key")
    judged = crowded.where("not odd").select("voxel_idx")
    rows = obs.join(judged, "voxel_idx", "left_semi")
    middle = quantiles.medians(rows.select(key, x.alias("value"))).select(F.col("key").alias("voxel_idx"), _sound(F.col("median")).alias("_median"))
    off = rows.join(middle, "voxel_idx").select(key, F.abs(x - F.col("_median")).alias("value")).where("value is not null")
    spread = quantiles.medians(off).join(off.groupBy("key").agg(F.min("value").alias("low")), "key")
    bound = threshold * MAD_TO_SIGMA * F.col("median")
    bounds = spread.select(F.col("key").alias("voxel_idx"), F.when(F.col("low") <= bound, bound).alias("_bound"))
    out = obs.join(middle.join(bounds, "voxel_idx"), "voxel_idx", "left")
    return out.where(~F.coalesce(F.abs(x - F.col("_median")) > F.col("_bound"), F.lit(False)))


def merge_columns(method: str) -> tuple[Column, Column]:
    x, s, n = F.col("intensity"), F.col("sigma"), F.count("*")
    if method == "inverse_variance":
        w = F.lit(1.0) / (s * s + TINY)
        value, error = F.sum(w * x) / F.sum(w), F.lit(1.0) / F.sqrt(F.sum(w))
    elif method == "uniform":
        value, error = F.avg(x), F.sqrt(F.sum(s * s)) / n
    else:
        raise ValueError(f"weight method {method!r} is neither inverse_variance nor uniform")
    return F.when(n == 1, F.first(x)).otherwise(value), F.when(n == 1, F.first(s)).otherwise(error)


def merged(obs: DataFrame, method: str = "inverse_variance", least: int = 1) -> DataFrame:
    """voxel_idx, I_merged_relative, Sigma_merged_relative, num_observations: one shuffle with partial sums. NaN results go."""
    value, error = merge_columns(method)
    out = obs.groupBy("voxel_idx").agg(value.alias("I_merged_relative"), error.alias("Sigma_merged_relative"), F.count("*").alias("num_observations"))
    return out.where((F.col("num_observations") >= least) & ~F.isnan("I_merged_relative") & ~F.isnan("Sigma_merged_relative"))


def merge(binned: DataFrame, grid: Grid, method: str = "inverse_variance", least: int = 1, reject: float | None = None) -> DataFrame:
    """Merged map of scaled, binned observations, with voxel centres. reject: outlier threshold, None: off."""
    out = observed_enough(binned, least) if reject is None else without_outliers(binned, reject, least=least)
    return with_centres(merged(out, method, least), grid)


def bragg_merge(reflections: DataFrame, operations, least_partiality: float = 0.1) -> DataFrame:
    """Weighted mean intensity of each reflection, mates by symmetry together: h, k, l (whole), intensity, sigma, n. Reflections
    of too little partiality go; intensities are not divided by it."""
    kept = reflections.where(enough_partiality(least_partiality))
    kept = reduced(kept.withColumns({c: F.rint(c) for c in ("h", "k", "l")}), operations)
    w = F.lit(1.0) / (F.col("sigma") * F.col("sigma") + TINY)
    keys = [F.col(c).cast("int").alias(c) for c in ("h", "k", "l")]
    return kept.groupBy(*keys).agg((F.sum(w * F.col("intensity")) / F.sum(w)).alias("intensity"), (F.lit(1.0) / F.sqrt(F.sum(w))).alias("sigma"), F.count("*").alias("n"))


def integrated(binned: DataFrame, frame: str = "still_id") -> DataFrame:
    """counts, pixels and mean_frame (weighted by counts) of each voxel."""
    i = F.col("intensity")
    return binned.groupBy("voxel_idx").agg(F.sum(i).alias("counts"), F.count("*").alias("pixels"), ratio(F.sum(F.col(frame) * i), F.sum(i)).alias("mean_frame"))


def averaged_correction(binned: DataFrame, value: str) -> DataFrame:
    """The mean of a correction in each voxel, of each still's mean weighted by its observations."""
    by = binned.groupBy("voxel_idx", "still_id").agg(F.count("*").alias("n"), F.avg(value).alias("s"))
    return by.groupBy("voxel_idx").agg((F.sum(F.col("n") * F.col("s")) / F.sum("n")).alias("correction"))


def concatenated(chunks: Sequence[DataFrame]) -> DataFrame:
    """All rows of tables of the same columns, in any order of columns."""
    out = chunks[0]
    for c in chunks[1:]:
        out = out.unionByName(c)
    return out


def merge_statistics(voxels: DataFrame) -> DataFrame:
    """One row of statistics of a merged map; nulls and zeros for an empty one."""
    i, s, n, q = (F.col(c) for c in ("I_merged_relative", "Sigma_merged_relative", "num_observations", "q_magnitude_center"))
    first = voxels.agg((F.avg(i) + 2 * F.stddev_pop(i)).alias("_bound"))
    middle = quantiles.of(voxels, "I_merged_relative", [0.5])[0]
    rel = s / (i + TINY)
    return voxels.crossJoin(F.broadcast(first)).agg(  # one row
        F.count("*").alias("n_voxels"), F.avg(i).alias("i_mean"), F.stddev_pop(i).alias("i_std"), F.min(i).alias("i_min"), F.max(i).alias("i_max"), F.max(F.lit(middle).cast("double")).alias("i_median"),
        F.avg(n).alias("obs_mean"), F.coalesce(F.sum(n), F.lit(0)).alias("obs_total"), F.count_if(n == 1).alias("n_single"), F.max(n).alias("obs_max"),
        F.min(q).alias("q_min"), F.max(q).alias("q_max"), F.avg(q).alias("q_mean"), F.avg(rel).alias("rel_mean"),
        F.count_if(i > F.col("_bound")).alias("n_high"), F.count_if(rel < 0.1).alias("n_precise"),
    )


def accumulation_statistics(binned: DataFrame) -> DataFrame:
    """One row: observations, voxels, and the distribution of observations over voxels."""
    by = binned.groupBy("voxel_idx").agg(F.count("*").alias("n"))
    return by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_observations"), F.count("*").alias("n_voxels"), F.coalesce(F.avg("n"), F.lit(0.0)).alias("mean_n"), F.coalesce(F.stddev_pop("n"), F.lit(0.0)).alias("std_n"), F.coalesce(F.min("n"), F.lit(0)).alias("min_n"), F.coalesce(F.max("n"), F.lit(0)).alias("max_n"))


def still_counts(binned: DataFrame) -> DataFrame:
    return binned.groupBy("still_id").agg(F.count("*").alias("n_observations"), F.countDistinct("voxel_idx").alias("n_voxels"))


def of_voxel(binned: DataFrame, index: int) -> DataFrame:
    return binned.where(F.col("voxel_idx") == index)

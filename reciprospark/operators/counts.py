"""Histograms of counts in voxels, and voxels whose neighbourhood does not count like a Poisson process (peaks)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reciprospark.operators.grid import Grid

#: Counts up to this one have a bin; greater ones are overflow.
MOST = 255


def histogram(pixels: DataFrame, most: int = MOST) -> DataFrame:
    """voxel_idx, count and n of pixels (voxel_idx, count) up to most: partial sums."""
    return pixels.where(F.col("count").between(0, most)).groupBy("voxel_idx", F.col("count").cast("int").alias("count")).agg(F.count("*").alias("n"))


def overflow(pixels: DataFrame, most: int = MOST) -> DataFrame:
    """The sum of counts beyond most of each voxel that has some."""
    return pixels.where(F.col("count") > most).groupBy("voxel_idx").agg(F.sum("count").alias("overflow"))


def neighbours(index: Column, grid: Grid) -> Column:
    """Voxels that share a face with one, and itself: an array, inside the grid."""
    nh, nk, nl = grid.shape
    div = lambda x, n: F.call_function("div", x, F.lit(n).cast("long"))
    at = {1: (index % nh, nh), nh: (div(index % (nh * nk), nh), nk), nh * nk: (div(index, nh * nk), nl)}
    steps = [F.when(place > 0, index - step) for step, (place, _) in at.items()] + [F.when(place < n - 1, index + step) for step, (place, n) in at.items()]
    return F.array_compact(F.array(index, *steps))


def divergence(hist: DataFrame, grid: Grid, most: int = MOST) -> DataFrame:
    """voxel_idx, rate and divergence of each voxel of hist. rate: the median, weighted by pixels, of the mean counts in
    the neighbourhood; divergence: Kullback-Leibler, of the neighbourhood's counts from a Poisson process of that rate.

    Each voxel's rows go to its seven neighbours at most, so a neighbourhood is an aggregation, not a range join."""
    means = hist.groupBy("voxel_idx").agg((F.sum(F.col("count") * F.col("n")) / F.sum("n")).alias("mean"), F.sum("n").alias("w"))
    near = means.select(F.explode(neighbours(F.col("voxel_idx"), grid)).alias("voxel_idx"), "mean", "w").join(means.select("voxel_idx"), "voxel_idx", "left_semi")
    by = Window.partitionBy("voxel_idx")
    near = near.withColumn("below", F.sum("w").over(by.orderBy("mean"))).withColumn("all", F.sum("w").over(by))
    rates = near.where(2 * F.col("below") >= F.col("all")).groupBy("voxel_idx").agg(F.min("mean").alias("rate"))
    around = hist.select(F.explode(neighbours(F.col("voxel_idx"), grid)).alias("voxel_idx"), "count", "n").groupBy("voxel_idx", "count").agg(F.sum("n").alias("n"))
    both = around.join(rates, "voxel_idx").withColumn("p", F.col("n") / F.sum("n").over(by))
    factorials = F.array(*[F.lit(math.lgamma(c + 1)) for c in range(most + 1)])
    rate = F.greatest(F.col("rate"), F.lit(1e-12))
    log_poisson = F.col("count") * F.log(rate) - rate - F.element_at(factorials, F.col("count") + 1)
    return both.groupBy("voxel_idx").agg(F.first("rate").alias("rate"), F.sum(F.col("p") * (F.log("p") - log_poisson)).alias("divergence"))


def outlying(hist: DataFrame, over: DataFrame, grid: Grid, most_divergence: float, most_overflow: float = 0.0) -> DataFrame:
    """Voxels of a divergence beyond the given one, or with counts beyond the bins that add up to more than most_overflow.

    hist and over are what histogram() and overflow() give of the same pixels: a voxel of great counts alone is in the latter only."""
    wide = divergence(hist, grid).where(F.col("divergence") > most_divergence).select("voxel_idx")
    return wide.union(over.where(F.col("overflow") > most_overflow).select("voxel_idx")).distinct()

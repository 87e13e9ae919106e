"""Pixel masks. A mask says good = true for a usable pixel; a peak table lists pixels of peaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reciprospark.schema import require_columns

KEY = ["panel_id", "slow", "fast"]
#: Bits of a shoebox code that mark a peak.
FOREGROUND, STRONG = 4, 16


def detector(spark, panels: Sequence[tuple[int, int, int]]) -> DataFrame:
    """All pixels of panels (panel_id, n_slow, n_fast)."""
    table = spark.createDataFrame([tuple(p) for p in panels], "panel_id int, n_slow int, n_fast int")
    rows = table.select("panel_id", "n_fast", F.explode(F.sequence(F.lit(0), F.col("n_slow") - 1)).alias("slow"))
    return rows.select("panel_id", "slow", F.explode(F.sequence(F.lit(0), F.col("n_fast") - 1)).alias("fast"))


def positions(pixels: DataFrame) -> DataFrame:
    """All pixels that images have, each once."""
    return pixels.select(*KEY).distinct()


def in_circle(slow: float, fast: float, radius: float) -> Column:
    return F.pow(F.col("slow") - slow, 2) + F.pow(F.col("fast") - fast, 2) <= radius * radius


def in_rectangle(slow0: float, slow1: float, fast0: float, fast1: float) -> Column:
    return F.col("slow").between(slow0, slow1) & F.col("fast").between(fast0, fast1)


def static_mask(pixels: DataFrame, regions: Sequence[Column] = (), untrusted_panels: Sequence[int] = ()) -> DataFrame:
    """Good unless inside a region, on any panel, or on an untrusted panel."""
    bad = F.lit(False)
    for region in regions:
        bad = bad | region
    if untrusted_panels:
        bad = bad | F.col("panel_id").isin(*untrusted_panels)
    return pixels.select(*KEY, (~bad).alias("good"))


def pixel_statistics(pixels: DataFrame) -> DataFrame:
    """Sum, count, least and greatest raw value of each pixel over images: partial aggregates."""
    return pixels.groupBy(*KEY).agg(F.sum("raw").alias("total"), F.count("raw").alias("n"), F.min("raw").alias("low"), F.max("raw").alias("high"))


def hot_or_negative(low: Column, high: Column, hot: float | None, negative: float) -> Column:
    """Whether a range of values goes over hot or under -|negative|."""
    out = low < -abs(negative)
    return out if hot is None else out | (high > hot)


def dynamic_mask(statistics: DataFrame, hot: float | None = 1e6, negative: float = 0.0) -> DataFrame:
    """Good unless a value was over hot or under -|negative|; a pixel never seen is good."""
    bad = hot_or_negative(F.col("low"), F.col("high"), hot, negative)
    return statistics.select(*KEY, (F.coalesce(F.col("n"), F.lit(0)).eqNullSafe(0) | ~F.coalesce(bad, F.lit(False))).alias("good"))


def combined_mask(one: DataFrame, other: DataFrame) -> DataFrame:
    other = other.withColumnRenamed("good", "_other")
    return one.join(other, KEY).select(*KEY, (F.col("good") & F.col("_other")).alias("good"))


def box_pixels(reflections: DataFrame, half: int = 2, n_slow: int | None = None, n_fast: int | None = None) -> DataFrame:
    """reflections, once for each pixel (slow, fast) of the box around its spot (panel_id, x, y; x is fast): rounded half to even, clipped.
    Generated, not range-joined."""
    x, y = F.rint("x").cast("int"), F.rint("y").cast("int")

    def side(centre: Column, n: int | None) -> Column:
        low, high = F.greatest(centre - half, F.lit(0)), centre + half if n is None else F.least(centre + half, F.lit(n - 1))
        return F.when(low <= high, F.sequence(low, F.greatest(low, high))).otherwise(F.array().cast("array<int>"))

    rows = reflections.where(F.col("x").isNotNull() & F.col("y").isNotNull()).withColumn("slow", F.explode(side(y, n_slow)))
    return rows.withColumn("fast", F.explode(side(x, n_fast)))


def of_image(table: DataFrame) -> list[str]:
    """The key of a pixel: with the image where a table has one."""
    return ["image_id", *KEY] if "image_id" in table.columns else KEY


def spot_pixels(reflections: DataFrame, half: int = 2, n_slow: int | None = None, n_fast: int | None = None) -> DataFrame:
    """Pixels of the boxes around spots, each once; of each image for reflections with an image_id."""
    keys = of_image(reflections)
    own = [c for c in keys if c not in ("slow", "fast")]
    return box_pixels(reflections.select(*own, "x", "y"), half, n_slow, n_fast).select(*keys).distinct()


def spot_centres(reflections: DataFrame) -> DataFrame:
    """panel_id, x, y, frame of reflections, from the observed centroid, else the calculated one; ValueError without either."""
    for name in ("xyzobs_px", "xyzcal_px"):
        if name in reflections.columns:
            c = F.col(name)
            return reflections.select(F.coalesce(F.col("panel"), F.lit(0)).alias("panel_id") if "panel" in reflections.columns else F.lit(0).alias("panel_id"), c[0].alias("x"), c[1].alias("y"), c[2].alias("frame"))
    raise ValueError("reflections have no centroid")


def of_frame(spots: DataFrame, frame: int) -> DataFrame:
    """Spots whose frame rounds, half away from zero, to the given one."""
    return spots.where(F.round("frame") == frame)


def is_peak(code: Column) -> Column:
    """Whether a shoebox code has the foreground or the strong bit."""
    return code.bitwiseAND(FOREGROUND | STRONG) != 0


def shoebox_pixels(reflections: DataFrame, n_slow: int, n_fast: int) -> DataFrame:
    """Peak pixels of shoeboxes: cells with a foreground or strong bit, on the panel that z names, inside the panel; of each image for reflections with an image_id."""
    require_columns(reflections, ["shoebox"], "reflections")
    image = [c for c in of_image(reflections) if c == "image_id"]
    cells = reflections.select(*image, "shoebox", F.posexplode("shoebox.mask").alias("at", "code"))
    wide, high = F.col("shoebox.x2") - F.col("shoebox.x1"), F.col("shoebox.y2") - F.col("shoebox.y1")
    cells = cells.where((wide > 0) & (high > 0) & is_peak(F.col("code")))
    plane = F.greatest(wide * high, F.lit(1))
    cells = cells.select(
        *image, F.floor(F.col("shoebox.z1") + F.col("at") / plane).cast("int").alias("panel_id"),
        F.floor(F.col("shoebox.y1") + (F.col("at") % plane) / F.greatest(wide, F.lit(1))).cast("int").alias("slow"),
        (F.col("shoebox.x1") + F.col("at") % F.greatest(wide, F.lit(1))).cast("int").alias("fast"),
    )
    return cells.where(F.col("slow").between(0, n_slow - 1) & F.col("fast").between(0, n_fast - 1)).distinct()


def total_mask(mask: DataFrame, peaks: DataFrame) -> DataFrame:
    """Good pixels that no peak covers."""
    marked = peaks.select(*KEY, F.lit(True).alias("_peak")).distinct()
    return mask.join(marked, KEY, "left").select(*KEY, (F.col("good") & F.col("_peak").isNull()).alias("good"))


def image_masks(pixels: DataFrame, mask: DataFrame | None, peaks: DataFrame | None) -> DataFrame:
    """pixels (image_id, panel_id, slow, fast, ...) with good: whether the mask that all images share calls the pixel good (a pixel that it lacks is good)
    and no peak of the pixel's own image covers it (peaks: image_id, panel_id, slow, fast). Equi-joins; images without peaks keep the shared mask."""
    out, good = pixels, F.lit(True)
    if mask is not None:
        out, good = out.join(mask.select(*KEY, F.col("good").alias("_shared")), KEY, "left"), F.coalesce("_shared", F.lit(True))
    if peaks is not None:
        keys = of_image(peaks)
        out, good = out.join(peaks.select(*keys, F.lit(True).alias("_peak")).distinct(), keys, "left"), good & F.col("_peak").isNull()
    return out.withColumn("good", good).select(*[c for c in pixels.columns if c != "good"], "good")


def mask_summary(mask: DataFrame) -> DataFrame:
    """Pixels, good pixels and their share, by panel."""
    return mask.groupBy("panel_id").agg(F.count("*").alias("n"), F.count_if("good").alias("n_good")).withColumn("good_share", F.col("n_good") / F.col("n"))


def incompatible_panels(one: DataFrame, other: DataFrame) -> DataFrame:
    """Panels of different extent in two masks, or in one only; empty if the masks fit."""
    size = lambda m, s: m.groupBy("panel_id").agg(F.count("*").alias(f"n{s}"), F.max("slow").alias(f"slow{s}"), F.max("fast").alias(f"fast{s}"))
    both = size(one, 1).join(size(other, 2), "panel_id", "full")
    return both.where(~(F.col("n1").eqNullSafe(F.col("n2")) & F.col("slow1").eqNullSafe(F.col("slow2")) & F.col("fast1").eqNullSafe(F.col("fast2"))))

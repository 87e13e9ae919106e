"""Frames of images among several scans: which scan, and which of its frames, an image's angle belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rounding of angles that is forgiven at the beginning of a frame, in frames.
SLACK = 1e-9


def framed(images: DataFrame, scans: DataFrame, by: tuple[str, ...] = (), step: float = 5.0) -> DataFrame:
    """images (image_id, angle, ...) with scan_id, frame (from 0), n_scans (that have the angle) and message.

    scans: scan_id, start, width (of a frame, of either sign, not 0) and n_frames; by: columns of both that must agree, such as the run. Where scans overlap, the
    least scan_id counts. An angle that no scan has, or a null one, has an outcome of its own: scan_id and frame are null, message says so.

    The join of an angle with ranges is one of equal bins: each scan is listed for every bin of ``step`` degrees that it touches, so no image
    meets scans that are far from it. A scan of a whole turn has 360 / step rows.
    """
    end = F.col("start") + F.col("width") * F.col("n_frames")
    low, high = F.least("start", end) - F.abs("width") * SLACK, F.greatest("start", end)
    listed = scans.where("width <> 0 and n_frames > 0").select(*by, "scan_id", "start", "width", "n_frames", F.explode(F.sequence(F.floor(low / step), F.floor(high / step))).alias("_bin"))
    frame = F.floor((F.col("angle") - F.col("start")) / F.col("width") + SLACK).cast("int")
    asked = images.select(*by, "angle").distinct().where("angle is not null").withColumn("_bin", F.floor(F.col("angle") / step))
    hits = asked.join(listed, [*by, "_bin"]).withColumn("_frame", frame).where((F.col("_frame") >= 0) & (F.col("_frame") < F.col("n_frames")))
    found = hits.groupBy(*by, "angle").agg(F.min(F.struct("scan_id", F.col("_frame").alias("frame"))).alias("_first"), F.countDistinct("scan_id").alias("n_scans"))
    out = images.join(found, [*by, "angle"], "left").select(*images.columns, F.col("_first.scan_id").alias("scan_id"), F.col("_first.frame").alias("frame"), F.coalesce("n_scans", F.lit(0)).alias("n_scans"))
    message = F.when(F.col("angle").isNull(), "no angle in the header").when(F.col("n_scans") == 0, "no scan has this angle")
    return out.withColumn("message", message)


def with_scan_models(framed_images: DataFrame, models: DataFrame) -> DataFrame:
    """Images with the model of their frame (models: scan_id, frame, ...): of a frame without one, that of the nearest earlier frame which has one (an as-of join), else null.

    Models are known at some frames of a scan; each is valid up to the next, so the join is with ranges of whole frames, listed by frame."""
    from pyspark.sql import Window

    names = [c for c in models.columns if c not in ("scan_id", "frame")]
    last = framed_images.where("scan_id is not null").groupBy("scan_id").agg(F.max("frame").alias("_last"))
    ranges = models.join(last, "scan_id").withColumn("_next", F.lead("frame").over(Window.partitionBy("scan_id").orderBy("frame")))
    until = F.greatest(F.least(F.coalesce(F.col("_next") - 1, F.col("_last")), F.col("_last")), F.col("frame"))
    valid = ranges.select("scan_id", F.explode(F.sequence(F.col("frame"), until)).alias("frame"), F.struct(*names).alias("_model"))
    out = framed_images.join(valid, ["scan_id", "frame"], "left")
    return out.select(*framed_images.columns, *[F.col(f"_model.{c}").alias(c) for c in names])

"""Batches of images: defaults, the route of each image, the gate of the merging phase, and the phase itself."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reciprospark.operators import grid as grids
from reciprospark.operators import merging, scaling, validation
from reciprospark.operators.pixels import Beam, Extraction, Panel, observations, unfolded
from reciprospark.sources import store
from reciprospark.sources.headers import route
from reciprospark.sources.shared import scratch


@dataclass(frozen=True)
class MergePhase:
    """Settings of the merging phase."""

    d_min: float = 1.0
    d_max: float = 10.0
    ndiv: tuple[int, int, int] = (5, 5, 5)
    rounds: int = 10
    tolerance: float = 1e-4
    reject: float | None = 3.0
    least: int = 2
    method: str = "inverse_variance"


def routed(images: DataFrame, forced: Column | str | None = None, legacy: bool = False) -> DataFrame:
    """images (increment) with route; each image by its own header."""
    return images.withColumn("route", route(F.col("increment"), forced, legacy))


def error_code(message: Column) -> Column:
    """The code of a failure from its message; the first that fits. The codes and their order."""
    low = F.lower(message)
    return (
        F.when(message.contains("Input") | low.contains("not found"), "InputFileError")
        .when(low.contains("consistency"), "ConsistencyCheckFailed")
        .when(low.contains("background"), "BackgroundFileError")
        .when(low.contains("write") | low.contains("save"), "OutputWriteError")
        .when(message.contains("DIALS") | low.contains("model"), "DIALSModelIncomplete")
        .otherwise("ProcessingError")
    )


@dataclass(frozen=True)
class Defaults:
    """Settings of a batch before the merging phase."""

    gain: float = 1.0
    cell_length_tolerance: float = 0.02
    cell_angle_tolerance: float = 2.0
    orientation_tolerance: float = 5.0
    q_tolerance: float = 0.01
    pixel_step: int = 1
    lp_correction: bool = False
    hot_pixel: float = 1e6
    negative_pixel: float = 0.0
    most_bad_pixels: float = 0.1
    peak_border: int = 2
    least_partiality: float = 0.1
    min_spot_area: int = 3

    def rows(self) -> list[tuple[str, str]]:
        return [(f.name, str(getattr(self, f.name))) for f in fields(self)]

    def filled(self, settings: DataFrame) -> DataFrame:
        """settings (a row for each image or batch) with every setting as a column: the row's own where it has one that is not null, else the default."""
        have = {c.lower() for c in settings.columns}
        return settings.withColumns({f.name: F.coalesce(F.col(f.name), F.lit(getattr(self, f.name))) if f.name in have else F.lit(getattr(self, f.name)) for f in fields(self)})


def process_batch(
    images: DataFrame, panel: Panel | DataFrame, beam: Beam | DataFrame, settings: Extraction = Extraction(), bad: DataFrame | None = None,
    forced: str | None = None, peaks: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All images of a batch at once: their observations, and one outcome for each image.

    images: image_id, panel_id, n_slow, n_fast, data (array), increment. An image without data, with data of another size than it
    says, or without a beam or panel in the tables of models, fails by itself: it has an outcome with an error code and no observations; the others
    go on. bad: pixels of the mask that all share; peaks: of each image. The observations are written once to the shared folder and counted from there.
    """
    size = F.col("n_slow") * F.col("n_fast")
    doubt = F.when(F.col("data").isNull(), F.lit("Input image not found")).when(F.size("data") != size, F.lit("image of another size than its header says"))
    checked = routed(images, forced).withColumn("message", doubt)
    if isinstance(panel, DataFrame) and isinstance(beam, DataFrame):
        known = checked.join(panel.select("panel_id", F.lit(True).alias("_panel")).distinct(), "panel_id", "left").join(beam.select("image_id", F.lit(True).alias("_beam")).distinct(), "image_id", "left")
        lacks = F.when(F.col("_panel").isNull(), F.lit("no panel model")).when(F.col("_beam").isNull(), F.lit("no beam model"))
        checked = known.withColumn("message", F.coalesce("message", lacks)).drop("_panel", "_beam")
    found = observations(unfolded(checked.where("message is null")), panel, beam, settings, bad, peaks=peaks).withColumnRenamed("image_id", "still_id")
    path = scratch(images.sparkSession, "extracted")
    found.write.parquet(path)
    found = images.sparkSession.read.schema(found.schema).parquet(path)
    counts = found.groupBy("still_id").agg(F.count("*").alias("n_observations")).withColumnRenamed("still_id", "image_id")
    out = checked.select("image_id", "route", "message").join(counts, "image_id", "left")
    failed = F.col("message").isNotNull()
    out = out.select("image_id", "route", F.when(failed, "FAILURE").otherwise("SUCCESS").alias("status"), "message", F.when(failed, error_code(F.col("message"))).alias("error_code"), F.coalesce("n_observations", F.lit(0).cast("long")).alias("n_observations"))
    return found, out


def consistency_outcome(checked: DataFrame) -> DataFrame:
    """status, message and error_code of what validation.q_consistency found."""
    message = F.when(~F.col("passed"), F.lit("q consistency check failed"))
    return checked.select("n", F.when(F.col("passed"), "SUCCESS").otherwise("FAILURE").alias("status"), message.alias("message"), F.when(~F.col("passed"), error_code(message)).alias("error_code"))


def outcome_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("status", "error_code").agg(F.count("*").alias("n"))


def may_merge(n_outputs: int, settings: MergePhase | None) -> bool:
    return settings is not None and n_outputs >= 2


def gate(outcomes: DataFrame, settings: MergePhase | None, *by: str) -> DataFrame:
    """Of each batch (by): n_outputs, its images that succeeded, and may_merge."""
    found = outcomes.groupBy(*by).agg(F.count_if(F.col("status") == "SUCCESS").alias("n_outputs"))
    return found.withColumn("may_merge", F.lit(settings is not None) & (F.col("n_outputs") >= 2))


def processed_and_validated(
    images: DataFrame, reflections: DataFrame, crystals: DataFrame, panel: Panel | DataFrame, s0, references: DataFrame | None = None,
    settings: Defaults = Defaults(), forced: str | None = None,
) -> DataFrame:
    """One outcome for each image (image_id, increment): its route, what indexing found, the checks of its geometry, and a status.

    reflections (image_id, x, y, s1, ...; panel_id for a table of panels) and crystals (image_id, cell, space_group) are what indexing gave; an image
    without either failed there. Its geometry passes if the residuals of q are within the tolerance (the mean) and five times it (the greatest),
    and its cell, where references has one for its space group, is within the tolerances. Each table is aggregated by image once, and joined.

    Fixed values: the names of status and error codes."""
    d = F.col("delta")
    residuals = validation.q_residuals(reflections, panel, s0).groupBy("image_id").agg(F.count("*").alias("n_reflections"), F.avg(d).alias("mean_residual"), F.max(d).alias("max_residual"))
    cells = crystals.withColumn("mismatch", F.lit(None).cast("string")).withColumn("_known", F.lit(False))
    if references is not None:
        known = references.select("space_group", F.lit(True).alias("_known")).distinct()
        cells = validation.cell_mismatch_of(crystals, references, settings.cell_length_tolerance, settings.cell_angle_tolerance).join(known, "space_group", "left")
    cells = cells.groupBy("image_id").agg(F.min("mismatch").alias("mismatch"), F.when(F.max(F.coalesce("_known", F.lit(False))), F.count("mismatch") == 0).alias("cell_ok"))
    out = routed(images, forced).select("image_id", "route").join(residuals, "image_id", "left").join(cells.withColumn("_crystal", F.lit(True)), "image_id", "left")
    indexed = F.col("_crystal").isNotNull() & F.col("n_reflections").isNotNull()
    q_ok = (F.col("mean_residual") <= settings.q_tolerance) & (F.col("max_residual") <= 5 * settings.q_tolerance)
    out = out.withColumns({"q_ok": F.coalesce(q_ok, F.lit(False)), "orientation_ok": F.lit(None).cast("boolean")})
    passed = validation.geometry_passed()
    status = F.when(~indexed, "FAILURE_DIALS_PROCESSING").when(passed, "SUCCESS").otherwise("FAILURE_GEOMETRY_VALIDATION")
    code = F.when(~indexed, "DIALS_PROCESSING_FAILED").when(~passed, "GEOMETRY_VALIDATION_FAILED")
    message = F.when(~indexed, "no crystal or reflections").when(passed, "Processed and validated").otherwise("Validation failed")
    return out.select("image_id", "route", status.alias("status"), code.alias("error_code"), message.alias("message"), F.coalesce("n_reflections", F.lit(0).cast("long")).alias("n_reflections"), "mean_residual", "max_residual", F.when(indexed, F.col("q_ok")).alias("q_ok"), "cell_ok", "mismatch")


def merge_phase(obs: DataFrame, setting, settings: MergePhase = MergePhase()) -> tuple[DataFrame, dict]:
    """Grid, binning, refinement and merge of observations of several stills: the map, and numbers of the run.

    The binned observations are stored once, dealt by voxel: refinement, rejection and merging read them as they lie."""
    grid = grids.fit(obs, setting, settings.ndiv, settings.d_min, settings.d_max)
    path = scratch(obs.sparkSession, "binned")
    binned = store.create(grids.binned(obs, grid), path)
    model, info = scaling.refine(binned, None, settings.rounds, settings.tolerance, settings.tolerance, dealt=binned)
    voxels = merging.merge(scaling.applied(model.scaled(binned)), grid, settings.method, settings.least, settings.reject)
    return voxels, info | {"grid": grid.summary(), "scales": scaling.model_info(model.scales, "b").first().asDict()}

"""Sinks: Parquet for rows, JSON and text for the few numbers of a run; all through Spark's writers, to any store that it reaches."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reciprospark.operators.grid import Grid
from reciprospark.operators.scaling import ScaleModel
from reciprospark.schema import MASK, OUTCOMES, require_columns
from reciprospark.sources.tables import VOXEL_COLUMNS


def save_observations(obs: DataFrame, path: str) -> None:
    """Pixel coordinates are kept only if all three are there."""
    extra = [c for c in ("panel_id", "fast", "slow") if c in obs.columns]
    names = [c for c in obs.columns if c not in ("panel_id", "fast", "slow")]
    obs.select(*names, *(extra if len(extra) == 3 else [])).write.mode("overwrite").parquet(path)


def save_voxels(voxels: DataFrame, path: str, kind: str = "parquet") -> None:
    if kind != "parquet":
        raise ValueError(f"unknown voxel format {kind!r}")
    require_columns(voxels, VOXEL_COLUMNS, "voxels").select(*VOXEL_COLUMNS).repartitionByRange("voxel_idx").sortWithinPartitions("voxel_idx").write.mode("overwrite").parquet(path)


def save_q_map(q_map: DataFrame, path: str) -> None:
    q_map.write.mode("overwrite").partitionBy("panel_id").parquet(path)


def append_binned(binned: DataFrame, path: str) -> None:
    binned.write.mode("append").parquet(path)


def append_outcomes(spark: SparkSession, outcomes: DataFrame | list[tuple], path: str) -> None:
    """Add outcomes to a run log: a table of any of the columns of schema.OUTCOMES, or a few rows of all of them."""
    if isinstance(outcomes, DataFrame):
        kinds = [tuple(x.split(" ", 1)) for x in OUTCOMES.split(", ", 4)]
        rows = outcomes.select(*[(F.col(n) if n in outcomes.columns else F.lit(None)).cast(kind).alias(n) for n, kind in kinds])
    else:
        rows = spark.createDataFrame(outcomes, OUTCOMES).coalesce(1)
    rows.write.mode("append").parquet(path)


def save_mask(mask: DataFrame, path: str) -> None:
    names = [f.split()[0] for f in MASK.split(", ")]
    require_columns(mask, names, "mask").select(*names).write.mode("overwrite").parquet(path)


def save_text(spark: SparkSession, lines: list[str], path: str) -> None:
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def save_json(spark: SparkSession, numbers: dict, path: str) -> None:
    save_text(spark, [json.dumps(numbers, sort_keys=True)], path)


def save_grid(spark: SparkSession, grid: Grid, path: str) -> None:
    save_text(spark, [grid.to_json()], path)


def save_scale_model(spark: SparkSession, model: ScaleModel, statistics: dict, path: str) -> None:
    s = model.smoother
    smoother = {"values": list(s.values), "q_min": s.q_min, "q_max": s.q_max} if s else None
    save_json(spark, {"refined_parameters": {"stills": {str(k): v for k, v in model.stills.items()}, "smoother": smoother}, "refinement_statistics": statistics}, path)


def save_report(numbers: DataFrame, path: str, title: str = "report") -> None:
    """The rows of a report as text: a line "name: value" for each column of each row. Reports have a few rows."""
    lines = [f"{c}: {v}" for r in numbers.collect() for c, v in r.asDict().items()]
    save_text(numbers.sparkSession, [f"# {title}", *lines], path)


def save_experiments(beam: DataFrame, panel: DataFrame, crystal: DataFrame, path: str) -> None:
    """One experiment file in JSON, for exchange, as tables.experiments reads it; lists are in order of image_id, panel_id and still_id. It is one row of one
    task: for the few thousand models of an experiment. See save_models for any number."""

    def listed(df: DataFrame, key: str) -> DataFrame:
        rows = F.sort_array(F.collect_list(F.struct(F.col(key).alias("_k"), F.struct(*[c for c in df.columns if c != key]).alias("_v"))))
        return df.agg(F.transform(rows, lambda x: x["_v"]).alias("list"))

    out = listed(beam, "image_id").select(F.col("list").alias("beam")).crossJoin(listed(crystal, "still_id").select(F.col("list").alias("crystal")))  # one row each
    out = out.crossJoin(listed(panel, "panel_id").select(F.array(F.struct(F.col("list").alias("panels"))).alias("detector")))
    out.coalesce(1).write.mode("overwrite").json(path)


MODELS = ("beam", "panel", "crystal", "reflections")


def save_models(path: str, **models: DataFrame) -> None:
    """Models of any number of images: of beam, panel, crystal and reflections those given, each a table under path with a row for each item;
    reflections are sorted by image where they have one. tables.models reads them."""
    if unknown := sorted(set(models) - set(MODELS)):
        raise ValueError(f"no models: {', '.join(unknown)}")
    for name, rows in models.items():
        if "image_id" in rows.columns:
            rows = rows.repartitionByRange("image_id").sortWithinPartitions("image_id")
        rows.write.mode("overwrite").parquet(f"{path}/{name}")


def save_manifest(outputs: DataFrame, path: str) -> None:
    outputs.write.mode("overwrite").json(path)

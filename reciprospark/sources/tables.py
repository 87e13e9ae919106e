"""Tables of the engine from files: Parquet as the normal form, JSON experiments, NPY and NPZ arrays."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reciprospark.operators import masks
from reciprospark.operators.grid import Grid
from reciprospark.operators.scaling import ScaleModel, Smoother
from reciprospark.schema import require_columns
from reciprospark.sources.headers import reference_cell

VOXEL_COLUMNS = ("voxel_idx", "H_center", "K_center", "L_center", "q_center_x", "q_center_y", "q_center_z", "q_magnitude_center", "I_merged_relative", "Sigma_merged_relative", "num_observations")


def parquet(spark: SparkSession, path: str, required=()) -> DataFrame:
    return require_columns(spark.read.parquet(path), required, path)


def _plain(path: Column) -> Column:
    """A path without the scheme and with single slashes."""
    return F.regexp_replace(F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:", ""), r"/+", "/")


def observations(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Observation tables, files or folders, one for each still; still_id is the place in the list.

    One scan of all files, whatever their number, joined to the list by the file's path or its folder's."""
    if not paths:
        raise ValueError("no observation tables")
    rows = spark.read.option("mergeSchema", True).parquet(*paths)
    require_columns(rows, ("qx", "qy", "qz", "intensity", "sigma"), ", ".join(paths[:3]))
    list_ = spark.createDataFrame([(p.rstrip("/"), k) for k, p in enumerate(paths)], "_p string, still_id int").select(_plain(F.col("_p")).alias("_p"), "still_id")
    rows = rows.drop("still_id").withColumn("_file", F.col("_metadata.file_path"))
    at = F.explode(F.array(_plain(F.col("_file")), F.regexp_replace(_plain(F.col("_file")), r"/[^/]*$", "")))
    files = rows.select("_file").distinct().select("_file", at.alias("_p")).join(list_, "_p").select("_file", "still_id")
    return rows.join(files, "_file").drop("_file")


def reflections(spark: SparkSession, path: str) -> DataFrame:
    """Reflections as Parquet: refl_id and a centroid, observed or calculated; the other columns of schema.REFLECTIONS where the file has them."""
    out = parquet(spark, path, ("refl_id",))
    if not {"xyzobs_px", "xyzcal_px"} & set(out.columns):
        raise ValueError(f"{path} lacks columns: xyzobs_px or xyzcal_px")
    return out


def mask(spark: SparkSession, path: str) -> DataFrame:
    """A pixel mask: panel_id, slow, fast, good. A null verdict is not good."""
    return parquet(spark, path, ("panel_id", "slow", "fast", "good")).select("panel_id", "slow", "fast", F.coalesce("good", F.lit(False)).alias("good"))


def background(spark: SparkSession, path: str) -> DataFrame:
    """A measured background: panel_id, slow, fast, bg."""
    return parquet(spark, path, ("panel_id", "slow", "fast", "bg"))


def observations_npz(spark: SparkSession, path: str) -> DataFrame:
    """Files of arrays q_vectors, intensities, sigmas, with optional pixel coordinates, as rows; each file is one task's work."""
    fields = "path string, qx double, qy double, qz double, intensity double, sigma double, panel_id int, fast int, slow int"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                with np.load(io.BytesIO(r.content), allow_pickle=False) as data:
                    if lack := {"q_vectors", "intensities", "sigmas"} - set(data.files):
                        raise ValueError(f"{r.path} lacks {', '.join(sorted(lack))}")
                    q = data["q_vectors"]
                    out = {"path": r.path, "qx": q[:, 0], "qy": q[:, 1], "qz": q[:, 2], "intensity": data["intensities"], "sigma": data["sigmas"]}
                    for name, key in (("panel_id", "original_panel_ids"), ("fast", "original_fast_coords"), ("slow", "original_slow_coords")):
                        out[name] = data[key] if key in data.files else None
                yield pd.DataFrame(out)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, fields)


def background_npy(spark: SparkSession, path: str, panel_id: int = 0) -> DataFrame:
    """A two-dimensional array as (panel_id, slow, fast, bg)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for content in f["content"]:
                a = np.load(io.BytesIO(content), allow_pickle=False)
                if a.ndim != 2:
                    raise ValueError("a background map has two dimensions")
                slow, fast = np.indices(a.shape)
                yield pd.DataFrame({"panel_id": panel_id, "slow": slow.ravel(), "fast": fast.ravel(), "bg": a.ravel().astype(float)})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "panel_id int, slow int, fast int, bg double")


def voxels(spark: SparkSession, path: str) -> DataFrame:
    """A merged map: Parquet, or NPZ by the end of its name."""
    if path.endswith((".h5", ".hdf5")):
        raise ValueError(f"{path}: merged maps are read from Parquet or .npz")
    return voxels_npz(spark, path) if path.endswith(".npz") else parquet(spark, path, VOXEL_COLUMNS)


def voxels_npz(spark: SparkSession, path: str) -> DataFrame:
    """Files of eleven arrays of equal length as rows; the index is named voxel_indices there."""
    kinds = ", ".join(f"{c} {'long' if c in ('voxel_idx', 'num_observations') else 'double'}" for c in VOXEL_COLUMNS)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                with np.load(io.BytesIO(r.content), allow_pickle=False) as data:
                    names = {c: "voxel_indices" if c == "voxel_idx" else c for c in VOXEL_COLUMNS}
                    if lack := set(names.values()) - set(data.files):
                        raise ValueError(f"{r.path} lacks {', '.join(sorted(lack))}")
                    yield pd.DataFrame({c: data[n] for c, n in names.items()})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, kinds)


def experiments(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """beam, panel and crystal tables of an experiment file in JSON; ValueError if it lists none."""
    found = spark.read.option("multiLine", True).json(path)
    require_columns(found, ("beam", "detector", "crystal"), path)
    if found.isEmpty():
        raise ValueError(f"{path} has no experiments")
    beam = found.select(F.posexplode("beam").alias("image_id", "b")).select("image_id", "b.*")
    panel = found.select(F.explode("detector").alias("d")).select(F.posexplode("d.panels").alias("panel_id", "p")).select("panel_id", "p.*")
    crystal = found.select(F.posexplode("crystal").alias("still_id", "c")).select("still_id", "c.*")
    return {"beam": beam, "panel": panel, "crystal": crystal}


def models(spark: SparkSession, path: str, *names: str) -> dict[str, DataFrame]:
    """The named tables that sinks.save_models has written."""
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}


def reference_cells(spark: SparkSession, path: str) -> DataFrame:
    """Cells of CRYST1 records of text files."""
    return spark.read.text(path).select(reference_cell(F.col("value")).alias("c")).where("c is not null").select("c.*")


def settings(spark: SparkSession, text_or_path: str, required=()) -> dict:
    """A configuration: JSON text if it starts with a brace, else a file of it, wherever Spark reads; ValueError names the keys that it lacks."""
    text = text_or_path
    if not text.lstrip().startswith("{"):
        text = "\n".join(r.value for r in spark.read.text(text_or_path, wholetext=True).collect())  # one small file
    found = json.loads(text)
    if lack := [k for k in required if k not in found]:
        raise ValueError(f"{text_or_path[:80]} lacks {', '.join(lack)}")
    return found


def grid(spark: SparkSession, text_or_path: str) -> Grid:
    return Grid.from_json(json.dumps(settings(spark, text_or_path)))


def scale_model(spark: SparkSession, text_or_path: str) -> ScaleModel:
    """Refined scales as sinks.save_scale_model writes them."""
    found = settings(spark, text_or_path, ("refined_parameters", "refinement_statistics"))["refined_parameters"]
    smoother = found.get("smoother")
    return ScaleModel({int(k): float(v) for k, v in found["stills"].items()}, Smoother(tuple(smoother["values"]), smoother["q_min"], smoother["q_max"]) if smoother else None)


def static_regions(config: dict) -> tuple[list[Column], list[int]]:
    """Regions and untrusted panels of a mask configuration: beamstop (type circle or rectangle), untrusted_rects, untrusted_panels. x is fast."""
    shapes = [config["beamstop"]] if config.get("beamstop") else []
    out = []
    for shape in [*shapes, *[{"type": "rectangle"} | r for r in config.get("untrusted_rects") or []]]:
        if shape.get("type") == "circle":
            out.append(masks.in_circle(shape["center_y"], shape["center_x"], shape["radius"]))
        elif shape.get("type") == "rectangle":
            out.append(masks.in_rectangle(shape["min_y"], shape["max_y"], shape["min_x"], shape["max_x"]))
        else:
            raise ValueError(f"a region is a circle or a rectangle, not {shape.get('type')!r}")
    return out, list(config.get("untrusted_panels") or [])

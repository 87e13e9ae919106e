"""Schemas of the engine's tables, and checks of them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIXELS = "image_id int, panel_id int, slow int, fast int, raw double"
MASK = "panel_id int, slow int, fast int, good boolean"
BACKGROUND = "panel_id int, slow int, fast int, bg double"
BEAM = "image_id int, wavelength double, s0x double, s0y double, s0z double"
PANEL = "panel_id int, n_fast int, n_slow int, px_fast double, px_slow double, origin array<double>, fast_axis array<double>, slow_axis array<double>"
CRYSTAL = "still_id int, a double, b double, c double, alpha double, beta double, gamma double, u array<double>, space_group string"
SHOEBOX = "struct<z1: int, y1: int, x1: int, z2: int, y2: int, x2: int, mask: array<int>>"
REFLECTIONS = f"refl_id bigint, miller_index array<int>, panel int, s1 array<double>, xyzobs_px array<double>, xyzcal_px array<double>, partiality double, shoebox {SHOEBOX}"
OBSERVATIONS = "still_id int, qx double, qy double, qz double, intensity double, sigma double"
SCALES = "still_id int, multiplicative_scale double, additive_offset double"
VOXELS = (
    "voxel_idx bigint, H_center double, K_center double, L_center double, q_center_x double, q_center_y double, q_center_z double, "
    "q_magnitude_center double, I_merged_relative double, Sigma_merged_relative double, num_observations bigint"
)
OUTCOMES = "input_path string, status string, message string, error_code string, artifacts map<string, string>"


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return sorted(c for c in required if c not in have)


def require_columns(df: DataFrame, required: Iterable[str], what: str = "table") -> DataFrame:
    """df itself, or ValueError that names what it lacks."""
    if lack := missing_columns(df, required):
        raise ValueError(f"{what} lacks columns: {', '.join(lack)}")
    return df


def lacking(have: Column, required: Iterable[str]) -> Column:
    """Of an array of the columns that a file has: those required that it lacks, sorted; for a manifest of any number of files."""
    return F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.coalesce(have, F.array().cast("array<string>"))))

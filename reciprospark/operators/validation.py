"""Checks of geometry and of reflections against models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reciprospark.functions import vec
from reciprospark.operators import quantiles
from reciprospark.operators.pixels import Panel, lab_position
from reciprospark.schema import missing_columns


def sampled(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, the same ones for a seed: those of smallest md5 of key and seed."""
    return rows.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary")), key).limit(n)


def q_residuals(reflections: DataFrame, panel: Panel | DataFrame, s0: tuple[float, float, float] | DataFrame) -> DataFrame:
    """reflections (s1 array, x, y) with delta: |(s1 - s0) - (|s0| l - s0)|, l the direction to the pixel.

    panel: one for all, or a table joined by panel_id; s0: one for all, or a table of beams joined by image_id. Without a model: null."""
    out, added = reflections, []
    if isinstance(panel, DataFrame):
        added += ["_origin", "_fast", "_slow", "_px_fast", "_px_slow"]
        out = out.join(panel.select("panel_id", *[F.col(c).alias(n) for c, n in zip(("origin", "fast_axis", "slow_axis", "px_fast", "px_slow"), added, strict=True)]), "panel_id", "left")
        panel = Panel(*[tuple(F.col(n)[k] for k in range(3)) for n in added[:3]], F.col("_px_fast"), F.col("_px_slow"))
    if isinstance(s0, DataFrame):
        out = out.join(s0.select("image_id", *[F.col(f"s0{k}").alias(f"_s0{k}") for k in "xyz"]), "image_id", "left")
        s0, added = tuple(F.col(f"_s0{k}") for k in "xyz"), [*added, *[f"_s0{k}" for k in "xyz"]]
    length, lab = vec.norm(s0), lab_position(panel, F.col("y"), F.col("x"))
    r = vec.norm(lab)
    return out.withColumn("delta", vec.norm([F.col("s1")[k] - length * x / r for k, x in enumerate(lab)])).drop(*added)


def q_consistency(reflections: DataFrame, panel: Panel | DataFrame, s0: tuple[float, float, float] | DataFrame, tolerance: float = 0.01, most: int | None = 500, key: str = "refl_id") -> DataFrame:
    """One row: n, mean, median and max of the residuals of a sample (most None: of all rows), and passed. Missing columns or no rows: not passed."""
    if missing_columns(reflections, ["s1", "x", "y", key]):
        return reflections.sparkSession.range(1).select(F.lit(0).cast("long").alias("n"), *[F.lit(None).cast("double").alias(c) for c in ("mean", "median", "max")], F.lit(False).alias("passed"))
    d = F.col("delta")
    found = q_residuals(reflections if most is None else sampled(reflections, key, most), panel, s0)
    middle = quantiles.of(found, "delta", [0.5])[0]
    out = found.agg(F.count("*").alias("n"), F.avg(d).alias("mean"), F.max(F.lit(middle).cast("double")).alias("median"), F.max(d).alias("max"))
    return out.withColumn("passed", F.coalesce((F.col("mean") <= tolerance) & (F.col("max") <= 5 * tolerance), F.lit(False)))


def cell_mismatch(cells: DataFrame, reference: tuple[float, ...], length_tolerance: float, angle_tolerance: float) -> DataFrame:
    """cells (a .. gamma) with mismatch: the first parameter off, lengths by ratio, angles by difference; null if none is, or no reference."""
    out: Column = F.lit(None).cast("string")
    for k, c in reversed(list(enumerate(("a", "b", "c", "alpha", "beta", "gamma")))):
        off = F.abs(F.col(c) - reference[k])
        off = off > length_tolerance * reference[k] if k < 3 else off > angle_tolerance
        out = F.when(off, F.lit(c)).otherwise(out)
    return cells.withColumn("mismatch", out)


def cell_mismatch_of(crystals: DataFrame, references: DataFrame, length_tolerance: float, angle_tolerance: float) -> DataFrame:
    """As cell_mismatch, against a table of reference cells (r_a .. r_gamma) joined by space_group; null where there is no reference."""
    names = ("a", "b", "c", "alpha", "beta", "gamma")
    both = crystals.join(references.select("space_group", *[f"r_{c}" for c in names]), "space_group", "left")
    out: Column = F.lit(None).cast("string")
    for k, c in reversed(list(enumerate(names))):
        off = F.abs(F.col(c) - F.col(f"r_{c}"))
        out = F.when(off > (length_tolerance * F.col(f"r_{c}") if k < 3 else F.lit(angle_tolerance)), F.lit(c)).otherwise(out)
    return both.withColumn("mismatch", out).drop(*[f"r_{c}" for c in names])


def enough_partiality(least: float = 0.1, column: str = "partiality") -> Column:
    """Whether a reflection is whole enough to be used; intensities are never divided by it. Unknown: not."""
    return F.coalesce(F.col(column) >= least, F.lit(False))


def rotation_angle(a1: np.ndarray, a2: np.ndarray) -> float:
    """Degrees of the rotation from one setting to the other, the lesser of both hands; 180 for a singular setting."""
    a1, a2 = np.asarray(a1, float).reshape(3, 3), np.asarray(a2, float).reshape(3, 3)
    if abs(np.linalg.det(a1)) < 1e-300:
        return 180.0
    each = [np.degrees(np.arccos(np.clip((np.trace(s * a2 @ np.linalg.inv(a1)) - 1) / 2, -1, 1))) for s in (1, -1)]
    return float(min(each))


def rotation_angles(pairs: DataFrame, one: str, other: str) -> DataFrame:
    """pairs of settings (arrays of nine, by rows) with angle, as rotation_angle gives it: column arithmetic on the inverse by cofactors."""
    a, b = ([[F.col(n)[3 * i + j] for j in range(3)] for i in range(3)] for n in (one, other))
    cofactors = [[a[(i + 1) % 3][(j + 1) % 3] * a[(i + 2) % 3][(j + 2) % 3] - a[(i + 1) % 3][(j + 2) % 3] * a[(i + 2) % 3][(j + 1) % 3] for j in range(3)] for i in range(3)]
    det = vec.dot(a[0], cofactors[0])
    flat = F.abs(det) < 1e-300
    trace = sum((b[i][j] * cofactors[i][j] for i in range(3) for j in range(3)), F.lit(0.0)) / F.when(flat, F.lit(1.0)).otherwise(det)  # of b times the inverse of a
    each = [F.degrees(F.acos(F.greatest(F.least((s * trace - 1) / 2, F.lit(1.0)), F.lit(-1.0)))) for s in (1, -1)]
    return pairs.withColumn("angle", F.when(flat, F.lit(180.0)).otherwise(F.least(*each)))


def geometry_passed() -> Column:
    """Of n_reflections, q_ok, cell_ok, orientation_ok: a check that was not made counts as passed."""
    return F.col("q_ok") & (F.col("n_reflections") > 0) & F.coalesce("cell_ok", F.lit(True)) & F.coalesce("orientation_ok", F.lit(True))

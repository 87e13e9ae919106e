"""Voxel grids in reciprocal space: mean crystal, bounds, index arithmetic."""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reciprospark.functions import vec

Q = ("qx", "qy", "qz")
HKL = ("h", "k", "l")
CELL = ("a", "b", "c", "alpha", "beta", "gamma")


@dataclass(frozen=True)
class Grid:
    """setting: A, which takes hkl to q; bounds are inclusive and count subdivisions."""

    setting: tuple[tuple[float, ...], ...]
    ndiv: tuple[int, int, int]
    low: tuple[int, int, int]
    high: tuple[int, int, int]

    def __post_init__(self) -> None:
        if any(n < 1 for n in self.ndiv):
            raise ValueError("subdivisions must be positive")
        if self.total_voxels >= 1 << 63:
            raise ValueError("the grid has too many voxels for 64-bit indices")

    @property
    def shape(self) -> tuple[int, ...]:
        return tuple(b - a + 1 for a, b in zip(self.low, self.high, strict=True))

    @property
    def total_voxels(self) -> int:
        return math.prod(self.shape)

    @property
    def inverse(self) -> tuple[tuple[float, ...], ...]:
        return tuple(map(tuple, np.linalg.inv(np.array(self.setting)).tolist()))

    def to_json(self) -> str:
        return json.dumps(asdict(self) | {"total_voxels": self.total_voxels})

    @classmethod
    def from_json(cls, text: str) -> Grid:
        found = json.loads(text)
        if lack := {"setting", "ndiv", "low", "high"} - set(found):
            raise ValueError(f"grid definition lacks {', '.join(sorted(lack))}")
        return cls(tuple(map(tuple, found["setting"])), *(tuple(found[k]) for k in ("ndiv", "low", "high")))

    def summary(self) -> dict:
        """Extent along each axis in units of hkl, and counts."""
        return {"shape": self.shape, "total_voxels": self.total_voxels, "extent": tuple((b - a) / n for a, b, n in zip(self.low, self.high, self.ndiv, strict=True))}


def reciprocal_basis(cell: tuple[float, ...]) -> np.ndarray:
    """B: columns are a*, b*, c* of a cell (lengths, angles in degrees), without 2 pi."""
    a, b, c, *angles = cell
    ca, cb, cg = (math.cos(math.radians(x)) for x in angles)
    sg = math.sin(math.radians(angles[2]))
    height = math.sqrt(max(1 - ca * ca - cb * cb - cg * cg + 2 * ca * cb * cg, 0.0)) / sg
    real = np.array([[a, b * cg, c * cb], [0, b * sg, c * (ca - cb * cg) / sg], [0, 0, c * height]])
    return np.linalg.inv(real).T


def with_settings(crystals: DataFrame) -> DataFrame:
    """crystals (a .. gamma, u) with setting: each one's own A = U B, nine by rows, in column arithmetic."""
    ca, cb, cg = (F.cos(F.radians(c)) for c in CELL[3:])
    sg = F.sin(F.radians(CELL[5]))
    height = F.sqrt(F.greatest(1 - ca * ca - cb * cb - cg * cg + 2 * ca * cb * cg, F.lit(0.0))) / sg
    r11, r12, r13, r22, r23, r33 = F.col("a"), F.col("b") * cg, F.col("c") * cb, F.col("b") * sg, F.col("c") * (ca - cb * cg) / sg, F.col("c") * height
    zero = F.lit(0.0)
    basis = ((1 / r11, zero, zero), (-r12 / (r11 * r22), 1 / r22, zero), ((r12 * r23 - r13 * r22) / (r11 * r22 * r33), -r23 / (r22 * r33), 1 / r33))
    cells = [sum((F.col("u")[3 * i + k] * basis[k][j] for k in (1, 2)), F.col("u")[3 * i] * basis[0][j]) for i in range(3) for j in range(3)]
    return crystals.withColumn("setting", F.array(*cells))


def mean_cell(crystals: DataFrame) -> tuple[float, ...]:
    row = crystals.agg(*[F.avg(c).alias(c) for c in CELL]).first()
    if row.a is None:
        raise ValueError("no crystals")
    return tuple(row[c] for c in CELL)


def misorientation(u: Column, of: Column) -> Column:
    """Degrees between two orientations (arrays of nine, by rows)."""
    trace = sum((u[k] * of[k] for k in range(1, 9)), u[0] * of[0])
    return F.degrees(F.acos((F.greatest(F.least(trace, F.lit(3.0)), F.lit(-1.0)) - 1.0) / 2.0))


def misorientations(crystals: DataFrame) -> DataFrame:
    """crystals with angle: degrees between each and the first still."""
    first = crystals.orderBy("still_id").limit(1).select(F.col("u").alias("_u"))
    return crystals.crossJoin(F.broadcast(first)).withColumn("angle", misorientation(F.col("u"), F.col("_u"))).drop("_u")  # one row


def orientation_spread(crystals: DataFrame) -> DataFrame:
    """Root mean square of the misorientations against the first still: one row, rms and n."""
    return misorientations(crystals).agg(F.sqrt(F.avg(F.col("angle") * F.col("angle"))).alias("rms"), F.count("*").alias("n"))


def check_spread(crystals: DataFrame, most: float = 2.0, warn: float = 1.0) -> tuple[float, bool]:
    """(rms degrees, whether to warn); ValueError beyond most. A single crystal has no spread."""
    row = orientation_spread(crystals).first()
    rms = row.rms or 0.0
    if row.n > 1 and rms > most:
        raise ValueError(f"orientations spread by {rms:.3f} degrees, more than {most}")
    return rms, row.n > 1 and rms > warn


def mean_orientation(crystals: DataFrame) -> np.ndarray:
    """The rotation nearest to the mean matrix."""
    row = crystals.agg(*[F.avg(F.col("u")[k]).alias(f"u{k}") for k in range(9)]).first()
    left, _, right = np.linalg.svd(np.array([row[f"u{k}"] for k in range(9)], dtype=float).reshape(3, 3))
    if np.linalg.det(left @ right) < 0:
        left[:, -1] *= -1
    return left @ right


def setting_matrix(crystals: DataFrame) -> tuple[tuple[float, ...], ...]:
    """A = U B of the mean crystal."""
    check_spread(crystals)
    return tuple(map(tuple, (mean_orientation(crystals) @ reciprocal_basis(mean_cell(crystals))).tolist()))


def with_hkl(obs: DataFrame, setting_inverse) -> DataFrame:
    """obs with h, k, l: fractional Miller indices."""
    found = vec.apply(setting_inverse, [F.col(c) for c in Q])
    return obs.withColumns(dict(zip(HKL, found, strict=True)))


def with_frame_hkl(obs: DataFrame, frames: DataFrame, setting_inverse) -> DataFrame:
    """As with_hkl, by the inverse (a_inv, nine by rows) of the observation's own frame where frames has it."""
    out = obs.join(frames.select("frame_idx", "a_inv"), "frame_idx", "left")
    own = [sum((F.col("a_inv")[3 * r + k] * F.col(Q[k]) for k in (1, 2)), F.col("a_inv")[3 * r] * F.col(Q[0])) for r in range(3)]
    mean = vec.apply(setting_inverse, [F.col(c) for c in Q])
    return out.withColumns({n: F.coalesce(a, b) for n, a, b in zip(HKL, own, mean, strict=True)}).drop("a_inv")


def in_resolution(obs: DataFrame, d_min: float, d_max: float) -> DataFrame:
    d = F.lit(1.0) / (vec.norm([F.col(c) for c in Q]) + 1e-10)
    return obs.where((d >= d_min) & (d <= d_max))


def hkl_bounds(hkl: DataFrame, ndiv: tuple[int, int, int]) -> DataFrame:
    """One row of inclusive bounds in subdivisions: low_h.. and high_h.. (one aggregation)."""
    low = [(F.floor(F.min(c) * n) - 1).cast("long").alias(f"low_{c}") for c, n in zip(HKL, ndiv, strict=True)]
    high = [(F.ceil(F.max(c) * n) + 1).cast("long").alias(f"high_{c}") for c, n in zip(HKL, ndiv, strict=True)]
    return hkl.agg(*low, *high)


def diagnostics(obs: DataFrame, crystals: DataFrame, grid: Grid) -> DataFrame:
    """One row: crystals and their spread, observations and those outside the grid, the range of the Miller indices, and how far they are from whole numbers."""
    hkl = with_hkl(obs, grid.inverse)
    inside = F.lit(True)
    for s, a, b in zip(subdivided(grid.ndiv), grid.low, grid.high, strict=True):
        inside = inside & s.between(a, b)
    off = sum((F.pow(F.col(c) - F.rint(c), 2) for c in HKL), F.lit(0.0))
    ranges = [f(c).alias(f"{n}_{c}") for c in HKL for f, n in ((F.min, "min"), (F.max, "max"))]
    found = hkl.agg(F.count("*").alias("n_observations"), F.count_if(~inside).alias("n_outside"), *ranges, F.sqrt(F.avg(off)).alias("rms_delta_hkl"))
    spread = orientation_spread(crystals).select(F.col("rms").alias("rms_misorientation"), F.col("n").alias("n_crystals"))
    return found.crossJoin(spread)  # one row each


def doubtful_observation() -> Column:
    """Why an observation cannot be binned or merged, null if it can."""
    unsound = lambda c: F.col(c).isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.when(unsound(Q[0]) | unsound(Q[1]) | unsound(Q[2]), "q is not finite").when(unsound("intensity"), "intensity is not finite").when(unsound("sigma") | (F.col("sigma") <= 0), "sigma is not positive")


def fit(obs: DataFrame, setting, ndiv: tuple[int, int, int], d_min: float | None = None, d_max: float | None = None) -> Grid:
    """The grid that holds the observations of a resolution range: one job with one row."""
    if (d_min is None) != (d_max is None) or (d_min is not None and not 0 < d_min < d_max):
        raise ValueError("give both resolution limits, the lower first, or none")
    kept = obs if d_min is None else in_resolution(obs, d_min, d_max)
    inverse = tuple(map(tuple, np.linalg.inv(np.array(setting, dtype=float)).tolist()))
    row = hkl_bounds(with_hkl(kept, inverse), ndiv).first()
    if row.low_h is None:
        raise ValueError("no observation is in the resolution range")
    return Grid(tuple(map(tuple, setting)), tuple(ndiv), tuple(row[f"low_{c}"] for c in HKL), tuple(row[f"high_{c}"] for c in HKL))


def subdivided(ndiv: tuple[int, int, int]) -> tuple[Column, ...]:
    """Grid steps of h, k, l: rounded half to even."""
    return tuple(F.rint(F.col(c) * n).cast("long") for c, n in zip(HKL, ndiv, strict=True))


def linear_index(steps, grid: Grid) -> Column:
    nh, nk, _ = grid.shape
    h, k, l = (s - a for s, a in zip(steps, grid.low, strict=True))  # noqa: E741
    return l * F.lit(nh * nk) + k * F.lit(nh) + h


def binned(obs: DataFrame, grid: Grid, operations=None, mode: str = "canonical") -> DataFrame:
    """obs with h, k, l and voxel_idx; observations outside the grid are dropped. operations: symmetry, applied before."""
    from reciprospark.operators.symmetry import reduced

    out = with_hkl(obs, grid.inverse)
    if operations is not None:
        out = reduced(out, operations, mode)
    steps = subdivided(grid.ndiv)
    inside = F.lit(True)
    for s, a, b in zip(steps, grid.low, grid.high, strict=True):
        inside = inside & s.between(a, b)
    return out.where(inside).withColumn("voxel_idx", linear_index(steps, grid))


def centre(index: Column, grid: Grid) -> tuple[Column, ...]:
    """hkl of a voxel's centre."""
    nh, nk, _ = grid.shape
    div = lambda x, n: F.call_function("div", x, F.lit(n).cast("long"))  # noqa: E731  whole numbers: an index may be beyond 2**53
    h = index % nh
    k = div(index % (nh * nk), nh)
    l = div(index, nh * nk)  # noqa: E741
    return tuple((x.cast("long") + a).cast("double") / n for x, a, n in zip((h, k, l), grid.low, grid.ndiv, strict=True))


def with_centres(voxels: DataFrame, grid: Grid) -> DataFrame:
    """voxels with H_center.., q_center_x.. and q_magnitude_center."""
    names = ("H_center", "K_center", "L_center")
    out = voxels.withColumns(dict(zip(names, centre(F.col("voxel_idx"), grid), strict=True)))
    q = ("q_center_x", "q_center_y", "q_center_z")
    out = out.withColumns(dict(zip(q, vec.apply(grid.setting, [F.col(c) for c in names]), strict=True)))
    return out.withColumn("q_magnitude_center", vec.norm([F.col(c) for c in q]))

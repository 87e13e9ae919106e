"""Relative scales of stills: lookup, resolution smoother, references, normal equations, refinement."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reciprospark.sources import store
from reciprospark.sources.shared import scratch

#: Up to so many stills, scales are a literal map in the plan; beyond, a table that is joined.
LITERAL_STILLS = 500
MOST_POINTS = 5
FLOOR, TINY, DAMPING = 0.01, 1e-10, 1e-6


@dataclass(frozen=True)
class Smoother:
    """A scale that depends on |q|: normalised Gaussian weights of equally spaced control points, at least FLOOR."""

    values: tuple[float, ...]
    q_min: float
    q_max: float

    def __post_init__(self) -> None:
        if not 1 <= len(self.values) <= MOST_POINTS:
            raise ValueError(f"a smoother has 1 to {MOST_POINTS} control points")
        if not self.q_min < self.q_max:
            raise ValueError("the range of |q| is empty")

    @property
    def points(self) -> list[float]:
        n = len(self.values)
        return [self.q_min] if n == 1 else [self.q_min + (self.q_max - self.q_min) * k / (n - 1) for k in range(n)]

    def weights(self, q: Column) -> list[Column]:
        """Derivatives of the scale by the control values, before the floor."""
        width = (self.q_max - self.q_min) / max(1, len(self.values) - 1)
        x = F.greatest(F.lit(self.q_min), F.least(F.lit(self.q_max), q))
        raw = [F.exp(-F.pow((x - p) / width, 2)) for p in self.points]
        total = raw[0]
        for r in raw[1:]:
            total = total + r
        return [r / total for r in raw]

    def column(self, q: Column) -> Column:
        out = F.lit(0.0)
        for v, w in zip(self.values, self.weights(q), strict=True):
            out = out + w * v
        return F.greatest(F.lit(FLOOR), out)

    def at(self, q: float) -> float:
        """The scale at one |q|; 1 where |q| is not positive."""
        if q <= 0:
            return 1.0
        width = (self.q_max - self.q_min) / max(1, len(self.values) - 1)
        x = min(max(q, self.q_min), self.q_max)
        w = [math.exp(-(((x - p) / width) ** 2)) for p in self.points]
        return max(FLOOR, sum(a * b for a, b in zip(w, self.values, strict=True)) / sum(w))


#: How many control points count at a place, and the width of their weights over their spacing.
NEAREST, WIDTH_RATIO = 3, 0.65


@dataclass(frozen=True)
class WindowedSmoother(Smoother):
    """A Smoother of which only the nearest control points count at a place, with a width that is a fixed share of their spacing. From four values
    on, the first and the last lie half a spacing beyond the ends of the range; two or three lie at its ends (and its middle)."""

    nearest: int = NEAREST
    ratio: float = WIDTH_RATIO

    @property
    def spacing(self) -> float:
        n = len(self.values)
        return (self.q_max - self.q_min) / max(1, n - 2 if n >= 4 else n - 1)

    @property
    def points(self) -> list[float]:
        first = self.q_min - self.spacing / 2 if len(self.values) >= 4 else self.q_min
        return [first + self.spacing * k for k in range(len(self.values))]

    def _first(self, place):
        """The first of the points that count, as a number from 0, for a place in spacings from the first point."""
        return place - (self.nearest - 1) / 2

    def weights(self, q: Column) -> list[Column]:
        n, m = len(self.values), min(self.nearest, len(self.values))
        x = F.greatest(F.lit(self.q_min), F.least(F.lit(self.q_max), q))
        low = F.greatest(F.least(F.floor(self._first((x - self.points[0]) / self.spacing) + 0.5), F.lit(n - m)), F.lit(0))
        raw = [F.when((low <= k) & (low + m > k), F.exp(-F.pow((x - p) / (self.ratio * self.spacing), 2))).otherwise(0.0) for k, p in enumerate(self.points)]
        total = raw[0]
        for r in raw[1:]:
            total = total + r
        return [r / total for r in raw]

    def at(self, q: float) -> float:
        n, m = len(self.values), min(self.nearest, len(self.values))
        x = min(max(q, self.q_min), self.q_max)
        low = max(min(math.floor(self._first((x - self.points[0]) / self.spacing) + 0.5), n - m), 0)
        w = [math.exp(-(((x - p) / (self.ratio * self.spacing)) ** 2)) if low <= k < low + m else 0.0 for k, p in enumerate(self.points)]
        return max(FLOOR, sum(a * b for a, b in zip(w, self.values, strict=True)) / sum(w))


@dataclass(frozen=True)
class ScaleModel:
    """b of each still, times the smoother's a(q). A still the model does not know has scale 1."""

    stills: dict[int, float]
    smoother: Smoother | None = None
    forbidden: frozenset = field(default=frozenset({"panel", "spatial", "additive"}), repr=False)

    @classmethod
    def start(cls, stills, smoother: Smoother | None = None, components=()) -> ScaleModel:
        if bad := cls.__dataclass_fields__["forbidden"].default & set(components):
            raise ValueError(f"components not in this model: {', '.join(sorted(bad))}")
        return cls({int(s): 1.0 for s in sorted(stills)}, smoother)

    def with_scale(self, still: int, value: float) -> ScaleModel:
        if still not in self.stills or value <= 0:
            raise ValueError(f"still {still} is unknown or scale {value} is not positive")
        return ScaleModel(self.stills | {still: value}, self.smoother)

    def info(self) -> dict:
        b = np.array(list(self.stills.values()))
        return {"n_stills": len(b), "n_parameters": len(b) + (len(self.smoother.values) if self.smoother else 0), "mean": float(b.mean()), "std": float(b.std()), "min": float(b.min()), "max": float(b.max())}

    def scaled(self, obs: DataFrame) -> DataFrame:
        """obs with scale (M)."""
        if len(self.stills) <= LITERAL_STILLS:
            known = F.create_map(*[x for s, b in self.stills.items() for x in (F.lit(s).cast("long"), F.lit(b))]) if self.stills else None
            b = F.coalesce(F.try_element_at(known, F.col("still_id").cast("long")), F.lit(1.0)) if known is not None else F.lit(1.0)
            out = obs.withColumn("scale", b)
        else:
            table = obs.sparkSession.createDataFrame(list(self.stills.items()), "still_id long, _b double")
            out = obs.join(table, "still_id", "left").withColumn("scale", F.coalesce("_b", F.lit(1.0))).drop("_b")
        return out if self.smoother is None else out.withColumn("scale", F.col("scale") * self.smoother.column(F.col("q")))


def with_scales(obs: DataFrame, scales: DataFrame) -> DataFrame:
    """obs with the scale of its still from a table, 1 for stills without one. Small tables are broadcast by Spark."""
    found = scales.select("still_id", F.col("multiplicative_scale").alias("scale"))
    return obs.join(found, "still_id", "left").withColumn("scale", F.coalesce("scale", F.lit(1.0)))


def product(components: Sequence[Callable[[DataFrame], Column]], obs: DataFrame) -> DataFrame:
    """obs with scale: the product of what components give for it. A component is any function from a table to a column."""
    out = F.lit(1.0)
    for component in components:
        out = out * component(obs)
    return obs.withColumn("scale", out)


def doubtful_scale(value: str = "multiplicative_scale", low: float = FLOOR, high: float = 1 / FLOOR) -> Column:
    """What is wrong with a still's scale, null if nothing is."""
    v = F.col(value)
    return F.when(v.isNull(), "missing").when(F.isnan(v) | (F.abs(v) == float("inf")), "not finite").when(v <= 0, "not positive").when((v < low) | (v > high), "out of range")


def model_info(scales: DataFrame, value: str = "multiplicative_scale") -> DataFrame:
    """One row: number, mean, deviation and range of the scales of a table, for any number of stills."""
    v = F.col(value)
    return scales.agg(F.count("*").alias("n_stills"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("low"), F.max(v).alias("high"))


def applied(obs: DataFrame, offset: float = 0.0) -> DataFrame:
    """Intensity and sigma on the common scale."""
    return obs.withColumn("intensity", (F.col("intensity") - F.lit(offset)) / F.col("scale")).withColumn("sigma", F.col("sigma") / F.abs("scale"))


def references(scaled: DataFrame) -> DataFrame:
    """Weighted mean of each voxel's scaled intensities: voxel_idx, reference, reference_sigma, n."""
    w = F.lit(1.0) / (F.pow(F.col("sigma") / F.col("scale"), 2) + TINY)
    return scaled.groupBy("voxel_idx").agg((F.sum(w * F.col("intensity") / F.col("scale")) / F.sum(w)).alias("reference"), (F.lit(1.0) / F.sqrt(F.sum(w))).alias("reference_sigma"), F.count("*").alias("n"))


def with_references(scaled: DataFrame) -> DataFrame:
    """The same mean beside each observation. Sums are partial, so a voxel of many observations is no hot key of the
    aggregation; in the join Spark broadcasts the means or splits what is skewed, and shuffles nothing that is dealt by voxel already."""
    return scaled.join(references(scaled).select("voxel_idx", "reference"), "voxel_idx")


def r_factor(referred: DataFrame) -> DataFrame:
    """One row: sum |I/M - reference| / sum I/M; infinite for a denominator that is not positive."""
    x = F.col("intensity") / F.col("scale")
    total, off = F.sum(x), F.sum(F.abs(x - F.col("reference")))
    return referred.agg(F.when(total > 0, off / total).otherwise(F.lit(float("inf"))).alias("r_factor"))


def safe_scale() -> Column:
    return F.when(F.abs("scale") > 1e-9, F.col("scale")).otherwise(F.lit(1e-9))


def normal_sums(referred: DataFrame, model: ScaleModel | ScaleTable, weighted: bool = False) -> DataFrame:
    """For each still: sums of the normal equations (jr, jj and, with a smoother, the borders) and of the R-factor."""
    m = safe_scale()
    x = F.col("intensity") / m
    w = F.lit(1.0) / (F.pow(F.col("sigma") / m, 2) + TINY) if weighted else F.lit(1.0)
    a = model.smoother.column(F.col("q")) if model.smoother else F.lit(1.0)
    j = -x / m * a
    r = x - F.col("reference")
    sums = {"jr": w * j * r, "jj": w * j * j, "off": F.abs(F.col("intensity") / F.col("scale") - F.col("reference")), "total": F.col("intensity") / F.col("scale")}
    if model.smoother:
        b = F.col("scale") / a
        k = [-x / m * b * d for d in model.smoother.weights(F.col("q"))]
        for p, kp in enumerate(k):
            sums |= {f"kr{p}": w * kp * r, f"jk{p}": w * j * kp} | {f"kk{p}_{o}": w * kp * k[o] for o in range(p, len(k))}
    return referred.groupBy("still_id").agg(*[F.sum(c).alias(n) for n, c in sums.items()])


@dataclass(frozen=True)
class ScaleTable:
    """A ScaleModel of any number of stills: the b of each is a row of a table (still_id, b) that is joined."""

    scales: DataFrame
    smoother: Smoother | None = None

    @classmethod
    def start(cls, binned: DataFrame, smoother: Smoother | None = None) -> ScaleTable:
        return cls(binned.select("still_id").distinct().withColumn("b", F.lit(1.0)), smoother)

    def scaled(self, obs: DataFrame) -> DataFrame:
        """obs with scale (M). Spark broadcasts the scales where their size allows it."""
        out = obs.join(self.scales.select("still_id", F.col("b").alias("_b")), "still_id", "left").withColumn("scale", F.coalesce("_b", F.lit(1.0))).drop("_b")
        return out if self.smoother is None else out.withColumn("scale", F.col("scale") * self.smoother.column(F.col("q")))


def _stored(table: DataFrame, name: str) -> DataFrame:
    path = scratch(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def stepped(sums: DataFrame, model: ScaleTable) -> tuple[ScaleTable, dict]:
    """A Gauss-Newton step from normal_sums. The normal matrix is diagonal in the stills with a border for each control point: the
    stills are eliminated (Schur complement) by one aggregation, whose single row comes to the driver for a system of as many rows
    as there are points; their own shifts are column arithmetic, written as the next table of scales.

    Gives the model and, as numbers, n (stills seen), off, total (sums of the R-factor) and shift (the largest)."""
    p = len(model.smoother.values) if model.smoother else 0
    known, zero = F.col("b").isNotNull(), F.lit(0.0)
    both = sums.join(model.scales.select("still_id", "b"), "still_id", "full")
    jj = F.coalesce("jj", zero) + DAMPING
    own = {"ratio": F.when(known, F.coalesce("jr", zero) / jj)} | {f"ratio{i}": F.when(known, F.coalesce(f"jk{i}", zero) / jj) for i in range(p)}
    both = both.withColumns(own)
    smoother, by_point, found = None, [], {}
    if p:
        both = _stored(both, "sums")
        cells = {f"kr{i}": F.sum(f"kr{i}") for i in range(p)} | {f"back{i}": F.sum(F.col(f"ratio{i}") * F.col("jr")) for i in range(p)}
        for i in range(p):
            cells |= {f"kk{i}_{o}": F.sum(f"kk{i}_{o}") for o in range(i, p)} | {f"less{i}_{o}": F.sum(F.col(f"ratio{i}") * F.col(f"jk{o}")) for o in range(i, p)}
        row = both.agg(*[F.coalesce(c, zero).alias(n) for n, c in cells.items()]).first()
        corner = np.array([[row[f"kk{min(i, o)}_{max(i, o)}"] - row[f"less{min(i, o)}_{max(i, o)}"] for o in range(p)] for i in range(p)]) + DAMPING * np.eye(p)
        by_point = np.linalg.solve(corner, [row[f"back{i}"] - row[f"kr{i}"] for i in range(p)]).tolist()
        smoother = replace(model.smoother, values=tuple(v + d for v, d in zip(model.smoother.values, by_point, strict=True)))
    shift = -F.col("ratio")
    for i, d in enumerate(by_point):
        shift = shift - F.col(f"ratio{i}") * d
    after = _stored(both.select("still_id", "b", (F.col("b") + shift).alias("after"), "off", "total", F.col("off").isNotNull().alias("seen")), "scales")
    row = after.agg(F.count_if("seen").alias("n"), F.sum("off").alias("off"), F.sum("total").alias("total"), F.max(F.abs(F.col("after") - F.col("b"))).alias("shift")).first()
    found = {"n": row.n, "off": row.off or 0.0, "total": row.total or 0.0, "shift": max([row.shift or 0.0, *map(abs, by_point)])}
    return ScaleTable(after.where("after is not null").select("still_id", F.col("after").alias("b")), smoother), found


def refine(
    binned: DataFrame, model: ScaleTable | None = None, rounds: int = 10, tolerance: float = 1e-6, shift_tolerance: float = 1e-6, weighted: bool = False,
    buckets: int | None = None, dealt: DataFrame | None = None,
) -> tuple[ScaleTable, dict]:
    """Gauss-Newton refinement of the scales, and numbers of the run. model: None begins with scales of 1 for the stills that there are; dealt: the
    same observations where a store has them already.

    The observations are written once, dealt by voxel (sources.store), so a round's means of the voxels and their join need no shuffle and a lost
    executor costs a read. A round is one aggregation by still; what it gives, and the scales, are tables: nothing that grows with the stills comes
    to the driver, and no lineage builds up.
    """
    if rounds < 1:
        raise ValueError("at least one round")
    smoother = model.smoother if model else None
    path = scratch(binned.sparkSession, "dealt")
    if dealt is None:
        dealt = store.create(binned.select("voxel_idx", "still_id", "intensity", "sigma", *(["q"] if smoother else [])), path, buckets)
    first = model or ScaleTable.start(dealt)
    model = ScaleTable(_stored(first.scales.select("still_id", "b"), "scales"), smoother)  # it is joined more than once
    try:
        before, stopped, info = math.inf, "rounds", {}
        for number in range(1, rounds + 1):
            last, (model, found) = model, stepped(normal_sums(with_references(model.scaled(dealt)), model, weighted), model)
            if not found["n"]:
                return last, {"n_iterations": 0, "r_factor": math.inf, "converged": False, "stopped_by": "empty"}
            r = found["off"] / found["total"] if found["total"] > 0 else math.inf
            info.setdefault("initial_r_factor", r)
            if abs(before - r) < tolerance and found["shift"] < shift_tolerance:
                stopped = "tolerance"
                break
            before = r
        # the last references, with the new parameters
        known = with_references(last.scaled(dealt)).drop("scale")
        final = r_factor(model.scaled(known)).first().r_factor
        return model, info | {"n_iterations": number, "r_factor": final, "converged": stopped == "tolerance", "stopped_by": stopped}
    finally:
        store.forget(binned.sparkSession, path)


def refined(binned: DataFrame, model: ScaleModel, rounds: int = 10, tolerance: float = 1e-6, shift_tolerance: float = 1e-6, weighted: bool = False, partitions: int | None = None) -> tuple[ScaleModel, dict]:
    """As refine(), from and to a model whose scales are numbers of the driver: for as many stills as a dictionary may hold."""
    start = ScaleTable(binned.sparkSession.createDataFrame(list(model.stills.items()), "still_id long, b double"), model.smoother)
    found, info = refine(binned, start, rounds, tolerance, shift_tolerance, weighted, partitions)
    return ScaleModel({int(r.still_id): r.b for r in found.scales.orderBy("still_id").collect()}, found.smoother), info


def normalised(model: ScaleModel) -> ScaleModel:
    """The same relative scales with mean 1: fixes the free overall factor."""
    mean = float(np.mean(list(model.stills.values())))
    return ScaleModel({s: b / mean for s, b in model.stills.items()}, model.smoother)


def relative(scales: DataFrame) -> DataFrame:
    """A table of scales (still_id, b) divided by their mean."""
    return scales.crossJoin(F.broadcast(scales.agg(F.avg("b").alias("_mean")))).withColumn("b", F.col("b") / F.col("_mean")).drop("_mean")  # one row

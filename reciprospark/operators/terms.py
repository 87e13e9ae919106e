"""Four-term scale models, fitted: intensity = a d (b R + c), with R the reference of the observation's voxel.

a (absorption, by detector position and rotation), b (scale, by rotation) and c (offset, by |q| and rotation) are smooth: linear between
control points on axes of equal steps; d has a value for each panel. Terms may be of each batch, or of all.

With the other terms held, a term is a linear problem. An observation touches the control points of its cell only, so the normal equations
are sums over cells: one aggregation with partial sums, whatever the number of observations. The equations of a batch (as many as a term
has control points) are solved by the executors, with a penalty on second differences of neighbouring points. Fitted terms are
tables of one row for each cell with the values at its corners, so applying a term is one equi-join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reciprospark.sources.shared import scratch

#: The value of a term that is not fitted, or at observations that its table lacks.
NEUTRAL = {"a": 1.0, "b": 1.0, "c": 0.0, "d": 1.0}
#: Added to the diagonal, as a share of its mean: for points that no observation touches.
RIDGE = 1e-12
TINY = 1e-10


@dataclass(frozen=True)
class Axis:
    """Control points at equal steps from low to high of a column; beyond the ends their values hold."""

    column: str
    low: float
    high: float
    points: int

    def __post_init__(self) -> None:
        if self.points < 2 or not self.low < self.high:
            raise ValueError(f"axis {self.column} needs two points and a range")

    def place(self) -> Column:
        at = (F.col(self.column) - self.low) * (self.points - 1) / (self.high - self.low)
        return F.greatest(F.least(at, F.lit(float(self.points - 1))), F.lit(0.0))

    def cell(self) -> Column:
        return F.least(F.floor(self.place()), F.lit(self.points - 2)).cast("int")


@dataclass(frozen=True)
class Term:
    """name: a, b, c or d. axes: of its control points, none for a single value. by: columns of which each combination has values of its own."""

    name: str
    axes: tuple[Axis, ...] = ()
    by: tuple[str, ...] = ()
    smoothness: float = 1e-3

    def __post_init__(self) -> None:
        if self.name not in NEUTRAL:
            raise ValueError(f"term {self.name!r} is none of {', '.join(NEUTRAL)}")

    @property
    def cells(self) -> list[str]:
        return [f"_cell{k}" for k in range(len(self.axes))]

    @property
    def corners(self) -> list[tuple[int, ...]]:
        return list(product((0, 1), repeat=len(self.axes)))

    def weights(self) -> list[Column]:
        """What the values at a cell's corners are multiplied with: column arithmetic."""
        shares = [axis.place() - axis.cell() for axis in self.axes]
        out = []
        for corner in self.corners:
            w = F.lit(1.0)
            for share, side in zip(shares, corner, strict=True):
                w = w * (share if side else 1.0 - share)
            out.append(w)
        return out

    def keyed(self, obs: DataFrame) -> DataFrame:
        return obs.withColumns({n: axis.cell() for n, axis in zip(self.cells, self.axes, strict=True)}) if self.axes else obs


def with_term(obs: DataFrame, term: Term, values: DataFrame | None) -> DataFrame:
    """obs with the column of a term: interpolated between the corners (v0, v1, ...) of its cell in values."""
    if values is None:
        return obs.withColumn(term.name, F.lit(NEUTRAL[term.name]))
    names = [f"_v{k}" for k in range(len(term.corners))]
    keys = [*term.by, *term.cells]
    own = values.select(*keys, *[F.col(n[1:]).alias(n) for n in names])
    out = term.keyed(obs)
    out = out.join(own, keys, "left") if keys else out.crossJoin(F.broadcast(own))  # one row
    value = sum((w * F.col(n) for w, n in zip(term.weights(), names, strict=True)), F.lit(0.0))
    return out.withColumn(term.name, F.coalesce(value, F.lit(NEUTRAL[term.name]))).drop(*term.cells, *names)


def with_terms(obs: DataFrame, terms: Sequence[Term], fitted: Mapping[str, DataFrame]) -> DataFrame:
    """obs with a, b, c and d, for absolute.applied."""
    for name in NEUTRAL:
        term = next((t for t in terms if t.name == name), None)
        obs = obs.withColumn(name, F.lit(NEUTRAL[name])) if term is None else with_term(obs, term, fitted.get(name))
    return obs


def design(name: str) -> tuple[Column, Column]:
    """(factor, target) of the linear problem of a term, the others held: intensity = factor * term + what the target leaves out."""
    a, b, c, d, i, ref = (F.col(n) for n in ("a", "b", "c", "d", "intensity", "reference"))
    return {"a": (d * (b * ref + c), i), "b": (a * d * ref, i - a * d * c), "c": (a * d, i - a * d * b * ref), "d": (a * (b * ref + c), i)}[name]


def cell_sums(obs: DataFrame, term: Term) -> DataFrame:
    """The normal equations of a term, by cell: n, the products of its corners (n0_0, n0_1, ...) and the right side (r0, ...), weighted by 1 / sigma**2.

    obs: with a, b, c, d and reference; observations without a reference or with an error that is not positive take no part."""
    factor, target = design(term.name)
    w = 1.0 / (F.col("sigma") * F.col("sigma") + TINY)
    rows = term.keyed(obs.where("reference is not null and sigma > 0 and not isnan(intensity) and intensity is not null"))
    rows = rows.withColumns({"_w": w, "_y": target} | {f"_x{k}": u * factor for k, u in enumerate(term.weights())})
    n = len(term.corners)
    sums = [F.sum(F.col("_w") * F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"n{i}_{j}") for i in range(n) for j in range(i, n)]
    return rows.groupBy(*term.by, *term.cells).agg(F.count("*").alias("n"), *sums, *[F.sum(F.col("_w") * F.col(f"_x{i}") * F.col("_y")).alias(f"r{i}") for i in range(n)])


def penalty(shape: Sequence[int]) -> np.ndarray:
    """The sum of squared second differences along each axis of points, as a matrix; of first differences along an axis of two."""
    size = int(np.prod(shape))
    out, at = np.zeros((size, size)), np.arange(size).reshape(shape)
    for axis, n in enumerate(shape):
        lines = np.moveaxis(at, axis, 0)
        step = np.array([1.0, -2.0, 1.0]) if n > 2 else np.array([1.0, -1.0])
        for k in range(n - len(step) + 1):
            for points in lines[k : k + len(step)].reshape(len(step), -1).T:
                out[np.ix_(points, points)] += np.outer(step, step)
    return out


def solved(sums: DataFrame, term: Term) -> DataFrame:
    """The values of a term from cell_sums: by, cells, and v0, v1, ... at the corners of every cell."""
    n, by = len(term.corners), list(term.by)
    shape = [axis.points for axis in term.axes]
    kinds = [f"`{c}` {sums.schema[c].dataType.simpleString()}" for c in by] + [f"{c} int" for c in term.cells] + [f"v{k} double" for k in range(n)]

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        at = np.arange(int(np.prod(shape, dtype=int))).reshape(shape) if shape else np.zeros((), int)
        matrix, right = np.zeros((at.size, at.size)), np.zeros(at.size)
        for row in rows.to_dict("records"):
            points = [int(at[tuple(row[c] + s for c, s in zip(term.cells, corner, strict=True))]) for corner in term.corners]
            for i in range(n):
                right[points[i]] += row[f"r{i}"]
                for j in range(i, n):
                    matrix[points[i], points[j]] += row[f"n{i}_{j}"]
                    if i != j:
                        matrix[points[j], points[i]] += row[f"n{i}_{j}"]
        scale = max(np.trace(matrix) / at.size, 1e-300)
        if shape:
            matrix = matrix + term.smoothness * scale * penalty(shape)
        values = np.linalg.solve(matrix + RIDGE * scale * np.eye(at.size), right)
        cells = list(product(*[range(p - 1) for p in shape]))
        out = {c: [rows[c].iloc[0]] * len(cells) for c in by} | {c: [x[k] for x in cells] for k, c in enumerate(term.cells)}
        for k, corner in enumerate(term.corners):
            out[f"v{k}"] = [float(values[at[tuple(x + s for x, s in zip(cell, corner, strict=True))]]) for cell in cells]
        return pd.DataFrame(out)

    return (sums if by else sums.withColumn("_all", F.lit(0))).groupBy(*(by or ["_all"])).applyInPandas(solve, ", ".join(kinds))


def _stored(table: DataFrame, name: str) -> DataFrame:
    path = scratch(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def _times(values: DataFrame, term: Term, factor: float) -> DataFrame:
    return values.withColumns({f"v{k}": F.col(f"v{k}") * factor for k in range(len(term.corners))})


def fit(obs: DataFrame, terms: Sequence[Term], rounds: int = 10, tolerance: float = 1e-9) -> tuple[dict[str, DataFrame], dict]:
    """The terms of obs (intensity, sigma, reference, and the columns of their axes), one after the other, for some rounds; and numbers of the run.

    The common factors of a, d and (b, c) are fixed by a mean of 1 of the values of a and of d. Where references vary little beside their mean, b and
    c stand in for each other and it takes many rounds to tell them apart. A round writes one small table for each
    term and reads the observations once for each, and once for the misfit: the weighted mean square residual. Stops when that falls by less than its share ``tolerance``."""
    if len({t.name for t in terms}) < len(terms) or not terms or rounds < 1:
        raise ValueError("give each term once, at least one, and at least one round")
    named = {t.name: t for t in terms}
    fitted: dict[str, DataFrame] = {}
    misfits: list[float | None] = []
    for _ in range(rounds):
        for name in [n for n in "bcad" if n in named]:
            term = named[name]
            fitted[name] = _stored(solved(cell_sums(with_terms(obs, terms, fitted), term), term), name)
            if name in "ad" and "b" in named:
                corners = [F.avg(f"v{k}") for k in range(len(term.corners))]
                mean = fitted[name].agg((sum(corners[1:], corners[0]) / len(corners)).alias("m")).first().m
                if mean and mean > 0:
                    fitted[name] = _times(fitted[name], term, 1 / mean)
                    fitted |= {n: _times(fitted[n], named[n], mean) for n in "bc" if n in fitted}
        misfits.append(misfit(with_terms(obs, terms, fitted)))
        if misfits[-1] is None or len(misfits) > 1 and misfits[-2] - misfits[-1] <= tolerance * misfits[-2]:
            break
    return fitted, {"rounds": len(misfits), "misfits": misfits}


def misfit(obs: DataFrame) -> float | None:
    """The mean of squared residuals, weighted by 1 / sigma**2; None without observations. obs: with a, b, c, d and reference."""
    off = (F.col("intensity") - F.col("a") * F.col("d") * (F.col("b") * F.col("reference") + F.col("c"))) / F.col("sigma")
    return obs.where("reference is not null and sigma > 0 and not isnan(intensity)").agg(F.avg(off * off).alias("x")).first().x

"""Three-vectors and 3 x 3 matrices as flat columns, so that generated code keeps them in registers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Vector = Sequence["Column | float"]
Matrix = Sequence[Sequence[float]]


def column(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def dot(a: Vector, b: Vector) -> Column:
    out = column(a[0]) * column(b[0])
    for x, y in zip(a[1:], b[1:], strict=True):
        out = out + column(x) * column(y)
    return out


def norm(a: Vector) -> Column:
    return F.sqrt(dot(a, a))


def cross(a: Vector, b: Vector) -> tuple[Column, ...]:
    a, b = [column(x) for x in a], [column(x) for x in b]
    return tuple(a[(k + 1) % 3] * b[(k + 2) % 3] - a[(k + 2) % 3] * b[(k + 1) % 3] for k in range(3))


def apply(m: Matrix, v: Vector) -> tuple[Column, ...]:
    """A matrix of literals times a vector of columns."""
    return tuple(dot([float(x) for x in row], v) for row in m)


def ratio(a: Column, b: Column, otherwise: float | None = None) -> Column:
    """a / b, and a default where b is 0: ANSI division would fail."""
    return F.when(b == 0, F.lit(otherwise)).otherwise(a / F.when(b == 0, F.lit(1.0)).otherwise(b))

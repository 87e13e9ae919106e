"""Multiplicative corrections of pixel intensities, as columns."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from reciprospark.functions import vec
from reciprospark.functions.air import HC, air_attenuation

FACTORS = ("lp", "qe", "sa", "air")
#: Ranges in which a factor is believable.
BELIEVABLE = {"lp": (0.1, 10.0), "qe": (0.1, 2.0), "sa": (1e-6, 1e6), "air": (0.9, 1.2)}


def background(measured: Column | None, constant: float | None = None) -> tuple[Column, Column]:
    """Background and its variance: a measured value before the constant; a constant has no variance."""
    fixed = F.lit(float(constant or 0.0))
    if measured is None:
        return fixed, F.lit(0.0)
    return F.coalesce(measured, fixed), F.coalesce(F.greatest(measured, F.lit(0.0)), F.lit(0.0))


def net_intensity(raw: Column, bg: Column, gain: float) -> Column:
    return (raw - bg) * F.lit(float(gain))


def poisson_sigma(raw: Column, bg_variance: Column, gain: float) -> Column:
    """Counting error of the scaled counts; NaN for a negative variance."""
    counts = raw / F.lit(float(gain)) if gain > 0 else raw
    variance = (counts + bg_variance) * F.lit(float(gain) ** 2)
    return F.when(variance < 0, F.lit(float("nan"))).otherwise(F.sqrt(F.greatest(variance, F.lit(0.0))))


def lp_factor(divisor: Column) -> Column:
    """Lorentz-polarisation: the reciprocal of its divisor, 1 for a divisor of 0 or null."""
    return F.coalesce(vec.ratio(F.lit(1.0), divisor, 1.0), F.lit(1.0))


def qe_factor(value: Column) -> Column:
    return F.coalesce(value, F.lit(1.0))


def solid_angle(lab: vec.Vector, fast_axis: vec.Vector, slow_axis: vec.Vector, px_fast: Column | float, px_slow: Column | float) -> Column:
    normal = vec.cross(fast_axis, slow_axis)
    r2 = vec.dot(lab, lab)
    facing = F.abs(vec.dot(normal, lab)) / (vec.norm(normal) * F.sqrt(r2))
    return vec.column(px_fast) * vec.column(px_slow) * facing / r2


def solid_angle_factor(omega: Column) -> Column:
    return F.when(omega <= 0, F.lit(1.0)).otherwise(F.lit(1.0) / F.when(omega <= 0, F.lit(1.0)).otherwise(omega))


def air_factor(lab: vec.Vector, wavelength: float, temperature_k: float = 293.15, pressure_atm: float = 1.0, mu: Column | None = None) -> Column:
    """exp(mu r) for a path of |lab| mm; mu is one number of the driver, or a column where it is given."""
    if mu is None:
        mu = F.lit(air_attenuation(HC / wavelength, temperature_k, pressure_atm))
    return F.exp(mu * vec.norm(lab) / 1000.0)


def total_factor(factors: Mapping[str, Column]) -> Column:
    out = F.lit(1.0)
    for name in FACTORS:
        out = out * factors.get(name, F.lit(1.0))
    return out


def analytic_45(distance: Column | float, pixel: Column | float, air_path: Column | float | None = None) -> dict[str, Column]:
    """Factors of a pixel at a scattering angle with theta = 45 degrees, for checks against closed forms."""
    theta = math.pi / 4
    lp = 1.0 / (math.sin(theta) ** 2 * (1.0 + math.cos(2 * theta) ** 2))
    out = {"lp": F.lit(lp), "qe": F.lit(1.0), "sa": F.pow(vec.column(distance) / math.cos(theta), 2) / F.pow(vec.column(pixel), 2)}
    out["air"] = F.lit(1.0) if air_path is None else F.exp(0.001 * vec.column(air_path))
    return out


def doubtful_factor(factors: Mapping[str, Column]) -> Column:
    """The name of the first factor that is not positive, else of the first outside BELIEVABLE; null if all are fine."""
    out = F.lit(None).cast("string")
    for name in reversed(FACTORS):
        low, high = BELIEVABLE[name]
        out = F.when((factors[name] < low) | (factors[name] > high), F.lit(f"{name} out of range")).otherwise(out)
    for name in reversed(FACTORS):
        out = F.when(factors[name] <= 0, F.lit(f"{name} not positive")).otherwise(out)
    return out

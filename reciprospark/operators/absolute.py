"""Absolute scale: theoretical scattering of the cell's contents, Krogh-Moe and Norman sums, and the map on that scale."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Electrons, and the coefficients a1 b1 a2 b2 a3 b3 a4 b4 c of the scattering factor by sin(theta)/wavelength
#: (Cromer and Mann; International Tables for Crystallography, volume C).
ATOMS = {
    "H": (1, (0.489918, 20.6593, 0.262003, 7.74039, 0.196767, 49.5519, 0.049879, 2.20159, 0.001305)),
    "C": (6, (2.31, 20.8439, 1.02, 10.2075, 1.5886, 0.5687, 0.865, 51.6512, 0.2156)),
    "N": (7, (12.2126, 0.0057, 3.1322, 9.8933, 2.0125, 28.9975, 1.1663, 0.5826, -11.529)),
    "O": (8, (3.0485, 13.2771, 2.2868, 5.7011, 1.5463, 0.3239, 0.867, 32.9089, 0.2508)),
    "S": (16, (6.9053, 1.4679, 5.2034, 22.2151, 1.4379, 0.2536, 1.5863, 56.172, 0.8669)),
}


def form_factor(element: str, q: Column, convention: str = "2pi") -> Column:
    """f0 of an atom at |q|."""
    *pairs, c = ATOMS[element][1]
    s2 = F.pow(q / (4 * math.pi if convention == "2pi" else 2.0), 2)
    out = F.lit(c)
    for a, b in zip(pairs[::2], pairs[1::2], strict=True):
        out = out + a * F.exp(-b * s2)
    return out


def electrons(contents: Mapping[str, float]) -> float:
    return sum(n * ATOMS[e][0] for e, n in contents.items())


def with_theory(rows: DataFrame, contents: Mapping[str, float], q: str = "q_magnitude_center", convention: str = "2pi") -> DataFrame:
    """rows with f_squared and incoherent, sums over the atoms of the cell (element: number). Incoherent scattering of an atom of Z
    electrons is taken as Z - f0**2 / Z. The contents are literals, so the sums are column arithmetic."""
    coherent = incoherent = F.lit(0.0)
    for element, n in contents.items():
        f2 = F.pow(form_factor(element, F.col(q), convention), 2)
        z = float(ATOMS[element][0])
        coherent, incoherent = coherent + n * f2, incoherent + n * (z - f2 / z)
    return rows.withColumns({"f_squared": coherent, "incoherent": incoherent})


def shell_averages(rows: DataFrame, value: str, q: str, width: float) -> DataFrame:
    """shell, its volume, n, and the mean of a value: shells of equal width of |q| from 0."""
    shells = rows.groupBy(F.floor(F.col(q) / width).cast("int").alias("shell")).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
    return shells.withColumn("volume", F.lit(4 * math.pi / 3) * (F.pow((F.col("shell") + 1) * width, 3) - F.pow(F.col("shell") * width, 3)))


def absolute_scales(observed: DataFrame, theory: DataFrame, n_electrons: float, cell_volume: float) -> DataFrame:
    """For each shell as the cutoff: cumulative sums of the observed and of the theoretical scattering (less the square of the
    number of electrons) over the shells up to it, and their ratio: the scale. Both tables are as of shell_averages; a shell has one row,
    so the window is over a few rows."""
    both = observed.select("shell", "n", "volume", F.col("mean").alias("_o")).join(theory.select("shell", F.col("mean").alias("_t")), "shell")
    up_to = Window.orderBy("shell")
    sums = {"cumulative_observed": cell_volume * F.sum(F.col("_o") * F.col("volume")).over(up_to), "cumulative_theory": -(n_electrons**2) + cell_volume * F.sum(F.col("_t") * F.col("volume")).over(up_to)}
    out = both.withColumns(sums)
    return out.select("shell", "n", *sums, F.when(F.col("cumulative_observed") != 0, F.col("cumulative_theory") / F.col("cumulative_observed")).alias("scale"))


def on_absolute_scale(voxels: DataFrame, scale: float, incoherent: Column) -> DataFrame:
    """voxels with I_abs_diffuse and Sigma_abs_diffuse: scaled, incoherent scattering subtracted, errors scaled."""
    return voxels.withColumn("I_abs_diffuse", F.col("I_merged_relative") * scale - incoherent).withColumn("Sigma_abs_diffuse", F.col("Sigma_merged_relative") * scale)


def folded(scales: DataFrame, scale: float, incoherent: Column) -> DataFrame:
    """Scale models (multiplicative_scale, additive_offset) that give the absolute scale themselves."""
    b = F.col("multiplicative_scale") / scale
    return scales.withColumn("additive_offset", F.coalesce("additive_offset", F.lit(0.0)) + incoherent * b).withColumn("multiplicative_scale", b)


def applied(obs: DataFrame) -> DataFrame:
    """Observations on the common scale of the four-term model: columns a (absorption), b (scale), c (offset) and d (panel) of obs."""
    factor = F.col("a") * F.col("b") * F.col("d")
    return obs.withColumn("intensity", F.col("intensity") / factor - F.col("c") / F.col("b")).withColumn("sigma", F.col("sigma") / F.abs(factor))

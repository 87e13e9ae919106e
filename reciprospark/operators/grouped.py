"""Group-wise extension points: the same results from pandas functions over groups, for checks and for own code.

A group must fit one task; the column forms in ``merging`` and ``scaling`` have no such limit and are the main path.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from reciprospark.operators.merging import MAD_TO_SIGMA, TINY


def by_voxel(obs: DataFrame, f: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """Apply a function of a voxel's observations."""
    return obs.groupBy("voxel_idx").applyInPandas(f, schema)


def without_outliers(obs: DataFrame, threshold: float = 3.0) -> DataFrame:
    def keep(g: pd.DataFrame) -> pd.DataFrame:
        if len(g) <= 2:
            return g
        off = (g["intensity"] - g["intensity"].median()).abs()
        near = off <= threshold * MAD_TO_SIGMA * off.median()
        return g[near] if near.any() else g

    return by_voxel(obs, keep, obs.schema)


def references(scaled: DataFrame) -> DataFrame:
    """As scaling.references, voxel by voxel."""

    def one(g: pd.DataFrame) -> pd.DataFrame:
        w = 1 / ((g["sigma"] / g["scale"]) ** 2 + TINY)
        return pd.DataFrame({"voxel_idx": g["voxel_idx"].iloc[:1], "reference": (w * g["intensity"] / g["scale"]).sum() / w.sum(), "reference_sigma": 1 / np.sqrt(w.sum()), "n": len(g)})

    return by_voxel(scaled.select("voxel_idx", "intensity", "sigma", "scale"), one, "voxel_idx long, reference double, reference_sigma double, n long")


def merged(obs: DataFrame) -> DataFrame:
    def one(g: pd.DataFrame) -> pd.DataFrame:
        x, s = g["intensity"].to_numpy(), g["sigma"].to_numpy()
        w = 1 / (s * s + TINY)
        value, error = ((w * x).sum() / w.sum(), 1 / np.sqrt(w.sum())) if len(g) > 1 else (x[0], s[0])
        return pd.DataFrame({"voxel_idx": g["voxel_idx"].iloc[:1], "I_merged_relative": value, "Sigma_merged_relative": error, "num_observations": len(g)})

    return by_voxel(obs, one, "voxel_idx long, I_merged_relative double, Sigma_merged_relative double, num_observations long")

"""Every reader behind one interface: ``read(spark, kind, path)`` gives the engine's table of that kind.

A reader is a function of a session and a path; ``register`` adds own ones, so data of other programs come in the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reciprospark.sources import headers, images, store, tables

Reader = Callable[[SparkSession, str], DataFrame]
READERS: dict[str, Reader] = {
    "observations": lambda spark, path: tables.observations(spark, [path]),
    "observations_npz": tables.observations_npz,
    "reflections": tables.reflections,
    "mask": tables.mask,
    "background": tables.background,
    "background_npy": tables.background_npy,
    "voxels": tables.voxels,
    "voxels_npz": tables.voxels_npz,
    "reference_cells": tables.reference_cells,
    "headers": headers.headers,
    "images": images.images,
    "voxel_store": store.opened,
    "beam": lambda spark, path: tables.experiments(spark, path)["beam"],
    "panel": lambda spark, path: tables.experiments(spark, path)["panel"],
    "crystal": lambda spark, path: tables.experiments(spark, path)["crystal"],
}


def register(kind: str, reader: Reader) -> None:
    READERS[kind] = reader


def read(spark: SparkSession, kind: str, path: str) -> DataFrame:
    if kind not in READERS:
        raise ValueError(f"no reader for {kind!r}; there are {', '.join(sorted(READERS))}")
    return READERS[kind](spark, path)

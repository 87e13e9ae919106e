"""Session settings that the engine counts on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "reciprospark", **settings: str) -> SparkSession:
    """A session with adaptive execution, ANSI arithmetic and UTC; other settings by keyword, dots as double underscores."""
    builder = SparkSession.builder.appName(name).config("spark.sql.adaptive.enabled", "true").config("spark.sql.ansi.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> str:
    """Send this package to the executors, for sessions started from another folder or without an installed package: a zip file, whose path is given."""
    import shutil
    import tempfile
    from pathlib import Path

    package = Path(__file__).resolve().parent
    path = shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="ship-")) / package.name), "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(path)
    return path

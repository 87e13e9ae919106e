"""Incremental binning and merging with Structured Streaming.

Sums of weights add up, so merging runs as a streaming aggregation; medians and refinement need whole voxels and stay
batch operations.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reciprospark.operators.grid import Grid, binned
from reciprospark.operators.masks import pixel_statistics
from reciprospark.operators.merging import accumulation_statistics
from reciprospark.schema import OBSERVATIONS

TINY = 1e-10


def observation_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def accumulate(stream: DataFrame, grid: Grid, path: str, checkpoint: str) -> StreamingQuery:
    """Bin each micro-batch and write it to its own folder of path: a batch that runs again replaces itself."""

    def put(batch: DataFrame, number: int) -> None:
        binned(batch, grid).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def add_observations(obs: DataFrame, grid: Grid, path: str, batch: str | None = None) -> int:
    """Bin observations, add them to path and give the number binned. Parts of a still add up, and so do observations that come twice.

    batch: the caller's id of this part. The same id again replaces what it has written before, so a part can be run again after a failure;
    without an id each call is a part of its own. A part is one folder, of any number of stills."""
    found = binned(obs, grid).observe(seen := Observation(), F.count(F.lit(1)).alias("n"))
    name = uuid.uuid4().hex if batch is None else hashlib.md5(str(batch).encode()).hexdigest()
    found.write.mode("overwrite").parquet(f"{path}/batch=b{name}")
    return seen.get["n"]


def of_arrays(spark: SparkSession, still_id: int, q, intensities, sigmas) -> DataFrame:
    """Observations of one still from arrays of equal length."""
    if not len(q) == len(intensities) == len(sigmas):
        raise ValueError(f"{len(q)} vectors, {len(intensities)} intensities and {len(sigmas)} errors")
    rows = [(still_id, *map(float, v), float(i), float(s)) for v, i, s in zip(q, intensities, sigmas, strict=True)]
    return spark.createDataFrame(rows, OBSERVATIONS)


def finalized(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """All that was accumulated in path, and one row of its statistics."""
    rows = spark.read.parquet(path).drop("batch")
    return rows, accumulation_statistics(rows)


def running_statistics(stream: DataFrame) -> DataFrame:
    """n, mean and variance of each voxel's intensities: sums that a stream and a batch update alike."""
    return stream.groupBy("voxel_idx").agg(F.count("*").alias("n"), F.avg("intensity").alias("mean"), F.var_pop("intensity").alias("variance"))


def running_merge(stream: DataFrame) -> DataFrame:
    """Inverse-variance sums of each voxel: voxel_idx, w, wx, n, intensity, sigma."""
    w = F.lit(1.0) / (F.col("sigma") * F.col("sigma") + TINY)
    out = stream.groupBy("voxel_idx").agg(F.sum(w).alias("w"), F.sum(w * F.col("intensity")).alias("wx"), F.count("*").alias("n"))
    return out.withColumns({"intensity": F.col("wx") / F.col("w"), "sigma": F.lit(1.0) / F.sqrt("w")})


def running_sums(stream: DataFrame) -> DataFrame:
    """What a running merge of each voxel keeps: n, mean and m2 (the sum of squared deviations, as Welford's update gives it) of the
    intensities, and the inverse-variance sums w and wx."""
    w = F.lit(1.0) / (F.col("sigma") * F.col("sigma") + TINY)
    x = F.col("intensity")
    return stream.groupBy("voxel_idx").agg(F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"), F.sum(w).alias("w"), F.sum(w * x).alias("wx"))


def combined(parts: DataFrame) -> DataFrame:
    """Running sums of parts that were kept apart (rows of running_sums, any number for a voxel), as of one run over all of them."""
    n, mean = F.col("n"), F.col("mean")
    together = F.sum(n * mean) / F.sum(n)
    whole = parts.where("n > 0").groupBy("voxel_idx").agg(F.sum(n).alias("n"), together.alias("mean"), F.sum("m2").alias("_within"), F.sum("w").alias("w"), F.sum("wx").alias("wx"))
    between = parts.where("n > 0").join(whole.select("voxel_idx", F.col("mean").alias("_mean")), "voxel_idx").groupBy("voxel_idx").agg(F.sum(n * F.pow(mean - F.col("_mean"), 2)).alias("_between"))
    return whole.join(between, "voxel_idx").select("voxel_idx", "n", "mean", (F.col("_within") + F.col("_between")).alias("m2"), "w", "wx")


def from_sums(sums: DataFrame) -> DataFrame:
    """sums with variance, and the merged intensity and sigma."""
    return sums.withColumns({"variance": F.col("m2") / F.col("n"), "intensity": F.col("wx") / F.col("w"), "sigma": F.lit(1.0) / F.sqrt("w")})


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_running(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """running_sums of a stream of binned observations, as state that outlives a run: the next call with the same checkpoint goes on
    with what has come since. The state is in RocksDB, so it may be larger than memory. Each micro-batch writes the voxels that it changed to a
    folder of path, of its own number: a batch that runs again after a failure replaces itself. See latest()."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    name, conf = "spark.sql.streaming.stateStore.providerClass", stream.sparkSession.conf
    before = conf.get(name, None)
    conf.set(name, ROCKSDB)
    try:
        return running_sums(stream).writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The last row of each voxel that keep_running has written."""
    rows = spark.read.parquet(path)
    names = [c for c in rows.columns if c not in ("voxel_idx", "batch")]
    return rows.groupBy("voxel_idx").agg(F.max_by(F.struct(*names), "batch").alias("x")).select("voxel_idx", *[f"x.{c}" for c in names])


def running_mask_statistics(pixels: DataFrame) -> DataFrame:
    """The sums that a dynamic mask needs, as a streaming aggregation."""
    return pixel_statistics(pixels)


def to_table(frame: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The aggregate after each micro-batch, written whole by the executors to path/batch=number: nothing comes to the driver."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return frame.writeStream.foreachBatch(put).outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def last_batch(spark: SparkSession, path: str) -> DataFrame:
    """The latest of what to_table wrote."""
    rows = spark.read.parquet(path)
    return rows.join(F.broadcast(rows.agg(F.max("batch").alias("batch"))), "batch").drop("batch")  # one row


def to_memory(frame: DataFrame, name: str, mode: str = "complete") -> StreamingQuery:
    """The aggregate as a table of the driver's memory: for tests and a look at small maps; to_table is for the rest."""
    return frame.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()

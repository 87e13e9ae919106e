"""A store of binned observations that is dealt by voxel once: bucketed Parquet.

What groups or joins by voxel reads the store as it lies, without a shuffle; a lookup reads the one bucket of its voxel. The store is a
folder (rows, and a note of its buckets and columns), which any session opens by its path. Rows that are added go to the same buckets,
as further files.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEY = "voxel_idx"


def _name(path: str) -> str:
    return "voxel_store_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()


def _note(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/note").first().value)


def create(binned: DataFrame, path: str, buckets: int | None = None) -> DataFrame:
    """Write observations (voxel_idx, ...) to a new store and give it back. One shuffle, and a file for each bucket.

    buckets: the tasks that read the store at most; by default as many as the session's shuffle partitions."""
    spark = binned.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = binned.repartition(buckets, KEY).sortWithinPartitions(KEY)
    spark.sql(f"drop table if exists {_name(path)}")
    dealt.write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY).option("path", f"{path}/rows").saveAsTable(_name(path))
    note = json.dumps({"buckets": buckets, "schema": json.loads(binned.schema.json())})
    spark.createDataFrame([(note,)], "value string").coalesce(1).write.text(f"{path}/note")
    return opened(spark, path)


def opened(spark: SparkSession, path: str) -> DataFrame:
    """The observations of a store, known to be dealt by voxel."""
    name = _name(path)
    if not spark.catalog.tableExists(name):
        note = _note(spark, path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(note["schema"]))
        spark.sql(f"create table {name} ({columns}) using parquet clustered by ({KEY}) sorted by ({KEY}) into {note['buckets']} buckets location '{path}/rows'")
    return spark.table(name)


def append(binned: DataFrame, path: str) -> DataFrame:
    """Add observations to a store. A part that is added twice is there twice."""
    spark = binned.sparkSession
    have, buckets = opened(spark, path), _note(spark, path)["buckets"]
    rows = binned.select(*[F.col(f.name).cast(f.dataType) for f in have.schema]).repartition(buckets, KEY).sortWithinPartitions(KEY)
    rows.write.format("parquet").mode("append").bucketBy(buckets, KEY).sortBy(KEY).option("path", f"{path}/rows").saveAsTable(_name(path))
    spark.catalog.refreshTable(_name(path))
    return opened(spark, path)


def lookup(spark: SparkSession, path: str, *voxels: int) -> DataFrame:
    """The observations of a few voxels: only their buckets are read, and of these only the row groups that can hold them."""
    return opened(spark, path).where(F.col(KEY).isin([int(v) for v in voxels]) if len(voxels) != 1 else F.col(KEY) == int(voxels[0]))


def forget(spark: SparkSession, path: str) -> None:
    """Take a store out of the session's catalog; its folder stays."""
    spark.sql(f"drop table if exists {_name(path)}")

"""Helpers that the text operators share: tables, shared folders, batches of whole texts, packed arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reciprospark.sources.shared import scratch

#: Texts are handled in slices of about this many bytes, which bounds a Python worker's memory (one longer text is a slice of its own).
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that go to a Python worker at once: Spark's default of 10,000 whole texts are tens of MB, several times over.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """From now on in this session, at most BATCH_ROWS rows go to a Python worker at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_STORED: list[str] = []


def stored(df: DataFrame, name: str = "part") -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, and survives the loss of executors."""
    path = scratch(df.sparkSession, name)
    _STORED.append(path)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Remove tables that stored() returned and that nothing reads any more."""
    for df in tables:
        if path := _PATHS.pop(df, None):
            _STORED.remove(path)
            _delete(df.sparkSession, path)


def stored_so_far() -> int:
    """A mark for sweep()."""
    return len(_STORED)


def sweep(spark: SparkSession, since: int, *keep: DataFrame) -> None:
    """Remove the tables stored since a mark, but for those to keep: for callers who have written what an operator gave them."""
    kept = {_PATHS.get(df) for df in keep}
    for path in [p for p in _STORED[since:] if p not in kept]:
        _STORED.remove(path)
        _delete(spark, path)


def fresh(name: str, taken: Iterable[str]) -> str:
    """The name, with as many "_" before it as it takes to clash with none (Spark's names ignore case)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = "_" + name
    return name


#: Bits of a bitmap of hashed keys: 4 MB, at most 524,288 rows. A key that is not marked is none of those put in.
MARKS = 1 << 25


#: The largest bitmap: 32 MB. Keys beyond its size make it mark more than was put in, never less.
MOST_MARKS = 1 << 28


def bits_for(n: int) -> int:
    """The bits of a bitmap in which n keys leave at most one in sixteen marked, within MARKS and MOST_MARKS."""
    return min(max(1 << (16 * max(n, 1) - 1).bit_length(), MARKS), MOST_MARKS)


def marks(keys: DataFrame, bits: int = MARKS) -> DataFrame:
    """A bitmap of the column key (long, hashed): word and bits. Of a fixed size, whatever the number of keys."""
    bit = F.col("key").bitwiseAND(bits - 1)
    return keys.select(F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, cast(key & 63 as int))").alias("b")).groupBy("word").agg(F.bit_or("b").alias("bits"))


def marked(df: DataFrame, key: Column, bitmap: DataFrame, name: str) -> DataFrame:
    """df with a boolean column: whether the key's bit is set. The bitmap (see marks) is broadcast: its size is fixed."""
    word, bits = fresh("word", df.columns), fresh("bits", df.columns)
    small = F.broadcast(bitmap.select(F.col("word").alias(word), F.col("bits").alias(bits)))
    out = df.join(small, F.shiftright(key.bitwiseAND(MARKS - 1), 6) == F.col(word), "left")
    return out.withColumn(name, F.coalesce(F.getbit(F.col(bits), key.bitwiseAND(63).cast("int")) == 1, F.lit(False))).drop(word, bits)


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of a key as text, modulo; a null key counts as empty text, whose crc32 is 0."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches into slices of at most SLICE_BYTES of text; gives each with its texts in UTF-8, null as empty."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset :]) if len(texts) else np.zeros(0, np.int64)
        at = 0
        while at < len(sizes):
            end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), SLICE_BYTES, side="right")))
            yield batch.slice(at, end - at), [x or b"" for x in texts.slice(at, end - at).to_pylist()]
            at = end
    pa.default_memory_pool().release_unused()  # the worker lives on, for tasks of other stages


def record(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def packed(values: np.ndarray) -> bytes:
    """An array as bytes: planes of its bytes, compressed."""
    values = np.ascontiguousarray(values)
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 3) if values.size else b""


def unpacked(blob: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    if not blob:
        return np.zeros(0, dtype)
    raw = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype)

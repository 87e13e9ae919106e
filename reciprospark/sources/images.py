"""Image files as a data source: headers and pixels, decoded file by file.

``spark.read.format("diffraction_images").load(path)`` after register(): a row for each file, with the numbers of its header and its
pixels. Files are dealt to partitions by their size. Filters on header columns are pushed down: of a file that they reject only the
header is read, and nothing is decoded. A file that cannot be decoded is a row with a message and no data.

The pixels are a byte-offset stream: the difference to the pixel before, in one byte, or after an escape of the least value of a size in two,
four or eight.

Paths are those that pyarrow's file systems reach (local ones, and s3, gs and hdfs where their libraries are there); for others, headers.headers
and decoded_column() read through Spark.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual

NAME = "diffraction_images"
#: Bytes of files in one partition, where one file is not larger.
PARTITION_BYTES = 64 << 20
HEADER_BYTES = 32 << 10
#: Fixed values of the file format: what precedes the stream, and the names of its MIME header.
START = b"\x0c\x1a\x04\xd5"
FAST, SLOW, SIZE = (rb"X-Binary-Size-Fastest-Dimension:\s*(\d+)", rb"X-Binary-Size-Second-Dimension:\s*(\d+)", rb"X-Binary-Size:\s*(\d+)")
SCHEMA = "path string, length long, start_angle double, increment double, wavelength double, panel_id int, n_slow int, n_fast int, data array<int>, message string"
_ARROW = pa.schema([
    ("path", pa.string()), ("length", pa.int64()), ("start_angle", pa.float64()), ("increment", pa.float64()), ("wavelength", pa.float64()),
    ("panel_id", pa.int32()), ("n_slow", pa.int32()), ("n_fast", pa.int32()), ("data", pa.list_(pa.int32())), ("message", pa.string()),
])
_HEADER = {"start_angle": "Start_angle", "increment": "Angle_increment", "wavelength": "Wavelength"}
_ESCAPES = ((1, -(1 << 7), "<b"), (2, -(1 << 15), "<h"), (4, -(1 << 31), "<i"), (8, None, "<q"))


def encoded(pixels: np.ndarray) -> bytes:
    """The byte-offset stream of pixels (whole numbers, in order)."""
    out = bytearray()
    for d in np.diff(pixels.astype(np.int64).ravel(), prepend=0).tolist():
        for size, least, kind in _ESCAPES:
            if least is None or least < d < -least:
                out += struct.pack(kind, d)
                break
            out += struct.pack(kind, least)
    return bytes(out)


def decoded(stream: bytes, n: int) -> np.ndarray:
    """n pixels (int32) of a byte-offset stream; ValueError if it is too short or a pixel is out of range."""
    steps = np.frombuffer(stream, dtype=np.int8)
    parts, at = [], 0
    for e in np.flatnonzero(steps == -128).tolist():
        if e < at:
            continue  # a byte of a longer difference
        parts.append(steps[at:e].astype(np.int64))
        at = e
        for size, least, kind in _ESCAPES:
            if at + size > len(stream):
                raise ValueError("the pixel stream ends within a pixel")
            (d,) = struct.unpack_from(kind, stream, at)
            at += size
            if d != least:
                break
        parts.append(np.array([d], dtype=np.int64))
    whole = np.cumsum(np.concatenate([*parts, steps[at:].astype(np.int64)])[:n])
    if len(whole) < n:
        raise ValueError(f"the pixel stream has {len(whole)} of {n} pixels")
    if n and (whole.min() < -(1 << 31) or whole.max() >= 1 << 31):
        raise ValueError("a pixel is out of the range of 32 bits")
    return whole.astype(np.int32)


def number(header: bytes, name: str) -> float | None:
    found = re.search(rb"(?im)^[ \t]*#[ \t]*" + name.encode() + rb"[ \t]+([+-]?(?:\d+\.?\d*|\.\d+))", header)
    return float(found[1]) if found else None


def pixels_of(content: bytes) -> tuple[int, int, np.ndarray]:
    """n_slow, n_fast and the pixels of a whole file; ValueError says what it lacks."""
    at = content.find(START)
    if at < 0:
        raise ValueError("no pixel stream")
    head = content[:at]
    sizes = [re.search(p, head) for p in (SLOW, FAST)]
    if not all(sizes):
        raise ValueError("no size of the image in its header")
    slow, fast = (int(x[1]) for x in sizes)
    length = re.search(SIZE, head)
    end = at + len(START) + int(length[1]) if length else len(content)
    return slow, fast, decoded(content[at + len(START) : end], slow * fast)


def decoded_column(content: Column) -> Column:
    """n_slow, n_fast, data and message of a column of whole files, as a struct: for files that Spark itself reads."""
    kind = "struct<n_slow: int, n_fast: int, data: array<int>, message: string>"

    @F.udf(kind)
    def decode(x):
        try:
            slow, fast, data = pixels_of(bytes(x or b""))
        except ValueError as e:
            return None, None, None, str(e)
        return slow, fast, data.tolist(), None

    return decode(content)


@dataclass
class Files(InputPartition):
    files: tuple[tuple[str, int], ...]


#: Filters on header columns that are judged before a file is decoded.
_TESTS: dict[type, Callable] = {
    EqualTo: lambda x, v: x == v, GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v,
    LessThanOrEqual: lambda x, v: x <= v, In: lambda x, v: x in v,
}


class ImageReader(DataSourceReader):
    def __init__(self, path: str, headers: bool = False) -> None:
        self.path, self.headers, self.filters = path, headers, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            if (type(f) in _TESTS or isinstance(f, (IsNull, IsNotNull))) and len(f.attribute) == 1 and f.attribute[0] in _HEADER:
                self.filters.append(f)
            else:
                yield f

    def passes(self, values: dict) -> bool:
        for f in self.filters:
            x = values[f.attribute[0]]
            if isinstance(f, IsNull):
                ok = x is None
            else:
                ok = x is not None and (isinstance(f, IsNotNull) or _TESTS[type(f)](x, f.value))
            if not ok:
                return False
        return True

    def partitions(self) -> list[Files]:
        where, path = _filesystem(self.path)
        found = where.get_file_info(path)
        if found.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [found] if found.type == fs.FileType.File else [x for x in where.get_file_info(fs.FileSelector(path, recursive=True)) if x.type == fs.FileType.File]
        out, held, size = [], [], 0
        for x in sorted(files, key=lambda x: x.path):
            if x.base_name.startswith((".", "_")):
                continue
            if held and size + x.size > PARTITION_BYTES:
                out.append(Files(tuple(held)))
                held, size = [], 0
            held.append((x.path, x.size))
            size += x.size
        return [*out, Files(tuple(held))]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        where, _ = _filesystem(self.path)
        for path, length in partition.files:
            with where.open_input_file(path) as f:
                head = f.read(HEADER_BYTES)
                header = head.split(b"_array_data.data", 1)[0]
                values = {c: number(header, name) for c, name in _HEADER.items()}
                if not self.passes(values):
                    continue
                content = b"" if self.headers else head + f.read()
            slow = fast = data = message = None
            try:
                if not self.headers:
                    slow, fast, data = pixels_of(content)
            except ValueError as e:
                message = str(e)
            row = [path, length, *values.values(), 0, slow, fast, data, message]
            yield pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip(row, _ARROW, strict=True)], schema=_ARROW)


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Images(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ImageReader:
        if not (path := self.options.get("path")):
            raise ValueError("give the path of the images")
        return ImageReader(path, self.options.get("headers", "false").lower() == "true")


def register(spark: SparkSession) -> None:
    """From now on in this session, images are a format of spark.read, and filters on their headers are pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Images)


def images(spark: SparkSession, path: str, headers: bool = False) -> DataFrame:
    """The images under a path (see SCHEMA). headers: of each file only its first HEADER_BYTES are read, and pixels are null."""
    register(spark)
    return spark.read.format(NAME).option("headers", str(headers).lower()).load(path)

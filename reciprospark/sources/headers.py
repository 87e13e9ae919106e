"""Header scans of image files: scan angles from text, without reading the pixels into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a file that are looked at first; a header that goes on beyond them is read to its end.
HEADER_BYTES = 32 << 10
DATA_MARK = r"_array_data\.data|octet-stream"
NUMBER = r"([+-]?\d*\.?\d+)"


def headers(spark: SparkSession, path: str) -> DataFrame:
    """path and header text of files: up to the mark of the binary part, or the whole file without one."""
    files = spark.read.format("binaryFile").load(path)
    head, whole = F.decode(F.substring("content", 1, HEADER_BYTES), "ISO-8859-1"), F.decode("content", "ISO-8859-1")
    return files.select("path", before_data(F.when(head.rlike(DATA_MARK), head).otherwise(whole)).alias("header"))


def before_data(header: Column) -> Column:
    """The lines before the binary part."""
    return F.regexp_extract(header, r"(?s)^(.*?)(?:(?:^|\n)[^\n]*(?:" + DATA_MARK + r")|\z)", 1)


def header_value(header: Column, name: str) -> Column:
    """The number of the first line "# name number", case aside; null without one."""
    found = F.regexp_extract(before_data(header), rf"(?im)^[ \t]*#[ \t]*{name}[ \t]+{NUMBER}", 1)
    return F.when(found != "", found).try_cast("double")


def angle_increment(header: Column) -> Column:
    return header_value(header, "Angle_increment")


def start_angle(header: Column) -> Column:
    return header_value(header, "Start_angle")


def route(increment: Column, forced: Column | str | None = None, legacy: bool = False) -> Column:
    """stills or sequence: a forced mode, case aside, before the header; increment 0 is stills; unknown is sequence (legacy: stills, with a tolerance)."""
    auto = F.when(increment.isNull() | (F.abs(increment) < 1e-6), "stills").otherwise("sequence") if legacy else F.when(increment == 0, "stills").otherwise("sequence")
    if forced is None:
        return auto
    forced = F.lower(forced if isinstance(forced, Column) else F.lit(forced))
    return F.when(forced.isin("stills", "sequence"), forced).otherwise(auto)


def frame_of(angle: Column, start: float, width: float) -> Column:
    """The frame that an angle falls in."""
    return F.floor((angle - start) / width + 1e-9).cast("int")


def reference_cell(lines: Column) -> Column:
    """a .. gamma and group of a CRYST1 record by its fixed columns, as a struct; null for other lines."""
    part = lambda a, n: F.trim(F.substring(lines, a, n)).try_cast("double")
    cell = F.struct(part(7, 9).alias("a"), part(16, 9).alias("b"), part(25, 9).alias("c"), part(34, 7).alias("alpha"), part(41, 7).alias("beta"), part(48, 7).alias("gamma"), F.trim(F.substring(lines, 56, 11)).alias("space_group"))
    return F.when(lines.startswith("CRYST1"), cell)

"""Exact quantiles of any number of rows, by narrowing histograms: at most MOST values of a group meet in one task.

The range of a group's values is cut into BUCKETS equal parts, counted with partial sums; the part that holds the rank sought is cut
again, until it holds few rows, which are sorted. The driver holds a range for each rank and group.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST, BUCKETS = 1_000_000, 1024


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def at_ranks(rows: DataFrame, ranks: Iterable[tuple[int, int]], ranges: dict[int, tuple[float, float, int]], most: int = MOST) -> dict[tuple[int, int], float]:
    """The value at each (key, rank), ranks from 1; rows: key (long), value (double, no nulls). ranges: least, greatest and number of each key's values."""
    session = rows.sparkSession
    open_ = {(k, r): (*ranges[k], 0) for k, r in ranks}  # low, high, rows between, rows below
    while wide := {a: s for a, s in open_.items() if s[2] > most and s[0] < s[1]}:
        table = session.createDataFrame([(k, r, lo, hi) for (k, r), (lo, hi, _, _) in wide.items()], "key long, rank long, lo double, hi double")
        hit = rows.join(F.broadcast(table), "key").where(F.col("value").between(F.col("lo"), F.col("hi")))
        part = F.least(F.floor((F.col("value") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * BUCKETS), F.lit(BUCKETS - 1)).alias("part")
        counts = hit.groupBy("key", "rank", part).agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
        of: dict[tuple[int, int], list] = {}
        for c in counts:
            of.setdefault((c["key"], c["rank"]), []).append(c)
        for (k, r), (_, _, _, below) in wide.items():
            for c in sorted(of[k, r], key=lambda c: c.part):
                if below + c.n >= r:
                    open_[k, r] = c.lo, c.hi, c.n, below
                    break
                below += c.n
    out = {a: lo for a, (lo, hi, _, _) in open_.items() if lo == hi}
    if rest := [(k, r, lo, hi, r - below) for (k, r), (lo, hi, _, below) in open_.items() if lo < hi]:
        table = session.createDataFrame(rest, "key long, rank long, lo double, hi double, place int")
        hit = rows.join(F.broadcast(table), "key").where(F.col("value").between(F.col("lo"), F.col("hi")))
        found = hit.groupBy("key", "rank", "place").agg(F.sort_array(F.collect_list("value")).alias("values"))
        out |= {(c["key"], c["rank"]): c.value for c in found.select("key", "rank", F.element_at("values", F.col("place")).alias("value")).collect()}
    return out


def _sides(n: int, share: float) -> tuple[int, int, float]:
    """The ranks on both sides of a share of n values, and how far to go from one to the other."""
    at = share * (n - 1)
    return math.floor(at) + 1, math.ceil(at) + 1, at - math.floor(at)


def by_key(rows: DataFrame, shares: Sequence[float], most: int = MOST) -> dict[int, list[float]]:
    """Quantiles (interpolated) of value for each key of rows (key long, value double), for a few keys of many rows each."""
    rows = rows.where(finite(F.col("value")))
    ranges = {r["key"]: (r.lo, r.hi, r.n) for r in rows.groupBy("key").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n")).collect()}
    ranks = {(k, r) for k, (_, _, n) in ranges.items() for q in shares for r in _sides(n, q)[:2]}
    found = at_ranks(rows, ranks, ranges, most)
    out = {}
    for k, (_, _, n) in ranges.items():
        each = [_sides(n, q) for q in shares]
        out[k] = [found[k, a] if f == 0 else found[k, a] + (found[k, b] - found[k, a]) * f for a, b, f in each]
    return out


def of(rows: DataFrame, value: str, shares: Sequence[float], most: int = MOST) -> list[float | None]:
    """Quantiles (interpolated) of a column over all rows; None without any."""
    return by_key(rows.select(F.lit(0).cast("long").alias("key"), F.col(value).cast("double").alias("value")), shares, most).get(0, [None] * len(shares))


#: Of the sketches that enclose a median, and the ranks on both sides that are taken for it: ten times what a sketch may be off by.
ACCURACY, MARGIN = 10_000, 0.001


def medians(rows: DataFrame) -> DataFrame:
    """key and median (exact) of value for each key of rows (key, value double; no nulls or NaN), for keys of any number of rows.

    Mergeable sketches enclose the middle; a second pass counts the rows below and the distinct values inside, of which a running
    count gives the value at each of the middle ranks. So of a key's rows, a few in a thousand meet in one task. Nothing comes to the driver.
    """
    ends = rows.groupBy("key").agg(F.count("*").alias("n"), F.percentile_approx("value", [0.5 - MARGIN, 0.5 + MARGIN], ACCURACY).alias("around"))
    ends = ends.select("key", "n", F.col("around")[0].alias("low"), F.col("around")[1].alias("high"))
    inside = rows.join(ends, "key").where("value <= high").select("key", "n", F.when(F.col("value") >= F.col("low"), F.col("value")).alias("v"))
    counted = inside.groupBy("key", "n", "v").agg(F.count("*").alias("c"))  # a null stands for all that lies below
    counted = counted.withColumn("upto", F.sum("c").over(Window.partitionBy("key").orderBy(F.col("v").asc_nulls_first())))

    def at(rank: Column) -> Column:
        here = F.min_by(F.struct("v"), F.when(F.col("upto") >= rank, F.col("upto")))
        return F.coalesce(here["v"], F.raise_error(F.lit("a sketch is off by more than its accuracy")).cast("double"))

    n = F.col("n")
    pair = counted.groupBy("key").agg(at(F.floor((n + 1) / 2)).alias("a"), at(F.floor(n / 2) + 1).alias("b"))
    return pair.select("key", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") / 2 + F.col("b") / 2).alias("median"))

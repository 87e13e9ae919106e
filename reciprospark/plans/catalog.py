"""Registry of the engine's own queries and of the SQL that gives the same rows.

"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reciprospark.plans import io_queries, merging_queries, phase_queries, pixel_queries, report_queries

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
for _part in (merging_queries, pixel_queries, report_queries, phase_queries, io_queries):
    QUERIES |= _part.QUERIES
    ORACLES |= _part.ORACLES

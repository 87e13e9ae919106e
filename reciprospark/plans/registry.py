"""How a module of queries lists them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lister():
    """(QUERIES, ORACLES, decorator): the decorator takes the key and the SQL, None without any."""
    queries: dict[str, Callable] = {}
    oracles: dict[str, str] = {}

    def query(key: str, sql: str | None = None):
        def put(f):
            queries[key] = f
            if sql is not None:
                oracles[key] = sql
            return f

        return put

    return queries, oracles, query


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """df with its doubles rounded."""
    return df.select(*[(F.round(c, digits) if t == "double" else F.col(c)).alias(c) for c, t in df.dtypes])


def r(c: Column | str, name: str, digits: int = 6) -> Column:
    return F.round(c, digits).alias(name)

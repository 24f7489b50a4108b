"""Registry of named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scoring import rounded
from .sqlkit import sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``check`` is the body of its check SQL."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if check is not None:
            ORACLES[name] = sql(check)
        return fn

    return register


def tidy(df: DataFrame, money: str = "", digits: int = 6) -> DataFrame:
    """Report form: whole numbers as BIGINT, doubles rounded (``money`` columns to cents)."""
    cents = money.split()
    cells = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            col = rounded(col.cast("double"), 2 if field.name in cents else digits)
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("long")
        cells.append(col.alias(field.name))
    return df.select(*cells)

"""Readers for stored tables: by catalog name or path (SRC-2, SRC-5)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What Spark reports when a table or path does not exist.
NOT_FOUND = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_optional(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None where its table or path does not exist. Any
    other error (rights, storage, format) is the caller's."""
    try:
        df = read()
        df.schema  # resolve now, not at the first action
        return df
    except AnalysisException as e:
        if e.getCondition() in NOT_FOUND:
            return None
        raise


#: Rows that a table looked up in a join may be broadcast with.
LOOKUP_ROWS = 1 << 18


def as_lookup(table: DataFrame, rows: int | None = None) -> DataFrame:
    """``table`` for a join that looks rows up in it. Spark judges a stored table by the size of
    its compressed columns, which rows in memory take many times: with more than LOOKUP_ROWS
    it would be collected by the driver all the same. Such a table is merged with the other
    side instead, and one whose few ``rows`` are known is broadcast."""
    if rows is None:
        return table.hint("merge") if table.count() > LOOKUP_ROWS else table
    return table.hint("merge") if rows > LOOKUP_ROWS else F.broadcast(table)

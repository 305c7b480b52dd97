"""Sentinel ("Unknown") dimension member (SRC-4 + SET-1, SPEC-10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_unknown_member(dim: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Append one row whose columns come from ``values`` (missing ones are typed
    NULLs), aligned by name and cast to the dimension's types. The row is built
    from a one-row range, so it carries an explicit schema and exists even when
    the dimension is empty."""
    one = dim.sparkSession.range(1).select([
        (values[f.name] if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in dim.schema.fields])
    return dim.unionByName(one)

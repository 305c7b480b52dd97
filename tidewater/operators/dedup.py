"""Latest row per natural key (WIN-1 + FLT-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructType


def _orderable(df: DataFrame, exclude: set[str]) -> list[str]:
    skip = (BinaryType, ArrayType, MapType, StructType)
    return [f.name for f in df.schema.fields
            if f.name not in exclude and not isinstance(f.dataType, skip)]


def latest_by_key(df: DataFrame, keys: Sequence[str], order_col: str = "ModifiedDate",
                  tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per ``keys``: the greatest ``order_col`` (NULL sorts last).

    Remaining columns break exact ties (all of them by default) so the pick is
    deterministic. ``row_number() == 1`` is planned with a partial
    WindowGroupLimit before the shuffle, so a hot key is already reduced to one
    row per map task before it reaches its reducer.
    """
    keys = list(keys)
    if tie_breakers is None:
        tie_breakers = _orderable(df, set(keys) | {order_col})
    order = [F.col(order_col).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tie_breakers]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_row_num", F.row_number().over(w))
              .filter(F.col("_row_num") == 1)
              .drop("_row_num"))

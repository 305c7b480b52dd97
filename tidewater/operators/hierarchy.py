"""Two-level parent/child flattening (JOIN-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_parent(df: DataFrame, id_col: str, parent_col: str, name_col: str,
                   out_name: str, out_parent_name: str) -> DataFrame:
    """Each node with its own name and its parent's name (NULL at the top).

    The node list is reduced to one row per id first (the smallest name, then
    parent), so a duplicated id can not multiply children and a rerun picks
    the same row.
    """
    nodes = df.groupBy(id_col).agg(F.min(F.struct(name_col, parent_col)).alias("_n")) \
              .select(id_col, F.col("_n")[parent_col].alias(parent_col), F.col("_n")[name_col].alias(name_col))
    parents = nodes.select(F.col(id_col).alias("_pid"), F.col(name_col).alias(out_parent_name))
    return (nodes.join(parents, nodes[parent_col] == parents["_pid"], "left")
                 .select(nodes[id_col], nodes[name_col].alias(out_name), nodes[parent_col],
                         parents[out_parent_name]))

"""Dense surrogate keys 1..n in natural-key order without a single-partition window.

``row_number().over(Window.orderBy(k))`` moves every row into one task. Here the
rows are range-partitioned on the order key, numbered inside each partition,
and shifted by the row count of all earlier partitions. The counts, one number a
range partition, come to the driver and go back as one constant array: bounded by
the partition count, not by the data, and tables built on the key plan neither join
nor shuffle for it. There is one path, whatever the size of the input.

The range-partitioned rows are written once with a reliable ``checkpoint()``
(to ``spark.checkpoint.dir``) before they are counted and numbered. Two
separate range exchanges could sample different boundaries, and a lost
executor could re-sample them; reading positions back from the checkpoint
makes the numbering deterministic and cuts the lineage of the table above it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROW_BITS = 33  # monotonically_increasing_id = (partition index << 33) + row index


def assign_sequential_key(df: DataFrame, order_by: Sequence[str | Column], key: str,
                          num_partitions: int | None = None) -> DataFrame:
    """Add the BIGINT ``key`` = 1..n following ``order_by`` (ascending, NULLs first).

    The order key should be unique (a natural key); exact duplicates get
    consecutive numbers in an arbitrary but stable order. Runs one job (sample,
    shuffle, checkpoint write) when called. Without ``num_partitions`` Spark
    chooses the number of ranges from its own settings and the runtime sizes.
    """
    from tidewater.session import ensure_checkpoint_dir
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(num_partitions, *order_cols) if num_partitions \
        else df.repartitionByRange(*order_cols)
    tagged = (ranged.sortWithinPartitions(*order_cols)
                    .withColumn("_kp", F.spark_partition_id())
                    .withColumn("_km", F.monotonically_increasing_id())
                    .checkpoint(eager=True))
    before = _before(tagged.groupBy("_kp").agg(F.count(F.lit(1)).alias("_kn")))
    pos = F.col("_km") - F.shiftleft(F.col("_kp").cast("long"), _ROW_BITS)
    return tagged.withColumn(key, (before + pos + 1).cast("long")).drop("_kp", "_km")


def _before(ranges: DataFrame) -> Column:
    """For a row's range ``_kp``, the sum of ``_kn`` over the earlier ranges: a constant
    array (parsed once, by the optimizer), one number a range."""
    sums = {r._kp: int(r._kn or 0) for r in ranges.collect()}  # one row a range partition
    offsets, total = [], 0
    for k in range(max(sums, default=-1) + 1):
        offsets.append(total)
        total += sums.get(k, 0)
    return F.get(F.from_json(F.lit(json.dumps(offsets)), "array<bigint>"), F.col("_kp"))


def running_offsets(df: DataFrame, order_by: Sequence[str], weight: str, offset: str) -> DataFrame:
    """Add the BIGINT ``offset``: the sum of ``weight`` over all rows before this one in
    the order of ``order_by`` (unique). The upper level of a two-level numbering: give it
    one narrow row a group of rows, and number the rows inside their group. The narrow
    rows are checkpointed for the reason given above; the rows they stand for never move."""
    from tidewater.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(*order_by).withColumn("_kp", F.spark_partition_id()).checkpoint(eager=True)
    before = _before(ranged.groupBy("_kp").agg(F.sum(weight).alias("_kn")))
    inside = Window.partitionBy("_kp").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.withColumn("_kr", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
                  .withColumn(offset, (before + F.col("_kr")).cast("long"))
                  .drop("_kp", "_kr"))


def current_lookup(dim: DataFrame, natural_key: str, columns: Sequence[str]) -> DataFrame:
    """One row per natural key with those of ``columns`` that ``dim`` has, of its
    current version (the one with the largest first column, the surrogate key, if
    several are open)."""
    rows = dim.filter(F.col("IsCurrent")) if "IsCurrent" in dim.columns else dim
    columns = [c for c in columns if c in dim.columns]
    if not columns:
        return rows.select(natural_key).distinct()
    picked = rows.groupBy(natural_key).agg(F.max(F.struct(*columns)).alias("_v"))
    return picked.select(natural_key, *[F.col("_v")[c].alias(c) for c in columns])


def version_spans(dim: DataFrame, natural_key: str, surrogate_key: str) -> DataFrame:
    """Versions of a type-2 dimension as disjoint spans [_from, _to): a version
    holds until the next one starts, and the first also covers all earlier dates.
    So a natural key and a date meet at most one row."""
    order = Window.partitionBy(natural_key).orderBy("EffectiveDate", surrogate_key)
    return dim.select(
        natural_key, surrogate_key,
        F.when(F.row_number().over(order) == 1, F.lit("0001-01-01").cast("date")).otherwise(F.col("EffectiveDate")).alias("_from"),
        F.coalesce(F.lead("EffectiveDate").over(order), F.lit("9999-12-31").cast("date")).alias("_to"))

"""Helpers shared by the operators: table reads, staged tables, size-checked
broadcasts, byte-level word rules."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import ensure_checkpoint_dir

#: Rows per Arrow batch handed to Python; whole texts travel, so batches stay short.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of long texts can hold."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the cluster's shared folder (spark.checkpoint.dir)
    and read it back. Cuts the lineage; the files survive lost executors and can
    be read any number of times. ``clear_staged`` removes them."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Delete every staged table of this checkpoint folder, once no result needs it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-staged")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Most rows, and most bytes of their one wide column, that a broadcast may hold.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, wide: str | None = None) -> DataFrame:
    """Hint a broadcast only when ``df`` is counted to hold few enough rows, and
    few enough bytes in its ``wide`` column if it has one; else the join shuffles."""
    if df.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return df
    if wide and (df.agg(F.sum(F.octet_length(wide))).first()[0] or 0) > BROADCAST_BYTES:
        return df
    return F.broadcast(df)


#: Groups that hold one row in so many, or more, count as hot.
HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str) -> DataFrame:
    """``rows`` left-joined with ``groups``, one row for each key ``on`` (nulls are
    equal) and in ``size`` how many of ``rows`` have it. Hot groups, at most
    HOT_SHARE of them since sizes add up to the rows, are broadcast, so their rows
    stay where they are; the others meet in a shuffle, where no key is hot. Both
    frames are read several times: stage them before."""
    hot = F.col(size) * HOT_SHARE >= rows.count()
    values = [c for c in groups.columns if c not in on]
    keyed = groups.select(*[F.col(c).alias(f"__{c}") for c in on], *values)
    few, many = F.broadcast(keyed.filter(hot)), keyed.filter(~hot)

    def same(side: DataFrame):
        cond = F.lit(True)
        for c in on:
            cond = cond & rows[c].eqNullSafe(side[f"__{c}"])
        return cond
    out = [*rows.columns, *values]
    return rows.join(few, same(few)).select(*out).unionByName(
        rows.join(few, same(few), "left_anti").join(many, same(many), "left").select(*out))


def give_back_memory() -> None:
    """Return freed memory to the system at the end of a task: a worker process
    serves tasks of several operators, and what one of them freed would stay with
    it. Arrow keeps a pool of its own beside the C library's. Does nothing where the C
    library has no such call."""
    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` of a mapInArrow that gives freed memory back after its last batch, when
    what it held is gone too."""
    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back_memory()
    return whole


def byte_table(keep) -> bytes:
    """A bytes.translate table: A-Z to a-z, bytes outside ``keep`` to a space."""
    low = [b + 32 if 65 <= b <= 90 else b for b in range(256)]
    return bytes(b if keep(b) else 32 for b in low)


#: A-Z lower-cased, nothing else changed.
LOWER = byte_table(lambda b: True)
#: Words are runs of ASCII digits, letters and any byte from 0x80 (contract of decontamination).
WORDS = byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of many ranges, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)

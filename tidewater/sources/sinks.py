"""Writers (SNK-1, SNK-2) with the layer naming of SNK-3.

A write is one Spark job; its row count comes from an ``Observation`` attached
to the written plan, so the table is not computed a second time to count it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observed(seen: Observation, names: list[str], reread: Callable[[], DataFrame]) -> dict:
    """What a finished write has observed. Spark leaves the observation out of a plan that
    it finds to be empty; then the written table is looked at: no rows, nothing else."""
    try:
        return seen.get
    except (Py4JError, PySparkException):
        if reread().limit(1).count():
            raise
        return {"rows": 0, **dict.fromkeys(names)}


def through_storage(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written once into the cluster's shared checkpoint folder and read back: for a
    table that one result reads several times."""
    from tidewater.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/tidewater-{kind}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that one bucket holds about, so that a bucket fits a task at any size of the table.
BUCKET_ROWS = 1 << 19


def bucket_count(*tables: DataFrame, least: int = 8) -> int:
    """Buckets for tables that share their buckets: as many as the largest one needs."""
    return max(least, -(-max(t.count() for t in tables) // BUCKET_ROWS))


#: Compressed bytes that a file of a partitioned table has about.
FILE_BYTES = 16 << 20


def gathered(df: DataFrame, by: list[str], root: str) -> DataFrame:
    """``df`` with each value of ``by`` in tasks of its own, as many as its bytes need. The
    rows go there through files under ``root``, a folder for each value: compressed by column
    they take a third of what the same rows take in a shuffle."""
    spark = df.sparkSession
    df.write.option("compression", "zstd").partitionBy(*by).parquet(root)
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs, folders = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), [top]
    for _ in by:
        folders = [f.getPath() for folder in folders for f in fs.listStatus(folder) if f.isDirectory() and "=" in f.getPath().getName()]
    if not folders:
        return spark.createDataFrame([], df.schema)
    reader = spark.read.schema(df.schema).option("basePath", root)
    tasks = [max(1, -(-fs.getContentSummary(f).getLength() // FILE_BYTES)) for f in folders]
    tasks[0] += len(folders) > 1  # were each value one task, Spark would make one task of them all
    parts = [reader.parquet(f.toString()).coalesce(n) for f, n in zip(folders, tasks)]
    while len(parts) > 1:  # in pairs, so the plan stays flat
        parts = [a.union(b[0]) if b else a for a, *b in (parts[k:k + 2] for k in range(0, len(parts), 2))]
    return parts[0].select(*df.columns)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                replace_schema: bool = False, partition_by: list[str] | None = None,
                name: str | None = None, bucket_by: str | None = None, buckets: int = 0) -> int:
    """Write ``df`` and return the number of rows written. With ``name`` the table
    is also entered in Spark's session catalog, at the same path.
    ``replace_schema`` is for formats that keep a schema of their own (Delta);
    Parquet overwrites replace it anyway. A partitioned write first brings the
    rows of a partition value together, in as many tasks as they need (``gathered``),
    so tasks do not write a small file for every value each. A named table may
    be kept in ``buckets`` of a key, sorted by it, one file a bucket: joins and groupings
    by that key then read it without a shuffle."""
    if partition_by:
        from tidewater.session import ensure_checkpoint_dir
        spark = df.sparkSession
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidewater-parts/{uuid.uuid4().hex}"
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        try:
            return _write(gathered(df, partition_by, root), path, fmt, mode, replace_schema, partition_by, name)
        finally:
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    if bucket_by:
        df = df.repartition(buckets, bucket_by)
    return _write(df, path, fmt, mode, replace_schema, None, name, bucket_by, buckets)


def _write(df: DataFrame, path: str, fmt: str, mode: str, replace_schema: bool, partition_by: list[str] | None,
           name: str | None, bucket_by: str | None = None, buckets: int = 0) -> int:
    obs = Observation("write_stats")
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.format(fmt).mode(mode)
    if fmt == "parquet":  # two thirds of the bytes of Spark's own choice, in the same time
        writer = writer.option("compression", "zstd")
    if replace_schema:
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    if name:
        writer.option("path", path).saveAsTable(name)
    else:
        writer.save(path)
    return int(observed(obs, [], lambda: df.sparkSession.read.format(fmt).schema(df.schema).load(path))["rows"])

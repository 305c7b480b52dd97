"""Incremental bronze landing with Structured Streaming (EXT-1).

A file-stream source remembers which files it has read in its checkpoint, so
each run with ``availableNow`` ingests only files that arrived since the last
run, exactly once, and stops. The parquet sink's metadata log makes the
output consistent for batch readers even if a run dies half way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidewater.config import RunConfig
from tidewater.plans.bronze import bronze_table


def incremental_bronze(spark: SparkSession, source_dir: str, file_glob: str, schema: StructType,
                       to_source: Callable[[DataFrame], DataFrame], source_table: str,
                       cfg: RunConfig, target_path: str, checkpoint_path: str,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Append new files under ``source_dir`` matching ``file_glob`` to the
    bronze table at ``target_path``; return the bronze table as a batch frame."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.format(cfg.table_format).load(source_dir)
    landed = bronze_table(to_source(stream), source_table, cfg)
    query = (landed.writeStream.format(cfg.table_format)
             .outputMode("append")
             .option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True)
             .start(target_path))
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.format(cfg.table_format).load(target_path)

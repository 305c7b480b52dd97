"""Bronze audit columns (BRZ-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_audit_columns(df: DataFrame, ingest_ts: Column, source_system: str,
                       source_schema: str, source_table: str) -> DataFrame:
    return df.withColumns({
        "_ingest_timestamp": ingest_ts,
        "_source_system": F.lit(source_system),
        "_source_schema": F.lit(source_schema),
        "_source_table": F.lit(source_table),
    })

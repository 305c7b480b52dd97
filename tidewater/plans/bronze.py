"""Bronze: raw source rows plus audit columns (BRZ-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewater.config import RunConfig
from tidewater.operators.audit import with_audit_columns
from tidewater.sources.model import SOURCE_TABLES, SalesSources


def bronze_table(df: DataFrame, source_table: str, cfg: RunConfig) -> DataFrame:
    """All source columns unchanged + _ingest_timestamp, _source_system,
    _source_schema, _source_table."""
    return with_audit_columns(df, cfg.now(), cfg.source_system, cfg.source_schema, source_table)


class BronzeLayer(dict):
    """Bronze frames keyed by source attribute name, built on first access."""

    def __init__(self, sources: SalesSources, cfg: RunConfig):
        super().__init__()
        self._sources, self._cfg = sources, cfg
        self._names = {attr: SOURCE_TABLES[attr] for attr in sources.available()}

    def __missing__(self, attr: str) -> DataFrame:
        if attr not in self._names:
            raise KeyError(attr)
        df = bronze_table(getattr(self._sources, attr), self._names[attr], self._cfg)
        self[attr] = df
        return df

    def __contains__(self, attr) -> bool:
        return attr in self._names

    def keys(self):
        return self._names.keys()

    def items(self):
        return [(k, self[k]) for k in self._names]


def bronze_layer(sources: SalesSources, cfg: RunConfig) -> BronzeLayer:
    return BronzeLayer(sources, cfg)

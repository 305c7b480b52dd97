"""Run configuration: injected clock, calendar range, fiscal year, storage layout.

Every transform takes its "today" and "now" from here instead of calling
``current_date()`` / ``current_timestamp()`` so reruns are reproducible.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunConfig:
    # None means "use the session clock" (current_date / current_timestamp).
    as_of: date | None = None
    load_ts: datetime | None = None
    calendar_start: date = date(2000, 1, 1)
    calendar_end: date = date(2030, 12, 31)
    fiscal_start_month: int = 1
    source_system: str = "oltp"
    source_schema: str = "sales"
    table_format: str = "parquet"
    mask_salt: str | None = None  # secret of masked exports
    # Layer table prefixes (SNK-3).
    layer_prefix: dict = field(default_factory=lambda: {
        "bronze": "bronze_", "silver": "silver_", "gold": "gold_"})

    def today(self) -> Column:
        if self.as_of is None:
            return F.current_date()
        return F.lit(self.as_of.isoformat()).cast("date")

    def now(self) -> Column:
        if self.load_ts is None:
            return F.localtimestamp()
        return F.lit(self.load_ts.isoformat(sep=" ")).cast("timestamp_ntz")

    def with_(self, **kw) -> "RunConfig":
        return replace(self, **kw)

    def table_name(self, layer: str, table: str) -> str:
        return f"{self.layer_prefix[layer]}{table}"


# Fixed clock used by every fixture query so Spark and the SQL oracle agree.
FIXTURE_CONFIG = RunConfig(
    as_of=date(2001, 1, 1),
    load_ts=datetime(2001, 12, 31, 0, 0, 0),
    calendar_start=date(1995, 1, 1),
    calendar_end=date(2005, 12, 31),
    source_system="tpch_fixture",
    source_schema="dbo",
    mask_salt="fixture-salt",
)

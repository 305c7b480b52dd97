"""Sales lakehouse on Spark: bronze landing, silver cleansing, gold star schema,
data-quality checks and analytics, all as DataFrame -> DataFrame functions."""

__version__ = "0.1.0"

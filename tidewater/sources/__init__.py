from tidewater.sources.model import SOURCE_TABLES, SalesSources  # noqa: F401

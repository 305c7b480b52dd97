"""The ten source tables of the sales model, by their source names."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Source table names (fixed values of the order-management schema).
SOURCE_TABLES = {
    "customer": "Customer",
    "product": "Product",
    "product_category": "ProductCategory",
    "product_model": "ProductModel",
    "product_description": "ProductDescription",
    "model_description": "ProductModelProductDescription",
    "address": "Address",
    "customer_address": "CustomerAddress",
    "header": "SalesOrderHeader",
    "detail": "SalesOrderDetail",
}

# What identifies a row of each source table (fixed values of the schema).
NATURAL_KEYS = {
    "customer": ["CustomerID"],
    "product": ["ProductID"],
    "product_category": ["ProductCategoryID"],
    "product_model": ["ProductModelID"],
    "product_description": ["ProductDescriptionID"],
    "model_description": ["ProductModelID", "ProductDescriptionID", "Culture"],
    "address": ["AddressID"],
    "customer_address": ["CustomerID", "AddressID"],
    "header": ["SalesOrderID"],
    "detail": ["SalesOrderID", "SalesOrderDetailID"],
}


class SalesSources:
    """The source tables, built on first use: a query that needs only orders
    never plans (or numbers) the order lines."""

    def __init__(self, **tables):
        self._factories = {}
        self._built = {}
        for attr in SOURCE_TABLES:
            value = tables.get(attr)
            if callable(value) and not isinstance(value, DataFrame):
                self._factories[attr] = value
            elif value is not None:
                self._built[attr] = value

    def __getattr__(self, attr: str):
        if attr.startswith("_") or attr not in SOURCE_TABLES:
            raise AttributeError(attr)
        if attr not in self._built:
            factory = self._factories.get(attr)
            self._built[attr] = factory() if factory else None
        return self._built[attr]

    def available(self) -> list[str]:
        return [a for a in SOURCE_TABLES if a in self._built or a in self._factories]

    def items(self):
        for attr in self.available():
            df = getattr(self, attr)
            if df is not None:
                yield SOURCE_TABLES[attr], attr, df

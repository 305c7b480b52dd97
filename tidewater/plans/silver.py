"""Silver: cleansed, flagged, de-duplicated tables (SLV-1 .. SLV-7).

Each builder is a pure DataFrame -> DataFrame function over the bronze frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.config import RunConfig
from tidewater.functions.cleanse import (clean_email, discount_amount, line_total, order_total,
                                         safe_pct, title_case, upper_trim)
from tidewater.operators.dedup import latest_by_key


def silver_customer(bronze: DataFrame, cfg: RunConfig) -> DataFrame:
    # PasswordHash / PasswordSalt are never selected: they stay in bronze.
    names = [c for c in ("FirstName", "LastName") if c in bronze.columns]
    df = bronze.select(
        "CustomerID", "Title", *names, "Suffix", "CompanyName", "SalesPerson",
        clean_email(F.col("EmailAddress")).alias("EmailAddress"),
        "ModifiedDate", "_ingest_timestamp")
    df = df.withColumns({
        "_is_valid_email": F.col("EmailAddress").isNotNull(),
        "_has_company": F.col("CompanyName").isNotNull(),
        "_processing_timestamp": cfg.now(),
    })
    return latest_by_key(df, ["CustomerID"])


def silver_product(bronze: DataFrame, cfg: RunConfig) -> DataFrame:
    df = bronze.select(
        "ProductID",
        upper_trim(F.col("ProductNumber")).alias("ProductNumber"),
        title_case(F.col("Color")).alias("Color"),
        upper_trim(F.col("Size")).alias("Size"),
        "Weight", "StandardCost", "ListPrice", "ProductCategoryID", "ProductModelID",
        "SellStartDate", "SellEndDate", "DiscontinuedDate", "ThumbNailPhoto",
        "ThumbnailPhotoFileName", "ModifiedDate", "_ingest_timestamp")
    cost, price = F.col("StandardCost"), F.col("ListPrice")
    df = df.withColumns({
        "_is_active": F.col("SellEndDate").isNull() | (F.col("SellEndDate") > cfg.today()),
        "_is_discontinued": F.col("DiscontinuedDate").isNotNull(),
        # Three-valued: NULL cost or price gives NULL, which filters treat as false.
        "_has_valid_pricing": (cost > 0) & (price > 0) & (price >= cost),
        "_margin_pct": F.when(price > 0, safe_pct(price - cost, price)),
        "_processing_timestamp": cfg.now(),
    })
    return latest_by_key(df, ["ProductID"])


def _name_or_unknown(df: DataFrame) -> F.Column:
    """The source name when the column exists, else the constant 'Unknown'."""
    return F.col("Name") if "Name" in df.columns else F.lit("Unknown")


def silver_product_category(bronze: DataFrame, cfg: RunConfig) -> DataFrame:
    return bronze.select(
        "ProductCategoryID", "ParentProductCategoryID",
        _name_or_unknown(bronze).alias("Name"),
        "ModifiedDate", "_ingest_timestamp",
        F.col("ParentProductCategoryID").isNull().alias("_is_top_level"),
        cfg.now().alias("_processing_timestamp"))


def silver_product_model(bronze: DataFrame, cfg: RunConfig) -> DataFrame:
    return bronze.select(
        "ProductModelID", _name_or_unknown(bronze).alias("Name"),
        "ModifiedDate", "_ingest_timestamp", cfg.now().alias("_processing_timestamp"))


def silver_address(bronze: DataFrame, cfg: RunConfig) -> DataFrame:
    extra = [upper_trim(F.col(c)).alias(c) for c in ("StateProvince", "CountryRegion")
             if c in bronze.columns]
    df = bronze.select(
        "AddressID",
        F.trim("AddressLine1").alias("AddressLine1"),
        F.trim("AddressLine2").alias("AddressLine2"),
        title_case(F.col("City")).alias("City"),
        *extra,
        upper_trim(F.col("PostalCode")).alias("PostalCode"),
        "ModifiedDate", "_ingest_timestamp")
    df = df.withColumns({
        "_has_complete_address": (F.col("AddressLine1").isNotNull() & F.col("City").isNotNull()
                                  & F.col("PostalCode").isNotNull()),
        "_processing_timestamp": cfg.now(),
    })
    return latest_by_key(df, ["AddressID"])


def silver_order_header(bronze: DataFrame, cfg: RunConfig) -> DataFrame:
    df = bronze.select(
        "SalesOrderID", "RevisionNumber", "OrderDate", "DueDate", "ShipDate", "Status",
        "CustomerID", "ShipToAddressID", "BillToAddressID",
        F.trim("ShipMethod").alias("ShipMethod"),
        "CreditCardApprovalCode", "SubTotal", "TaxAmt", "Freight", "Comment",
        "ModifiedDate", "_ingest_timestamp")
    shipped = F.col("ShipDate").isNotNull()
    return df.withColumns({
        "TotalDue": order_total(F.col("SubTotal"), F.col("TaxAmt"), F.col("Freight")),
        "_is_shipped": shipped,
        "_days_to_ship": F.when(shipped, F.datediff(F.col("ShipDate"), F.col("OrderDate"))),
        "_is_overdue": ~shipped & (F.col("DueDate") < cfg.today()),
        "_has_valid_amounts": (F.col("SubTotal") > 0) & (F.col("TaxAmt") >= 0) & (F.col("Freight") >= 0),
        "_processing_timestamp": cfg.now(),
    })


def silver_order_detail(bronze: DataFrame, cfg: RunConfig) -> DataFrame:
    df = bronze.select("SalesOrderID", "SalesOrderDetailID", "OrderQty", "ProductID",
                       "UnitPrice", "UnitPriceDiscount", "ModifiedDate", "_ingest_timestamp")
    qty, price, disc = F.col("OrderQty"), F.col("UnitPrice"), F.col("UnitPriceDiscount")
    return df.withColumns({
        "LineTotal": line_total(qty, price, disc),
        "DiscountAmount": discount_amount(qty, price, disc),
        "_has_valid_quantities": qty > 0,
        "_has_valid_pricing": (price > 0) & (disc >= 0) & (disc < 1),
        "_has_discount": disc > 0,
        "_processing_timestamp": cfg.now(),
    })


SILVER_BUILDERS = {
    "customer": silver_customer,
    "product": silver_product,
    "product_category": silver_product_category,
    "product_model": silver_product_model,
    "address": silver_address,
    "header": silver_order_header,
    "detail": silver_order_detail,
}

"""Expected source schemas (the contract checked before any write, SPEC-9)."""

from __future__ import annotations

from pyspark.sql.types import (BinaryType, DecimalType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)

_I, _L, _S, _T = IntegerType(), LongType(), StringType(), TimestampNTZType()
_M = DecimalType(19, 4)


def _schema(*cols) -> StructType:
    return StructType([StructField(n, t) for n, t in cols])


EXPECTED_SOURCE_SCHEMAS = {
    "Customer": _schema(("CustomerID", _I), ("Title", _S), ("Suffix", _S), ("CompanyName", _S),
                        ("SalesPerson", _S), ("EmailAddress", _S), ("PasswordHash", _S),
                        ("PasswordSalt", _S), ("ModifiedDate", _T)),
    "Product": _schema(("ProductID", _I), ("ProductNumber", _S), ("Color", _S), ("Size", _S),
                       ("Weight", DecimalType(8, 2)), ("StandardCost", _M), ("ListPrice", _M),
                       ("ProductCategoryID", _I), ("ProductModelID", _I), ("SellStartDate", _T),
                       ("SellEndDate", _T), ("DiscontinuedDate", _T), ("ThumbNailPhoto", BinaryType()),
                       ("ThumbnailPhotoFileName", _S), ("ModifiedDate", _T)),
    "ProductCategory": _schema(("ProductCategoryID", _I), ("ParentProductCategoryID", _I),
                               ("rowguid", _S), ("ModifiedDate", _T)),
    "ProductModel": _schema(("ProductModelID", _I), ("rowguid", _S), ("ModifiedDate", _T)),
    "ProductDescription": _schema(("ProductDescriptionID", _I), ("Description", _S)),
    "ProductModelProductDescription": _schema(("ProductModelID", _I), ("ProductDescriptionID", _I),
                                              ("Culture", _S)),
    "Address": _schema(("AddressID", _I), ("AddressLine1", _S), ("AddressLine2", _S), ("City", _S),
                       ("StateProvince", _S), ("CountryRegion", _S), ("PostalCode", _S), ("rowguid", _S), ("ModifiedDate", _T)),
    "CustomerAddress": _schema(("CustomerID", _I), ("AddressID", _I), ("AddressType", _S), ("ModifiedDate", _T)),
    "SalesOrderHeader": _schema(("SalesOrderID", _L), ("RevisionNumber", _I), ("OrderDate", _T),
                                ("DueDate", _T), ("ShipDate", _T), ("Status", _I), ("CustomerID", _I),
                                ("ShipToAddressID", _I), ("BillToAddressID", _I), ("ShipMethod", _S),
                                ("CreditCardApprovalCode", _S), ("SubTotal", _M), ("TaxAmt", _M),
                                ("Freight", _M), ("Comment", _S), ("ModifiedDate", _T)),
    "SalesOrderDetail": _schema(("SalesOrderID", _L), ("SalesOrderDetailID", _L), ("OrderQty", _I),
                                ("ProductID", _I), ("UnitPrice", _M), ("UnitPriceDiscount", _M),
                                ("ModifiedDate", _T)),
}

# DuckDB type name -> Spark simple type string, for the SQL oracle of the check.
DUCK_TO_SPARK_TYPE_SQL = """lower(CASE typeof({c})
  WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'SMALLINT' THEN 'smallint'
  WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date'
  WHEN 'BOOLEAN' THEN 'boolean' WHEN 'BLOB' THEN 'binary' WHEN 'DOUBLE' THEN 'double'
  ELSE typeof({c}) END)"""

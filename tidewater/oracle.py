"""The same pipeline written as plain SQL (DuckDB dialect) for the correctness
oracle. Each step is one CTE named after the Spark table it mirrors; a query's
oracle is ``with_pipeline(final_select)``.

Fixed clock of the fixture run: as_of 2001-01-01, load 2001-12-31 00:00:00,
fact calendar 1995-01-01 .. 2005-12-31.
"""

from __future__ import annotations

AS_OF = "DATE '2001-01-01'"
LOAD_TS = "TIMESTAMP '2001-12-31 00:00:00'"
CAL_START, CAL_END = "1995-01-01", "2005-12-31"
EMAIL_RE = r"'^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$'"
LINEITEM_ORDER = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
                  "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: concat(upper(w[1]), lower(w[2:]))), ' ')")


def line_total(q: str, p: str, d: str) -> str:
    return (f"CAST(CAST({q} AS DECIMAL(10,0)) * {p} * (CAST(1 AS DECIMAL(1,0)) - "
            f"CAST({d} AS DECIMAL(5,4))) AS DECIMAL(19,4))")


def date_key(d: str) -> str:
    return f"CAST(strftime(CAST({d} AS DATE), '%Y%m%d') AS INTEGER)"


def date_attrs(d: str, fiscal_start: int = 1) -> str:
    """Calendar columns of Dim_Date except IsHoliday and the fiscal ones."""
    return f"""{date_key(d)} AS DateKey, CAST({d} AS DATE) AS Date,
      CAST(year({d}) AS INTEGER) AS Year, CAST(quarter({d}) AS INTEGER) AS Quarter,
      concat('Q', CAST(quarter({d}) AS VARCHAR)) AS QuarterName,
      CAST(month({d}) AS INTEGER) AS Month, strftime({d}, '%B') AS MonthName,
      strftime({d}, '%b') AS MonthNameShort, CAST(day({d}) AS INTEGER) AS DayOfMonth,
      CAST(isodow({d}) AS INTEGER) AS DayOfWeek, strftime({d}, '%A') AS DayOfWeekName,
      strftime({d}, '%a') AS DayOfWeekNameShort, CAST(dayofyear({d}) AS INTEGER) AS DayOfYear,
      CAST(weekofyear({d}) AS INTEGER) AS WeekOfYear, isodow({d}) IN (6, 7) AS IsWeekend"""


def fiscal_cols(d: str, fiscal_start: int = 1) -> str:
    shift = (13 - fiscal_start) % 12
    fy = f"year({d} + INTERVAL '{shift}' MONTH)" if shift else f"year({d})"
    fm = f"((month({d}) - {fiscal_start} + 12) % 12 + 1)"
    return (f"CAST({fy} AS INTEGER) AS FiscalYear, CAST(({fm} - 1) // 3 + 1 AS INTEGER) AS FiscalQuarter, "
            f"CAST({fm} AS INTEGER) AS FiscalMonth")


def days(start: str, end: str) -> str:
    return (f"SELECT CAST(unnest(generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}', "
            f"INTERVAL 1 DAY)) AS DATE) AS d")


def bronze(src: str, table: str) -> str:
    return (f"SELECT *, {LOAD_TS} AS _ingest_timestamp, 'tpch_fixture' AS _source_system, "
            f"'dbo' AS _source_schema, '{table}' AS _source_table FROM {src}")


def latest(body: str, key: str, cols: str) -> str:
    """Latest row per key; ties broken by all listed columns."""
    order = ", ".join(f"{c.strip()} DESC NULLS LAST" for c in cols.split(","))
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
            f"ORDER BY ModifiedDate DESC NULLS LAST, {order}) AS _rn FROM ({body})) WHERE _rn = 1")


CTES: dict[str, str] = {}

# ------------------------------------------------------------------ sources
CTES["src_customer_cur"] = """
  SELECT CAST(c_custkey AS INTEGER) AS CustomerID,
    CASE WHEN c_custkey % 3 = 0 THEN 'Mr.' WHEN c_custkey % 3 = 1 THEN 'Ms.' END AS Title,
    CAST(NULL AS VARCHAR) AS Suffix,
    CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS CompanyName,
    concat('sp', CAST(c_nationkey AS VARCHAR)) AS SalesPerson,
    CASE WHEN c_custkey % 7 = 0 THEN 'bad-email' WHEN c_custkey % 11 = 0 THEN NULL
         WHEN c_custkey % 13 = 0 THEN ' pad@Example.com'
         ELSE concat('User', CAST(c_custkey AS VARCHAR), '@Example.COM') END AS EmailAddress,
    md5(concat('pw', CAST(c_custkey AS VARCHAR))) AS PasswordHash,
    concat('s', CAST(c_custkey % 97 AS VARCHAR)) AS PasswordSalt,
    TIMESTAMP '2001-01-01 00:00:00' AS ModifiedDate
  FROM customer"""
CTES["src_customer"] = """
  SELECT * FROM src_customer_cur
  UNION ALL
  SELECT CustomerID, Title, Suffix, 'OLD', 'sp', 'old@example.com', PasswordHash, PasswordSalt,
         TIMESTAMP '2000-01-01 00:00:00'
  FROM src_customer_cur WHERE CustomerID % 10 = 0"""
CTES["src_product"] = """
  SELECT CAST(p_partkey AS INTEGER) AS ProductID,
    concat(' ', lower(p_brand), '-', CAST(p_partkey AS VARCHAR), ' ') AS ProductNumber,
    concat(lower(p_type), ' ') AS Color,
    CAST(p_size AS VARCHAR) AS Size,
    CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size AS DECIMAL(8,2)) END AS Weight,
    CAST(CASE WHEN p_partkey % 50 = 0 THEN 0
         ELSE CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.6 AS DECIMAL(2,1)) END AS DECIMAL(19,4)) AS StandardCost,
    CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DECIMAL(19,4)) AS ListPrice,
    CAST(100 + p_partkey % 25 AS INTEGER) AS ProductCategoryID,
    CASE WHEN p_partkey % 9 <> 0 THEN CAST(p_partkey % 64 AS INTEGER) END AS ProductModelID,
    TIMESTAMP '1995-01-01 00:00:00' AS SellStartDate,
    CASE WHEN p_partkey % 8 = 0 THEN TIMESTAMP '2000-06-30 00:00:00' END AS SellEndDate,
    CASE WHEN p_partkey % 20 = 0 THEN TIMESTAMP '2000-12-31 00:00:00' END AS DiscontinuedDate,
    CAST(NULL AS BLOB) AS ThumbNailPhoto,
    concat('p', CAST(p_partkey AS VARCHAR), '.gif') AS ThumbnailPhotoFileName,
    TIMESTAMP '2001-01-01 00:00:00' AS ModifiedDate
  FROM part"""
CTES["src_product_category"] = """
  SELECT ProductCategoryID, ParentProductCategoryID, Name,
         concat('cat-', CAST(ProductCategoryID AS VARCHAR)) AS rowguid,
         TIMESTAMP '2001-01-01 00:00:00' AS ModifiedDate
  FROM (SELECT CAST(r_regionkey AS INTEGER) AS ProductCategoryID,
               CAST(NULL AS INTEGER) AS ParentProductCategoryID, r_name AS Name FROM region
        UNION ALL
        SELECT CAST(100 + n_nationkey AS INTEGER), CAST(n_regionkey AS INTEGER), n_name FROM nation)"""
CTES["src_product_model"] = """
  SELECT ProductModelID, concat('Model ', CAST(ProductModelID AS VARCHAR)) AS Name,
         concat('mdl-', CAST(ProductModelID AS VARCHAR)) AS rowguid,
         TIMESTAMP '2001-01-01 00:00:00' AS ModifiedDate
  FROM (SELECT DISTINCT CAST(p_partkey % 64 AS INTEGER) AS ProductModelID FROM part)"""
CTES["src_product_description"] = """
  SELECT CAST(1000 + ProductModelID AS INTEGER) AS ProductDescriptionID,
         concat('Description ', CAST(ProductModelID AS VARCHAR)) AS Description,
         TIMESTAMP '2001-01-01 00:00:00' AS ModifiedDate FROM src_product_model
  UNION ALL
  SELECT CAST(2000 + ProductModelID AS INTEGER), concat('Description fr ', CAST(ProductModelID AS VARCHAR)),
         TIMESTAMP '2001-01-01 00:00:00' FROM src_product_model"""
CTES["src_model_description"] = """
  SELECT ProductModelID, CAST(1000 + ProductModelID AS INTEGER) AS ProductDescriptionID, 'en' AS Culture,
         TIMESTAMP '2001-01-01 00:00:00' AS ModifiedDate FROM src_product_model WHERE ProductModelID % 10 <> 0
  UNION ALL
  SELECT ProductModelID, CAST(2000 + ProductModelID AS INTEGER), 'fr', TIMESTAMP '2001-01-01 00:00:00'
  FROM src_product_model"""
CTES["src_address"] = """
  SELECT CAST(c_custkey AS INTEGER) AS AddressID,
    concat('  ', c_name, ' ') AS AddressLine1,
    CASE WHEN c_custkey % 2 = 1 THEN concat('Unit ', CAST(c_custkey AS VARCHAR)) END AS AddressLine2,
    lower(n_name) AS City, concat(lower(n_name), ' ') AS StateProvince, lower(r_name) AS CountryRegion,
    CASE WHEN c_custkey % 17 <> 0 THEN concat('pc', CAST(c_custkey AS VARCHAR)) END AS PostalCode,
    concat('adr-', CAST(c_custkey AS VARCHAR)) AS rowguid,
    TIMESTAMP '2001-01-01 00:00:00' AS ModifiedDate
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
CTES["src_customer_address"] = """
  SELECT CAST(c_custkey AS INTEGER) AS CustomerID, CAST(c_custkey AS INTEGER) AS AddressID,
         'Main Office' AS AddressType, TIMESTAMP '2001-01-01 00:00:00' AS ModifiedDate FROM customer"""
CTES["src_header"] = """
  SELECT CAST(o_orderkey AS BIGINT) AS SalesOrderID, CAST(1 AS INTEGER) AS RevisionNumber,
    o_orderdate AS OrderDate, o_orderdate + INTERVAL 12 DAY AS DueDate,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 7 DAY END AS ShipDate,
    CAST(CASE WHEN o_orderstatus = 'F' THEN 5 WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS INTEGER) AS Status,
    CAST(o_custkey AS INTEGER) AS CustomerID, CAST(o_custkey AS INTEGER) AS ShipToAddressID,
    CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_custkey AS INTEGER) END AS BillToAddressID,
    concat(o_orderpriority, ' ') AS ShipMethod,
    CASE WHEN o_orderkey % 3 = 0 THEN concat('cc', CAST(o_orderkey AS VARCHAR)) END AS CreditCardApprovalCode,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(19,4)) AS SubTotal,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.08 AS DECIMAL(3,2)) AS DECIMAL(19,4)) AS TaxAmt,
    CAST(CASE WHEN o_orderkey % 101 <> 0 THEN 25 END AS DECIMAL(19,4)) AS Freight,
    CAST(NULL AS VARCHAR) AS Comment, o_orderdate AS ModifiedDate
  FROM orders"""
CTES["src_detail"] = f"""
  SELECT CAST(l.l_orderkey AS BIGINT) AS SalesOrderID, CAST(l._rn AS BIGINT) AS SalesOrderDetailID,
    CAST(l.l_quantity AS SMALLINT) AS OrderQty, CAST(l.l_partkey AS INTEGER) AS ProductID,
    CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) AS DECIMAL(19,4)) AS UnitPrice,
    CAST(CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(19,4)) AS UnitPriceDiscount,
    l.l_shipdate AS ModifiedDate
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINEITEM_ORDER}) AS _rn FROM lineitem) l
  JOIN part p ON l.l_partkey = p.p_partkey"""

# ------------------------------------------------------------------ bronze
BRONZE_NAMES = {"customer": "Customer", "product": "Product", "product_category": "ProductCategory",
                "product_model": "ProductModel", "product_description": "ProductDescription",
                "model_description": "ProductModelProductDescription", "address": "Address",
                "customer_address": "CustomerAddress", "header": "SalesOrderHeader",
                "detail": "SalesOrderDetail"}
for _k, _t in BRONZE_NAMES.items():
    CTES[f"brz_{_k}"] = bronze(f"src_{_k}", _t)

# ------------------------------------------------------------------ silver
CTES["slv_customer"] = latest(f"""
  SELECT CustomerID, Title, Suffix, CompanyName, SalesPerson,
    CASE WHEN regexp_matches(EmailAddress, {EMAIL_RE}) THEN lower(trim(EmailAddress)) END AS EmailAddress,
    ModifiedDate, _ingest_timestamp,
    (CASE WHEN regexp_matches(EmailAddress, {EMAIL_RE}) THEN lower(trim(EmailAddress)) END) IS NOT NULL AS _is_valid_email,
    CompanyName IS NOT NULL AS _has_company, {LOAD_TS} AS _processing_timestamp
  FROM brz_customer""", "CustomerID", "Title, Suffix, CompanyName, SalesPerson, EmailAddress")
CTES["slv_product"] = latest(f"""
  SELECT ProductID, upper(trim(ProductNumber)) AS ProductNumber, {initcap('trim(Color)')} AS Color,
    upper(trim(Size)) AS Size, Weight, StandardCost, ListPrice, ProductCategoryID, ProductModelID,
    SellStartDate, SellEndDate, DiscontinuedDate, ThumbNailPhoto, ThumbnailPhotoFileName,
    ModifiedDate, _ingest_timestamp,
    SellEndDate IS NULL OR SellEndDate > {AS_OF} AS _is_active,
    DiscontinuedDate IS NOT NULL AS _is_discontinued,
    (StandardCost > 0) AND (ListPrice > 0) AND (ListPrice >= StandardCost) AS _has_valid_pricing,
    CASE WHEN ListPrice > 0 THEN CAST(ListPrice - StandardCost AS DOUBLE) / CAST(ListPrice AS DOUBLE) * 100.0 END AS _margin_pct,
    {LOAD_TS} AS _processing_timestamp
  FROM brz_product""", "ProductID", "ProductNumber, Color, Size, StandardCost, ListPrice")
CTES["slv_product_category"] = f"""
  SELECT ProductCategoryID, ParentProductCategoryID, Name, ModifiedDate, _ingest_timestamp,
         ParentProductCategoryID IS NULL AS _is_top_level, {LOAD_TS} AS _processing_timestamp
  FROM brz_product_category"""
CTES["slv_product_model"] = f"""
  SELECT ProductModelID, Name, ModifiedDate, _ingest_timestamp, {LOAD_TS} AS _processing_timestamp
  FROM brz_product_model"""
CTES["slv_address"] = latest(f"""
  SELECT AddressID, trim(AddressLine1) AS AddressLine1, trim(AddressLine2) AS AddressLine2,
    {initcap('trim(City)')} AS City,
    upper(trim(StateProvince)) AS StateProvince, upper(trim(CountryRegion)) AS CountryRegion, upper(trim(PostalCode)) AS PostalCode, ModifiedDate, _ingest_timestamp,
    trim(AddressLine1) IS NOT NULL AND City IS NOT NULL AND PostalCode IS NOT NULL AS _has_complete_address,
    {LOAD_TS} AS _processing_timestamp
  FROM brz_address""", "AddressID", "AddressLine1, AddressLine2, City, StateProvince, CountryRegion, PostalCode")
CTES["slv_header"] = f"""
  SELECT SalesOrderID, RevisionNumber, OrderDate, DueDate, ShipDate, Status, CustomerID,
    ShipToAddressID, BillToAddressID, trim(ShipMethod) AS ShipMethod, CreditCardApprovalCode,
    SubTotal, TaxAmt, Freight, Comment, ModifiedDate, _ingest_timestamp,
    CAST(SubTotal + TaxAmt + Freight AS DECIMAL(19,4)) AS TotalDue,
    ShipDate IS NOT NULL AS _is_shipped,
    CASE WHEN ShipDate IS NOT NULL THEN CAST(date_diff('day', CAST(OrderDate AS DATE), CAST(ShipDate AS DATE)) AS INTEGER) END AS _days_to_ship,
    (ShipDate IS NULL) AND (DueDate < {AS_OF}) AS _is_overdue,
    (SubTotal > 0) AND (TaxAmt >= 0) AND (Freight >= 0) AS _has_valid_amounts,
    {LOAD_TS} AS _processing_timestamp
  FROM brz_header"""
CTES["slv_detail"] = f"""
  SELECT SalesOrderID, SalesOrderDetailID, OrderQty, ProductID, UnitPrice, UnitPriceDiscount,
    ModifiedDate, _ingest_timestamp,
    {line_total('OrderQty', 'UnitPrice', 'UnitPriceDiscount')} AS LineTotal,
    CAST(CAST(OrderQty AS DECIMAL(10,0)) * UnitPrice * CAST(UnitPriceDiscount AS DECIMAL(5,4)) AS DECIMAL(19,4)) AS DiscountAmount,
    OrderQty > 0 AS _has_valid_quantities,
    (UnitPrice > 0) AND (UnitPriceDiscount >= 0) AND (UnitPriceDiscount < 1) AS _has_valid_pricing,
    UnitPriceDiscount > 0 AS _has_discount,
    {LOAD_TS} AS _processing_timestamp
  FROM brz_detail"""

# ------------------------------------------------------------------ gold
CTES["dim_date"] = f"""
  SELECT {date_attrs('d')}, FALSE AS IsHoliday, {fiscal_cols('d')}
  FROM ({days(CAL_START, CAL_END)})"""
CTES["dim_customer"] = """
  SELECT CAST(row_number() OVER (ORDER BY CustomerID) AS BIGINT) AS CustomerKey, CustomerID, Title,
    CAST(NULL AS VARCHAR) AS FirstName, CAST(NULL AS VARCHAR) AS LastName, Suffix, CompanyName,
    SalesPerson, EmailAddress, ModifiedDate, TRUE AS IsCurrent, DATE '2001-01-01' AS EffectiveDate,
    CAST(NULL AS DATE) AS EndDate
  FROM slv_customer"""
CTES["cat_flat"] = """
  SELECT c.ProductCategoryID, c.Name AS ProductCategoryName, c.ParentProductCategoryID,
         p.Name AS ParentProductCategoryName
  FROM slv_product_category c LEFT JOIN slv_product_category p ON c.ParentProductCategoryID = p.ProductCategoryID"""
CTES["desc_en"] = """
  SELECT b.ProductModelID, arg_min(d.Description, d.ProductDescriptionID) AS ProductName
  FROM brz_model_description b JOIN brz_product_description d ON b.ProductDescriptionID = d.ProductDescriptionID
  WHERE trim(b.Culture) = 'en' GROUP BY b.ProductModelID"""
CTES["dim_product"] = """
  SELECT CAST(row_number() OVER (ORDER BY p.ProductID) AS BIGINT) AS ProductKey, p.ProductID,
    p.ProductNumber, de.ProductName, p.Color, p.Size, p.Weight, p.StandardCost, p.ListPrice,
    p.ProductCategoryID, cf.ProductCategoryName, cf.ParentProductCategoryID, cf.ParentProductCategoryName,
    p.ProductModelID, m.Name AS ProductModelName, p.SellStartDate, p.SellEndDate, p.DiscontinuedDate,
    p.DiscontinuedDate IS NOT NULL AS IsDiscontinued, p.ModifiedDate, TRUE AS IsCurrent,
    DATE '2001-01-01' AS EffectiveDate, CAST(NULL AS DATE) AS EndDate
  FROM slv_product p
  LEFT JOIN cat_flat cf ON p.ProductCategoryID = cf.ProductCategoryID
  LEFT JOIN slv_product_model m ON p.ProductModelID = m.ProductModelID
  LEFT JOIN desc_en de ON p.ProductModelID = de.ProductModelID"""
CTES["dim_address"] = f"""
  SELECT CAST(row_number() OVER (ORDER BY AddressID) AS BIGINT) AS AddressKey, AddressID, AddressLine1,
    AddressLine2, City, StateProvince, CountryRegion, PostalCode, ModifiedDate, TRUE AS IsCurrent,
    DATE '2001-01-01' AS EffectiveDate, CAST(NULL AS DATE) AS EndDate
  FROM slv_address
  UNION ALL
  SELECT -1, -1, 'Unknown', NULL, 'Unknown', 'Unknown', 'Unknown', '00000', {LOAD_TS}, TRUE, DATE '2001-01-01', NULL"""
CTES["fact_sales"] = """
  SELECT CAST(row_number() OVER (ORDER BY d.SalesOrderID, d.SalesOrderDetailID) AS BIGINT) AS SalesKey,
    d.SalesOrderID, d.SalesOrderDetailID, c.CustomerKey, p.ProductKey, od.DateKey AS OrderDateKey,
    dd.DateKey AS DueDateKey, sd.DateKey AS ShipDateKey, sa.AddressKey AS ShipToAddressKey,
    ba.AddressKey AS BillToAddressKey, d.OrderQty, d.UnitPrice, d.UnitPriceDiscount, d.LineTotal,
    p.StandardCost AS ProductStandardCost,
    CAST(d.LineTotal - CAST(d.OrderQty AS DECIMAL(10,0)) * p.StandardCost AS DECIMAL(19,4)) AS LineProfit,
    h.SubTotal AS OrderSubTotal, h.TaxAmt AS OrderTaxAmt, h.Freight AS OrderFreight,
    h.TotalDue AS OrderTotal, h.Status AS OrderStatus, h.ShipMethod, h.RevisionNumber
  FROM slv_detail d
  JOIN slv_header h ON d.SalesOrderID = h.SalesOrderID
  JOIN dim_product p ON d.ProductID = p.ProductID
  JOIN dim_customer c ON h.CustomerID = c.CustomerID
  JOIN dim_date od ON CAST(h.OrderDate AS DATE) = od.Date
  JOIN dim_date dd ON CAST(h.DueDate AS DATE) = dd.Date
  LEFT JOIN dim_date sd ON CAST(h.ShipDate AS DATE) = sd.Date
  LEFT JOIN dim_address sa ON h.ShipToAddressID = sa.AddressID
  LEFT JOIN dim_address ba ON h.BillToAddressID = ba.AddressID"""


def with_pipeline(final_sql: str, extra: dict[str, str] | None = None) -> str:
    ctes = dict(CTES)
    if extra:
        ctes.update(extra)
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {body}\n{final_sql}"

"""Registered queries: name -> (spark builder, oracle SQL or None).

Each builder takes (spark, sf_dir) and returns a DataFrame built from the
driver's tables through the full bronze -> silver -> gold plan. The oracle SQL
is the same computation in DuckDB over the same parquet views.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import oracle as O
from tidewater.config import FIXTURE_CONFIG
from tidewater.operators.dedup import latest_by_key
from tidewater.operators.merge import high_water_mark, rows_after, upsert
from tidewater.operators.scd import scd2_apply
from tidewater.plans import analytics as A
from tidewater.plans import gold as G
from tidewater.plans import quality as Q
from tidewater.plans import silver as S
from tidewater.plans.star import Star
from tidewater.schemas import DUCK_TO_SPARK_TYPE_SQL, EXPECTED_SOURCE_SCHEMAS

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def star(spark: SparkSession, sf_dir: str) -> Star:
    """A star over ``sf_dir`` as the files are now; its tables are lazy, so a query
    builds what it reads."""
    return Star.from_fixture(spark, sf_dir)


def _run_folder(spark: SparkSession, kind: str) -> str:
    """A new folder in the cluster's shared checkpoint folder."""
    from tidewater.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidewater-{kind}/{uuid.uuid4().hex}"


W = O.with_pipeline
MONEY_SUM = "CAST(SUM({c}) AS DECIMAL(38,4))"


def msum(c: str) -> str:
    return MONEY_SUM.format(c=c)


def pct(n: str, d: str) -> str:
    return f"CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) * 100.0"


# =========================================================== bronze / silver

@register("bronze_ingest_orders", W("SELECT * FROM brz_header"))
def bronze_ingest_orders(spark, sf):
    return star(spark, sf).bronze["header"]


for _key in O.BRONZE_NAMES:
    if _key != "header":
        def _bronze(spark, sf, _key=_key):
            return star(spark, sf).bronze[_key]
        register(f"bronze_{_key}", W(f"SELECT * FROM brz_{_key}"))(_bronze)


for _name, _cte, _key in [("silver_customer", "slv_customer", "customer"),
                          ("silver_product", "slv_product", "product"),
                          ("silver_product_category", "slv_product_category", "product_category"),
                          ("silver_product_model", "slv_product_model", "product_model"),
                          ("silver_address", "slv_address", "address"),
                          ("silver_order_header", "slv_header", "header"),
                          ("silver_order_detail", "slv_detail", "detail")]:
    def _silver(spark, sf, _key=_key):
        return star(spark, sf).silver[_key]
    register(_name, W(f"SELECT * FROM {_cte}"))(_silver)


@register("latest_event_per_user", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST,
    event_type DESC NULLS LAST, value DESC NULLS LAST, props DESC NULLS LAST) AS _rn FROM events)
WHERE _rn = 1""")
def latest_event_per_user(spark, sf):
    return latest_by_key(spark.read.parquet(f"{sf}/events.parquet"), ["user_id"], order_col="ts")


# =========================================================== gold

_SPAN_SQL = """
  SELECT CAST(date_trunc('year', least(min(CAST(OrderDate AS DATE)), min(CAST(DueDate AS DATE)),
              min(CAST(ShipDate AS DATE)))) AS DATE) AS lo,
         CAST(date_trunc('year', greatest(max(CAST(OrderDate AS DATE)), max(CAST(DueDate AS DATE)),
              max(CAST(ShipDate AS DATE)))) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS hi
  FROM slv_header"""
_SPAN_DAYS = ("SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), "
              "INTERVAL 1 DAY)) AS DATE) AS d FROM span")
HOLIDAYS = [(1, 1), (7, 4), (12, 25)]  # rule for the holiday list of the fiscal-calendar query
_HOLIDAY_SQL = " OR ".join(f"(month(d) = {m} AND day(d) = {dd})" for m, dd in HOLIDAYS)


def _order_span(st: Star) -> DataFrame:
    return G.calendar_span(st.silver["header"], ["OrderDate", "DueDate", "ShipDate"])


@register("gold_dim_date", W(f"SELECT {O.date_attrs('d')}, FALSE AS IsHoliday, {O.fiscal_cols('d')} FROM ({_SPAN_DAYS})",
                             {"span": _SPAN_SQL}))
def gold_dim_date(spark, sf):
    """Calendar over the whole years the orders touch."""
    return G.date_attributes(_order_span(star(spark, sf)))


@register("gold_dim_date_fiscal_july", W(
    f"SELECT {O.date_attrs('d', 7)}, ({_HOLIDAY_SQL}) AS IsHoliday, {O.fiscal_cols('d', 7)} FROM ({_SPAN_DAYS})",
    {"span": _SPAN_SQL}))
def gold_dim_date_fiscal_july(spark, sf):
    days = _order_span(star(spark, sf))
    return G.date_attributes(days, 7, G.rule_holidays(days, HOLIDAYS))


@register("gold_dim_customer", W("SELECT * FROM dim_customer"))
def gold_dim_customer(spark, sf):
    return star(spark, sf).dim_customer


@register("gold_dim_product", W("SELECT * FROM dim_product"))
def gold_dim_product(spark, sf):
    return star(spark, sf).dim_product


@register("gold_dim_address", W("SELECT * FROM dim_address"))
def gold_dim_address(spark, sf):
    return star(spark, sf).dim_address


@register("product_description_join", W("SELECT * FROM desc_en"))
def product_description_join(spark, sf):
    return star(spark, sf).descriptions


@register("gold_fact_sales", W("SELECT * FROM fact_sales"))
def gold_fact_sales(spark, sf):
    return star(spark, sf).fact_sales


# =========================================================== analytics

@register("revenue_by_year", W(f"""
SELECT d.Year, COUNT(DISTINCT f.SalesOrderID) AS Orders, {msum('f.LineTotal')} AS Revenue,
       {msum('f.LineProfit')} AS Profit
FROM fact_sales f JOIN dim_date d ON f.OrderDateKey = d.DateKey GROUP BY d.Year ORDER BY d.Year"""))
def revenue_by_year(spark, sf):
    st = star(spark, sf)
    return A.revenue_by_year(st.fact_measures, st.dim_date)


@register("top_products", W(f"""
SELECT p.ProductName, p.ProductCategoryName, p.ParentProductCategoryName,
       CAST(SUM(f.OrderQty) AS BIGINT) AS TotalQuantity, {msum('f.LineTotal')} AS TotalRevenue,
       {msum('f.LineProfit')} AS TotalProfit
FROM fact_sales f JOIN dim_product p ON f.ProductKey = p.ProductKey
GROUP BY p.ProductName, p.ProductCategoryName, p.ParentProductCategoryName
ORDER BY TotalRevenue DESC, ProductName ASC NULLS FIRST, ProductCategoryName ASC NULLS FIRST,
         ParentProductCategoryName ASC NULLS FIRST
LIMIT 10"""))
def top_products(spark, sf):
    st = star(spark, sf)
    return A.top_products(st.order_lines, st.products)


@register("top_product_numbers", W(f"""
SELECT p.ProductNumber, p.ProductCategoryName, CAST(SUM(f.OrderQty) AS BIGINT) AS Quantity,
       {msum('f.LineTotal')} AS Revenue
FROM fact_sales f JOIN dim_product p ON f.ProductKey = p.ProductKey
GROUP BY p.ProductNumber, p.ProductCategoryName
ORDER BY Revenue DESC, ProductNumber ASC NULLS FIRST, ProductCategoryName ASC NULLS FIRST
LIMIT 10"""))
def top_product_numbers(spark, sf):
    st = star(spark, sf)
    return A.top_product_numbers(st.order_lines, st.products)


@register("revenue_by_category", W(f"""
SELECT COALESCE(p.ParentProductCategoryName, p.ProductCategoryName) AS Category,
       COUNT(DISTINCT f.SalesOrderID) AS OrderCount, CAST(SUM(f.OrderQty) AS BIGINT) AS TotalQuantity,
       {msum('f.LineTotal')} AS TotalRevenue
FROM fact_sales f JOIN dim_product p ON f.ProductKey = p.ProductKey
GROUP BY COALESCE(p.ParentProductCategoryName, p.ProductCategoryName)
ORDER BY TotalRevenue DESC, Category"""))
def revenue_by_category(spark, sf):
    st = star(spark, sf)
    return A.revenue_by_category(st.order_lines, st.products)


@register("monthly_trend", W(f"""
SELECT d.Year, d.Month, d.MonthName, COUNT(DISTINCT f.SalesOrderID) AS OrderCount,
       {msum('f.LineTotal')} AS TotalRevenue
FROM fact_sales f JOIN dim_date d ON f.OrderDateKey = d.DateKey
GROUP BY d.Year, d.Month, d.MonthName ORDER BY d.Year, d.Month"""))
def monthly_trend(spark, sf):
    st = star(spark, sf)
    return A.monthly_trend(st.fact_measures, st.dim_date)


@register("fact_summary", W(f"""
SELECT *, {pct('total_profit', 'total_revenue')} AS profit_margin_pct FROM (
  SELECT COUNT(*) AS total_row_count, COUNT(DISTINCT SalesOrderID) AS unique_orders,
         {msum('LineTotal')} AS total_revenue, {msum('LineProfit')} AS total_profit FROM fact_sales)"""))
def fact_summary(spark, sf):
    return A.fact_summary(star(spark, sf).fact_measures)


_TABLE_COUNTS = [("Dim_Date", "dim_date"), ("Dim_Customer", "dim_customer"),
                 ("Dim_Product", "dim_product"), ("Dim_Address", "dim_address"),
                 ("Fact_Sales", "fact_sales"), ("bronze_Customer", "brz_customer"),
                 ("bronze_Product", "brz_product"), ("bronze_SalesOrderDetail", "brz_detail")]


@register("table_counts", W("\nUNION ALL\n".join(
    f"SELECT '{label}' AS table_name, COUNT(*) AS row_count FROM {cte}" for label, cte in _TABLE_COUNTS)))
def table_counts(spark, sf):
    st = star(spark, sf)
    return A.labelled_counts({**st.gold_rows(), "bronze_Customer": st.bronze["customer"],
                              "bronze_Product": st.bronze["product"], "bronze_SalesOrderDetail": st.bronze["detail"]})


# =========================================================== validation

_FKS = [("CustomerKey", "dim_customer", "CustomerKey", "Dim_Customer"),
        ("ProductKey", "dim_product", "ProductKey", "Dim_Product"),
        ("OrderDateKey", "dim_date", "DateKey", "Dim_Date"),
        ("DueDateKey", "dim_date", "DateKey", "Dim_Date"),
        ("ShipDateKey", "dim_date", "DateKey", "Dim_Date"),
        ("ShipToAddressKey", "dim_address", "AddressKey", "Dim_Address"),
        ("BillToAddressKey", "dim_address", "AddressKey", "Dim_Address")]


@register("fk_orphans", W("\nUNION ALL\n".join(f"""
SELECT '{fk}' AS foreign_key, '{dname}' AS dimension, COUNT(f.{fk}) AS non_null_keys,
       COUNT(*) FILTER (WHERE f.{fk} IS NULL) AS null_keys,
       COUNT(*) FILTER (WHERE f.{fk} IS NOT NULL AND k._dk IS NULL) AS orphans
FROM fact_sales f LEFT JOIN (SELECT DISTINCT {dk} AS _dk FROM {cte}) k ON f.{fk} = k._dk"""
    for fk, cte, dk, dname in _FKS)))
def fk_orphans(spark, sf):
    st = star(spark, sf)
    fact = st.fact_places
    dims = {"dim_customer": st.dim_customer, "dim_product": st.dim_product,
            "dim_date": st.dim_date, "dim_address": st.dim_address}
    return Q.fk_orphans(fact, [(fk, dims[cte], dk, dname) for fk, cte, dk, dname in _FKS])


_DIM_KEYS = [("Dim_Customer", "dim_customer", "CustomerKey"), ("Dim_Product", "dim_product", "ProductKey"),
             ("Dim_Date", "dim_date", "DateKey"), ("Dim_Address", "dim_address", "AddressKey")]


@register("key_uniqueness", W("\nUNION ALL\n".join(f"""
SELECT '{name}' AS dimension, '{key}' AS key_column, COUNT(*) AS rows, COUNT(DISTINCT {key}) AS distinct_keys,
       COUNT(*) = COUNT(DISTINCT {key}) AS is_unique FROM {cte}""" for name, cte, key in _DIM_KEYS)))
def key_uniqueness(spark, sf):
    st = star(spark, sf)
    dims = {"dim_customer": st.dim_customer, "dim_product": st.dim_product,
            "dim_date": st.dim_date, "dim_address": st.dim_address}
    return Q.key_uniqueness({name: (dims[cte], key) for name, cte, key in _DIM_KEYS})


@register("row_reconciliation", W("""
SELECT 'SalesOrderDetail' AS source_table, 'Fact_Sales' AS target_table, s AS source_rows, t AS target_rows,
       s - t AS difference, s = t AS is_match
FROM (SELECT (SELECT COUNT(*) FROM brz_detail) AS s, (SELECT COUNT(*) FROM fact_sales) AS t)"""))
def row_reconciliation(spark, sf):
    st = star(spark, sf)
    return Q.row_reconciliation(st.bronze["detail"], st.fact_measures, "SalesOrderDetail", "Fact_Sales")


@register("measure_check", W("""
SELECT COUNT(*) AS rows_checked,
       COUNT(*) FILTER (WHERE abs(CAST(OrderQty AS DOUBLE) * CAST(UnitPrice AS DOUBLE)
             * (1.0 - CAST(UnitPriceDiscount AS DOUBLE)) - CAST(LineTotal AS DOUBLE)) >= 0.01) AS mismatches
FROM fact_sales"""))
def measure_check(spark, sf):
    return Q.measure_check(star(spark, sf).fact_measures)


def _pct_sql(table: str, flags: dict[str, str]) -> str:
    counts = ", ".join(f"COUNT(*) FILTER (WHERE {flag}) AS {name}" for name, flag in flags.items())
    pcts = ", ".join(f"{pct(name, 'total')} AS pct_{name}" for name in flags)
    return W(f"SELECT *, {pcts} FROM (SELECT COUNT(*) AS total, {counts} FROM {table})")


@register("dq_customer", _pct_sql("slv_customer", {"valid_email": "_is_valid_email", "has_company": "_has_company"}))
def dq_customer(spark, sf):
    return Q.dq_customer(star(spark, sf).silver["customer"])


@register("dq_product", _pct_sql("slv_product", {"active": "_is_active", "valid_pricing": "_has_valid_pricing"}))
def dq_product(spark, sf):
    return Q.dq_product(star(spark, sf).silver["product"])


@register("dq_orders", _pct_sql("slv_header", {"shipped": "_is_shipped", "overdue": "_is_overdue",
                                               "valid_amounts": "_has_valid_amounts"}))
def dq_orders(spark, sf):
    return Q.dq_orders(star(spark, sf).silver["header"])


@register("business_metrics", W(f"""
SELECT *, {pct('total_profit', 'total_revenue')} AS profit_margin_pct,
       CAST(total_revenue AS DOUBLE) / CAST(total_orders AS DOUBLE) AS avg_order_value FROM (
  SELECT COUNT(DISTINCT SalesOrderID) AS total_orders, COUNT(*) AS total_lines,
         {msum('LineTotal')} AS total_revenue, {msum('LineProfit')} AS total_profit FROM fact_sales)"""))
def business_metrics(spark, sf):
    return Q.business_metrics(star(spark, sf).fact_measures)


_SOURCES = [("Customer", "src_customer"), ("Product", "src_product"), ("ProductCategory", "src_product_category"),
            ("ProductModel", "src_product_model"), ("ProductDescription", "src_product_description"),
            ("ProductModelProductDescription", "src_model_description"), ("Address", "src_address"),
            ("CustomerAddress", "src_customer_address"), ("SalesOrderHeader", "src_header"),
            ("SalesOrderDetail", "src_detail")]


@register("source_counts", W("\nUNION ALL\n".join(
    f"SELECT '{label}' AS table_name, COUNT(*) AS row_count FROM {cte}" for label, cte in _SOURCES)))
def source_counts(spark, sf):
    st = star(spark, sf)
    return A.labelled_counts({name: df for name, _, df in st.sources.items()})


# Silver tables with their published column counts (all / '_'-prefixed).
_SILVER_PROFILE = [("silver_Customer", "slv_customer", 11, 4), ("silver_Product", "slv_product", 21, 6),
                   ("silver_ProductCategory", "slv_product_category", 7, 3),
                   ("silver_ProductModel", "slv_product_model", 5, 2),
                   ("silver_Address", "slv_address", 11, 3), ("silver_SalesOrderHeader", "slv_header", 23, 6),
                   ("silver_SalesOrderDetail", "slv_detail", 14, 5)]
# Bronze tables carry 4 audit columns; gold tables carry none.
_BRONZE_COLUMNS = {"customer": 9, "product": 15, "product_category": 5, "product_model": 4, "product_description": 3,
                   "model_description": 4, "address": 9, "customer_address": 4, "header": 16, "detail": 7}
_BRONZE_PROFILE = [(f"bronze_{O.BRONZE_NAMES[k]}", f"brz_{k}", n + 4, 4) for k, n in _BRONZE_COLUMNS.items()]
_GOLD_PROFILE = [("gold_Dim_Date", "dim_date", 19, 0), ("gold_Dim_Customer", "dim_customer", 13, 0),
                 ("gold_Dim_Product", "dim_product", 23, 0), ("gold_Dim_Address", "dim_address", 12, 0),
                 ("gold_Fact_Sales", "fact_sales", 23, 0)]


@register("layer_profile", W("\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS rows, {n} AS columns, {h} AS quality_columns FROM {cte}"
    for name, cte, n, h in _BRONZE_PROFILE + _SILVER_PROFILE + _GOLD_PROFILE)))
def layer_profile(spark, sf):
    """Rows and columns of every table of all three layers (DQ-8)."""
    st = star(spark, sf)
    frames = {f"bronze_{O.BRONZE_NAMES[k]}": df for k, df in st.bronze.items()}
    frames.update({f"silver_{O.BRONZE_NAMES[k]}": df for k, df in st.silver.items()})
    frames.update({f"gold_{k}": df for k, df in st.gold_rows().items()})
    return Q.layer_profile(frames, {"gold_Dim_Date": G.DIM_DATE_COLUMNS, "gold_Dim_Customer": G.DIM_CUSTOMER_COLUMNS,
                                    "gold_Dim_Product": G.DIM_PRODUCT_COLUMNS, "gold_Dim_Address": G.DIM_ADDRESS_COLUMNS,
                                    "gold_Fact_Sales": G.FACT_SALES_COLUMNS})


_LAYER_TABLES = ([("bronze", f"brz_{k}") for k in O.BRONZE_NAMES]
                 + [("silver", cte) for _, cte, _, _ in _SILVER_PROFILE]
                 + [("gold", c) for c in ("dim_date", "dim_customer", "dim_product", "dim_address", "fact_sales")])


@register("tables_per_layer", W("SELECT layer, COUNT(*) AS table_count, CAST(SUM(n) AS BIGINT) AS total_rows FROM (\n"
                                + "\nUNION ALL\n".join(f"SELECT '{layer}' AS layer, COUNT(*) AS n FROM {cte}"
                                                       for layer, cte in _LAYER_TABLES)
                                + ") GROUP BY layer"))
def tables_per_layer(spark, sf):
    st = star(spark, sf)
    frames = {f"bronze_{k}": df for k, df in st.bronze.items()}
    frames.update({f"silver_{k}": df for k, df in st.silver.items()})
    frames.update({f"gold_{k}": df for k, df in st.gold_rows().items()})
    counts = A.labelled_counts(frames, "table_name", "n")
    return (counts.withColumn("layer", F.substring_index("table_name", "_", 1))
                  .groupBy("layer").agg(F.count(F.lit(1)).alias("table_count"),
                                        F.sum("n").cast("bigint").alias("total_rows")))


# =========================================================== spec items

@register("customer_summary", W(f"""
SELECT f.CustomerKey, COUNT(DISTINCT f.SalesOrderID) AS OrderCount, COUNT(*) AS LineCount,
       CAST(SUM(f.OrderQty) AS BIGINT) AS TotalQuantity, {msum('f.LineTotal')} AS TotalRevenue,
       {msum('f.LineProfit')} AS TotalProfit, MIN(f.OrderDateKey) AS FirstOrderDateKey,
       MAX(f.OrderDateKey) AS LastOrderDateKey, c.CustomerID, c.CompanyName
FROM fact_sales f JOIN dim_customer c ON f.CustomerKey = c.CustomerKey
GROUP BY f.CustomerKey, c.CustomerID, c.CompanyName"""))
def customer_summary(spark, sf):
    st = star(spark, sf)
    return A.customer_summary(st.fact_measures, st.dim_customer)


@register("orders_by_quarter", W(f"""
SELECT d.Year, d.Quarter, d.Month, COUNT(DISTINCT f.SalesOrderID) AS OrderCount, {msum('f.LineTotal')} AS TotalRevenue
FROM fact_sales f JOIN dim_date d ON f.OrderDateKey = d.DateKey
GROUP BY d.Year, d.Quarter, d.Month ORDER BY d.Year, d.Quarter, d.Month"""))
def orders_by_quarter(spark, sf):
    st = star(spark, sf)
    return A.orders_by_quarter(st.fact_measures, st.dim_date)


@register("monthly_aggregate", W(f"""
SELECT d.Year, d.Month, COUNT(DISTINCT f.SalesOrderID) AS OrderCount, COUNT(*) AS LineCount,
       CAST(SUM(f.OrderQty) AS BIGINT) AS TotalQuantity, {msum('f.LineTotal')} AS TotalRevenue,
       {msum('f.LineProfit')} AS TotalProfit
FROM fact_sales f JOIN dim_date d ON f.OrderDateKey = d.DateKey GROUP BY d.Year, d.Month"""))
def monthly_aggregate(spark, sf):
    st = star(spark, sf)
    return A.monthly_aggregate(st.fact_measures, st.dim_date)


@register("revenue_reconciliation", W(f"""
SELECT s AS source_revenue, t AS star_revenue, CAST(s - t AS DECIMAL(38,4)) AS difference
FROM (SELECT (SELECT {msum('LineTotal')} FROM slv_detail) AS s, (SELECT {msum('LineTotal')} FROM fact_sales) AS t)"""))
def revenue_reconciliation(spark, sf):
    st = star(spark, sf)
    return Q.revenue_reconciliation(st.silver["detail"], st.fact_measures)


@register("calendar_gaps", W("""
SELECT COUNT(*) AS rows, COUNT(DISTINCT d) AS distinct_dates, MIN(d) AS first_date, MAX(d) AS last_date,
       CAST(date_diff('day', MIN(d), MAX(d)) + 1 AS BIGINT) AS expected_days,
       CAST(date_diff('day', MIN(d), MAX(d)) + 1 - COUNT(DISTINCT d) AS BIGINT) AS missing_days,
       COUNT(*) - COUNT(DISTINCT d) AS duplicate_rows
FROM (""" + _SPAN_DAYS + ")", {"span": _SPAN_SQL}))
def calendar_gaps(spark, sf):
    return Q.calendar_check(G.date_attributes(_order_span(star(spark, sf))))


@register("geo_rollup", W(f"""
SELECT a.CountryRegion, a.StateProvince, a.City,
       CAST(GROUPING(a.CountryRegion, a.StateProvince, a.City) AS INTEGER) AS Level,
       COUNT(DISTINCT f.SalesOrderID) AS OrderCount, {msum('f.LineTotal')} AS TotalRevenue
FROM fact_sales f LEFT JOIN dim_address a ON f.ShipToAddressKey = a.AddressKey
GROUP BY ROLLUP (a.CountryRegion, a.StateProvince, a.City)"""))
def geo_rollup(spark, sf):
    st = star(spark, sf)
    return A.geo_rollup(st.fact_places, st.dim_address).withColumn("Level", F.col("Level").cast("int"))


@register("unknown_member_fact", W("""
SELECT 'ShipToAddressKey' AS role, COUNT(*) FILTER (WHERE sa.AddressKey IS NULL) AS unknown_rows, COUNT(*) AS total_rows
FROM fact_sales f JOIN slv_header h ON f.SalesOrderID = h.SalesOrderID LEFT JOIN dim_address sa ON h.ShipToAddressID = sa.AddressID
UNION ALL
SELECT 'BillToAddressKey', COUNT(*) FILTER (WHERE ba.AddressKey IS NULL), COUNT(*)
FROM fact_sales f JOIN slv_header h ON f.SalesOrderID = h.SalesOrderID LEFT JOIN dim_address ba ON h.BillToAddressID = ba.AddressID"""))
def unknown_member_fact(spark, sf):
    """Fact built with missing addresses mapped to the -1 member (SPEC-10)."""
    st = star(spark, sf)
    s = st.silver
    fact = G.fact_sales(s["detail"], s["header"], st.dim_product, st.dim_customer, st.dim_address,
                        st.cfg, unknown_address_key=True, with_sales_key=False)
    roles = ("ShipToAddressKey", "BillToAddressKey")
    counts = fact.agg(*[F.count_if(F.col(r) == -1).alias(r) for r in roles], F.count(F.lit(1)).alias("total_rows"))
    pairs = ", ".join(f"'{r}', {r}" for r in roles)
    return counts.selectExpr(f"stack({len(roles)}, {pairs}) AS (role, unknown_rows)", "total_rows")


#: Columns the fixture's sources have beyond the expected schemas.
_UNEXPECTED = {"ProductCategory": ["Name"], "ProductModel": ["Name"], "ProductDescription": ["ModifiedDate"],
               "ProductModelProductDescription": ["ModifiedDate"]}


def _schema_check_sql() -> str:
    src = dict((label, cte) for label, cte in _SOURCES)
    parts = []
    for table, schema in EXPECTED_SOURCE_SCHEMAS.items():
        for f in schema.fields:
            actual = DUCK_TO_SPARK_TYPE_SQL.format(c=f.name)
            exp = f.dataType.simpleString()
            parts.append(f"""SELECT '{table}' AS table_name, '{f.name}' AS column_name, '{exp}' AS expected_type,
  any_value({actual}) AS actual_type,
  CASE WHEN any_value({actual}) = '{exp}' THEN 'ok' ELSE 'type_mismatch' END AS status,
  COUNT(*) FILTER (WHERE {f.name} IS NULL) AS null_count FROM {src[table]}""")
        for name in _UNEXPECTED.get(table, ()):
            parts.append(f"""SELECT '{table}', '{name}', CAST(NULL AS VARCHAR), any_value({DUCK_TO_SPARK_TYPE_SQL.format(c=name)}),
  'unexpected', COUNT(*) FILTER (WHERE {name} IS NULL) FROM {src[table]}""")
    return W("\nUNION ALL\n".join(parts))


@register("schema_check", _schema_check_sql())
def schema_check(spark, sf):
    st = star(spark, sf)
    return Q.schema_check({name: df for name, _, df in st.sources.items()}, EXPECTED_SOURCE_SCHEMAS)


def _diff_sql(first: str, second: str) -> str:
    differs = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in G.FACT_SALES_COLUMNS if c != "SalesKey")
    return f"""
SELECT COUNT(a.SalesKey) AS rows_first, COUNT(b.SalesKey) AS rows_second,
       COUNT(*) FILTER (WHERE b.SalesKey IS NULL) AS only_in_first, COUNT(*) FILTER (WHERE a.SalesKey IS NULL) AS only_in_second,
       COUNT(*) FILTER (WHERE a.SalesKey IS NOT NULL AND b.SalesKey IS NOT NULL AND ({differs})) AS changed
FROM {first} a FULL JOIN {second} b ON a.SalesKey = b.SalesKey"""


@register("rerun_diff", W(_diff_sql("fact_sales", "fact_sales")))
def rerun_diff(spark, sf):
    """Two independent builds of the fact must be identical (SPEC-12)."""
    return Q.table_diff(star(spark, sf).fact_sales, star(spark, sf).fact_sales, ["SalesKey"])


# ------------------------------------------ the same checks on a fact with known faults

_FAULTY_CTE = {"faulty": """
  SELECT * REPLACE (CASE WHEN SalesOrderID % 11 = 0 THEN CustomerKey + 10000000 ELSE CustomerKey END AS CustomerKey,
      CASE WHEN SalesOrderID % 17 = 0 THEN -5 ELSE ShipToAddressKey END AS ShipToAddressKey,
      CASE WHEN SalesOrderID % 13 = 0 THEN CAST(LineTotal + 1 AS DECIMAL(19,4)) ELSE LineTotal END AS LineTotal,
      CASE WHEN SalesOrderID % 19 = 0 THEN NULL ELSE BillToAddressKey END AS BillToAddressKey)
  FROM fact_sales WHERE SalesOrderID % 7 <> 0"""}


def faulty_fact(fact: DataFrame) -> DataFrame:
    """A fact with known faults: lost orders, unknown customers and ship-to
    addresses, wrong line totals, lost bill-to addresses."""
    k = F.col("SalesOrderID")
    faults = {"CustomerKey": F.when(k % 11 == 0, F.col("CustomerKey") + 10000000).otherwise(F.col("CustomerKey")),
              "ShipToAddressKey": F.when(k % 17 == 0, F.lit(-5)).otherwise(F.col("ShipToAddressKey")),
              "LineTotal": F.when(k % 13 == 0, (F.col("LineTotal") + 1).cast("decimal(19,4)")).otherwise(F.col("LineTotal")),
              "BillToAddressKey": F.when(k % 19 == 0, F.lit(None)).otherwise(F.col("BillToAddressKey"))}
    return fact.filter(k % 7 != 0).withColumns({c: v.cast(fact.schema[c].dataType) for c, v in faults.items() if c in fact.columns})


@register("faulty_fk_orphans", W("\nUNION ALL\n".join(f"""
SELECT '{fk}' AS foreign_key, '{dname}' AS dimension, COUNT(f.{fk}) AS non_null_keys,
       COUNT(*) FILTER (WHERE f.{fk} IS NULL) AS null_keys,
       COUNT(*) FILTER (WHERE f.{fk} IS NOT NULL AND k._dk IS NULL) AS orphans
FROM faulty f LEFT JOIN (SELECT DISTINCT {dk} AS _dk FROM {cte}) k ON f.{fk} = k._dk"""
    for fk, cte, dk, dname in _FKS), _FAULTY_CTE))
def faulty_fk_orphans(spark, sf):
    """Orphans per foreign key where there are some (DQ-1)."""
    st = star(spark, sf)
    fact = faulty_fact(st.fact_places)
    dims = {"dim_customer": st.dim_customer, "dim_product": st.dim_product,
            "dim_date": st.dim_date, "dim_address": st.dim_address}
    return Q.fk_orphans(fact, [(fk, dims[cte], dk, dname) for fk, cte, dk, dname in _FKS])


@register("faulty_orphan_rows", W("""
SELECT f.SalesOrderID, f.SalesOrderDetailID, f.CustomerKey FROM faulty f
WHERE f.CustomerKey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.CustomerKey = f.CustomerKey)""", _FAULTY_CTE))
def faulty_orphan_rows(spark, sf):
    """The fact rows whose customer is missing from the dimension (JOIN-10)."""
    st = star(spark, sf)
    rows = Q.orphan_rows(faulty_fact(st.fact_lines), st.dim_customer, "CustomerKey", "CustomerKey")
    return rows.select("SalesOrderID", "SalesOrderDetailID", "CustomerKey")


@register("faulty_key_uniqueness", W("""
SELECT 'Dim_Customer' AS dimension, 'CustomerKey' AS key_column, COUNT(*) AS rows, COUNT(DISTINCT CustomerKey) AS distinct_keys,
       COUNT(*) = COUNT(DISTINCT CustomerKey) AS is_unique
FROM (SELECT CustomerKey FROM dim_customer UNION ALL SELECT CustomerKey FROM dim_customer WHERE CustomerKey % 9 = 0)"""))
def faulty_key_uniqueness(spark, sf):
    """Every ninth customer twice (DQ-2)."""
    d = star(spark, sf).dim_customer
    return Q.key_uniqueness({"Dim_Customer": (d.unionByName(d.filter("CustomerKey % 9 = 0")), "CustomerKey")})


@register("faulty_row_reconciliation", W("""
SELECT 'SalesOrderDetail' AS source_table, 'Fact_Sales' AS target_table, s AS source_rows, t AS target_rows,
       s - t AS difference, s = t AS is_match
FROM (SELECT (SELECT COUNT(*) FROM brz_detail) AS s, (SELECT COUNT(*) FROM faulty) AS t)""", _FAULTY_CTE))
def faulty_row_reconciliation(spark, sf):
    """Lost lines show up as a difference (DQ-3)."""
    st = star(spark, sf)
    return Q.row_reconciliation(st.bronze["detail"], faulty_fact(st.fact_measures), "SalesOrderDetail", "Fact_Sales")


@register("faulty_measure_check", W("""
SELECT COUNT(*) AS rows_checked,
       COUNT(*) FILTER (WHERE abs(CAST(OrderQty AS DOUBLE) * CAST(UnitPrice AS DOUBLE)
             * (1.0 - CAST(UnitPriceDiscount AS DOUBLE)) - CAST(LineTotal AS DOUBLE)) >= 0.01) AS mismatches
FROM faulty""", _FAULTY_CTE))
def faulty_measure_check(spark, sf):
    """Wrong line totals are counted (DQ-4)."""
    return Q.measure_check(faulty_fact(star(spark, sf).fact_measures))


@register("faulty_revenue_reconciliation", W(f"""
SELECT s AS source_revenue, t AS star_revenue, CAST(s - t AS DECIMAL(38,4)) AS difference
FROM (SELECT (SELECT {msum('LineTotal')} FROM slv_detail) AS s, (SELECT {msum('LineTotal')} FROM faulty) AS t)""", _FAULTY_CTE))
def faulty_revenue_reconciliation(spark, sf):
    """Lost and wrong lines change the revenue (SPEC-7)."""
    st = star(spark, sf)
    return Q.revenue_reconciliation(st.silver["detail"], faulty_fact(st.fact_measures))


_FAULTY_DAYS = f"SELECT d FROM ({_SPAN_DAYS}) WHERE day(d) <> 15 UNION ALL SELECT d FROM ({_SPAN_DAYS}) WHERE day(d) = 2"


@register("faulty_calendar_gaps", W("""
SELECT COUNT(*) AS rows, COUNT(DISTINCT d) AS distinct_dates, MIN(d) AS first_date, MAX(d) AS last_date,
       CAST(date_diff('day', MIN(d), MAX(d)) + 1 AS BIGINT) AS expected_days,
       CAST(date_diff('day', MIN(d), MAX(d)) + 1 - COUNT(DISTINCT d) AS BIGINT) AS missing_days,
       COUNT(*) - COUNT(DISTINCT d) AS duplicate_rows
FROM (""" + _FAULTY_DAYS + ")", {"span": _SPAN_SQL}))
def faulty_calendar_gaps(spark, sf):
    """A calendar without the 15th and with the 2nd of each month twice (SPEC-4)."""
    days = _order_span(star(spark, sf))
    day = F.dayofmonth("Date")
    return Q.calendar_check(G.date_attributes(days.filter(day != 15).unionByName(days.filter(day == 2))))


@register("faulty_rerun_diff", W(_diff_sql("fact_sales", "faulty"), _FAULTY_CTE))
def faulty_rerun_diff(spark, sf):
    """A second build that lost and changed rows (SPEC-12)."""
    from tidewater.sources.sinks import through_storage
    fact = through_storage(star(spark, sf).fact_sales, "fact")  # both sides come from this one build
    return Q.table_diff(fact, faulty_fact(fact), ["SalesKey"])


# =========================================================== extensions

SCD_CUTOFF = date(2000, 6, 1)
_SCD_TRACKED = ["Title", "Suffix", "CompanyName", "SalesPerson", "EmailAddress"]
_DIM_CUST_ATTRS = ("CustomerID, Title, CAST(NULL AS VARCHAR) AS FirstName, CAST(NULL AS VARCHAR) AS LastName, "
                   "Suffix, CompanyName, SalesPerson, EmailAddress, ModifiedDate")
_SCD_CTES = {
    "scd_old_slv": O.latest(f"""
      SELECT CustomerID, Title, Suffix, CompanyName, SalesPerson,
        CASE WHEN regexp_matches(EmailAddress, {O.EMAIL_RE}) THEN lower(trim(EmailAddress)) END AS EmailAddress,
        ModifiedDate FROM brz_customer WHERE ModifiedDate < TIMESTAMP '2000-06-01 00:00:00'""",
                            "CustomerID", "Title, Suffix, CompanyName, SalesPerson, EmailAddress"),
    "scd_cur": f"""SELECT CAST(row_number() OVER (ORDER BY CustomerID) AS BIGINT) AS CustomerKey, {_DIM_CUST_ATTRS},
      TRUE AS IsCurrent, DATE '2000-06-01' AS EffectiveDate, CAST(NULL AS DATE) AS EndDate FROM scd_old_slv""",
    "scd_inc": f"SELECT {_DIM_CUST_ATTRS} FROM slv_customer",
    "scd_chg": "SELECT i.* FROM scd_inc i LEFT JOIN scd_cur c ON i.CustomerID = c.CustomerID AND c.IsCurrent "
               "WHERE c.CustomerID IS NULL OR " + " OR ".join(f"i.{t} IS DISTINCT FROM c.{t}" for t in _SCD_TRACKED),
}


@register("scd2_apply", W("""
SELECT * REPLACE (FALSE AS IsCurrent, DATE '2001-01-01' AS EndDate) FROM scd_cur
  WHERE IsCurrent AND CustomerID IN (SELECT CustomerID FROM scd_chg)
UNION ALL
SELECT * FROM scd_cur WHERE NOT IsCurrent OR CustomerID NOT IN (SELECT CustomerID FROM scd_chg)
UNION ALL
SELECT CAST((SELECT coalesce(max(CustomerKey), 0) FROM scd_cur) + row_number() OVER (ORDER BY CustomerID) AS BIGINT)
         AS CustomerKey, CustomerID, Title, FirstName, LastName, Suffix, CompanyName, SalesPerson, EmailAddress,
       ModifiedDate, TRUE AS IsCurrent, DATE '2001-01-01' AS EffectiveDate, CAST(NULL AS DATE) AS EndDate
FROM scd_chg""", _SCD_CTES))
def scd2_apply_customers(spark, sf):
    """Customer dimension loaded at 2000-06-01, then the current load applied as SCD-2."""
    return _scd2_customers(star(spark, sf), SCD_CUTOFF, None)


def _scd2_customers(st: Star, first_load: date, second_load: date | None) -> DataFrame:
    old_cfg = st.cfg.with_(as_of=first_load)
    old_bronze = st.bronze["customer"].filter(F.col("ModifiedDate") < F.lit("2000-06-01").cast("timestamp_ntz"))
    current = G.dim_customer(S.silver_customer(old_bronze, old_cfg), old_cfg)
    incoming = st.silver["customer"].select(
        "CustomerID", "Title", F.lit(None).cast("string").alias("FirstName"),
        F.lit(None).cast("string").alias("LastName"), "Suffix", "CompanyName", "SalesPerson",
        "EmailAddress", "ModifiedDate")
    today = st.cfg.today() if second_load is None else F.lit(second_load.isoformat()).cast("date")
    return scd2_apply(current, incoming, "CustomerID", _SCD_TRACKED, today, "CustomerKey")


_VERSIONS_CTES = {**_SCD_CTES, "versions": """
  SELECT CustomerID, CustomerKey, CompanyName, DATE '0001-01-01' AS f,
         CASE WHEN CustomerID IN (SELECT CustomerID FROM scd_chg) THEN DATE '1997-01-01' ELSE DATE '9999-12-31' END AS t
  FROM scd_cur
  UNION ALL
  SELECT CustomerID, (SELECT coalesce(max(CustomerKey), 0) FROM scd_cur) + row_number() OVER (ORDER BY CustomerID), CompanyName,
         CASE WHEN CustomerID IN (SELECT CustomerID FROM scd_cur) THEN DATE '1997-01-01' ELSE DATE '0001-01-01' END,
         DATE '9999-12-31'
  FROM scd_chg"""}


@register("fact_on_scd2_customers", W("""
SELECT f.SalesOrderID, f.SalesOrderDetailID, f.OrderDateKey, v.CustomerKey, v.CompanyName, f.LineTotal
FROM fact_sales f JOIN slv_header h ON f.SalesOrderID = h.SalesOrderID
JOIN versions v ON v.CustomerID = h.CustomerID AND CAST(h.OrderDate AS DATE) >= v.f AND CAST(h.OrderDate AS DATE) < v.t""",
                                     _VERSIONS_CTES))
def fact_on_scd2_customers(spark, sf):
    """The fact on a customer dimension with history: each order meets the version
    valid on its date, so there are as many rows as lines (JOIN-3 with SPEC-3)."""
    st = star(spark, sf)
    s = st.silver
    customers = _scd2_customers(st, date(1995, 1, 1), date(1997, 1, 1))
    fact = G.fact_sales(s["detail"], s["header"], st.dim_product, customers, None, st.cfg,
                        with_sales_key=False, customer_versions="as_of")
    names = customers.select("CustomerKey", "CompanyName")
    return fact.join(names, "CustomerKey").select(
        "SalesOrderID", "SalesOrderDetailID", "OrderDateKey", "CustomerKey", "CompanyName", "LineTotal")


_UPSERT_COLS = "SalesOrderID, RevisionNumber, OrderDate, Status, TotalDue, ModifiedDate"


@register("upsert_orders", W(f"""
SELECT {_UPSERT_COLS} FROM slv_header
  WHERE OrderDate < TIMESTAMP '1998-01-01 00:00:00'
    AND SalesOrderID NOT IN (SELECT SalesOrderID FROM slv_header WHERE OrderDate >= TIMESTAMP '1997-07-01 00:00:00')
UNION ALL
SELECT SalesOrderID, CAST(RevisionNumber + CASE WHEN SalesOrderID % 3 = 0 THEN 6 ELSE 1 END AS INTEGER) AS RevisionNumber, OrderDate, Status, TotalDue,
       {O.LOAD_TS} AS ModifiedDate
FROM slv_header WHERE OrderDate >= TIMESTAMP '1997-07-01 00:00:00'"""))
def upsert_orders(spark, sf):
    """Orders loaded up to 1997, then a revised batch from 1997-07 on is merged by key.
    Every third order comes twice in the batch; its later revision wins."""
    target, updates = _order_batches(star(spark, sf))
    return upsert(target, updates, ["SalesOrderID"], "RevisionNumber")


def _order_batches(st: Star) -> tuple[DataFrame, DataFrame]:
    h = st.silver["header"].select(*[c.strip() for c in _UPSERT_COLS.split(",")])
    target = h.filter(F.col("OrderDate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    updates = (h.filter(F.col("OrderDate") >= F.lit("1997-07-01").cast("timestamp_ntz"))
                .withColumns({"RevisionNumber": (F.col("RevisionNumber") + 1).cast("int"),
                              "ModifiedDate": st.cfg.now()}))
    again = (updates.filter(F.col("SalesOrderID") % 3 == 0)
                    .withColumn("RevisionNumber", (F.col("RevisionNumber") + 5).cast("int")))
    return target, updates.unionByName(again)


@register("incremental_orders", W("""
SELECT * FROM brz_header WHERE ModifiedDate > (
  SELECT max(ModifiedDate) FROM brz_header WHERE ModifiedDate <= TIMESTAMP '1998-06-30 00:00:00')"""))
def incremental_orders(spark, sf):
    """Rows above the high-water mark of a table loaded up to 1998-06-30 (EXT-1)."""
    st = star(spark, sf)
    src = st.bronze["header"]
    loaded = src.filter(F.col("ModifiedDate") <= F.lit("1998-06-30").cast("timestamp_ntz"))
    return rows_after(src, "ModifiedDate", high_water_mark(loaded, "ModifiedDate"))


@register("incremental_late_orders", W("""
SELECT * FROM brz_header WHERE ModifiedDate >= m AND NOT (ModifiedDate = m AND SalesOrderID % 2 = 0)""".replace(
    " m", " (SELECT max(ModifiedDate) FROM brz_header WHERE ModifiedDate <= TIMESTAMP '1998-06-30 00:00:00' AND SalesOrderID % 2 = 0)")))
def incremental_late_orders(spark, sf):
    """Half of the orders are loaded; the next load also finds the rows that came
    late with the mark's own timestamp (EXT-1)."""
    src = star(spark, sf).bronze["header"]
    loaded = src.filter((F.col("ModifiedDate") <= F.lit("1998-06-30").cast("timestamp_ntz")) & (F.col("SalesOrderID") % 2 == 0))
    return rows_after(src, "ModifiedDate", high_water_mark(loaded, "ModifiedDate"), loaded, ["SalesOrderID"])


@register("masked_customers", W("""
SELECT CustomerKey, CustomerID, CompanyName,
       CASE WHEN EmailAddress IS NOT NULL THEN concat(sha256(concat('fixture-salt', EmailAddress)), '@',
            string_split(EmailAddress, '@')[-1]) END AS EmailAddress
FROM dim_customer"""))
def masked_customers(spark, sf):
    from tidewater.functions.cleanse import mask_email
    st = star(spark, sf)
    return st.dim_customer.select("CustomerKey", "CustomerID", "CompanyName",
                                  mask_email(F.col("EmailAddress"), st.cfg.mask_salt).alias("EmailAddress"))


_PIPELINE_TABLES = ([("bronze", t, f"brz_{k}") for k, t in O.BRONZE_NAMES.items()]
                    + [("silver", name.removeprefix("silver_"), cte) for name, cte, _, _ in _SILVER_PROFILE]
                    + [("gold", name.removeprefix("gold_"), cte) for name, cte, _, _ in _GOLD_PROFILE])
_PIPELINE_LOG_SQL = "\nUNION ALL\n".join(
    f"SELECT '{layer}' AS layer, '{t}' AS table_name, 'success' AS status, COUNT(*) AS rows, CAST(NULL AS VARCHAR) AS error FROM {cte}"
    for layer, t, cte in _PIPELINE_TABLES)


def _pipeline(spark, sf, **options):
    from tidewater.plans.pipeline import Pipeline
    st = star(spark, sf)
    return Pipeline(spark, st.sources, st.cfg, _run_folder(spark, "runs"), **options)


@register("pipeline_run_log", W(_PIPELINE_LOG_SQL))
def pipeline_run_log(spark, sf):
    """Bronze, silver and gold written as named tables of Spark's session catalog, each
    layer read by name from the one before; the run log without its durations."""
    return _pipeline(spark, sf, database=f"tidewater_{uuid.uuid4().hex}").run().drop("duration_seconds")


@register("pipeline_run_summary", W(f"""
SELECT layer, COUNT(*) AS tables, COUNT(*) AS succeeded, CAST(0 AS BIGINT) AS failed, CAST(SUM(rows) AS BIGINT) AS rows
FROM ({_PIPELINE_LOG_SQL}) GROUP BY layer"""))
def pipeline_run_summary(spark, sf):
    """Tables and rows per layer of a run (PIP-2, AGG-9)."""
    from tidewater.plans.pipeline import run_summary
    return run_summary(_pipeline(spark, sf).run()).drop("duration_seconds")


@register("partitioned_fact", W(f"""
SELECT CAST(OrderDateKey // 10000 AS INTEGER) AS Year, CAST(OrderDateKey // 100 % 100 AS INTEGER) AS Month, COUNT(*) AS Lines,
       {msum('LineTotal')} AS Revenue, COUNT(*) FILTER (WHERE BillToAddressKey = -1) AS UnknownBillTo
FROM (SELECT * REPLACE (coalesce(BillToAddressKey, -1) AS BillToAddressKey) FROM fact_sales)
WHERE OrderDateKey // 10000 = 1996 GROUP BY ALL"""))
def partitioned_fact(spark, sf):
    """The fact written by year and month and read back for one year (EXT-3, SPEC-10)."""
    run = _pipeline(spark, sf, partition_fact=True, unknown_addresses=True)
    run.run()
    return run.read("gold", "Fact_Sales").filter("Year = 1996").groupBy("Year", "Month").agg(
        F.count("*").alias("Lines"), A.sum_money("LineTotal").alias("Revenue"),
        F.count_if(F.col("BillToAddressKey") == -1).alias("UnknownBillTo"))


@register("streaming_incremental_orders", W("SELECT * FROM brz_header"))
def streaming_incremental_orders(spark, sf):
    """Orders landed in bronze by an availableNow stream over the source folder;
    the landed table must equal the batch bronze table (EXT-1)."""
    from tidewater.sources.fixture import map_orders, raw
    from tidewater.streaming.incremental import incremental_bronze
    base = _run_folder(spark, "streams")
    schema = raw(spark, sf, "orders").schema
    return incremental_bronze(spark, sf, "orders.parquet", schema, map_orders, "SalesOrderHeader",
                              FIXTURE_CONFIG, f"{base}/bronze_SalesOrderHeader", f"{base}/_checkpoint")


# =========================================================== incremental and restartable runs

ARRIVAL = "2000-06-30"
_ARRIVED = f"ModifiedDate <= TIMESTAMP '{ARRIVAL} 00:00:00'"
#: Tables of which a part arrives later; the others arrive whole.
_IN_PARTS = ("customer", "header", "detail")


def _first_arrival(st: Star):
    """The sources as they were at ARRIVAL: only the old versions of customers, orders
    placed and lines shipped until then."""
    from tidewater.sources.model import SalesSources
    until = F.col("ModifiedDate") <= F.lit(ARRIVAL).cast("timestamp_ntz")
    return SalesSources(**{a: (lambda a=a: getattr(st.sources, a).filter(until) if a in _IN_PARTS else getattr(st.sources, a))
                           for a in st.sources.available()})


def _incremental(spark, sf, **options):
    """(star, pipeline over a new store with the first arrival committed)."""
    from tidewater.plans.incremental import IncrementalPipeline
    from tidewater.sources.versions import TableStore
    st = star(spark, sf)
    run = IncrementalPipeline(spark, TableStore(spark, _run_folder(spark, "stores")), st.cfg, buckets=8, **options)
    run.run(_first_arrival(st))
    return st, run


@register("pipeline_two_arrivals", W("SELECT * FROM fact_sales"))
def pipeline_two_arrivals(spark, sf):
    """Two incremental runs: what was there in the middle of 2000, then the rest. The
    stored fact equals that of a full refresh (EXT-1, EXT-2)."""
    st, run = _incremental(spark, sf)
    run.run(st.sources)
    return run.read("gold", "Fact_Sales")


@register("pipeline_after_crash", W(f"""
SELECT 'crashed' AS state, COUNT(*) AS lines, {msum('f.LineTotal')} AS revenue
FROM fact_sales f JOIN slv_header h ON f.SalesOrderID = h.SalesOrderID
JOIN slv_detail d ON f.SalesOrderID = d.SalesOrderID AND f.SalesOrderDetailID = d.SalesOrderDetailID
JOIN (SELECT DISTINCT CustomerID FROM brz_customer WHERE {_ARRIVED}) c ON h.CustomerID = c.CustomerID
WHERE h.{_ARRIVED} AND d.{_ARRIVED}
UNION ALL
SELECT 'rerun', COUNT(*), {msum('LineTotal')} FROM fact_sales"""))
def pipeline_after_crash(spark, sf):
    """A second run dies when bronze, silver and the dimensions are written: readers still
    see the first run whole. The rerun takes the same rows and commits (SPEC-12, SNK-1)."""
    from tidewater.plans.pipeline import LayerFailed
    st, run = _incremental(spark, sf, tries=1)
    build = run._fact

    def dies(_):
        raise RuntimeError("lost")
    run._fact = dies
    try:
        run.run(st.sources)
    except LayerFailed:
        pass
    run._fact = build
    crashed = run.store.state()["version"]
    run.run(st.sources)
    parts = [run.read("gold", "Fact_Sales", version).agg(F.count(F.lit(1)).alias("lines"), A.sum_money("LineTotal").alias("revenue"))
             .select(F.lit(state).alias("state"), "lines", "revenue") for state, version in (("crashed", crashed), ("rerun", None))]
    return parts[0].unionByName(parts[1])


_HISTORY_CTES = {
    "hist_slv": O.latest(f"""
      SELECT CustomerID, Title, Suffix, CompanyName, SalesPerson,
        CASE WHEN regexp_matches(EmailAddress, {O.EMAIL_RE}) THEN lower(trim(EmailAddress)) END AS EmailAddress,
        ModifiedDate FROM brz_customer WHERE {_ARRIVED}""", "CustomerID", "Title, Suffix, CompanyName, SalesPerson, EmailAddress"),
    "hist_old": "SELECT CAST(row_number() OVER (ORDER BY CustomerID) AS BIGINT) AS CustomerKey, * FROM hist_slv",
    "hist_new": "SELECT i.* FROM slv_customer i LEFT JOIN hist_old c ON i.CustomerID = c.CustomerID WHERE c.CustomerID IS NULL OR "
                + " OR ".join(f"i.{t} IS DISTINCT FROM c.{t}" for t in _SCD_TRACKED)}


@register("pipeline_customer_history", W("""
SELECT CustomerKey, CustomerID, CompanyName, CustomerID NOT IN (SELECT CustomerID FROM hist_new) AS IsCurrent,
       CASE WHEN CustomerID IN (SELECT CustomerID FROM hist_new) THEN DATE '2001-01-01' END AS EndDate
FROM hist_old
UNION ALL
SELECT CAST((SELECT coalesce(max(CustomerKey), 0) FROM hist_old) + row_number() OVER (ORDER BY CustomerID) AS BIGINT), CustomerID,
       CompanyName, TRUE, CAST(NULL AS DATE) FROM hist_new""", _HISTORY_CTES))
def pipeline_customer_history(spark, sf):
    """Customers as a type-2 dimension of the pipeline: the second run closes versions
    that changed and opens new ones (SPEC-3)."""
    st, run = _incremental(spark, sf, customer_history=True)
    run.run(st.sources)
    return run.read("gold", "Dim_Customer").select("CustomerKey", "CustomerID", "CompanyName", "IsCurrent", "EndDate")


def _period_tables(spark, sf):
    """Monthly and yearly sales after two batches: the first two lines of each order placed
    before 1998, then everything, so orders of the first batch change."""
    from tidewater.plans.aggregates import add_to_periods
    from tidewater.sources.versions import TableStore
    st = star(spark, sf)
    fact = st.fact_measures
    early = fact.filter((F.col("OrderDateKey") < 19980101) & (F.col("SalesOrderDetailID") <= 2))
    store = TableStore(spark, _run_folder(spark, "stores"))
    for now, before in ((early, None), (fact, early)):
        run = store.begin()
        add_to_periods(run, st.cfg, now, before)
        run.commit()
    return store, st.cfg


_PERIOD_SUMS = f"""COUNT(DISTINCT SalesOrderID) AS OrderCount, COUNT(*) AS LineCount, CAST(SUM(OrderQty) AS BIGINT) AS TotalQuantity,
       {msum('LineTotal')} AS TotalRevenue, {msum('LineProfit')} AS TotalProfit"""


@register("monthly_sales_table", W(f"""
SELECT CAST(OrderDateKey // 10000 AS INTEGER) AS Year, CAST(OrderDateKey // 100 % 100 AS INTEGER) AS Month, {_PERIOD_SUMS}
FROM fact_sales GROUP BY ALL"""))
def monthly_sales_table(spark, sf):
    """The stored monthly table, kept up by two batches (EXT-4)."""
    store, cfg = _period_tables(spark, sf)
    return store.read(cfg.table_name("gold", "Monthly_Sales"))


@register("yearly_sales_table", W(f"""
SELECT CAST(OrderDateKey // 10000 AS INTEGER) AS Year, {_PERIOD_SUMS} FROM fact_sales GROUP BY ALL"""))
def yearly_sales_table(spark, sf):
    """The stored yearly table, kept up by two batches (EXT-4)."""
    store, cfg = _period_tables(spark, sf)
    return store.read(cfg.table_name("gold", "Yearly_Sales"))


@register("upsert_orders_by_bucket", REGISTRY["upsert_orders"][1])
def upsert_orders_by_bucket(spark, sf):
    """The batch of ``upsert_orders`` merged into a stored table in buckets of its key (EXT-2)."""
    from tidewater.sources.versions import TableStore
    target, updates = _order_batches(star(spark, sf))
    store = TableStore(spark, _run_folder(spark, "stores"))
    for batch in (target, updates):
        run = store.begin()
        run.upsert("orders", batch, ["SalesOrderID"], "RevisionNumber", buckets=16)
        run.commit()
    return store.read("orders")


@register("bucketed_revenue_by_year", REGISTRY["revenue_by_year"][1])
def bucketed_revenue_by_year(spark, sf):
    """Header and lines written in buckets of the order id, so that they meet without a
    shuffle, as does counting orders (JOIN-1, QRY-1). There are more buckets for more lines."""
    from tidewater.sources.sinks import bucket_count, write_table
    st = star(spark, sf)
    base, database = _run_folder(spark, "buckets"), f"tidewater_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    stored, buckets = {}, bucket_count(st.silver["header"], st.silver["detail"])
    for name in ("header", "detail"):
        write_table(st.silver[name], f"{base}/{name}", name=f"{database}.{name}", bucket_by="SalesOrderID", buckets=buckets)
        stored[name] = spark.read.table(f"{database}.{name}")
    return A.revenue_by_year_of_orders(stored["detail"], stored["header"], st.silver["product"], st.silver["customer"], st.cfg)


@register("streaming_latest_events", REGISTRY["latest_event_per_user"][1])
def streaming_latest_events(spark, sf):
    """Events in three arrivals, a seventh of them one arrival late and a fifth sent again:
    three micro-batches leave the latest event of each user (EXT-1)."""
    from tidewater.sources.versions import TableStore
    from tidewater.streaming.upserts import merge_stream
    events, base = spark.read.parquet(f"{sf}/events.parquet"), _run_folder(spark, "streams")
    low, high = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("low", "high"))
    span = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).select(low.alias("low"), (high - low + 1).alias("width")).first()
    third = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - (span.low or 0)) * 3 / (span.width or 1))
    late = F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    arrival = F.least(F.coalesce(third, F.lit(0)) + late, F.lit(2))
    sent = events.withColumn("arrival", F.explode(F.when(F.col("event_id") % 5 == 0, F.array(arrival, F.least(arrival + 1, F.lit(2))))
                                                  .otherwise(F.array(arrival))))
    store = TableStore(spark, f"{base}/store")
    days = -(-(span.width or 1) // (24 * 3600 * 1_000_000))
    for k in range(3):
        sent.filter(F.col("arrival") == k).drop("arrival").write.mode("append").parquet(f"{base}/in")
        report = merge_stream(spark, f"{base}/in", events.schema, store, "latest_events", ["event_id"], ["user_id"], "ts",
                              f"{days} days", f"{base}/checkpoint", buckets=8)
        if report.too_late:
            raise RuntimeError(f"{report.too_late} events were later than {days} days")
    return store.read("latest_events")


def queries() -> dict[str, Builder]:
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}

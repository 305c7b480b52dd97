"""Gold: star schema of four dimensions and one fact (GLD-1 .. GLD-6)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.config import RunConfig
from tidewater.functions.cleanse import line_profit
from tidewater.functions.dates import (date_key, fiscal_month, fiscal_quarter, fiscal_year,
                                       iso_day_of_week)
from tidewater.operators.hierarchy import flatten_parent
from tidewater.operators.keys import assign_sequential_key, current_lookup, running_offsets, version_spans
from tidewater.operators.members import with_unknown_member
from tidewater.operators.scd import with_scd_columns
from tidewater.sources.sinks import through_storage

# Fixed published column lists of the star.
DIM_DATE_COLUMNS = [
    "DateKey", "Date", "Year", "Quarter", "QuarterName", "Month", "MonthName", "MonthNameShort",
    "DayOfMonth", "DayOfWeek", "DayOfWeekName", "DayOfWeekNameShort", "DayOfYear", "WeekOfYear",
    "IsWeekend", "IsHoliday", "FiscalYear", "FiscalQuarter", "FiscalMonth"]
DIM_CUSTOMER_COLUMNS = [
    "CustomerKey", "CustomerID", "Title", "FirstName", "LastName", "Suffix", "CompanyName",
    "SalesPerson", "EmailAddress", "ModifiedDate", "IsCurrent", "EffectiveDate", "EndDate"]
DIM_PRODUCT_COLUMNS = [
    "ProductKey", "ProductID", "ProductNumber", "ProductName", "Color", "Size", "Weight",
    "StandardCost", "ListPrice", "ProductCategoryID", "ProductCategoryName",
    "ParentProductCategoryID", "ParentProductCategoryName", "ProductModelID", "ProductModelName",
    "SellStartDate", "SellEndDate", "DiscontinuedDate", "IsDiscontinued", "ModifiedDate",
    "IsCurrent", "EffectiveDate", "EndDate"]
DIM_ADDRESS_COLUMNS = [
    "AddressKey", "AddressID", "AddressLine1", "AddressLine2", "City", "StateProvince", "CountryRegion",
    "PostalCode", "ModifiedDate", "IsCurrent", "EffectiveDate", "EndDate"]
FACT_SALES_COLUMNS = [
    "SalesKey", "SalesOrderID", "SalesOrderDetailID", "CustomerKey", "ProductKey",
    "OrderDateKey", "DueDateKey", "ShipDateKey", "ShipToAddressKey", "BillToAddressKey",
    "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal", "ProductStandardCost",
    "LineProfit", "OrderSubTotal", "OrderTaxAmt", "OrderFreight", "OrderTotal", "OrderStatus",
    "ShipMethod", "RevisionNumber"]


# ---------------------------------------------------------------- calendar

def calendar_days(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day, both ends included (SRC-3). ``spark.range`` spreads the
    days over tasks; the row count is bounded by the span, not by the data."""
    n_days = (end - start).days + 1
    if n_days <= 0:
        raise ValueError(f"empty calendar {start}..{end}")
    return spark.range(0, n_days).select(
        F.date_add(F.lit(start.isoformat()).cast("date"), F.col("id").cast("int")).alias("Date"))


def calendar_span(dates: DataFrame, date_cols: list[str]) -> DataFrame:
    """Whole calendar years covering every date in ``date_cols`` of ``dates``.
    One aggregate row expands into the days, so the size is bounded by the span."""
    lo = F.least(*[F.min(F.to_date(c)) for c in date_cols])
    hi = F.greatest(*[F.max(F.to_date(c)) for c in date_cols])
    bounds = dates.agg(F.trunc(lo, "year").alias("lo"),
                       F.date_add(F.add_months(F.trunc(hi, "year"), 12), -1).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("Date"))


def date_attributes(days: DataFrame, fiscal_start_month: int = 1,
                    holidays: DataFrame | None = None) -> DataFrame:
    """Dim_Date columns for a frame with a ``Date`` column (GLD-1, SPEC-1, SPEC-2)."""
    d = F.col("Date")
    out = days.select(
        date_key(d).alias("DateKey"), d.alias("Date"),
        F.year(d).alias("Year"), F.quarter(d).alias("Quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("QuarterName"),
        F.month(d).alias("Month"),
        F.date_format(d, "MMMM").alias("MonthName"),
        F.date_format(d, "MMM").alias("MonthNameShort"),
        F.dayofmonth(d).alias("DayOfMonth"),
        iso_day_of_week(d).alias("DayOfWeek"),
        F.date_format(d, "EEEE").alias("DayOfWeekName"),
        F.date_format(d, "EEE").alias("DayOfWeekNameShort"),
        F.dayofyear(d).alias("DayOfYear"),
        F.weekofyear(d).alias("WeekOfYear"),
        iso_day_of_week(d).isin(6, 7).alias("IsWeekend"),
        fiscal_year(d, fiscal_start_month).alias("FiscalYear"),
        fiscal_quarter(d, fiscal_start_month).alias("FiscalQuarter"),
        fiscal_month(d, fiscal_start_month).alias("FiscalMonth"))
    if holidays is None:
        out = out.withColumn("IsHoliday", F.lit(False))
    else:
        # Holiday list is one row per date at most; dedup keeps the calendar grain.
        flags = holidays.select(F.col("Date").cast("date").alias("_hd")).distinct() \
                        .withColumn("_is_h", F.lit(True))
        out = (out.join(flags, out["Date"] == flags["_hd"], "left")
                  .withColumn("IsHoliday", F.coalesce(F.col("_is_h"), F.lit(False)))
                  .drop("_hd", "_is_h"))
    return out.select(DIM_DATE_COLUMNS)


def dim_date(spark: SparkSession, cfg: RunConfig, holidays: DataFrame | None = None) -> DataFrame:
    return date_attributes(calendar_days(spark, cfg.calendar_start, cfg.calendar_end),
                           cfg.fiscal_start_month, holidays)


def rule_holidays(days: DataFrame, month_days: list[tuple[int, int]]) -> DataFrame:
    """Holiday list derived by rule (fixed month/day pairs) from a calendar."""
    cond = F.lit(False)
    for m, dd in month_days:
        cond = cond | ((F.month("Date") == m) & (F.dayofmonth("Date") == dd))
    return days.filter(cond).select("Date")


# ---------------------------------------------------------------- dimensions

def _or_null(df: DataFrame, name: str) -> Column:
    """An optional source column; a typed NULL where the source has none."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string").alias(name)


def customer_attributes(silver: DataFrame) -> DataFrame:
    """Dim_Customer's natural key and attributes."""
    return silver.select("CustomerID", "Title", _or_null(silver, "FirstName"), _or_null(silver, "LastName"),
                         "Suffix", "CompanyName", "SalesPerson", "EmailAddress", "ModifiedDate")


def dim_customer(silver: DataFrame, cfg: RunConfig) -> DataFrame:
    df = assign_sequential_key(customer_attributes(silver), ["CustomerID"], "CustomerKey")
    return with_scd_columns(df, cfg.today()).select(DIM_CUSTOMER_COLUMNS)


def english_descriptions(model_description: DataFrame, description: DataFrame,
                         culture: str = "en") -> DataFrame:
    """One English description per product model (JOIN-9). Culture codes are
    compared trimmed; with several English rows the lowest description id wins,
    so products never fan out."""
    bridge = model_description.filter(F.trim(F.col("Culture")) == culture) \
                              .select("ProductModelID", "ProductDescriptionID")
    joined = bridge.join(description.select("ProductDescriptionID", "Description"),
                         "ProductDescriptionID")
    return joined.groupBy("ProductModelID").agg(
        F.min_by("Description", "ProductDescriptionID").alias("ProductName"))


def dim_product(product: DataFrame, category: DataFrame, model: DataFrame, cfg: RunConfig,
                descriptions: DataFrame | None = None) -> DataFrame:
    # Keys are assigned on the product table itself: every enrichment is a left
    # lookup on a unique key, so it neither adds nor removes products.
    df = assign_sequential_key(product, ["ProductID"], "ProductKey")
    return product_attributes(df, category, model, cfg, descriptions)


def product_attributes(df: DataFrame, category: DataFrame, model: DataFrame, cfg: RunConfig,
                       descriptions: DataFrame | None = None) -> DataFrame:
    """Products with category, model and description: Dim_Product, keyed or not."""
    cats = flatten_parent(category, "ProductCategoryID", "ParentProductCategoryID", "Name",
                          "ProductCategoryName", "ParentProductCategoryName")
    models = model.groupBy("ProductModelID").agg(F.min("Name").alias("ProductModelName"))
    df = (df.join(cats, "ProductCategoryID", "left")
            .join(models, "ProductModelID", "left"))
    if descriptions is not None:
        df = df.join(descriptions, "ProductModelID", "left")
    else:
        df = df.withColumn("ProductName", F.lit(None).cast("string"))
    df = df.withColumn("IsDiscontinued", F.col("DiscontinuedDate").isNotNull())
    df = with_scd_columns(df, cfg.today())
    return df.select([c for c in DIM_PRODUCT_COLUMNS if c in df.columns])


def address_rows(silver: DataFrame) -> DataFrame:
    """As many rows as Dim_Address has, its unknown member included, without keys."""
    return with_unknown_member(silver.select("AddressID"), {"AddressID": F.lit(-1)})


def dim_address(silver: DataFrame, cfg: RunConfig, unknown_member: bool = True) -> DataFrame:
    df = silver.select("AddressID", "AddressLine1", "AddressLine2", "City", _or_null(silver, "StateProvince"),
                       _or_null(silver, "CountryRegion"), "PostalCode", "ModifiedDate")
    df = assign_sequential_key(df, ["AddressID"], "AddressKey")
    df = with_scd_columns(df, cfg.today()).select(DIM_ADDRESS_COLUMNS)
    if unknown_member:
        df = with_unknown_member(df, {
            "AddressKey": F.lit(-1), "AddressID": F.lit(-1), "AddressLine1": F.lit("Unknown"),
            "City": F.lit("Unknown"), "StateProvince": F.lit("Unknown"), "CountryRegion": F.lit("Unknown"),
            "PostalCode": F.lit("00000"), "ModifiedDate": cfg.now(),
            "IsCurrent": F.lit(True), "EffectiveDate": cfg.today()})
    return df


# ---------------------------------------------------------------- fact

def date_key_in(ts: Column, cfg: RunConfig) -> tuple[Column, Column]:
    """Dim_Date key of a timestamp and whether that date is in the calendar.

    Dim_Date is the contiguous day range [calendar_start, calendar_end] and its
    key is yyyyMMdd, so the lookup is arithmetic: an inner lookup becomes a
    range predicate (pushed to the scan) and a left lookup a CASE. No join, no
    broadcast of the calendar."""
    d = F.to_date(ts)
    inside = d.between(F.lit(cfg.calendar_start.isoformat()).cast("date"),
                       F.lit(cfg.calendar_end.isoformat()).cast("date"))
    return date_key(d), inside


def _customer_keys(orders: DataFrame, dim_customer_df: DataFrame, versions: str) -> DataFrame:
    """Orders with their customer's key; orders without a customer drop out.

    ``current``: the open version. ``as_of``: the version valid on the order date.
    Either side has at most one row for an order, so lines are never multiplied."""
    if versions == "current":
        return orders.join(current_lookup(dim_customer_df, "CustomerID", ["CustomerKey"]), "CustomerID")
    if versions != "as_of":
        raise ValueError(f"customer_versions: {versions!r}")
    spans = version_spans(dim_customer_df, "CustomerID", "CustomerKey")
    day = F.to_date("OrderDate")
    return orders.join(spans, "CustomerID").filter((day >= F.col("_from")) & (day < F.col("_to"))).drop("_from", "_to")


def _address_keys(places: DataFrame, dim_address_df: DataFrame, unknown: bool) -> DataFrame:
    """Rows with a customer and two addresses (ids), with the keys of the two addresses."""
    # grouped by the type that is joined, so that the lookup is shuffled once
    keys = current_lookup(dim_address_df.withColumn("_aid", F.col("AddressID").cast("long")), "_aid", ["AddressKey"])
    for role in ("ShipTo", "BillTo"):
        side = keys.select("_aid", F.col("AddressKey").alias(f"{role}AddressKey"))
        # missing addresses are spread, so the NULLs do not meet in one partition; they match nothing
        known = F.col(f"{role}AddressID").isNotNull()
        probe = F.coalesce(F.col(f"{role}AddressID").cast("long"), F.xxhash64(*PLACE_COLUMNS))
        places = places.withColumn("_probe", probe).join(side, (F.col("_probe") == F.col("_aid")) & known, "left").drop("_probe", "_aid")
    if unknown:
        places = places.withColumns({f"{r}AddressKey": F.coalesce(f"{r}AddressKey", F.lit(-1)) for r in ("ShipTo", "BillTo")})
    return places


#: What a line brings into the fact.
LINE_COLUMNS = ["SalesOrderID", "SalesOrderDetailID", "OrderQty", "ProductID", "UnitPrice", "UnitPriceDiscount", "LineTotal"]


#: What an order's customer and address keys are looked up by.
PLACE_COLUMNS = ["CustomerID", "ShipToAddressID", "BillToAddressID"]


def known_orders(header: DataFrame, dim_customer_df: DataFrame, cfg: RunConfig, customer_versions: str = "current",
                 dim_address_df: DataFrame | None = None, unknown_address_key: bool = False) -> DataFrame:
    """Orders whose order and due date are in the calendar and whose customer is known,
    with their date keys, their customer's key and, with ``dim_address_df``, the keys of
    their addresses. Those are looked up by the distinct combinations of customer and
    addresses, narrow rows; the wide orders move once, to their combination."""
    orders = header.select("SalesOrderID", "RevisionNumber", "OrderDate", "DueDate", "ShipDate",
                           "Status", "CustomerID", "ShipToAddressID", "BillToAddressID",
                           "ShipMethod", "SubTotal", "TaxAmt", "Freight", "TotalDue")
    order_key, order_in = date_key_in(F.col("OrderDate"), cfg)
    due_key, due_in = date_key_in(F.col("DueDate"), cfg)
    ship_key, ship_in = date_key_in(F.col("ShipDate"), cfg)
    # Date filters apply to the header before the join, so the line side only
    # meets orders that survive the calendar lookup; the customer is looked up here
    # too, as one row per order is cheaper to join than one row per line.
    orders = (orders.filter(order_in & due_in)
                    .withColumns({"OrderDateKey": order_key, "DueDateKey": due_key,
                                  "ShipDateKey": F.when(ship_in, ship_key)}))
    if dim_address_df is None:
        return _customer_keys(orders, dim_customer_df, customer_versions)
    if customer_versions == "current":
        places = _customer_keys(orders.select(*PLACE_COLUMNS).distinct(), dim_customer_df, customer_versions)
    else:  # the version depends on the order's date
        orders = _customer_keys(orders, dim_customer_df, customer_versions)
        places = orders.select(*PLACE_COLUMNS).distinct()
    places = _address_keys(places, dim_address_df, unknown_address_key)
    keys = [c for c in places.columns if c not in PLACE_COLUMNS]
    places = places.withColumnsRenamed({c: f"_{c}" for c in PLACE_COLUMNS})
    same = F.col("CustomerID") == F.col("_CustomerID")  # an order without a customer is not known
    for c in PLACE_COLUMNS[1:]:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    columns = ["CustomerID", *[c for c in orders.columns if c != "CustomerID"], *keys]
    return orders.join(places, same).select(*columns)


def order_lines(detail: DataFrame, header: DataFrame, dim_customer_df: DataFrame, cfg: RunConfig) -> DataFrame:
    """Lines with their known orders, by natural keys, before any product is looked up:
    for reports that sum lines first and join products once."""
    return detail.select(LINE_COLUMNS).join(known_orders(header, dim_customer_df, cfg), "SalesOrderID")


def fact_sales(detail: DataFrame, header: DataFrame, dim_product_df: DataFrame,
               dim_customer_df: DataFrame, dim_address_df: DataFrame | None, cfg: RunConfig,
               unknown_address_key: bool = False, with_sales_key: bool = True,
               customer_versions: str = "current", lines_once: bool = False) -> DataFrame:
    """One row per order line (GLD-5).

    Mandatory lookups (customer, product, order date, due date) drop unmatched
    lines like inner joins; ship date and the two address roles are optional.
    With ``unknown_address_key`` a missing address maps to the -1 member (SPEC-10).
    Without ``dim_address_df`` the address roles are left out: they never change
    rows or measures, so a query that reads no address plans none. Dimensions
    without surrogate keys give the same rows and measures, with the natural
    keys (ProductID) in place of the surrogate ones. With ``lines_once`` the lines
    that are numbered are written once with their products and read back: for lines
    that are not stored yet, since numbering reads them twice.
    """
    lines = detail.select(LINE_COLUMNS)
    orders = known_orders(header, dim_customer_df, cfg, customer_versions, dim_address_df, unknown_address_key)
    # Product key and standard cost come from the same dimension row.
    products = current_lookup(dim_product_df, "ProductID", ["ProductKey", "StandardCost"])
    known = lines.join(products, "ProductID")
    if with_sales_key:
        survivors = known_orders(header, dim_customer_df, cfg, customer_versions).select("SalesOrderID")
        if lines_once:
            known = narrow = through_storage(known, "lines")
        else:
            narrow = lines.join(products.select("ProductID"), "ProductID")
        f = _numbered_lines(known, orders, narrow, survivors)
    else:
        f = known.join(orders, "SalesOrderID")
    f = f.withColumn("LineProfit", line_profit(F.col("LineTotal"), F.col("OrderQty"), F.col("StandardCost")))
    source = {"ProductStandardCost": "StandardCost", "OrderSubTotal": "SubTotal", "OrderTaxAmt": "TaxAmt",
              "OrderFreight": "Freight", "OrderTotal": "TotalDue", "OrderStatus": "Status"}
    columns = [c for c in FACT_SALES_COLUMNS if source.get(c, c) in f.columns]
    columns += [natural for key, natural in (("ProductKey", "ProductID"), ("CustomerKey", "CustomerID")) if key not in columns]
    return f.select(*[F.col(source.get(c, c)).alias(c) for c in columns])


#: Line ids in one block of an order. Lines meet their order by block, so an order with
#: very many lines is spread over as many tasks as it has blocks.
LINE_BLOCK = 1 << 16


def _numbered_lines(known: DataFrame, orders: DataFrame, narrow: DataFrame, survivors: DataFrame) -> DataFrame:
    """Order lines joined with their orders, and SalesKey = 1..n by order and line (WIN-3),
    in two levels: blocks of an order's lines are counted (``narrow``: lines that stay;
    ``survivors``: orders that stay), running sums over the blocks give each its offset,
    and a line adds its place in its block. Only the blocks' counts are sorted over the
    whole table; the lines move once, to their orders, and their place comes from the
    order they have there. The first block of an order's lines meets the order by its id
    alone, where the order's copies are numbered anyway; only further blocks, which few
    orders have, take orders to tasks of their own. An order delivered twice multiplies
    its lines, as in a join; the copies take turns line by line."""
    block = F.coalesce(F.floor(F.col("SalesOrderDetailID") / LINE_BLOCK), F.lit(-1 << 62)).alias("_block")
    copies = survivors.groupBy("SalesOrderID").agg(F.count(F.lit(1)).alias("_copies"))
    blocks = narrow.groupBy("SalesOrderID", block).agg(F.count(F.lit(1)).alias("_lines")).join(copies, "SalesOrderID") \
                   .select("SalesOrderID", "_block", "_copies", (F.col("_lines") * F.col("_copies")).alias("_rows"))
    blocks = running_offsets(blocks, ["SalesOrderID", "_block"], "_rows", "_offset").drop("_rows")
    same = Window.partitionBy("SalesOrderID").orderBy(*[c for c in orders.columns if c != "SalesOrderID"])
    numbered = orders.withColumn("_copy", F.row_number().over(same))
    order = ["SalesOrderDetailID", "ProductID", "OrderQty", "UnitPrice", "UnitPriceDiscount"]
    first = (F.col("SalesOrderDetailID") >= 0) & (F.col("SalesOrderDetailID") < LINE_BLOCK)

    def placed(lines: DataFrame, by: list[str], spread: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
        return lines.withColumn("_place", place).join(spread, by).withColumn(
            "SalesKey", (F.col("_offset") + F.col("_place") * F.col("_copies") + F.col("_copy")).cast("long"))

    near = placed(known.filter(first), ["SalesOrderID"], numbered.join(blocks.filter("_block = 0").drop("_block"), "SalesOrderID"))
    far = placed(known.filter(F.coalesce(~first, F.lit(True))).withColumn("_block", block), ["SalesOrderID", "_block"],
                 numbered.join(blocks.filter("_block <> 0"), "SalesOrderID"))
    return near.unionByName(far.drop("_block"))

"""Analytic queries on the star (QRY-1 .. QRY-7, SPEC-5/6/11, EXT-4).

Joins are left to Spark: it broadcasts only what it estimates or measures small.
Top-k reports sort with the group columns as tie-breakers so the cut is stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.config import RunConfig
from tidewater.functions.cleanse import safe_pct

REVENUE = "decimal(38,4)"


def sum_money(c: str) -> F.Column:
    return F.sum(c).cast(REVENUE)


def sum_qty(c: str = "OrderQty") -> F.Column:
    return F.sum(c).cast("bigint")


def _with_date(fact: DataFrame, dim_date: DataFrame, cols: list[str],
               key: str = "OrderDateKey") -> DataFrame:
    d = dim_date.select("DateKey", *cols)
    return fact.join(d, fact[key] == d["DateKey"])


def revenue_by_year(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return (_with_date(fact, dim_date, ["Year"])
            .groupBy("Year")
            .agg(F.count_distinct("SalesOrderID").alias("Orders"),
                 sum_money("LineTotal").alias("Revenue"),
                 sum_money("LineProfit").alias("Profit"))
            .orderBy("Year"))


def revenue_by_year_of_orders(detail: DataFrame, header: DataFrame, products: DataFrame, customers: DataFrame,
                              cfg: RunConfig) -> DataFrame:
    """Revenue by year straight from header and lines that are stored in buckets of the
    order id: each order's lines are summed where they lie, and what travels is a row an
    order at most. Products and customers are looked up as in the fact."""
    from tidewater.functions.cleanse import line_profit
    from tidewater.operators.keys import current_lookup
    from tidewater.plans.gold import date_key_in
    order_key, order_in = date_key_in(F.col("OrderDate"), cfg)
    _, due_in = date_key_in(F.col("DueDate"), cfg)
    orders = header.filter(order_in & due_in).select("SalesOrderID", "CustomerID", F.floor(order_key / 10000).cast("int").alias("Year"))
    costs = current_lookup(products, "ProductID", ["StandardCost"])
    lines = detail.select("SalesOrderID", "ProductID", "OrderQty", "LineTotal").join(costs, "ProductID") \
                  .withColumn("LineProfit", line_profit(F.col("LineTotal"), F.col("OrderQty"), F.col("StandardCost")))
    per_order = lines.join(orders, "SalesOrderID").groupBy("SalesOrderID", "Year", "CustomerID").agg(
        F.sum("LineTotal").alias("Revenue"), F.sum("LineProfit").alias("Profit"))
    known = per_order.join(customers.select("CustomerID").distinct(), "CustomerID", "left_semi")
    return (known.groupBy("Year").agg(F.count(F.lit(1)).alias("Orders"), sum_money("Revenue").alias("Revenue"),
                                      sum_money("Profit").alias("Profit")).orderBy("Year"))


def product_totals(lines: DataFrame, products: DataFrame, attributes: list[str]) -> DataFrame:
    """Lines (natural keys, no product looked up yet) summed by ProductID, then joined once
    with the products: what is joined is one row a product sold, however many lines. The
    profit follows from the sums, as a line's profit is its total less quantity times cost."""
    per = lines.groupBy("ProductID").agg(
        sum_qty().alias("Quantity"), sum_money("LineTotal").alias("Revenue"),
        F.sum(F.when(F.col("LineTotal").isNotNull(), F.col("OrderQty"))).cast("bigint").alias("_costed"))
    known = per.join(products.select("ProductID", "StandardCost", *attributes), "ProductID")
    return known.withColumn("Profit", (F.col("Revenue") - F.col("_costed") * F.col("StandardCost")).cast(REVENUE)).drop("_costed")


def top_products(lines: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    keys = ["ProductName", "ProductCategoryName", "ParentProductCategoryName"]
    return (product_totals(lines, products, keys)
            .groupBy(*keys)
            .agg(sum_qty("Quantity").alias("TotalQuantity"), sum_money("Revenue").alias("TotalRevenue"),
                 sum_money("Profit").alias("TotalProfit"))
            .orderBy(F.desc("TotalRevenue"), *[F.asc_nulls_first(c) for c in keys])
            .limit(k))


def top_product_numbers(lines: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    keys = ["ProductNumber", "ProductCategoryName"]
    return (product_totals(lines, products, keys)
            .groupBy(*keys)
            .agg(sum_qty("Quantity").alias("Quantity"), sum_money("Revenue").alias("Revenue"))
            .orderBy(F.desc("Revenue"), *[F.asc_nulls_first(c) for c in keys])
            .limit(k))


def revenue_by_category(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Orders are counted by category, so lines meet the products one by one: one join
    with one short label."""
    label = F.coalesce("ParentProductCategoryName", "ProductCategoryName").alias("Category")
    return (lines.join(products.select("ProductID", label), "ProductID")
             .groupBy("Category")
             .agg(F.count_distinct("SalesOrderID").alias("OrderCount"),
                  sum_qty().alias("TotalQuantity"), sum_money("LineTotal").alias("TotalRevenue"))
             .orderBy(F.desc("TotalRevenue"), "Category"))


def monthly_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return (_with_date(fact, dim_date, ["Year", "Month", "MonthName"])
            .groupBy("Year", "Month", "MonthName")
            .agg(F.count_distinct("SalesOrderID").alias("OrderCount"),
                 sum_money("LineTotal").alias("TotalRevenue"))
            .orderBy("Year", "Month"))


def fact_summary(fact: DataFrame) -> DataFrame:
    s = fact.agg(F.count(F.lit(1)).alias("total_row_count"),
                 F.count_distinct("SalesOrderID").alias("unique_orders"),
                 sum_money("LineTotal").alias("total_revenue"),
                 sum_money("LineProfit").alias("total_profit"))
    return s.withColumn("profit_margin_pct", safe_pct(F.col("total_profit"), F.col("total_revenue")))


def labelled_counts(frames: dict[str, DataFrame], label: str = "table_name",
                    count: str = "row_count") -> DataFrame:
    """UNION ALL of one-row counts (SET-2). Each branch is its own aggregate."""
    parts = [df.agg(F.count(F.lit(1)).alias(count)).select(F.lit(name).alias(label), count)
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def customer_summary(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Lines by natural keys are summed by CustomerID; the sums meet the dimension once."""
    per = (fact.groupBy("CustomerID")
               .agg(F.count_distinct("SalesOrderID").alias("OrderCount"),
                    F.count(F.lit(1)).alias("LineCount"), sum_qty().alias("TotalQuantity"),
                    sum_money("LineTotal").alias("TotalRevenue"),
                    sum_money("LineProfit").alias("TotalProfit"),
                    F.min("OrderDateKey").alias("FirstOrderDateKey"),
                    F.max("OrderDateKey").alias("LastOrderDateKey")))
    return per.join(dim_customer.select("CustomerKey", "CustomerID", "CompanyName"), "CustomerID")


def orders_by_quarter(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return (_with_date(fact, dim_date, ["Year", "Quarter", "Month"])
            .groupBy("Year", "Quarter", "Month")
            .agg(F.count_distinct("SalesOrderID").alias("OrderCount"),
                 sum_money("LineTotal").alias("TotalRevenue"))
            .orderBy("Year", "Quarter", "Month"))


def monthly_aggregate(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return (_with_date(fact, dim_date, ["Year", "Month"])
            .groupBy("Year", "Month")
            .agg(F.count_distinct("SalesOrderID").alias("OrderCount"),
                 F.count(F.lit(1)).alias("LineCount"), sum_qty().alias("TotalQuantity"),
                 sum_money("LineTotal").alias("TotalRevenue"),
                 sum_money("LineProfit").alias("TotalProfit")))


def geo_rollup(fact: DataFrame, dim_address: DataFrame) -> DataFrame:
    """Country, state, city and a grand total over the ship-to role (SPEC-11).
    Level is the grouping id: 0 city, 1 state, 3 country, 7 total.

    An order ships to one address, so lines are first summed by order: then orders are
    counted, not told apart, and the rollup multiplies one row a place instead of lines."""
    levels = ["CountryRegion", "StateProvince", "City"]
    a = dim_address.select(F.col("AddressKey").alias("ShipToAddressKey"), *levels)
    orders = fact.groupBy("SalesOrderID", "ShipToAddressKey").agg(sum_money("LineTotal").alias("Revenue"))
    places = orders.groupBy("ShipToAddressKey").agg(F.count(F.lit(1)).alias("Orders"), sum_money("Revenue").alias("Revenue"))
    return (places.join(a, "ShipToAddressKey", "left")
                .rollup(*levels)
                .agg(F.grouping_id().alias("Level"), F.sum("Orders").cast("bigint").alias("OrderCount"),
                     sum_money("Revenue").alias("TotalRevenue")))

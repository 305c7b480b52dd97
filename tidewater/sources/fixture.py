"""Map the driver's TPC-H-style tables onto the ten sales source tables.

The driver's tables carry no NULLs, duplicates or bad values, so those are
derived deterministically from the keys (e.g. every 7th customer has a broken
e-mail, every 10th customer also has an older version). Every column is a
built-in expression. A line's number is its place inside its order, so no global
order is needed and the number prunes away where it is not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.sources.model import SalesSources
from tidewater.sources.tables import as_lookup

LINEITEM_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                    "l_shipdate")


def ts(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def fixture_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    current = raw(spark, sf_dir, "customer").select(
        k.cast("int").alias("CustomerID"),
        F.when(k % 3 == 0, "Mr.").when(k % 3 == 1, "Ms.").alias("Title"),
        F.lit(None).cast("string").alias("Suffix"),
        F.when(k % 5 != 0, F.col("c_mktsegment")).alias("CompanyName"),
        F.concat(F.lit("sp"), _s(F.col("c_nationkey"))).alias("SalesPerson"),
        F.when(k % 7 == 0, "bad-email")
         .when(k % 11 == 0, F.lit(None).cast("string"))
         .when(k % 13 == 0, " pad@Example.com")
         .otherwise(F.concat(F.lit("User"), _s(k), F.lit("@Example.COM"))).alias("EmailAddress"),
        F.md5(F.concat(F.lit("pw"), _s(k))).alias("PasswordHash"),
        F.concat(F.lit("s"), _s(k % 97)).alias("PasswordSalt"),
        ts("2001-01-01").alias("ModifiedDate"),
    )
    older = (current.filter(F.col("CustomerID") % 10 == 0)
             .withColumns({"CompanyName": F.lit("OLD"), "EmailAddress": F.lit("old@example.com"),
                           "SalesPerson": F.lit("sp"), "ModifiedDate": ts("2000-01-01")}))
    return current.unionByName(older)


def fixture_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    price = F.col("p_retailprice").cast("decimal(10,2)")
    return raw(spark, sf_dir, "part").select(
        k.cast("int").alias("ProductID"),
        F.concat(F.lit(" "), F.lower("p_brand"), F.lit("-"), _s(k), F.lit(" ")).alias("ProductNumber"),
        F.concat(F.lower("p_type"), F.lit(" ")).alias("Color"),
        _s(F.col("p_size")).alias("Size"),
        F.when(k % 4 != 0, F.col("p_size").cast("decimal(8,2)")).alias("Weight"),
        F.when(k % 50 == 0, F.lit(0))
         .otherwise(price * F.lit(0.6).cast("decimal(2,1)")).cast("decimal(19,4)").alias("StandardCost"),
        price.cast("decimal(19,4)").alias("ListPrice"),
        (F.lit(100) + k % 25).cast("int").alias("ProductCategoryID"),
        F.when(k % 9 != 0, (k % 64).cast("int")).alias("ProductModelID"),
        ts("1995-01-01").alias("SellStartDate"),
        F.when(k % 8 == 0, ts("2000-06-30")).alias("SellEndDate"),
        F.when(k % 20 == 0, ts("2000-12-31")).alias("DiscontinuedDate"),
        F.lit(None).cast("binary").alias("ThumbNailPhoto"),
        F.concat(F.lit("p"), _s(k), F.lit(".gif")).alias("ThumbnailPhotoFileName"),
        ts("2001-01-01").alias("ModifiedDate"),
    )


def fixture_product_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = raw(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("int").alias("ProductCategoryID"),
        F.lit(None).cast("int").alias("ParentProductCategoryID"),
        F.col("r_name").alias("Name"))
    child = raw(spark, sf_dir, "nation").select(
        (F.lit(100) + F.col("n_nationkey")).cast("int").alias("ProductCategoryID"),
        F.col("n_regionkey").cast("int").alias("ParentProductCategoryID"),
        F.col("n_name").alias("Name"))
    return (top.unionByName(child)
               .withColumns({"rowguid": F.concat(F.lit("cat-"), _s(F.col("ProductCategoryID"))),
                             "ModifiedDate": ts("2001-01-01")}))


def fixture_product_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = raw(spark, sf_dir, "part").select((F.col("p_partkey") % 64).cast("int").alias("ProductModelID")).distinct()
    return ids.select(
        "ProductModelID",
        F.concat(F.lit("Model "), _s(F.col("ProductModelID"))).alias("Name"),
        F.concat(F.lit("mdl-"), _s(F.col("ProductModelID"))).alias("rowguid"),
        ts("2001-01-01").alias("ModifiedDate"))


def fixture_product_description(models: DataFrame) -> DataFrame:
    m = F.col("ProductModelID")
    en = models.select((F.lit(1000) + m).cast("int").alias("ProductDescriptionID"),
                       F.concat(F.lit("Description "), _s(m)).alias("Description"))
    fr = models.select((F.lit(2000) + m).cast("int").alias("ProductDescriptionID"),
                       F.concat(F.lit("Description fr "), _s(m)).alias("Description"))
    return en.unionByName(fr).withColumn("ModifiedDate", ts("2001-01-01"))


def fixture_model_description(models: DataFrame) -> DataFrame:
    m = F.col("ProductModelID")
    en = models.filter(m % 10 != 0).select(
        "ProductModelID", (F.lit(1000) + m).cast("int").alias("ProductDescriptionID"), F.lit("en").alias("Culture"))
    fr = models.select(
        "ProductModelID", (F.lit(2000) + m).cast("int").alias("ProductDescriptionID"), F.lit("fr").alias("Culture"))
    return en.unionByName(fr).withColumn("ModifiedDate", ts("2001-01-01"))


def fixture_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    # small code lists; Spark broadcasts them by their size
    places = raw(spark, sf_dir, "nation").join(raw(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return (raw(spark, sf_dir, "customer")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                k.cast("int").alias("AddressID"),
                F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("AddressLine1"),
                F.when(k % 2 == 1, F.concat(F.lit("Unit "), _s(k))).alias("AddressLine2"),
                F.lower("n_name").alias("City"),
                F.concat(F.lower("n_name"), F.lit(" ")).alias("StateProvince"),
                F.lower("r_name").alias("CountryRegion"),
                F.when(k % 17 != 0, F.concat(F.lit("pc"), _s(k))).alias("PostalCode"),
                F.concat(F.lit("adr-"), _s(k)).alias("rowguid"),
                ts("2001-01-01").alias("ModifiedDate")))


def fixture_customer_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("int")
    return raw(spark, sf_dir, "customer").select(
        k.alias("CustomerID"), k.alias("AddressID"), F.lit("Main Office").alias("AddressType"),
        ts("2001-01-01").alias("ModifiedDate"))


def fixture_order_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_orders(raw(spark, sf_dir, "orders"))


def map_orders(orders: DataFrame) -> DataFrame:
    """orders -> SalesOrderHeader; row-wise only, so it also maps a stream."""
    k = F.col("o_orderkey")
    od = F.col("o_orderdate")
    total = F.col("o_totalprice").cast("decimal(12,2)")
    return orders.select(
        k.cast("long").alias("SalesOrderID"),
        F.lit(1).cast("int").alias("RevisionNumber"),
        od.alias("OrderDate"),
        (od + F.expr("INTERVAL 12 DAYS")).alias("DueDate"),
        F.when(F.col("o_orderstatus") != "O", od + F.expr("INTERVAL 7 DAYS")).alias("ShipDate"),
        F.when(F.col("o_orderstatus") == "F", 5).when(F.col("o_orderstatus") == "P", 2)
         .otherwise(1).cast("int").alias("Status"),
        F.col("o_custkey").cast("int").alias("CustomerID"),
        F.col("o_custkey").cast("int").alias("ShipToAddressID"),
        F.when(k % 10 != 0, F.col("o_custkey").cast("int")).alias("BillToAddressID"),
        F.concat(F.col("o_orderpriority"), F.lit(" ")).alias("ShipMethod"),
        F.when(k % 3 == 0, F.concat(F.lit("cc"), _s(k))).alias("CreditCardApprovalCode"),
        total.cast("decimal(19,4)").alias("SubTotal"),
        (total * F.lit(0.08).cast("decimal(3,2)")).cast("decimal(19,4)").alias("TaxAmt"),
        F.when(k % 101 != 0, F.lit(25)).cast("decimal(19,4)").alias("Freight"),
        F.lit(None).cast("string").alias("Comment"),
        od.alias("ModifiedDate"),
    )


def fixture_order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = raw(spark, sf_dir, "lineitem")
    in_order = Window.partitionBy("l_orderkey").orderBy(*LINEITEM_COLUMNS)
    numbered = lines.withColumn("SalesOrderDetailID", F.row_number().over(in_order).cast("long"))
    # joined by the product id that the fact looks up, so lines keep their place for that lookup;
    # a line key beyond int meets no part, as before
    part = as_lookup(raw(spark, sf_dir, "part")).select(F.col("p_partkey").cast("int").alias("_part"), "p_retailprice")
    return (numbered.withColumn("ProductID", F.col("l_partkey").try_cast("int"))
            .join(part, F.col("ProductID") == F.col("_part"))
            .select(
                F.col("l_orderkey").cast("long").alias("SalesOrderID"),
                "SalesOrderDetailID",
                F.col("l_quantity").cast("smallint").alias("OrderQty"),
                "ProductID",
                F.col("p_retailprice").cast("decimal(10,2)").cast("decimal(19,4)").alias("UnitPrice"),
                F.col("l_discount").cast("decimal(4,2)").cast("decimal(19,4)").alias("UnitPriceDiscount"),
                F.col("l_shipdate").alias("ModifiedDate")))


def fixture_sources(spark: SparkSession, sf_dir: str) -> SalesSources:
    models = fixture_product_model(spark, sf_dir)
    return SalesSources(
        customer=lambda: fixture_customer(spark, sf_dir),
        product=lambda: fixture_product(spark, sf_dir),
        product_category=lambda: fixture_product_category(spark, sf_dir),
        product_model=lambda: models,
        product_description=lambda: fixture_product_description(models),
        model_description=lambda: fixture_model_description(models),
        address=lambda: fixture_address(spark, sf_dir),
        customer_address=lambda: fixture_customer_address(spark, sf_dir),
        header=lambda: fixture_order_header(spark, sf_dir),
        detail=lambda: fixture_order_detail(spark, sf_dir),
    )

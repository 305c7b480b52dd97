from datetime import date

from pyspark.sql import functions as F

from tidewater.config import RunConfig
from tidewater.plans import gold as G
from tidewater.plans.star import Star


def test_default_calendar_rows(spark):
    dd = G.dim_date(spark, RunConfig())
    assert dd.count() == 11323
    assert dd.columns == G.DIM_DATE_COLUMNS
    r = dd.filter(F.col("Date") == F.lit("2023-01-15").cast("date")).first()
    assert (r.DateKey, r.DayOfWeek, r.DayOfWeekName, r.IsWeekend, r.QuarterName) == (20230115, 7, "Sunday", True, "Q1")


def test_holiday_override(spark):
    cfg = RunConfig(calendar_start=date(2024, 1, 1), calendar_end=date(2024, 12, 31))
    days = G.calendar_days(spark, cfg.calendar_start, cfg.calendar_end)
    dd = G.date_attributes(days, 1, G.rule_holidays(days, [(12, 25)]))
    assert dd.filter("IsHoliday").select("DateKey").collect()[0][0] == 20241225
    assert dd.count() == 366


def test_star_grain_and_keys(spark, sf_small):
    st = Star.from_fixture(spark, sf_small)
    fact = st.fact_sales
    n_lines = st.silver["detail"].count()
    assert fact.count() == n_lines  # every line survives: calendar covers all dates, no orphans
    assert fact.agg(F.min("SalesKey"), F.max("SalesKey"), F.count_distinct("SalesKey")).first() == (1, n_lines, n_lines)
    for dim, key in [(st.dim_customer, "CustomerKey"), (st.dim_product, "ProductKey")]:
        n = dim.count()
        assert dim.agg(F.min(key), F.max(key), F.count_distinct(key)).first() == (1, n, n)
    # NULL foreign keys exactly where the source has no value.
    open_orders = st.silver["header"].filter(F.col("ShipDate").isNull()).select("SalesOrderID")
    null_ship = fact.filter(F.col("ShipDateKey").isNull()).select("SalesOrderID").distinct()
    assert null_ship.exceptAll(open_orders).count() == 0
    assert st.dim_address.filter("AddressKey = -1").count() == 1


def test_password_columns_stay_in_bronze(spark, sf_small):
    st = Star.from_fixture(spark, sf_small)
    assert "PasswordHash" in st.bronze["customer"].columns
    assert "PasswordHash" not in st.silver["customer"].columns
    assert "PasswordHash" not in st.dim_customer.columns

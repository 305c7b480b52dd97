"""Two-level fact keys, history in parts, versioned tables, incremental runs and streams."""

import tempfile
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewater import catalog
from tidewater.operators.keys import running_offsets
from tidewater.operators.scd import scd2_apply, scd2_step
from tidewater.plans import gold as G
from tidewater.plans.aggregates import merge_periods, order_totals, period_totals
from tidewater.plans.incremental import IncrementalPipeline
from tidewater.plans.pipeline import LayerFailed
from tidewater.plans.star import Star
from tidewater.sources.versions import TableStore
from tidewater.streaming.upserts import merge_batch, merge_stream


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _new(kind: str) -> str:
    return tempfile.mkdtemp(prefix=f"tidewater-test-{kind}-")


# --- dense fact key -------------------------------------------------------------------

def test_running_offsets_are_prefix_sums(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7 % 3001).alias("a"), (F.col("id") % 5).alias("w"))
    want = {r.a: r.s for r in df.select("a", F.coalesce(F.sum("w").over(
        Window.orderBy("a").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("s")).collect()}
    got = {r.a: r.o for r in running_offsets(df, ["a"], "w", "o").collect()}
    assert got == want
    assert running_offsets(df.filter("a < 0"), ["a"], "w", "o").count() == 0


def _order_tables(spark, lines, headers, products=(1, 2, 3)):
    money = Decimal("1.0000")
    detail = spark.createDataFrame([(o, d, 1, p, money, Decimal(0), money) for o, d, p in lines],
                                   "SalesOrderID long, SalesOrderDetailID long, OrderQty int, ProductID int, UnitPrice decimal(19,4), "
                                   "UnitPriceDiscount decimal(19,4), LineTotal decimal(19,4)")
    day = datetime(2001, 5, 5)
    header = spark.createDataFrame([(o, rev, day, day, None, 1, 7, None, None, "x", money, money, money, money) for o, rev in headers],
                                   "SalesOrderID long, RevisionNumber int, OrderDate timestamp_ntz, DueDate timestamp_ntz, ShipDate timestamp_ntz, "
                                   "Status int, CustomerID int, ShipToAddressID int, BillToAddressID int, ShipMethod string, "
                                   "SubTotal decimal(19,4), TaxAmt decimal(19,4), Freight decimal(19,4), TotalDue decimal(19,4)")
    product = spark.createDataFrame([(p, money) for p in products], "ProductID int, StandardCost decimal(19,4)")
    customer = spark.createDataFrame([(7,)], "CustomerID int")
    return detail, header, product, customer


def test_fact_keys_of_lost_lines_many_blocks_and_repeated_orders(spark):
    lines = [(1, 5, 1), (1, 2, 2), (1, 9, 99), (2, 1, 1), (3, 1, 1), (3, None, 2), (3, 70_000, 1), (3, 140_000, 3), (3, 7, 2),
             (4, 1, 1), (5, 1, 1), (5, 2, 1), (6, -3, 1), (6, -70_000, 2)]
    headers = [(1, 1), (3, 1), (4, 1), (5, 1), (5, 2), (6, 1), (8, 1)]  # order 2 has no header, order 5 came twice
    detail, header, product, customer = _order_tables(spark, lines, headers)
    fact = G.fact_sales(detail, header, product, customer, None, catalog.FIXTURE_CONFIG)
    rows = sorted((r.SalesKey, r.SalesOrderID, r.SalesOrderDetailID) for r in fact.collect())
    want = [(1, 2), (1, 5), (3, None), (3, 1), (3, 7), (3, 70_000), (3, 140_000), (4, 1), (5, 1), (5, 1), (5, 2), (5, 2), (6, -70_000), (6, -3)]
    assert rows == [(k + 1, *w) for k, w in enumerate(want)]
    empty = G.fact_sales(detail.filter("false"), header, product, customer, None, catalog.FIXTURE_CONFIG)
    assert empty.count() == 0


def test_fact_rows_are_not_checkpointed_to_number_them(spark, sf_small):
    plan = _plan(E.queries()["gold_fact_sales"](spark, sf_small))
    scans = [line for line in plan.split("\n") if "ExistingRDD" in line]
    assert scans and not any("OrderQty" in line or "LineTotal" in line or "l_quantity" in line for line in scans)
    assert "rangepartitioning" not in plan


def test_fact_reads_lines_once_and_looks_addresses_up_by_narrow_rows(spark, sf_small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(E.queries()["gold_fact_sales"](spark, sf_small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "l_extendedprice" not in plan  # lines come from storage, where they were written once
    assert "hashpartitioning(_probe" in plan  # addresses are looked up by narrow rows:
    assert not any("ShipMethod" in line for line in plan.split("\n") if "_probe#" in line)


def test_places_with_missing_and_negative_addresses(spark):
    lines, headers = [(k, 1, 1) for k in range(1, 6)], [(k, 1) for k in range(1, 6)]
    detail, header, product, customer = _order_tables(spark, lines, headers)
    ids = {1: (10, None), 2: (None, 10), 3: (None, None), 4: (99, -5), 5: (10, 10)}
    ship, bill = (F.element_at(F.create_map(*[F.lit(v) for k, i in ids.items() for v in (k, i[n])]), F.col("SalesOrderID").cast("int")) for n in (0, 1))
    header = header.withColumns({"ShipToAddressID": ship.cast("int"), "BillToAddressID": bill.cast("int")})
    address = spark.createDataFrame([(7, 10, True), (8, -5, True), (9, None, True)], "AddressKey long, AddressID int, IsCurrent boolean")
    for unknown, none in ((False, None), (True, -1)):
        fact = G.fact_sales(detail, header, product, customer, address, catalog.FIXTURE_CONFIG, unknown_address_key=unknown)
        got = [(r.SalesOrderID, r.ShipToAddressKey, r.BillToAddressKey) for r in fact.orderBy("SalesKey").collect()]
        assert got == [(1, 7, none), (2, none, 7), (3, none, none), (4, none, 8), (5, 7, 7)]


def test_counts_make_no_keys(spark, sf_small):
    for name in ("layer_profile", "table_counts", "tables_per_layer"):
        assert "ExistingRDD" not in _plan(E.queries()[name](spark, sf_small)), name


def test_reports_join_products_once(spark, sf_small):
    for name in ("top_products", "top_product_numbers", "revenue_by_category"):
        plan = E.queries()[name](spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("windowspecdefinition(ProductID") == 1, (name, plan)  # deduplicated once


def test_rollup_expands_places_not_lines(spark, sf_small):
    plan = E.queries()["geo_rollup"](spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Expand")]
    below = plan[plan.index("Expand"):]
    assert "Aggregate [ShipToAddressKey" in below and "distinct" not in above


# --- history in parts -------------------------------------------------------------------

DIM = "SK long, NK long, attr string, IsCurrent boolean, EffectiveDate date, EndDate date"


def test_closed_versions_stay_where_they_are(spark):
    old, day = date(2000, 1, 1), F.lit("2001-01-01").cast("date")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ids = F.col("id")
        dim = spark.range(0, 40_000, 1, 16).select(
            (ids + 1).alias("SK"), (ids % 2000).alias("NK"), F.lit("a").alias("attr"), (ids >= 38_000).alias("IsCurrent"),
            F.lit(old).alias("EffectiveDate"), F.when(ids < 38_000, F.lit(old)).alias("EndDate"))
        batch = spark.range(0, 1000).select((F.col("id") * 2).alias("NK"), F.lit("b").alias("attr"))
        out = scd2_apply(dim, batch, "NK", ["attr"], day, "SK")
        sizes = Counter(r.p for r in out.select(F.spark_partition_id().alias("p")).collect())
        closed_before = [n for p, n in sizes.items() if p < 16]
        joined = [n for p, n in sizes.items() if p >= 16]
        assert sum(closed_before) == 38_000 and max(closed_before) <= 3 * sorted(closed_before)[len(closed_before) // 2]
        assert max(joined) <= 3 * sorted(joined)[len(joined) // 2]
        assert out.count() == 41_000 and out.filter("IsCurrent").count() == 2000
        assert out.agg(F.max("SK"), F.count_distinct("SK")).first() == (41_000, 41_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_open_versions_step_without_history(spark):
    d = date(2000, 1, 1)
    open_rows = spark.createDataFrame([(1, 10, "a", True, d, None), (2, 20, "b", True, d, None), (3, None, "n", True, d, None)], DIM)
    batch = spark.createDataFrame([(10, "a"), (20, "B"), (30, "c")], "NK long, attr string")
    nxt, closed, added = scd2_step(open_rows, batch, "NK", ["attr"], F.lit("2001-01-01").cast("date"), "SK", 8)
    assert added == 2
    assert sorted((r.SK, r.NK, r.attr) for r in nxt.collect()) == [(1, 10, "a"), (3, None, "n"), (9, 20, "B"), (10, 30, "c")]
    assert [(r.SK, r.IsCurrent, r.EndDate) for r in closed.collect()] == [(2, False, date(2001, 1, 1))]


# --- versioned tables ---------------------------------------------------------------------

def _files(store, table):
    return {r[0] for r in store.read(table).select("_metadata.file_path").distinct().collect()}


def test_readers_see_commits_only(spark):
    store = TableStore(spark, _new("store"))
    assert store.versions() == [] and store.state()["version"] == 0
    with pytest.raises(KeyError):
        store.read("t")
    first = store.begin()
    first.write("t", spark.range(5))
    first.append("log", spark.range(1))
    first.marks["m"] = "1"
    assert store.versions() == []
    first.commit()
    second = store.begin()
    second.write("t", spark.range(9))
    second.append("log", spark.range(1))
    assert store.read("t").count() == 5 and store.read("log").count() == 1
    late = store.begin()
    second.commit()
    assert store.read("t").count() == 9 and store.read("log").count() == 2 and store.read("t", 1).count() == 5
    late.write("t", spark.range(1))
    with pytest.raises(RuntimeError, match="another run"):
        late.commit()
    gone = store.remove_unlisted()
    assert len(gone) == 2 and store.versions() == [2] and store.read("t").count() == 9 and store.read("log").count() == 2


def test_upsert_rewrites_touched_buckets_only(spark):
    store = TableStore(spark, _new("store"))
    rows = lambda ids, v: spark.createDataFrame([(i, v, v) for i in ids], "id long, v int, m int")
    run = store.begin()
    run.upsert("t", rows(range(200), 1), ["id"], "m", buckets=16)
    run.commit()
    before = _files(store, "t")
    run = store.begin()
    seen = run.upsert("t", rows([3, 500], 2).unionByName(rows([3], 3)), ["id"], "m")
    run.commit()
    after = _files(store, "t")
    assert 1 <= len(seen["touched"]) <= 2 and len(before & after) >= 14 * len(before) // 16
    got = {r.id: r.v for r in store.read("t").collect()}
    assert len(got) == 201 and got[3] == 3 and got[500] == 2 and got[4] == 1
    run = store.begin()
    run.upsert("t", rows([3], 1).unionByName(rows([4], 9)), ["id"], "m", newest=True)
    run.upsert("t", rows([], 1), ["id"], "m")
    run.commit()
    got = {r.id: r.v for r in store.read("t").collect()}
    assert got[3] == 3 and got[4] == 9 and len(got) == 201
    store.remove_unlisted()
    assert {r.id: r.v for r in store.read("t").collect()} == got


# --- incremental runs -----------------------------------------------------------------------

def test_second_run_takes_only_what_is_new(spark, sf_small):
    st, run = catalog._incremental(spark, sf_small)
    first = run.store.state()
    log = {(r.layer, r.table_name): r for r in run.run(st.sources).collect()}
    assert log["bronze", "Product"].rows == 0 and log["silver", "Product"].rows == 0
    headers = st.bronze["header"].count()
    assert 0 < log["bronze", "SalesOrderHeader"].rows < headers
    assert run.read("bronze", "SalesOrderHeader").count() == headers == run.read("silver", "SalesOrderHeader").count()
    assert run.read("bronze", "Customer").count() == st.bronze["customer"].count()
    assert run.store.state()["marks"]["bronze_SalesOrderHeader"] > first["marks"]["bronze_SalesOrderHeader"]
    for name, key in (("Customer", "customer"), ("SalesOrderDetail", "detail"), ("Address", "address")):
        stored, full = run.read("silver", name), st.silver[key]
        assert stored.exceptAll(full.select(stored.columns)).count() == 0 and stored.count() == full.count()
    same = run.store.state()["tables"]["silver_Product"]["parts"]
    assert same == first["tables"]["silver_Product"]["parts"]
    log = run.run(st.sources).collect()  # nothing new
    assert sum(r.rows for r in log if r.layer in ("bronze", "silver")) == 0
    assert run.read("gold", "Monthly_Sales").agg(F.sum("LineCount")).first()[0] == run.read("gold", "Fact_Sales").count()


def test_rows_without_a_time_come_once(spark, sf_small):
    st, run = catalog._incremental(spark, sf_small)
    row = spark.createDataFrame([(999, None, "New", "cat-999", None)], st.sources.product_category.schema)
    st.sources._built["product_category"] = st.sources.product_category.unionByName(row)
    added = lambda log: log.filter("layer = 'bronze' AND table_name = 'ProductCategory'").first().rows
    assert added(run.run(st.sources)) == 1 and added(run.run(st.sources)) == 0
    assert run.read("silver", "ProductCategory").filter("ProductCategoryID = 999").count() == 1


def test_a_refresh_builds_anew_and_shows_at_its_commit(spark, sf_small):
    st, run = catalog._incremental(spark, sf_small)
    early = run.read("gold", "Fact_Sales").count()
    log = run.run(st.sources, refresh=True)
    assert run.read("gold", "Fact_Sales", 1).count() == early < run.read("gold", "Fact_Sales").count()
    assert log.filter("layer = 'bronze' AND table_name = 'Product'").first().rows == st.bronze["product"].count()
    assert run.read("bronze", "SalesOrderHeader").count() == st.bronze["header"].count()
    assert run.read("gold", "Yearly_Sales").agg(F.sum("LineCount")).first()[0] == run.read("gold", "Fact_Sales").count()
    held = run.store.remove_unlisted()
    assert held and run.read("gold", "Fact_Sales").count() == st.silver["detail"].count()


def test_a_failed_table_is_tried_again_and_then_ends_the_run(spark, sf_small):
    st = Star.from_fixture(spark, sf_small)
    run = IncrementalPipeline(spark, TableStore(spark, _new("store")), st.cfg, buckets=4)
    tries = []
    build = run._customers

    def shaky(r):
        tries.append(1)
        if len(tries) == 1:
            raise RuntimeError("lost")
        return build(r)
    run._customers = shaky
    log = run.run(st.sources)
    assert len(tries) == 2 and log.filter("status <> 'success'").count() == 0
    st.sources._built["header"] = st.sources.header.drop("ShipMethod")
    broken = IncrementalPipeline(spark, TableStore(spark, _new("store")), st.cfg, buckets=4)
    with pytest.raises(LayerFailed, match="ShipMethod") as halted:
        broken.run(st.sources)
    assert broken.store.versions() == [] and {r.layer for r in halted.value.log.collect()} == {"bronze", "silver"}


def test_periods_follow_orders_that_change_and_go(spark):
    schema = "SalesOrderID long, OrderDateKey int, OrderQty int, LineTotal decimal(19,4), LineProfit decimal(19,4)"
    rows = lambda *r: order_totals(spark.createDataFrame([(o, k, 1, Decimal(v), Decimal(v)) for o, k, v in r], schema))
    stored = period_totals(rows((1, 20010105, 5), (1, 20010105, 6), (2, 20010207, 7), (3, 20020101, 8)), ["Year"])
    out = merge_periods(stored, rows((2, 20010207, 9), (4, 20030101, 1)), rows((2, 20010207, 7), (3, 20020101, 8)), ["Year"])
    got = sorted((r.Year, r.OrderCount, r.LineCount, int(r.TotalRevenue)) for r in out.collect())
    assert got == [(2001, 2, 3, 20), (2003, 1, 1, 1)]


# --- storage-partitioned join, streams ---------------------------------------------------------

def test_bucketed_orders_meet_without_a_shuffle(spark, sf_small):
    plan = _plan(E.queries()["bucketed_revenue_by_year"](spark, sf_small))
    assert "Bucketed: true" in plan
    at = plan.index("SortMergeJoin [SalesOrderID") if "SortMergeJoin [SalesOrderID" in plan else plan.index("[SalesOrderID")
    assert "hashpartitioning(SalesOrderID" not in plan[at:] and "hashpartitioning(SalesOrderID" not in plan


EVENTS = "event_id long, ts timestamp, user_id long, value int"


def test_stream_drops_repeats_and_counts_what_is_too_late(spark):
    base, t0 = _new("stream"), datetime(2024, 1, 1)
    store = TableStore(spark, f"{base}/store")

    def send(*rows):
        df = spark.createDataFrame([(i, t0 + timedelta(hours=h), u, v) for i, h, u, v in rows], EVENTS)
        df.coalesce(1).write.mode("append").parquet(f"{base}/in")
        return merge_stream(spark, f"{base}/in", df.schema, store, "latest", ["event_id"], ["user_id"], "ts", "5 hours", f"{base}/cp", buckets=4)

    assert send((1, 1, 1, 10), (2, 2, 2, 20), (1, 1, 1, 10)).rows_in == 3
    second = send((3, 10, 1, 30), (2, 2, 2, 20), (4, 1, 2, 5))
    assert second.too_late == 0
    send((5, 20, 3, 1))
    assert {r.user_id: r.value for r in store.read("latest").collect()} == {1: 30, 2: 20, 3: 1}
    assert send((6, 1, 1, 99), (7, 21, 3, 2)).too_late == 1
    assert {r.user_id: r.value for r in store.read("latest").collect()} == {1: 30, 2: 20, 3: 2}


def test_a_repeated_micro_batch_changes_nothing(spark):
    store = TableStore(spark, _new("store"))
    rows = spark.createDataFrame([(1, datetime(2024, 1, 1), 1, 1)], EVENTS)
    assert merge_batch(store, "t", rows, 0, ["user_id"], "ts", 4)
    assert not merge_batch(store, "t", rows.withColumn("value", F.lit(9)), 0, ["user_id"], "ts", 4)
    assert store.read("t").first().value == 1 and store.state()["version"] == 1


def test_buckets_grow_with_the_lines(spark, sf_small, monkeypatch):
    from tidewater.sources import sinks
    assert sinks.bucket_count(spark.range(10), spark.range(3)) == 8
    monkeypatch.setattr(sinks, "BUCKET_ROWS", 500)
    lines = spark.read.parquet(f"{sf_small}/lineitem.parquet").count()
    df = E.queries()["bucketed_revenue_by_year"](spark, sf_small)
    assert f"SelectedBucketsCount: {-(-lines // 500)} out of" in df._jdf.queryExecution().toString()
    assert sorted(df.collect()) == sorted(E.queries()["revenue_by_year"](spark, sf_small).collect())


def test_first_upsert_is_written_once(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = spark.createDataFrame([(k % 50, k, "x") for k in range(120)] + [(None, 5, "n"), (None, 9, "m")], "id long, v long, t string")
    run = store.begin()
    seen = run.upsert("t", rows, ["id"], "v", buckets=4)
    run.commit()
    assert store._names("data") == ["t"]  # no copy of the batch beside the table
    assert seen["rows"] == 51 and seen["touched"] == sorted(store.state()["tables"]["t"]["parts"])
    got = {r.id: (r.v, r.t) for r in store.read("t").collect()}
    assert got == {None: (9, "m"), **{k: (k + 100 if k < 20 else k + 50, "x") for k in range(50)}}


def test_lines_are_summed_by_order_once(spark, sf_small, monkeypatch):
    from tidewater.plans import aggregates
    asked = []
    monkeypatch.setattr(aggregates, "period_totals", lambda orders, columns: asked.append(orders) or period_totals(orders, columns))
    catalog._period_tables(spark, sf_small)
    plans = [o._jdf.queryExecution().optimizedPlan().toString() for o in asked]
    assert len(plans) == 6 and not any("Aggregate" in p or "Join" in p for p in plans)  # stored orders, lines not summed again


# --- batches cost what they hold ------------------------------------------------------------

def test_new_keys_are_added_without_rewriting_their_buckets(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = lambda ids, v: spark.createDataFrame([(i, v, v) for i in ids], "id long, v int, m int")
    for newest in (True, False):
        run = store.begin()
        run.forget()
        run.upsert("t", rows(range(100), 1), ["id"], "m", buckets=4)
        run.commit()
        first = store.state()["tables"]["t"]["parts"]
        run = store.begin()
        seen = run.upsert("t", rows([*range(100, 200), 150], 2), ["id"], "m", newest=newest)
        run.commit()
        parts = store.state()["tables"]["t"]["parts"]
        assert all(parts[p][:-1] == first[p] for p in first)  # nothing stored was written again
        assert seen["rows"] == 200 and seen["touched"] == sorted(parts) and store.read("t").count() == 200
        run = store.begin()
        seen = run.upsert("t", rows([5, 777], 3).unionByName(rows([7], 0)), ["id"], "m", newest=newest)
        run.commit()
        after = store.state()["tables"]["t"]["parts"]
        got = {r.id: r.v for r in store.read("t").collect()}
        assert len(got) == 201 and got[5] == 3 and got[777] == 3 and got[7] == (1 if newest else 0)
        assert seen["rows"] == sum(store.load(store.state()["tables"]["t"], [p]).count() for p in seen["touched"])
        assert all(after[p] == parts[p] for p in parts if p not in seen["touched"])
        store.remove_unlisted()
        assert {r.id: r.v for r in store.read("t").collect()} == got


def test_missing_keys_meet_and_buckets_do_not_grow_without_end(spark, tmp_path, monkeypatch):
    from tidewater.sources import versions
    monkeypatch.setattr(versions, "MOST_FOLDERS", 3)
    store = TableStore(spark, str(tmp_path))
    for k in range(5):
        run = store.begin()
        run.upsert("t", spark.createDataFrame([(None, k, "n"), (k, k, "x"), (k, -1, "old")], "id long, v long, t string"), ["id"], "v",
                   buckets=1, newest=True)
        run.commit()
    assert {r.id: (r.v, r.t) for r in store.read("t").collect()} == {None: (4, "n"), **{k: (k, "x") for k in range(5)}}
    for k in range(5, 9):
        run = store.begin()
        run.upsert("t", spark.createDataFrame([(k, k, "x")], "id long, v long, t string"), ["id"], "v", newest=True)
        run.commit()
    assert store.read("t").count() == 10 and len(store.state()["tables"]["t"]["parts"]["0"]) <= 3


def test_an_increment_reads_its_source_once(spark, sf_small, monkeypatch):
    from tidewater.sources.versions import Run
    st, run = catalog._incremental(spark, sf_small)
    plans, append = {}, Run.append
    monkeypatch.setattr(Run, "append", lambda self, table, df, *a, **k: (
        plans.__setitem__(table, df._jdf.queryExecution().optimizedPlan().toString()), append(self, table, df, *a, **k))[1])
    run.run(st.sources)
    lines = plans["bronze_SalesOrderDetail"]
    assert lines.count("Window [") == 1 and "Union" not in lines
    assert run.read("bronze", "SalesOrderDetail").count() == st.bronze["detail"].count()


def test_rows_with_and_without_a_time_come_once(spark):
    from tidewater.operators.merge import rows_after
    day = lambda k: datetime(2000, 1, k)
    frame = lambda *r: spark.createDataFrame(r, "id long, m timestamp_ntz")
    loaded = frame((1, day(1)), (2, day(2)), (3, None))
    source = frame((1, day(1)), (2, day(2)), (3, None), (4, day(2)), (5, day(3)), (6, None), (3, day(2)), (2, None), (None, day(2)), (None, None))
    got = rows_after(source, "m", day(2), loaded, ["id"], undated=True).collect()
    assert sorted(((r.id or 0), r.m or day(9)) for r in got) == sorted(
        [(4, day(2)), (5, day(3)), (6, day(9)), (3, day(2)), (2, day(9)), (0, day(2)), (0, day(9))])


def test_changed_orders_by_one_grouping(spark):
    from tidewater.plans.aggregates import _side, changed_orders
    schema = "SalesOrderID long, OrderDateKey int, OrderQty int, LineTotal decimal(19,4), LineProfit decimal(19,4)"
    fact = lambda *r: spark.createDataFrame([(o, d, q, Decimal(q), None) for o, d, q in r], schema)
    now, before = fact((1, 10, 1), (2, 10, 2), (2, 10, 3), (3, 11, 1), (None, 12, 1)), fact((1, 10, 1), (2, 10, 2), (4, 10, 1), (3, 12, 1))
    changed = changed_orders(now, before)
    assert _plan(changed).count("Exchange hashpartitioning") == 1
    for side, frames in (("now", (now, before)), ("were", (before, now))):
        want = order_totals(frames[0]).exceptAll(order_totals(frames[1]))
        got = _side(changed, side)
        assert got.schema.names == want.schema.names and got.exceptAll(want).count() == want.exceptAll(got).count() == 0

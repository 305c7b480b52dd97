import re
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewater.operators.dedup import latest_by_key
from tidewater.plans.pipeline import LayerFailed, Pipeline, run_summary
from tidewater.plans.star import Star
from tidewater.sources.model import SOURCE_TABLES
from tidewater.sources.tables import read_optional


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pipeline_layers_hand_over_through_storage(spark, sf_small):
    st = Star.from_fixture(spark, sf_small)
    target = tempfile.mkdtemp(prefix="tidewater-test-run-")
    log = Pipeline(spark, st.sources, st.cfg, target, partition_fact=True).run()
    rows = {(r.layer, r.table_name): r for r in log.collect()}
    assert len(rows) == 22 and all(r.status == "success" for r in rows.values())
    fact = spark.read.parquet(f"{target}/gold_Fact_Sales")
    assert fact.count() == rows[("gold", "Fact_Sales")].rows == rows[("silver", "SalesOrderDetail")].rows
    # Year/Month directories prune: the filter becomes a partition filter.
    pruned = fact.filter((F.col("Year") == 1996) & (F.col("Month") == 3))
    assert "PartitionFilters: [isnotnull(Year" in _plan(pruned)
    summary = {r.layer: r for r in run_summary(log).collect()}
    assert (summary["bronze"].tables, summary["silver"].tables, summary["gold"].tables) == (10, 7, 5)


def _broken(spark, sf):
    st = Star.from_fixture(spark, sf)
    st.sources._built["header"] = st.sources.header.drop("ShipMethod")  # silver needs it
    return st


def test_pipeline_halts_where_the_caller_sees_it(spark, sf_small):
    st = _broken(spark, sf_small)
    with pytest.raises(LayerFailed, match="ShipMethod") as halted:
        Pipeline(spark, st.sources, st.cfg, tempfile.mkdtemp(prefix="tidewater-test-fail-")).run()
    log = halted.value.log.collect()
    assert [r.layer for r in log if r.status == "failed"] == ["silver"]
    assert "gold" not in {r.layer for r in log}


def test_pipeline_takes_no_stale_input(spark, sf_small):
    target = tempfile.mkdtemp(prefix="tidewater-test-stale-")
    good = Star.from_fixture(spark, sf_small)
    Pipeline(spark, good.sources, good.cfg, target).run(("bronze", "silver"))
    bad = _broken(spark, sf_small)
    log = Pipeline(spark, bad.sources, bad.cfg, target, fail_fast=False).run()
    status = {(r.layer, r.table_name): r.status for r in log.collect()}
    assert status[("silver", "SalesOrderHeader")] == "failed"
    assert status[("gold", "Fact_Sales")] == "skipped" and status[("gold", "Dim_Customer")] == "success"


def test_tables_of_a_layer_are_written_side_by_side(spark, sf_small):
    st = Star.from_fixture(spark, sf_small)
    run = Pipeline(spark, st.sources, st.cfg, tempfile.mkdtemp(prefix="tidewater-test-side-"), workers=4)
    meet = threading.Barrier(3, timeout=60)  # three writes must be under way at once
    write = run._write

    def slow(layer, table, *args, **kw):
        if table in ("Customer", "Address", "Product"):
            meet.wait()
        return write(layer, table, *args, **kw)

    run._write = slow
    log = run.run(("bronze",)).collect()
    assert [r.table_name for r in log] == [SOURCE_TABLES[a] for a in st.sources.available()]
    assert all(r.status == "success" for r in log)


def test_optional_descriptions_only_when_absent(spark, sf_small):
    st = Star.from_fixture(spark, sf_small)
    run = Pipeline(spark, st.sources, st.cfg, tempfile.mkdtemp(prefix="tidewater-test-opt-"))
    assert run._descriptions() is None
    with pytest.raises(ZeroDivisionError):
        read_optional(lambda: 1 / 0)


def test_partitioned_fact_has_few_files(spark, sf_small):
    st = Star.from_fixture(spark, sf_small)
    target = tempfile.mkdtemp(prefix="tidewater-test-part-")
    Pipeline(spark, st.sources, st.cfg, target, partition_fact=True).run()
    files = spark.read.parquet(f"{target}/gold_Fact_Sales").select("_metadata.file_path").distinct().collect()
    folders = {f[0].rsplit("/", 1)[0] for f in files}
    assert len(files) <= len(folders) + 8


def test_streaming_landing_equals_batch_bronze(spark, sf_small):
    q = E.queries()
    streamed = q["streaming_incremental_orders"](spark, sf_small)
    batch = q["bronze_ingest_orders"](spark, sf_small)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(streamed.columns)).count() == 0


def test_latest_by_key_limits_before_shuffle(spark, sf_small):
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    plan = _plan(latest_by_key(events, ["user_id"], "ts"))
    assert "WindowGroupLimit" in plan


def test_high_water_mark_is_pushed_into_scan(spark, sf_small):
    df = E.queries()["incremental_orders"](spark, sf_small)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in plan


def test_only_keyed_tables_start_from_a_checkpoint(spark):
    sf = "/root/testdata/sf0.1"
    star = Star.from_fixture(spark, sf)
    assert "ExistingRDD" not in _plan(star.silver["detail"]) and "ExistingRDD" not in _plan(star.bronze["detail"])
    rev = _plan(E.queries()["revenue_by_year"](spark, sf))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_discount:double>" in rev
    assert "Window" not in rev.split("l_orderkey", 1)[0]


def test_analytics_plan_no_addresses(spark, sf_small):
    for name in ("fact_summary", "business_metrics"):
        assert "AddressKey" not in _plan(E.queries()[name](spark, sf_small))


def test_schema_check_reads_each_table_once(spark, sf_small):
    plan = _plan(E.queries()["schema_check"](spark, sf_small))
    assert plan.count("FileScan") <= 20  # 10 tables; models and addresses read two files each


def test_as_of_lookup_keeps_every_line_and_changes_version(spark, sf_small):
    rows = E.queries()["fact_on_scd2_customers"](spark, sf_small)
    assert rows.count() == Star.from_fixture(spark, sf_small).silver["detail"].count()
    old = rows.filter("CompanyName = 'OLD'").agg(F.max("OrderDateKey")).first()[0]
    assert old is not None and old < 19970101


def test_large_lookups_are_not_broadcast(spark, sf_small, monkeypatch):
    # by their compressed columns Spark takes them for small; their rows are counted instead
    from tidewater.plans.gold import FACT_SALES_COLUMNS
    from tidewater.sources import tables
    st = Star.from_fixture(spark, sf_small)
    run = Pipeline(spark, st.sources, st.cfg, tempfile.mkdtemp(prefix="tidewater-test-lookup-"))
    run.run()
    lookups = lambda: [line for line in run._fact()._jdf.queryExecution().optimizedPlan().toString().split("\n")
                       if re.search(r"Join .*\b(ProductID|CustomerID|_aid)#\d+L?\)", line) and "_CustomerID" not in line]
    assert lookups() and not any("strategy=merge" in line for line in lookups())
    monkeypatch.setattr(tables, "LOOKUP_ROWS", 3)
    assert {"ProductID", "CustomerID", "_aid"} <= set(re.findall(r"[A-Za-z_]+(?=#)", " ".join(lookups())))
    assert all("strategy=merge" in line for line in lookups())
    assert "BroadcastExchange" not in _plan(Star.from_fixture(spark, sf_small).sources.detail)
    fact, stored = run._fact(), run.read("gold", "Fact_Sales")
    assert fact.columns == FACT_SALES_COLUMNS and fact.exceptAll(stored).count() == 0 and fact.count() == stored.count()


def test_partitions_are_gathered_without_a_shuffle(spark, tmp_path, monkeypatch):
    from tidewater.session import ensure_checkpoint_dir
    from tidewater.sources import sinks
    rows = [(k, k % 3 or None, ["a b", "c/d", None, "e=f"][k % 4], k % 5) for k in range(4000)]
    df = spark.createDataFrame(rows, "id long, y int, m string, v int").repartition(6).select("id", "y", "m", "v")
    monkeypatch.setattr(sinks, "FILE_BYTES", 4000)
    got = sinks.gathered(df, ["y", "m"], str(tmp_path / "parts"))
    assert "Exchange" not in _plan(got) and got.schema == df.schema and got.exceptAll(df).count() == 0 and got.count() == 4000
    held = got.groupBy(F.spark_partition_id().alias("p")).agg(F.countDistinct(F.struct("y", "m")).alias("n")).collect()
    assert {r.n for r in held} == {1} and len(held) > 12  # one value a task, several tasks a value
    monkeypatch.setattr(sinks, "FILE_BYTES", 1 << 20)
    whole = sinks.gathered(df, ["y", "m"], str(tmp_path / "whole"))
    assert 12 <= whole.select(F.spark_partition_id()).distinct().count() <= 13  # not one task for all small values
    rebalanced = []
    hint = type(df).hint
    monkeypatch.setattr(type(df), "hint", lambda self, name, *a: rebalanced.append(name) or hint(self, name, *a))
    assert sinks.write_table(df, str(tmp_path / "t"), partition_by=["y", "m"]) == 4000 and not rebalanced
    stored = spark.read.schema(df.schema).parquet(str(tmp_path / "t")).select(df.columns)
    assert stored.exceptAll(df).count() == 0 and stored.count() == 4000
    assert sinks.write_table(df.filter("id < 0"), str(tmp_path / "none"), partition_by=["y", "m"]) == 0
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/tidewater-parts")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert len(fs.listStatus(folder)) == 0  # what was gathered is gone

from datetime import date, datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators.dedup import latest_by_key
from tidewater.operators.hierarchy import flatten_parent
from tidewater.plans.quality import table_diff
from tidewater.operators.keys import assign_sequential_key, current_lookup, version_spans
from tidewater.operators.members import with_unknown_member
from tidewater.operators.merge import high_water_mark, rows_after, upsert
from tidewater.operators.scd import scd2_apply


def test_latest_by_key_nulls_last_and_ties(spark):
    rows = [(1, "old", datetime(2000, 1, 1)), (1, "new", datetime(2001, 1, 1)),
            (2, "dated", datetime(1999, 1, 1)), (2, "undated", None),
            (3, "a", datetime(2001, 1, 1)), (3, "b", datetime(2001, 1, 1))]
    df = spark.createDataFrame(rows, "id int, v string, ModifiedDate timestamp_ntz")
    got = {r.id: r.v for r in latest_by_key(df, ["id"]).collect()}
    assert got == {1: "new", 2: "dated", 3: "b"}  # exact tie broken by the other columns
    plan = latest_by_key(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan


def test_sequential_key_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("a"), (F.col("id") % 3).alias("b"))
    want = df.withColumn("k", F.row_number().over(Window.orderBy("a", "b")).cast("long"))
    for n in (None, 1, 16):
        got = assign_sequential_key(df, ["a", "b"], "k", num_partitions=n)
        assert got.schema["k"].dataType.simpleString() == "bigint"
        assert got.count() == 5000 and got.exceptAll(want.select(got.columns)).count() == 0
    assert assign_sequential_key(df.filter("a < 0"), ["a"], "k").count() == 0


def test_version_spans_cover_each_date_once(spark):
    rows = [(1, 10, date(2000, 1, 1)), (1, 11, date(2001, 1, 1)), (2, 12, date(2000, 6, 1))]
    dim = spark.createDataFrame(rows, "NK int, SK int, EffectiveDate date")
    got = sorted((r.NK, r.SK, str(r._from), str(r._to)) for r in version_spans(dim, "NK", "SK").collect())
    assert got == [(1, 10, "0001-01-01", "2001-01-01"), (1, 11, "2001-01-01", "9999-12-31"), (2, 12, "0001-01-01", "9999-12-31")]


def test_current_lookup_has_one_row_per_key(spark):
    dim = spark.createDataFrame([(1, 10, True), (1, 11, True), (1, 12, False), (2, 13, None)], "NK int, SK int, IsCurrent boolean")
    assert [tuple(r) for r in current_lookup(dim, "NK", ["SK"]).collect()] == [(1, 11)]


def test_unknown_member_typed(spark):
    dim = spark.createDataFrame([(1, 10, "x", date(2001, 1, 1))], "k int, id int, name string, d date")
    out = with_unknown_member(dim, {"k": F.lit(-1), "id": F.lit(-1), "name": F.lit("Unknown")})
    assert out.schema == dim.schema
    assert sorted(r.k for r in out.collect()) == [-1, 1]
    empty = with_unknown_member(dim.filter("k < 0"), {"k": F.lit(-1)})
    assert empty.count() == 1


def test_flatten_parent(spark):
    cats = spark.createDataFrame([(1, None, "Top"), (10, 1, "Child"), (11, 99, "Orphan")],
                                 "id int, parent int, name string")
    got = {r.id: (r.cat, r.parent_name) for r in
           flatten_parent(cats, "id", "parent", "name", "cat", "parent_name").collect()}
    assert got == {1: ("Top", None), 10: ("Child", "Top"), 11: ("Orphan", None)}


def test_scd2_apply(spark):
    cur = spark.createDataFrame(
        [(1, 100, "a", True, date(2000, 1, 1), None), (2, 200, "b", True, date(2000, 1, 1), None)],
        "SK int, NK int, attr string, IsCurrent boolean, EffectiveDate date, EndDate date")
    inc = spark.createDataFrame([(100, "a"), (200, "b2"), (300, "c")], "NK int, attr string")
    out = scd2_apply(cur, inc, "NK", ["attr"], F.lit("2001-01-01").cast("date"), "SK")
    rows = sorted((r.SK, r.NK, r.attr, r.IsCurrent, r.EndDate) for r in out.collect())
    assert rows == [(1, 100, "a", True, None), (2, 200, "b", False, date(2001, 1, 1)),
                    (3, 200, "b2", True, None), (4, 300, "c", True, None)]


def test_upsert_and_high_water_mark(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    u = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    assert sorted(tuple(r) for r in upsert(t, u, ["id"]).collect()) == [(1, "a"), (2, "B"), (3, "C")]
    src = spark.createDataFrame([(1, datetime(2000, 1, 1)), (2, datetime(2001, 1, 1))], "id int, m timestamp_ntz")
    assert [r.id for r in rows_after(src, "m", datetime(2000, 6, 1)).collect()] == [2]


def test_upsert_reduces_the_batch(spark):
    t = spark.createDataFrame([(1, 1, "a")], "id int, v int, s string")
    u = spark.createDataFrame([(1, 2, "b"), (1, 3, "c"), (2, 1, "d"), (2, 1, "d")], "id int, v int, s string")
    assert sorted(tuple(r) for r in upsert(t, u, ["id"], "v").collect()) == [(1, 3, "c"), (2, 1, "d")]


def test_rows_late_at_the_mark_are_found(spark):
    m = datetime(2000, 1, 1)
    loaded = spark.createDataFrame([(1, m)], "id int, m timestamp_ntz")
    src = spark.createDataFrame([(1, m), (2, m), (3, datetime(2000, 1, 2)), (4, datetime(1999, 1, 1))], "id int, m timestamp_ntz")
    got = rows_after(src, "m", high_water_mark(loaded, "m"), loaded, ["id"])
    assert sorted(r.id for r in got.collect()) == [2, 3]


def test_scd2_reduces_the_batch_and_keeps_rows_that_are_not_open(spark):
    cur = spark.createDataFrame(
        [(1, 100, "a", True, date(2000, 1, 1), None), (2, 100, "z", None, date(1999, 1, 1), None),
         (3, 200, "b", True, date(2000, 1, 1), None), (4, 300, None, True, date(2000, 1, 1), None)],
        "SK int, NK int, attr string, IsCurrent boolean, EffectiveDate date, EndDate date")
    inc = spark.createDataFrame([(100, "n1"), (100, "n2"), (300, None), (400, "c"), (400, "c")], "NK int, attr string")
    out = scd2_apply(cur, inc, "NK", ["attr"], F.lit("2001-01-01").cast("date"), "SK")
    rows = sorted((r.SK, r.NK, r.attr, r.IsCurrent, r.EndDate) for r in out.collect())
    assert rows == [(1, 100, "a", False, date(2001, 1, 1)), (2, 100, "z", None, None), (3, 200, "b", True, None),
                    (4, 300, None, True, None), (5, 100, "n2", True, None), (6, 400, "c", True, None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1


def test_diff_moves_digests_and_sees_nulls_and_swaps(spark):
    rows = [(1, "a", 5, None), (2, "b", None, 5), (3, None, 1, 1), (4, "d", 2, 3), (6, "f", 0, 0)]
    other = [(1, "a", None, 5), (2, "b", None, 5), (3, None, 1, 1), (4, "d", 3, 2), (5, "e", 0, 0)]
    a, b = (spark.createDataFrame(r, "k long, t string, x int, y int") for r in (rows, other))
    diff = table_diff(a, b, ["k"])
    assert tuple(diff.first()) == (5, 5, 1, 1, 2)
    assert "__digest" in diff._jdf.queryExecution().optimizedPlan().toString()
    assert tuple(table_diff(a, b.withColumn("x", F.col("x").cast("long")), ["k"]).first()) == (5, 5, 1, 1, 2)

"""Validation and data-quality checks (DQ-1 .. DQ-10, SPEC-4, SPEC-7, SPEC-9).

Every check is one aggregate per table (conditional counts in a single pass)
instead of one count job per flag, and covers all rows, not a sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StructType

from tidewater.functions.cleanse import safe_pct
from tidewater.plans.analytics import sum_money


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fk_orphans(fact: DataFrame, checks: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Per foreign key: rows with a key, NULL keys, and keys missing from the
    dimension (NULL keys are allowed and are not orphans).

    The fact is read once: ``stack`` gives a row per foreign key, counted by key
    value before the shuffle (which also absorbs NULLs and hot keys). Only those
    distinct values meet the dimensions' keys, in one join. A value without a
    match stands for the rows the anti join would return."""
    pairs = ", ".join(f"'{fk}', CAST({fk} AS BIGINT)" for fk, _, _, _ in checks)
    used = fact.selectExpr(f"stack({len(checks)}, {pairs}) AS (foreign_key, _k)") \
               .groupBy("foreign_key", "_k").agg(F.count(F.lit(1)).alias("_n"))
    known = _union([dim.select(F.lit(fk).alias("foreign_key"), F.col(key).cast("long").alias("_k"))
                    for fk, dim, key, _ in checks]).distinct().withColumn("_hit", F.lit(True))
    names = F.create_map(*[F.lit(x) for fk, _, _, name in checks for x in (fk, name)])
    n, is_null = F.col("_n"), F.col("_k").isNull()
    return used.join(known, ["foreign_key", "_k"], "left").groupBy("foreign_key").agg(
        F.sum(F.when(is_null, 0).otherwise(n)).alias("non_null_keys"),
        F.sum(F.when(is_null, n).otherwise(0)).alias("null_keys"),
        F.sum(F.when(~is_null & F.col("_hit").isNull(), n).otherwise(0)).alias("orphans")) \
        .withColumn("dimension", names[F.col("foreign_key")])


def orphan_rows(fact: DataFrame, dim: DataFrame, fk: str, dim_key: str) -> DataFrame:
    """The fact rows whose non-NULL key is missing from the dimension (JOIN-10)."""
    keys = dim.select(F.col(dim_key).alias("_dk"))
    return fact.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_dk"), "left_anti")


def key_uniqueness(dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("distinct_keys"))
               .select(F.lit(name).alias("dimension"), F.lit(key).alias("key_column"), "rows",
                       "distinct_keys", (F.col("rows") == F.col("distinct_keys")).alias("is_unique"))
             for name, (df, key) in dims.items()]
    return _union(parts)


def _tagged_union(first: DataFrame, second: DataFrame, cols1: list, cols2: list) -> DataFrame:
    return (first.select(F.lit(1).alias("_side"), *cols1)
                 .unionByName(second.select(F.lit(2).alias("_side"), *cols2)))


def row_reconciliation(source: DataFrame, target: DataFrame, source_name: str,
                       target_name: str) -> DataFrame:
    """Row counts of both tables from one pass over their union (DQ-3)."""
    both = _tagged_union(source, target, [], [])
    s = both.agg(F.count_if(F.col("_side") == 1).alias("source_rows"),
                 F.count_if(F.col("_side") == 2).alias("target_rows"))
    return s.select(F.lit(source_name).alias("source_table"), F.lit(target_name).alias("target_table"),
                    "source_rows", "target_rows",
                    (F.col("source_rows") - F.col("target_rows")).alias("difference"),
                    (F.col("source_rows") == F.col("target_rows")).alias("is_match"))


def measure_check(fact: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Recompute LineTotal for every row and count those off by >= tolerance."""
    expected = (F.col("OrderQty").cast("double") * F.col("UnitPrice").cast("double")
                * (F.lit(1.0) - F.col("UnitPriceDiscount").cast("double")))
    off = F.abs(expected - F.col("LineTotal").cast("double")) >= F.lit(tolerance)
    return fact.agg(F.count(F.lit(1)).alias("rows_checked"), F.count_if(off).alias("mismatches"))


def _pct_report(df: DataFrame, flags: dict[str, str]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.count_if(F.col(flag)).alias(name) for name, flag in flags.items()]
    out = df.agg(*aggs)
    for name in flags:
        out = out.withColumn(f"pct_{name}", safe_pct(F.col(name), F.col("total")))
    return out


def dq_customer(silver_customer: DataFrame) -> DataFrame:
    return _pct_report(silver_customer, {"valid_email": "_is_valid_email", "has_company": "_has_company"})


def dq_product(silver_product: DataFrame) -> DataFrame:
    return _pct_report(silver_product, {"active": "_is_active", "valid_pricing": "_has_valid_pricing"})


def dq_orders(silver_header: DataFrame) -> DataFrame:
    return _pct_report(silver_header, {"shipped": "_is_shipped", "overdue": "_is_overdue",
                                       "valid_amounts": "_has_valid_amounts"})


def business_metrics(fact: DataFrame) -> DataFrame:
    s = fact.agg(F.count_distinct("SalesOrderID").alias("total_orders"),
                 F.count(F.lit(1)).alias("total_lines"),
                 sum_money("LineTotal").alias("total_revenue"),
                 sum_money("LineProfit").alias("total_profit"))
    return s.withColumns({
        "profit_margin_pct": safe_pct(F.col("total_profit"), F.col("total_revenue")),
        "avg_order_value": F.try_divide(F.col("total_revenue").cast("double"),
                                        F.col("total_orders").cast("double")),
    })


def layer_profile(tables: dict[str, DataFrame], columns: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows, column count and number of '_' helper columns per table (DQ-8). ``columns``
    names the columns of tables that are only counted here, so that a frame with the same
    rows will do and no surrogate key is made to count them."""
    parts = []
    for name, df in tables.items():
        cols = (columns or {}).get(name, df.columns)
        helper = sum(1 for c in cols if c.startswith("_"))
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"))
                       .select(F.lit(name).alias("table_name"), "rows",
                               F.lit(len(cols)).alias("columns"), F.lit(helper).alias("quality_columns")))
    return _union(parts)


def calendar_check(dim_date: DataFrame) -> DataFrame:
    """Gaps and duplicates of a calendar (SPEC-4): a contiguous calendar has
    rows == distinct dates == days between first and last + 1."""
    s = dim_date.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("Date").alias("distinct_dates"),
                     F.min("Date").alias("first_date"), F.max("Date").alias("last_date"))
    expected = F.datediff("last_date", "first_date") + 1
    return s.select("rows", "distinct_dates", "first_date", "last_date",
                    expected.cast("bigint").alias("expected_days"),
                    (expected - F.col("distinct_dates")).cast("bigint").alias("missing_days"),
                    (F.col("rows") - F.col("distinct_dates")).alias("duplicate_rows"))


def revenue_reconciliation(source_lines: DataFrame, fact: DataFrame) -> DataFrame:
    """Revenue of the cleansed lines versus the star (SPEC-7), one pass."""
    both = _tagged_union(source_lines, fact, ["LineTotal"], ["LineTotal"])
    s = both.agg(F.sum(F.when(F.col("_side") == 1, F.col("LineTotal"))).cast("decimal(38,4)").alias("source_revenue"),
                 F.sum(F.when(F.col("_side") == 2, F.col("LineTotal"))).cast("decimal(38,4)").alias("star_revenue"))
    return s.withColumn("difference", (F.col("source_revenue") - F.col("star_revenue")).cast("decimal(38,4)"))


def _row_digest(df: DataFrame, columns: list[str]) -> Column:
    """128 bits of ``columns``: two 64-bit hashes, by the columns in either order. Hashes
    pass over NULLs, so which columns are NULL is hashed too."""
    nulls = F.concat(F.lit(""), *[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    return F.struct(F.xxhash64(nulls, *columns).alias("x"), F.xxhash64(*reversed(columns), nulls).alias("y"))


def table_diff(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of two builds of a table compared by key, NULL-safe (SPEC-12). What travels to
    its key is a digest of 128 bits a row; columns that one build has in another type are
    compared by value instead."""
    rest = [c for c in first.columns if c not in keys]
    alike = [c for c in rest if first.schema[c].dataType == second.schema[c].dataType
             and isinstance(first.schema[c].dataType, AtomicType)]
    whole = [c for c in rest if c not in alike]
    a, b = (df.select(*keys, F.struct(_row_digest(df, alike).alias("__digest"), *whole).alias(n)) for df, n in ((first, "_a"), (second, "_b")))
    has_a, has_b = F.col("_a").isNotNull(), F.col("_b").isNotNull()
    same = F.lit(True)
    for c in ["__digest", *whole]:
        same = same & F.col("_a")[c].eqNullSafe(F.col("_b")[c])
    return a.join(b, keys, "full_outer").agg(
        F.count_if(has_a).alias("rows_first"), F.count_if(has_b).alias("rows_second"),
        F.count_if(~has_b).alias("only_in_first"), F.count_if(~has_a).alias("only_in_second"),
        F.count_if(has_a & has_b & ~same).alias("changed"))


def schema_check(tables: dict[str, DataFrame], expected: dict[str, StructType]) -> DataFrame:
    """Dry-run check of source schemas (SPEC-9): one row per expected or found
    column with its status (ok, type_mismatch, missing, unexpected) and its NULL
    count, so required-but-empty columns show up before any write. Each table is
    read once: one aggregate, turned into rows by ``stack``."""
    parts = []
    for name, want in expected.items():
        df = tables[name]
        have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        wanted = {f.name: f.dataType.simpleString() for f in want.fields}
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in have])
        rows = []
        for c in [*wanted, *[c for c in have if c not in wanted]]:
            status = ("missing" if c not in have else "unexpected" if c not in wanted
                      else "ok" if have[c] == wanted[c] else "type_mismatch")
            text = [f"'{x}'" if x is not None else "CAST(NULL AS STRING)"
                    for x in (name, c, wanted.get(c), have.get(c), status)]
            rows.append(", ".join([*text, f"`{c}`" if c in have else "CAST(NULL AS BIGINT)"]))
        parts.append(counts.selectExpr(
            f"stack({len(rows)}, {', '.join(rows)}) AS (table_name, column_name, expected_type, actual_type, status, null_count)"))
    return _union(parts)

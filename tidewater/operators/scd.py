"""SCD columns (GLD-6) and the SCD type 2 apply step (SPEC-3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.dedup import latest_by_key


def with_scd_columns(df: DataFrame, effective_date: Column) -> DataFrame:
    """IsCurrent = true, EffectiveDate = load date, EndDate = NULL."""
    return df.withColumns({
        "IsCurrent": F.lit(True),
        "EffectiveDate": effective_date.cast("date"),
        "EndDate": F.lit(None).cast("date"),
    })


def _pairs(open_rows: DataFrame, incoming: DataFrame, natural_key: str, tracked: Sequence[str],
           load_date: Column) -> DataFrame:
    """Open rows after a batch, closed where they changed, and the rows it adds (flag
    ``added``): one full outer join pairs each open row with its incoming row and gives
    one or two rows. The batch is first reduced to one row per natural key."""
    tracked, cols = list(tracked), open_rows.columns
    attributes = [c for c in incoming.columns if c in cols]
    order = "ModifiedDate" if "ModifiedDate" in attributes else attributes[0]
    batch = latest_by_key(incoming.select(*attributes), [natural_key], order) if len(attributes) > 1 \
        else incoming.select(*attributes).distinct()
    old = open_rows.select(F.struct(*cols).alias("o"), F.col(natural_key).alias("_ok"))
    new = batch.select(F.struct(*attributes).alias("n"), F.col(natural_key).alias("_nk"))
    pairs = old.join(new, F.col("_ok") == F.col("_nk"), "full_outer")
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col("o")[c].eqNullSafe(F.col("n")[c])
    has_old, has_new = F.col("o").isNotNull(), F.col("n").isNotNull()
    changed = has_old & has_new & differs
    kept = F.struct(*[
        F.when(changed, {"IsCurrent": F.lit(False), "EndDate": load_date.cast("date")}[c]).otherwise(F.col("o")[c]).alias(c)
        if c in ("IsCurrent", "EndDate") else F.col("o")[c].alias(c) for c in cols])
    fresh_values = {"IsCurrent": F.lit(True), "EffectiveDate": load_date.cast("date")}
    added = F.struct(*[
        (fresh_values[c] if c in fresh_values else F.col("n")[c] if c in attributes else F.lit(None))
        .cast(open_rows.schema[c].dataType).alias(c) for c in cols])
    return pairs.select(F.explode(F.filter(F.array(
        F.struct(F.lit(False).alias("added"), F.when(has_old, kept).alias("r")),
        F.struct(F.lit(True).alias("added"), F.when(changed | ~has_old, added).alias("r"))),
        lambda x: x["r"].isNotNull())).alias("v")).select("v.added", "v.r.*")


def _numbered(rows: DataFrame, natural_key: str, surrogate_key: str, top: int) -> tuple[DataFrame, int]:
    """The added rows of ``_pairs`` with keys after ``top`` in natural-key order, and how
    many they are. They are written once (a checkpoint as large as what changed), so that
    neither numbering nor reading them joins the dimension again."""
    from tidewater.operators.keys import assign_sequential_key
    from tidewater.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(rows.sparkSession)
    kind, columns = rows.schema[surrogate_key].dataType, [c for c in rows.columns if c != "added"]
    added = rows.filter("added").select(columns).checkpoint(eager=True)
    numbered = assign_sequential_key(added, [natural_key], "_seq") \
        .withColumn(surrogate_key, (F.lit(int(top)) + F.col("_seq")).cast(kind))
    return numbered.select(columns), added.count()


def _is_open(natural_key: str) -> Column:
    """Rows that a batch can meet. Rows without a natural key meet none."""
    return F.coalesce(F.col("IsCurrent"), F.lit(False)) & F.col(natural_key).isNotNull()


def scd2_apply(current: DataFrame, incoming: DataFrame, natural_key: str,
               tracked: Sequence[str], load_date: Column, surrogate_key: str) -> DataFrame:
    """Return the next version of an SCD-2 dimension.

    * unchanged keys keep their row;
    * changed keys: the open row is closed (IsCurrent=false, EndDate=load date)
      and a new open row is added;
    * new keys get a new open row;
    * rows that are not open (IsCurrent false or NULL) stay as they are: history takes no
      part in the join, however long it is, and no shuffle moves it.

    Added rows are numbered after the current maximum, in natural-key order.
    """
    cols = current.columns
    rows = _pairs(current.filter(_is_open(natural_key)), incoming, natural_key, tracked, load_date)
    # The current maximum key (one scalar) crosses to the driver, nothing else.
    top = current.agg(F.max(surrogate_key)).first()[0] or 0
    numbered, _ = _numbered(rows, natural_key, surrogate_key, top)
    return current.filter(~_is_open(natural_key)).unionByName(rows.filter("NOT added").select(cols)) \
                  .unionByName(numbered.select(cols))


def scd2_step(open_rows: DataFrame, incoming: DataFrame, natural_key: str, tracked: Sequence[str],
              load_date: Column, surrogate_key: str, top: int) -> tuple[DataFrame, DataFrame, int]:
    """The same step for a dimension stored as open and closed versions apart:
    (open versions after the batch, versions it closed, versions it added). The closed
    ones stored before are neither read nor written. ``top``: largest key in use."""
    cols = open_rows.columns
    rows = _pairs(open_rows.filter(_is_open(natural_key)), incoming, natural_key, tracked, load_date)
    numbered, added = _numbered(rows, natural_key, surrogate_key, top)
    kept = rows.filter("NOT added").select(cols)
    open_next = open_rows.filter(~_is_open(natural_key)).unionByName(kept.filter("IsCurrent")).unionByName(numbered.select(cols))
    return open_next, kept.filter("NOT IsCurrent"), added

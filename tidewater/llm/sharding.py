"""Sharding by balanced label propagation; DataFrame operations only.

Documents with equal texts are linked. Linked documents start in place order: groups follow
each other, largest size class first, and running sums cut that order into shares, so
a small group starts whole and a group larger than a shard fills neighbouring shards. Then
documents move, round by round, towards the shard that holds most of their group, within
quotas: a shard takes in what it has room for and as much again as leaves it in the same
round, so opposite moves need no room at all. Rounds go on until nothing moves. Documents
without links have no preference and fill the shards up at the end, so counts are at most
one apart (law ``rows``).

What moves is a cell: a small group, or a part of a large one (a hash of the row; at most
``MOST_PARTS`` a group). Votes and moves are joins over these pre-aggregated rows, and no
key is hot. The driver sees one load per shard and one flow per pair of shards. Moves are
accepted by running sums inside hash buckets, each with its share of the flow. A cell moves
only to the shard where its group is strongest, which thereby only gets stronger; so every
cell moves a bounded number of times and rounds end. Numbering (surplus, slots) adds the
bucket's offset to the place inside the bucket.

Defined cases: a null text is an empty one, linked to empty texts; repeated rows and rows
without an id are documents with places of their own, told apart by a row number given
once, when they are staged; an empty table gives no rows. Groups are told apart by a 64-bit
hash, the length and the checksum of the text; a collision could only cost a better place,
never a row. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import join_groups, stage

GROUP = ["g", "size", "text_crc32"]
#: Parts of one group at most.
MOST_PARTS = 4096


def _bucket(*cols, buckets: int, salt: int) -> Column:
    return F.pmod(F.xxhash64(*cols, F.lit(salt)), F.lit(buckets))


def _loads(df: DataFrame, rows: str, shards: int) -> list[int]:
    found = {r[0]: int(r[1]) for r in df.groupBy("label").agg(F.expr(rows)).collect()}  # one row per shard
    return [found.get(s, 0) for s in range(shards)]


def _pick(values: list[int], by: str | Column = "label") -> Column:
    """The value of a row's shard, from one number per shard."""
    by = F.col(by) if isinstance(by, str) else by
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), by.cast("int") + 1)


def _running(df: DataFrame, keys: list[str], order: list, weight: str, name: str) -> DataFrame:
    """``name``: sum of ``weight`` over all rows before this one, by ``keys`` (few values, in
    order) and inside a key by ``order``: the key's offset and the sum inside."""
    totals = df.groupBy(*keys).agg(F.sum(weight).alias("__w"))
    before = totals.select(*keys, (F.sum("__w").over(Window.orderBy(*keys)) - F.col("__w")).alias("__off"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("__in", F.sum(weight).over(inside) - F.col(weight)).join(before, keys) \
        .withColumn(name, F.col("__off") + F.col("__in")).drop("__off", "__in")


def accepted(flows: list[list[int]], loads: list[int], quota: int) -> list[list[int]]:
    """Of what wants to move from one shard to another (``flows``), how much may: no shard
    ends above the quota, or above what it has if that is more. Inflows that are too much
    are cut in proportion, which lessens other shards' outflows, until all fits."""
    n = len(loads)
    take = [[float(x) for x in row] for row in flows]
    for _ in range(1000):
        over = False
        for t in range(n):
            inflow, outflow = sum(take[s][t] for s in range(n)), sum(take[t])
            excess = loads[t] + inflow - outflow - max(quota, loads[t])
            if excess > 1e-6 and inflow:
                over = True
                keep = max(0.0, inflow - excess) / inflow
                for s in range(n):
                    take[s][t] *= keep
        if not over:
            break
    return [[int(x + 1e-6) for x in row] for row in take]


def _round(cells: DataFrame, quota: int, shards: int, buckets: int, only_with_room: bool) -> DataFrame:
    """One propagation round: ``cells`` with the labels after it and ``moved``.
    ``only_with_room``: full shards are nobody's aim (groups whose best shard is full)."""
    loads = _loads(cells, "sum(n)", shards)
    votes = cells.groupBy(*GROUP, "label").agg(F.sum("n").alias("votes"))
    rank = F.struct("votes", F.xxhash64(*GROUP, "label").alias("tie"), "label")
    own = votes.select(*GROUP, "label", rank.alias("own"))
    room = [max(0, quota - x) for x in loads]
    aims = votes.filter(_pick(room) > 0) if only_with_room else votes
    best = aims.groupBy(*GROUP).agg(F.max(rank).alias("best"))
    asked = cells.join(own, [*GROUP, "label"]).join(best, GROUP, "left")
    wants = F.coalesce(F.col("best") > F.col("own"), F.lit(False))
    asked = stage(asked.select(*cells.columns, F.when(wants, F.col("best.label")).alias("target"),
                               _bucket(*GROUP, "part", buckets=buckets, salt=7).alias("b")), "asked")
    flows = [[0] * shards for _ in range(shards)]
    for r in asked.filter("target IS NOT NULL").groupBy("label", "target").agg(F.sum("n").alias("n")).collect():  # shards squared at most
        flows[r.label][r.target] = int(r.n)
    take = [x for row in accepted(flows, loads, quota) for x in row]
    pair = F.col("label") * shards + F.col("target")
    # what a bucket may move: its share of the flow, the rest going to the first buckets
    share = F.floor(_pick(take, pair) / buckets) + F.when(F.col("b") < F.pmod(_pick(take, pair), F.lit(buckets)), 1).otherwise(0)
    in_order = Window.partitionBy("label", "target", "b").orderBy(F.desc("n"), *GROUP, "part") \
        .rowsBetween(Window.unboundedPreceding, 0)
    moving = asked.filter("target IS NOT NULL").withColumn("run", F.sum("n").over(in_order))
    # a cell that starts within the share moves; what a shard takes too much is given back when the counts are evened out
    moving = moving.withColumn("moved", F.col("run") - F.col("n") < share)
    staying = asked.filter("target IS NULL").withColumn("moved", F.lit(False))
    return staying.unionByName(moving.drop("run")).select(
        *[c for c in cells.columns if c != "label"], F.when(F.col("moved"), F.col("target")).otherwise(F.col("label")).alias("label"), "moved")


def _numbered(df: DataFrame, keys: list[str], order: list, spread: Column, name: str) -> DataFrame:
    """Gapless number from 0 inside ``keys``: the offset of a row's bucket (``spread``) and
    its place in it."""
    df = df.withColumn("nb", spread)
    counts = df.groupBy(*keys, "nb").agg(F.count("*").alias("c"))
    before = counts.select(*keys, "nb", (F.sum("c").over(Window.partitionBy(*keys).orderBy("nb")) - F.col("c")).alias("off"))
    inside = F.row_number().over(Window.partitionBy(*keys, "nb").orderBy(*order)) - 1
    return df.withColumn("in", inside).join(before, [*keys, "nb"]) \
        .withColumn(name, F.col("off") + F.col("in")).drop("nb", "in", "off")


def _seeded(rows: DataFrame, shards: int, buckets: int, quota: int) -> DataFrame:
    """Cells (GROUP, part, n, label) of the linked rows in their first shards, each filled
    up to ``quota`` (or all alike, if linked rows alone are more)."""
    cells = stage(rows.filter("members IS NOT NULL").groupBy(*GROUP, "members", "part").agg(F.count("*").alias("n")), "cells")
    linked = int(cells.agg(F.sum("n")).first()[0] or 0)
    order = [F.desc("members"), *GROUP]
    groups = cells.select(*GROUP, "members").distinct() \
        .withColumn("class", -F.floor(F.log2("members")).cast("int")).withColumn("b", _bucket(*GROUP, buckets=buckets, salt=5))
    placed = _running(groups, ["class", "b"], order, "members", "start").select(*GROUP, "start")
    inside = Window.partitionBy(*GROUP).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("start") + F.sum("n").over(inside) - F.col("n") / 2
    width = max(linked / shards, quota, 1e-9)
    label = F.least(F.floor(middle / width), F.lit(shards - 1)).cast("int")
    return stage(cells.join(placed, GROUP).withColumn("label", label).drop("members", "start"), "cells")


def assign_shards(docs: DataFrame, shards: int = 8, part_rows: int = 20_000) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("g"))
    base = stage(rows.withColumn("row", F.monotonically_increasing_id()), "shard-docs")
    total = base.count()
    buckets = max(1, -(-total // part_rows))
    cell_rows = max(1, min(part_rows, total // (shards * 64)))
    groups = stage(base.groupBy(*GROUP).agg(F.count("*").alias("members")).filter("members > 1"), "groups")
    parts = F.least(F.ceil(F.col("members") / cell_rows), F.lit(MOST_PARTS))
    base = stage(join_groups(base, groups, GROUP, "members").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "row", F.lit(3)), F.coalesce(parts, F.lit(1)))), "shard-rows")

    cells = _seeded(base, shards, buckets, total // shards - cell_rows)  # a cell may stick out
    for only_with_room in (False, True):
        while True:
            after = stage(_round(cells, total // shards, shards, buckets, only_with_room), "cells")
            moved = after.filter("moved").limit(1).count()
            cells = after.drop("moved")
            if not moved:
                break

    own = _bucket("doc_id", "row", buckets=shards, salt=1).cast("int")
    linked = cells.select(*GROUP, "part", "label")
    placed = stage(base.join(linked, [*GROUP, "part"], "left").select(
        "doc_id", "row", *GROUP, "part", F.coalesce("label", own).alias("label"), F.col("label").isNotNull().alias("linked")), "placed")
    loads = _loads(placed, "count(*)", shards)
    goal = [total // shards + (s < total % shards) for s in range(shards)]
    surplus = [max(0, a - b) for a, b in zip(loads, goal)]
    lack = [max(0, b - a) for a, b in zip(loads, goal)]
    # the first `surplus` documents of a shard, unlinked ones first, go where rows are lacking;
    # linked ones go by group, so that few groups lose rows
    singles = _loads(placed.filter("NOT linked"), "count(*)", shards)
    spread = F.when(F.col("linked"), _bucket(*GROUP, "part", buckets=buckets, salt=11)) \
        .otherwise(_bucket("doc_id", "row", buckets=buckets, salt=11))
    ranked = _numbered(placed, ["label", "linked"], [*GROUP, "doc_id", "row"], spread, "rank") \
        .withColumn("rank", F.col("rank") + F.when(F.col("linked"), _pick(singles)).otherwise(0))
    pool = F.col("rank") + _pick([sum(surplus[:s]) for s in range(shards)])
    target = F.lit(None).cast("int")
    for s in range(shards - 1, -1, -1):
        target = F.when(pool < sum(lack[:s + 1]), s).otherwise(target)
    final = ranked.withColumn("shard", F.when(F.col("rank") < _pick(surplus), target).otherwise(F.col("label")).cast("int"))
    slots = _numbered(stage(final.select("doc_id", "row", *GROUP, "shard"), "sharded"), ["shard"], ["doc_id", *GROUP, "row"],
                      _bucket("doc_id", "row", buckets=buckets, salt=13), "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"))

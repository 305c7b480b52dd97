"""Exact deduplication against immutable snapshots screened by binary-fuse filters.

Documents arrive in batches. What a batch brings that no earlier one had becomes a
snapshot that never changes: a table of exact entries (digest, copies, first row)
and, for each bucket of its digests, one static binary-fuse filter of 8 bits a cell
(about 9 bits a digest, no digest of the snapshot is ever missed). Digests of the
next batch are grouped among themselves first, then screened by the filters of their
buckets. Only what passes is joined with the exact entries; the rest is known to be
new without a look at them.

Digests that occur more than once, in a batch or across batches, are suspects. Their
texts are read again and grouped by digest and text: equality of bytes decides, and
map-side aggregation sends each text once a task, however many copies there are. A
digest that stands for several texts (never seen with SHA-256) is dealt with by text.

Plan: one narrow staged row for each document; all shuffles carry digests, but for
the suspects' texts. Rows meet their group through ``join_groups``: hot groups are a
broadcast of at most 1,000 rows. Buckets hold about ``KEYS_PER_FILTER`` digests, and
a bucket that meets many more incoming digests is split by salt.

Defined cases: a null text is an empty one; texts are equal when equal after each run
of white space is one space; of equal texts the row with the smallest doc_id stays
(null last), and of rows equal in that too exactly one; an empty table gives no rows;
other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import broadcast_if_small, join_groups, stage

#: Digests in one filter, about; also the incoming digests screened by one task at once.
KEYS_PER_FILTER = 1 << 15
#: Largest segment of a filter, as a power of two.
SEGMENT_BITS = 18
FILTERS = "bucket int, seed long, segment int, segments int, cells binary"


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


class FuseFilter:
    """A static set of 64-bit keys in three segments a key. Keys are peeled in waves:
    a cell that only one remaining key touches is that key's own; cells are filled in
    the opposite order, so that the three cells of a key give its fingerprint."""

    def __init__(self, seed: int, segment: int, segments: int, cells: np.ndarray):
        self.seed, self.segment, self.segments, self.cells = seed, segment, segments, cells

    @staticmethod
    def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
        h = keys + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        return h ^ (h >> np.uint64(33))

    @staticmethod
    def _cells_of(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
        start = ((h >> np.uint64(32)) * np.uint64(segment * segments)) >> np.uint64(32)
        mask = np.uint64(segment - 1)
        return np.stack([start, (start + np.uint64(segment)) ^ ((h >> np.uint64(14)) & mask),
                         (start + np.uint64(2 * segment)) ^ (h & mask)]).astype(np.int64)

    @staticmethod
    def _fingerprints(h: np.ndarray) -> np.ndarray:
        return (h ^ (h >> np.uint64(32))).astype(np.uint8)

    @classmethod
    def of(cls, keys: np.ndarray, tries: int = 1000) -> FuseFilter:
        keys = np.unique(keys.astype(np.int64).view(np.uint64))
        n = len(keys)
        segment = 1 << min(SEGMENT_BITS, max(2, int(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
        room = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
        segments = max(1, math.ceil(room / segment) - 2)
        for seed in range(tries):
            h = cls._mixed(keys, seed)
            at = cls._cells_of(h, segment, segments)
            waves = cls._peel(at, (segments + 2) * segment)
            if waves is not None:
                break
        else:
            raise RuntimeError("no seed peels these keys")
        cells, prints = np.zeros((segments + 2) * segment, np.uint8), cls._fingerprints(h)
        for own, cell in reversed(waves):
            cells[cell] = prints[own] ^ np.bitwise_xor.reduce(cells[at[:, own]], axis=0)
        return cls(seed, segment, segments, cells)

    @staticmethod
    def _peel(at: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Waves of (keys, the cell of each); None if some keys cannot be peeled."""
        n = at.shape[1]
        touched = np.bincount(at.ravel(), minlength=size)
        owners = np.zeros(size, np.int64)  # sum of the remaining keys of a cell
        np.add.at(owners, at.ravel(), np.tile(np.arange(n), 3))
        waves, free, left = [], np.flatnonzero(touched == 1), n
        while len(free):
            own, first = np.unique(owners[free], return_index=True)
            waves.append((own, free[first]))
            left -= len(own)
            gone = at[:, own]
            np.subtract.at(touched, gone.ravel(), 1)
            np.subtract.at(owners, gone.ravel(), np.tile(own, 3))
            free = np.unique(gone.ravel()[touched[gone.ravel()] == 1])
        return None if left else waves

    def has(self, keys: np.ndarray) -> np.ndarray:
        """For each key whether it may be in the set (always for its members)."""
        h = self._mixed(keys.astype(np.int64).view(np.uint64), self.seed)
        cells = self.cells[self._cells_of(h, self.segment, self.segments)]
        return self._fingerprints(h) == np.bitwise_xor.reduce(cells, axis=0)


class Snapshot(NamedTuple):
    """An immutable set of texts. entries: digest, key, n, first; filters: one a bucket."""
    entries: DataFrame
    filters: DataFrame
    buckets: int


def _bucket(buckets: int) -> Column:
    return F.pmod("key", F.lit(buckets)).cast("int").alias("bucket")


def build_snapshot(entries: DataFrame) -> Snapshot:
    """The snapshot of staged ``entries`` (digest, key, n, first)."""
    buckets = max(1, -(-entries.count() // KEYS_PER_FILTER))

    def build(group: pa.Table) -> pa.Table:
        made = FuseFilter.of(group.column("key").to_numpy())
        return pa.table({"bucket": pa.array([group.column("bucket")[0].as_py()], pa.int32()),
                         "seed": pa.array([made.seed], pa.int64()), "segment": pa.array([made.segment], pa.int32()),
                         "segments": pa.array([made.segments], pa.int32()),
                         "cells": pa.array([made.cells.tobytes()], pa.binary())})

    filters = entries.select("key", _bucket(buckets)).groupBy("bucket").applyInArrow(build, FILTERS)
    return Snapshot(entries, stage(filters, "fuse-filters"), buckets)


def screen(incoming: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Those of ``incoming`` (digest, key; distinct) that the filters let through: all
    that the snapshot has and about one in 256 of the others."""
    salts = max(1, -(-incoming.count() // (snapshot.buckets * KEYS_PER_FILTER)))
    salt = F.pmod(F.shiftright("key", 40), F.lit(salts)).cast("int").alias("salt")

    def sift(group: pa.Table, found: pa.Table) -> pa.Table:
        if not group.num_rows or not found.num_rows:
            return group.select(["digest", "key"]).slice(0, 0)
        f = found.slice(0, 1).to_pylist()[0]
        one = FuseFilter(f["seed"], f["segment"], f["segments"], np.frombuffer(f["cells"], np.uint8))
        return group.select(["digest", "key"]).filter(pa.array(one.has(group.column("key").to_numpy())))

    left = incoming.select("digest", "key", _bucket(snapshot.buckets), salt)
    right = snapshot.filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.groupBy("bucket", "salt").cogroup(right.groupBy("bucket", "salt")).applyInArrow(sift, "digest binary, key long")


def deduplicate(docs: DataFrame, arrival: Column, arrivals: int, digest_bytes: int = 32) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.
    ``arrival``: the number, from 0, of the batch in which a row arrives.
    ``digest_bytes``: leading bytes of SHA-256 that are compared; texts decide anyway."""
    cut = F.substring("sha", 1, digest_bytes)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("t"),
                        arrival.cast("int").alias("arrival")).withColumn("sha", F.unhex(F.sha2("t", 256)))
    rows = stage(texts.select("doc_id", "arrival", "sha", cut.alias("digest"), F.xxhash64(cut).alias("key"),
                              F.monotonically_increasing_id().alias("row")), "digests")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")

    known: list[Snapshot] = []
    suspects, batches = [], []
    for number in range(arrivals):
        own = stage(rows.filter(F.col("arrival") == number).groupBy("digest", "key").agg(F.count("*").alias("n"), first), "batch")
        batches.append(own)
        suspects.append(own.filter("n > 1").select("digest"))
        fresh = own
        for old in known:
            passed = screen(own, old)
            met = stage(passed.join(old.entries.select("digest"), "digest", "left_semi").select("digest"), "met")
            suspects.append(met)
            fresh = fresh.join(met, "digest", "left_anti")
        if number < arrivals - 1:
            known.append(build_snapshot(stage(fresh, "entries") if known else own))

    several = suspects[0]
    for more in suspects[1:]:
        several = several.unionByName(more)
    several = stage(several.distinct(), "suspects")
    small = broadcast_if_small(several)

    # bytes decide: texts under one digest, each sent once a task
    alike = texts.select(cut.alias("digest"), "t").join(small, "digest", "left_semi").groupBy("digest", "t").count()
    mixed = stage(alike.groupBy("digest").count().filter("count > 1").select("digest"), "mixed-digests")

    entries = batches[0]
    for more in batches[1:]:
        entries = entries.unionByName(more)
    groups = stage(entries.join(several, "digest", "left_semi").join(mixed, "digest", "left_anti").groupBy("digest")
                   .agg(F.sum("n").alias("n"), F.min("first").alias("first")), "groups")
    if mixed.limit(1).count():
        odd = stage(texts.select("doc_id", "sha", "t", cut.alias("digest")).join(mixed, "digest", "left_semi")
                    .withColumn("row", F.monotonically_increasing_id()), "mixed-rows")
        by_text = stage(odd.groupBy("digest", "t").agg(F.count("*").alias("n"), first), "mixed-groups")
        placed = _placed(join_groups(odd, by_text, ["digest", "t"], "n"))
        rows = stage(rows.join(mixed, "digest", "left_anti"), "digests")
        return _placed(join_groups(rows, groups, ["digest"], "n")).unionByName(placed)
    return _placed(join_groups(rows, groups, ["digest"], "n"))


def _placed(joined: DataFrame) -> DataFrame:
    alone = F.col("first").isNull()
    return joined.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
                         F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                         (alone | (F.col("first.row") == F.col("row"))).alias("kept"),
                         F.lower(F.hex("sha")).alias("text_sha256"))

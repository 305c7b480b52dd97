"""SimHash near-duplicates by a self-join of a binary trie over fingerprints.

A fingerprint holds, bit by bit, what more than half of a text's shingle hashes
hold. Equal fingerprints are one trie leaf, so links are sought between distinct
fingerprints only. The trie is walked by pairs of nodes from the root: a pair
splits into its children's pairs, a differing bit is added to the pair's count,
and pairs over the budget are cut off, with all below them.

Distribution: two fingerprints that differ in at most 2 bits agree on one of
three blocks of bits, and on one of three parts of the other bits. The nine
(block, part) patterns deal out every fingerprint nine times, and each group
(35 or more equal bits) is one sub-trie; a worker walks all sub-tries of its
partition together, level by level. It returns a spanning forest of the links,
one link a fingerprint at most, never all pairs. Components come from
``components`` over those links.

Defined cases: a null, empty or wordless text has fingerprint 0; fewer words than
a shingle are one shingle; rows with equal fingerprints are linked, repeated rows
too; ``component_id`` is the smallest non-null doc_id reachable (null if there is
none); an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import LOWER, giving_back, small_batches, stage
from tidewater.llm.components import component_roots

SEED = 42
CHUNK = 1 << 18   # hashes turned to bits at once
FRONTIER = 1 << 20  # node pairs held at once


def fingerprint(text: str | None, words: int = 3) -> int:
    import xxhash
    w = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not w:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    n = max(1, len(w) - words + 1)
    h = np.fromiter((digest(join(w[i:i + words]), SEED) for i in range(n)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = h[at:at + CHUNK]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, key: str | None = None) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number; with the column ``key`` also that."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            carried = [b.column(2)] if key else []
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), *carried], names=["doc_id", "fp", "key"][:2 + len(carried)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
                       *([F.col(key).alias("key")] if key else [])) \
        .mapInArrow(giving_back(run), "doc_id long, fp long" + (", key long" if key else ""))


def patterns(budget: int = 2) -> list[int]:
    """Bit masks: any two fingerprints within the budget agree on one of them."""
    def cut(bits: list[int]) -> list[list[int]]:
        k = budget + 1
        return [bits[i * len(bits) // k:(i + 1) * len(bits) // k] for i in range(k)]

    every = list(range(64))
    masks = []
    for block in cut(every):
        for part in cut([b for b in every if b not in block]):
            masks.append(sum(1 << b for b in block + part))
    return masks


def trie_links(fps: np.ndarray, groups: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of distinct fingerprints in the same group within the budget.
    ``fps`` is sorted inside each group and groups are contiguous; a group is the
    root of a sub-trie, a node is a range of its rows."""
    start = np.flatnonzero(np.diff(groups, prepend=groups[:1] - 1) != 0) if len(groups) else np.zeros(0, np.int64)
    end = np.append(start[1:], len(fps))
    big = end - start > 1
    start, end = start[big], end[big]
    ones = {}

    def ones_before(bit: int) -> np.ndarray:
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((fps >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        return ones[bit]

    left, right = [], []
    stack = [(63, np.stack([start, end, start, end, np.zeros_like(start)]))]
    while stack:
        bit, pairs = stack.pop()
        if pairs.shape[1] > FRONTIER:
            half = pairs.shape[1] // 2
            stack += [(bit, pairs[:, :half]), (bit, pairs[:, half:])]
            continue
        al, ah, bl, bh, err = pairs
        single = (ah - al == 1) & (bh - bl == 1)
        if single.any():
            i, j = al[single], bl[single]
            near = (i != j) & (np.bitwise_count(fps[i] ^ fps[j]) <= budget)
            left.append(i[near])
            right.append(j[near])
            al, ah, bl, bh, err = pairs[:, ~single]
        if not len(al) or bit < 0:
            continue
        count = ones_before(bit)
        am, bm = ah - (count[ah] - count[al]), bh - (count[bh] - count[bl])
        cross = al != bl  # a node paired with itself has one mixed pair of children only
        parts = [np.stack([al, am, bl, bm, err]), np.stack([am, ah, bm, bh, err]),
                 np.stack([al, am, bm, bh, err + 1]), np.stack([am, ah, bl, bm, err + 1])[:, cross]]
        child = np.concatenate(parts, axis=1)
        keep = (child[0] < child[1]) & (child[2] < child[3]) & (child[4] <= budget)
        keep &= ~((child[0] == child[2]) & (child[1] - child[0] == 1))
        if keep.any():
            stack.append((bit - 1, child[:, keep]))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def spanning_forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for nodes that are not the smallest."""
    low = np.arange(n)
    while len(a):
        m = np.minimum(low[a], low[b])
        np.minimum.at(low, low[a], m)
        np.minimum.at(low, low[b], m)
        while True:
            up = low[low]
            if (up == low).all():
                break
            low = up
        apart = low[a] != low[b]
        a, b = a[apart], b[apart]
    child = np.flatnonzero(low != np.arange(n))
    return child, low[child]


def fingerprint_links(distinct: DataFrame, budget: int = 2) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) within the budget."""
    masks = patterns(budget)
    dealt = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("pattern"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("same"))
        for k, m in enumerate(masks)])).alias("g")).select("g.pattern", "g.same", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()) for b in batches]
        if not held:
            return
        pattern, same, fp = (np.concatenate(c) for c in zip(*held))
        fp = fp.view(np.uint64)
        order = np.lexsort((fp, same, pattern))
        pattern, same, fp = pattern[order], same[order], fp[order]
        new = np.concatenate([[True], (np.diff(pattern) != 0) | (same[1:] != same[:-1])])
        a, b = trie_links(fp, np.cumsum(new), budget)
        child, root = spanning_forest(len(fp), a, b)
        for at in range(0, len(child), 100_000):
            cut = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(fp[child[cut]].view(np.int64)),
                                              pa.array(fp[root[cut]].view(np.int64))], names=["a", "b"])

    return dealt.repartition("pattern", "same").mapInArrow(giving_back(run), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 3, budget: int = 2, key: str | None = None) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``. With ``key``, a column that
    tells rows apart, also key and ``stays``: true for the first row of a component by
    doc_id (null last) and key, and for rows equal in both."""
    found = stage(fingerprints(docs, words, key), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key") if key else F.col("doc_id")
    distinct = stage(found.groupBy("fp").agg(F.min(row).alias("low")), "distinct-fp")
    roots = component_roots(fingerprint_links(distinct, budget))
    linked = distinct.join(roots, distinct.fp == roots.node, "left") \
        .select("fp", "low", F.coalesce("root", "fp").alias("root"))
    ids = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    members = linked.join(ids, "root").select("fp", "component_id")
    out = found.join(members, "fp")
    if key:
        return out.select("doc_id", "fp", F.col("component_id.doc_id").alias("component_id"), "key",
                          row.eqNullSafe(F.col("component_id")).alias("stays"))
    return out.select("doc_id", "fp", "component_id")

"""Approximate nearest neighbours by a robust-pruned directed graph per shard.

Vectors are dealt to shards of about ``shard_rows`` by a hash of their id, so a
vector that a third of the rows share is spread evenly. A worker indexes the
distinct vectors of its shard: points are inserted in batches; a greedy beam
search from the medoid proposes neighbours; relaxed distance pruning (a candidate
goes if a kept neighbour is ``alpha`` times nearer to it than the point is) keeps
few but diverse edges; reverse edges are added and pruned alike. Queries follow
their shard's vectors in the same task, in batches, and are answered by beam
search; so memory holds one shard and one batch. The nearest of all shards win.

Every valid vector is indexed; nothing is sampled. Distances of what a beam finds
are computed again in double precision, and a distinct vector stands for its
``k`` + 1 smallest ids, which is all a result can hold.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part; vectors of different length are not compared; rows with
the query's own id are no candidates; a query id that repeats with another vector
is a query of its own; fewer than ``k`` candidates are all returned; an empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import spread, stage

FOUND = "query_id long, query_key long, vec_id long, score double"


class Graph:
    """A robust-pruned graph over the rows of ``points`` (distinct vectors)."""

    def __init__(self, points: np.ndarray, degree: int = 32, beam: int = 64, alpha: float = 1.2, batch: int = 256, seed: int = 7):
        # searched in single precision, unless that cannot hold the squares
        self.kind = np.float32 if np.abs(points).max(initial=0.0) <= 1e15 else np.float64
        self.x = self.held(points)
        self.n, self.degree, self.beam = len(points), degree, beam
        self.square = np.einsum("ij,ij->i", self.x, self.x)
        self.start = int(np.argmin(((self.x - self.x.mean(0)) ** 2).sum(1)))
        rng = np.random.default_rng(seed)
        self.edges = rng.integers(0, self.n, (self.n, degree)).astype(np.int64)
        for relax in (1.0, alpha):
            for part in np.array_split(rng.permutation(self.n), max(1, -(-self.n // batch))):
                self._insert(part, relax)

    def held(self, points: np.ndarray) -> np.ndarray:
        """Vectors as the graph compares them."""
        most = 1e15 if self.kind is np.float32 else 1e150
        return np.ascontiguousarray(np.clip(points, -most, most), self.kind)

    def _distances(self, q: np.ndarray, q2: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return q2[:, None] + self.square[ids] - 2 * np.einsum("bd,bkd->bk", q, self.x[ids])

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of all queries at once: nearest ids found (-1: none) and squared
        distances, nearest first."""
        b = len(q)
        q2 = np.einsum("ij,ij->i", q, q)
        seen = np.zeros((b, self.n), bool)
        seen[:, self.start] = True
        ids = np.full((b, beam), -1, np.int64)
        dist = np.full((b, beam), np.inf, self.kind)
        open_ = np.zeros((b, beam), bool)
        ids[:, 0], open_[:, 0] = self.start, True
        dist[:, 0] = self._distances(q, q2, ids[:, :1])[:, 0]
        active = np.arange(b)
        while len(active):
            first = np.argmax(open_[active], 1)
            node = ids[active, first]
            open_[active, first] = False
            near = self.edges[node]
            d = self._distances(q[active], q2[active], near)
            d[seen[active[:, None], near]] = np.inf
            order = np.argsort(near, 1, kind="stable")  # an id proposed twice counts once
            same = np.take_along_axis(near, order, 1)
            twice = np.zeros_like(same, bool)
            twice[:, 1:] = same[:, 1:] == same[:, :-1]
            back = np.empty_like(twice)
            np.put_along_axis(back, order, twice, 1)
            d[back] = np.inf
            seen[active[:, None], near] = True
            all_d = np.concatenate([dist[active], d], 1)
            all_i = np.concatenate([ids[active], near], 1)
            all_o = np.concatenate([open_[active], np.isfinite(d)], 1)
            top = np.argsort(all_d, 1, kind="stable")[:, :beam]
            dist[active] = np.take_along_axis(all_d, top, 1)
            ids[active] = np.where(np.isfinite(dist[active]), np.take_along_axis(all_i, top, 1), -1)
            open_[active] = np.take_along_axis(all_o, top, 1) & np.isfinite(dist[active])
            active = active[open_[active].any(1)]
        return ids, dist

    def _prune(self, points: np.ndarray, cand: np.ndarray, alpha: float) -> np.ndarray:
        """The diverse neighbours of each point among its candidates (-1: none)."""
        own = cand == points[:, None]
        bad = own | (cand < 0)
        order = np.argsort(cand, 1, kind="stable")
        s = np.take_along_axis(cand, order, 1)
        twice = np.zeros_like(bad)
        twice[:, 1:] = s[:, 1:] == s[:, :-1]
        back = np.empty_like(bad)
        np.put_along_axis(back, order, twice, 1)
        bad |= back
        safe = np.where(cand < 0, 0, cand)
        d = self._distances(self.x[points], self.square[points], safe)
        d[bad] = np.inf
        order = np.argsort(d, 1, kind="stable")
        safe, d = np.take_along_axis(safe, order, 1), np.take_along_axis(d, order, 1)
        v = self.x[safe]
        between = self.square[safe][:, :, None] + self.square[safe][:, None, :] - 2 * (v @ v.transpose(0, 2, 1))
        alive = np.isfinite(d)
        out = np.full((len(points), self.degree), -1, np.int64)
        rows = np.arange(len(points))
        for k in range(self.degree):
            some = alive.any(1)
            if not some.any():
                break
            pick = np.argmax(alive, 1)
            out[some, k] = safe[rows, pick][some]
            far = alpha * alpha * between[rows, pick] > d  # squared distances
            alive &= far
            alive[rows, pick] = False
        return out

    def _insert(self, part: np.ndarray, alpha: float) -> None:
        ids, _ = self.search(self.x[part], self.beam)
        kept = self._prune(part, np.concatenate([ids, self.edges[part]], 1), alpha)
        self._set(part, kept)
        # reverse edges: each target gets its new neighbours in one go
        source = np.repeat(part, self.degree)
        target = kept.ravel()
        real = target >= 0
        source, target = source[real], target[real]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        first = np.flatnonzero(np.diff(target, prepend=-1))
        size = np.diff(np.append(first, len(target)))
        for lo in range(0, len(first), 512):
            f, s = first[lo:lo + 512], size[lo:lo + 512]
            wide = int(s.max())
            cand = np.full((len(f), self.degree + wide), -1, np.int64)
            cand[:, :self.degree] = self.edges[target[f]]
            at = spread(f, s)
            cand[np.repeat(np.arange(len(f)), s), self.degree + (at - np.repeat(f, s))] = source[at]
            for piece in np.array_split(np.arange(len(f)), max(1, len(f) * wide // 20_000)):
                self._set(target[f[piece]], self._prune(target[f[piece]], cand[piece], alpha))

    def _set(self, points: np.ndarray, kept: np.ndarray) -> None:
        """Store neighbours; empty places repeat the first one."""
        self.edges[points] = np.where(kept < 0, np.where(kept[:, :1] < 0, self.start, kept[:, :1]), kept)


class ShardIndex:
    """Distinct vectors of a shard, their ids, and the graph over them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, **options):
        _, first, inverse = np.unique(np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel(),
                                      return_index=True, return_inverse=True)
        self.exact, self.k = vectors[first], k
        order = np.lexsort((ids, inverse))
        ids, inverse = ids[order], inverse[order]
        start = np.flatnonzero(np.diff(inverse, prepend=-1))
        size = np.minimum(np.diff(np.append(start, len(ids))), k + 1)
        self.ids, self.size = ids[spread(start, size)], size
        self.at = np.cumsum(size) - size
        self.graph = Graph(self.exact, **options)

    def query(self, ids: np.ndarray, keys: np.ndarray, vectors: np.ndarray, beam: int) -> pa.RecordBatch:
        found, _ = self.graph.search(self.graph.held(vectors), max(beam, self.k + 1))
        row, col = np.nonzero(found >= 0)
        point = found[row, col]
        diff = self.exact[point] - vectors[row]
        with np.errstate(over="ignore"):
            score = np.sqrt((diff * diff).sum(1))
        wide = ~np.isfinite(score)
        if wide.any():  # squares beyond the range of a double
            top = np.abs(diff[wide]).max(1)
            score[wide] = top * np.sqrt(((diff[wide] / top[:, None]) ** 2).sum(1))
        n = self.size[point]
        vec, row, score = self.ids[spread(self.at[point], n)], np.repeat(row, n), np.repeat(score, n)
        other = vec != ids[row]
        vec, row, score = vec[other], row[other], score[other]
        order = np.lexsort((vec, score, row))
        vec, row, score = vec[order], row[order], score[order]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        place = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        top = place < self.k
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[row[top]]), pa.array(keys[row[top]]), pa.array(vec[top]), pa.array(score[top])],
            names=["query_id", "query_key", "vec_id", "score"])


def _matrix(col: pa.Array, rows: np.ndarray, dim: int) -> np.ndarray:
    return col.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), dim)


def nearest(vectors: DataFrame, is_query: str = "pmod(vec_id, 100) = 0", k: int = 10, shard_rows: int = 8192,
            beam: int = 96, **options) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's nearest, nearest first.
    ``vectors``: vec_id, embedding; ``is_query`` is SQL over vec_id."""
    v = F.col("embedding")
    good = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding")).filter(
        "vec_id IS NOT NULL AND embedding IS NOT NULL AND exists(embedding, x -> x <> 0) "
        "AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    good = stage(good, "vectors")
    shards = max(1, -(-good.count() // shard_rows))
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    points = good.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"),
                         "vec_id", F.lit(0).cast("long").alias("query_key"), "embedding")
    asked = good.filter(is_query).withColumn("query_key", F.xxhash64("embedding")).dropDuplicates(["vec_id", "query_key"])
    asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"),
                         "vec_id", "query_key", "embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, index = None, {}, {}
        for b in batches:
            shard, kind, ids, keys = (b.column(i).to_numpy() for i in range(4))
            dims = b.column(4).value_lengths().to_numpy()
            border = np.flatnonzero((np.diff(shard, prepend=-1) != 0) | (np.diff(kind, prepend=-1) != 0))
            for a, z in zip(border, np.append(border[1:], len(shard))):
                if shard[a] != now:
                    now, held, index = shard[a], {}, {}
                for dim in np.unique(dims[a:z]).tolist():
                    rows = a + np.flatnonzero(dims[a:z] == dim)
                    m = _matrix(b.column(4), rows, dim)
                    if kind[a] == 0:
                        held.setdefault(dim, []).append((ids[rows], m))
                        continue
                    if dim in held:
                        parts = held.pop(dim)
                        index[dim] = ShardIndex(np.concatenate([i for i, _ in parts]), np.concatenate([x for _, x in parts]), k, **options)
                    if dim in index:
                        for c in range(0, len(rows), 256):
                            cut = slice(c, c + 256)
                            yield index[dim].query(ids[rows[cut]], keys[rows[cut]], m[cut], beam)

    dealt = points.unionByName(asked).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "kind")
    found = dealt.mapInArrow(run, FOUND)
    best = Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

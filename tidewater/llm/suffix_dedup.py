"""Removal of repeated substrings, exact, by hash-compared suffix sorting.

A byte goes if a ``length``-byte string covering it also starts earlier. Every
window of ``length`` bytes is assigned to one anchor: its smallest hashed k-mer,
the leftmost of equal ones. The anchor depends on the window's bytes alone, so
equal windows share the anchor's k-mer and its offset, and only suffixes around
the same k-mer need to be compared. Anchors are about 3 % of all bytes.

Steps (buckets, not documents, travel; their number follows the corpus size):

0. K-mers with many different contexts (the edges of a passage that very many
   documents share) are found: those with ``HOT_CONTEXTS`` in one worker's buffer.
   Their windows travel one by one, dealt out by the window's own hash, and the
   first of equal windows stays; so no bucket gathers such a k-mer. Which k-mers
   take this way changes no result.
1. Documents are read; prefix polynomial hashes give the k-mer hashes, anchors
   and a hash of each anchor's context (the bytes of all its windows). Contexts
   that repeat inside a worker's buffer are settled there: all but the first are
   removal spans, and only the first travels. This collapses groups of copies.
2. By k-mer: repeated contexts are settled as in 1. A k-mer left with one context
   is done; the others' first contexts are asked for, with their bytes.
3. Contexts are cut out of their documents and dealt out by k-mer. Their suffixes
   from the k-mer on are sorted by a merge sort whose comparisons find the common
   extension by binary search over prefix hashes, so a comparison takes
   logarithmic time. Neighbours' extensions are verified byte by byte. For each
   offset, windows that agree to the right (common extension) and to the left
   (prefix hash, verified byte by byte) form a class; all but its first go.
4. Spans are merged for each row and cut out of its text.

Hashes are 64-bit; steps 0 to 2 compare k-mer hash and context hash together.

Defined cases: null is an empty text; texts shorter than ``length`` stay whole;
rows with the same doc_id and the same text are one document, so neither is earlier
than the other; different texts with one doc_id are rows of their own, at equal
places in the order of a hash; rows without a doc_id are rows of their own too and
come after all others, at equal places in the order they were staged; very long texts
are hashed in chunks; an empty table gives no rows. Other columns are carried by
``remove_repeats`` and not read by ``repeat_digest``; internal columns are kept
apart in a struct, so names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import broadcast_if_small, giving_back, small_batches, spread, stage

LENGTH = 100
KMER = 32
CHUNK = 1 << 19           # window starts hashed at once
BUFFER = 12 << 20         # bytes of text whose anchors are settled together
BUCKET_BYTES = 24 << 20   # bytes of text behind a bucket
PORTION = 1 << 20         # bytes of contexts sorted, or compared, together
HOT_CONTEXTS = 256        # different contexts of a k-mer in a buffer that make its windows travel alone
HOT_KMERS = 1 << 20       # most k-mers that do, the ones with the most contexts (8 MB)
LAST = (1 << 63) - 1      # place of null doc_ids
U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
MIX = U(0xBF58476D1CE4E5B9)

ANCHOR = np.dtype([("kmer", "<u8"), ("context", "<u8"), ("doc", "<i8"), ("row", "<i8"), ("start", "<u4"), ("end", "<u4"), ("at", "<u4")])
REQUEST = np.dtype([("kmer", "<u8"), ("start", "<u4"), ("end", "<u4"), ("at", "<u4")])
SPAN = np.dtype([("doc", "<i8"), ("row", "<i8"), ("start", "<u4"), ("end", "<u4")])
BLOBS = "kind string, bucket int, data binary"

_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK + 4 * LENGTH)
        inverse = U(pow(int(BASE), -1, 1 << 64))
        _POWERS[:] = [np.cumprod(np.concatenate([[U(1)], np.full(size, b)])) for b in (BASE, inverse)]
    return _POWERS[0], _POWERS[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(29))
    h = h * MIX
    return h ^ (h >> U(32))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H[i]: polynomial hash of the first i bytes."""
    up, _ = powers(len(data) + 1)
    return np.concatenate([[U(0)], np.cumsum((data.astype(U) + U(1)) * up[:len(data)])])


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return (prefix[end] - prefix[start]) * down[start]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def anchors(raw: bytes, hot: np.ndarray | None = None) -> Iterator[tuple]:
    """(k-mer hash, context hash, context start, context end, k-mer place, alone) of all
    windows of a text, in chunks; a context holds one or more windows in a row.
    The windows of k-mers in ``hot`` (sorted) come one by one, with ``alone`` True."""
    data = np.frombuffer(raw, np.uint8)
    low = U((1 << 20) - 1)
    for first in range(0, len(data) - LENGTH + 1, CHUNK):
        part = data[first:first + CHUNK + LENGTH - 1]
        prefix = prefix_hashes(part)
        _, down = powers(len(part) + 1)
        n = len(part) - KMER + 1
        kmer = mixed((prefix[KMER:] - prefix[:-KMER]) * down[:n])
        best = sliding_min(kmer & ~low | np.arange(n, dtype=U), LENGTH - KMER + 1)
        at = (best & low).astype(np.int64)
        start = np.flatnonzero(np.diff(at, prepend=-1))
        end = np.append(start[1:], len(at)) - 1 + LENGTH
        at = at[start]
        if hot is not None and len(hot):
            place = np.minimum(np.searchsorted(hot, kmer[at]), len(hot) - 1)
            alone = hot[place] == kmer[at]
            n_windows = (end - start - LENGTH + 1)[alone]
            w = spread(start[alone], n_windows)
            if len(w):
                yield np.repeat(kmer[at[alone]], n_windows), mixed(range_hash(prefix, w, w + LENGTH)), w + first, w + first + LENGTH, w + first, True
            start, end, at = start[~alone], end[~alone], at[~alone]
        shape = ((at - start).astype(U) << U(32)) | (end - start).astype(U)
        context = mixed(range_hash(prefix, start, end) ^ (shape * MIX))
        yield kmer[at], context, start + first, end + first, at + first, False


def settle(rec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchor records sorted by k-mer and context: (firsts, spans of the others)."""
    rec = rec[np.lexsort((rec["row"], rec["at"], rec["doc"], rec["context"], rec["kmer"]))]
    new = np.ones(len(rec), bool)
    new[1:] = (rec["kmer"][1:] != rec["kmer"][:-1]) | (rec["context"][1:] != rec["context"][:-1])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(rec)), 0))
    later = np.zeros(len(rec), bool)
    for c in ("doc", "at", "row"):
        later |= rec[c] != rec[c][lead]
    gone = rec[later]
    spans = np.empty(len(gone), SPAN)
    for c in SPAN.names:
        spans[c] = gone[c]
    return rec[new], merge_spans(spans)


def merge_spans(spans: np.ndarray) -> np.ndarray:
    """Overlapping and touching spans of a row joined."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["start"], spans["row"], spans["doc"]))]
    new = np.ones(len(spans), bool)
    new[1:] = (spans["doc"][1:] != spans["doc"][:-1]) | (spans["row"][1:] != spans["row"][:-1])
    group = np.cumsum(new).astype(np.int64)
    reach = np.maximum.accumulate(spans["end"].astype(np.int64) + (group << 33)) - (group << 33)
    new[1:] |= spans["start"][1:] > reach[:-1]
    first = np.flatnonzero(new)
    out = spans[first].copy()
    out["end"] = reach[np.append(first[1:], len(spans)) - 1]
    return out


def hashed_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(keys.view(U) * BASE) % U(buckets)).astype(np.int32)


def row_bucket(rec: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a record's row; rows with one doc_id, or none, are dealt out too."""
    return hashed_bucket(rec["doc"].astype(U) ^ mixed(rec["row"].astype(U)), buckets)


def blobs(kind: str, rec: np.ndarray, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Records as one row per bucket."""
    if not len(rec):
        return
    order = np.argsort(bucket, kind="stable")
    rec, bucket = rec[order], bucket[order]
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    cuts = np.append(first, len(rec)).tolist()
    data = [rec[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
    yield pa.RecordBatch.from_arrays([pa.array([kind] * len(data)), pa.array(bucket[first], pa.int32()),
                                      pa.array(data, pa.binary())], names=["kind", "bucket", "data"])


def gathered(batches: Iterator[pa.RecordBatch]) -> dict[tuple[int, str], list[bytes]]:
    """The blobs of a partition by (bucket, kind)."""
    held: dict[tuple[int, str], list[bytes]] = {}
    for b in batches:
        for kind, bucket, data in zip(*(c.to_pylist() for c in b.columns)):
            held.setdefault((bucket, kind), []).append(data)
    return held


def emptied(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, str], list[bytes]]]:
    """The same one by one, each let go of before the next."""
    held = gathered(batches)
    while held:
        key = next(iter(held))
        yield key, held.pop(key)


def unpacked(parts: list[bytes], dtype: np.dtype) -> np.ndarray:
    """The records of the blobs, which are let go of."""
    data = b"".join(parts)
    parts.clear()
    return np.frombuffer(data, dtype)


def dealt(blobs_df: DataFrame, buckets: int) -> DataFrame:
    return blobs_df.repartitionById(buckets, F.col("bucket"))


def _buffers(batches: Iterator[pa.RecordBatch], hot: np.ndarray | None) -> Iterator[list[np.ndarray]]:
    """Anchor records of bounded portions of text: [contexts, windows that travel alone]."""
    held: list[list[np.ndarray]] = [[], []]
    size = 0
    none = np.zeros(0, ANCHOR)
    for b in batches:
        for doc, text, row in zip(*(b.column(k).to_pylist() for k in range(3))):
            raw = (text or "").encode("utf-8", "replace")
            for kmer, context, start, end, at, alone in anchors(raw, hot):
                rec = np.empty(len(at), ANCHOR)
                rec["kmer"], rec["context"], rec["doc"], rec["row"] = kmer, context, LAST if doc is None else doc, row
                rec["start"], rec["end"], rec["at"] = start, end, at
                held[alone].append(rec)
            size += len(raw)
            if size >= BUFFER:
                full = [np.concatenate([none, *h]) for h in held]
                held, size = [[], []], 0
                yield full
                del full
    if size:
        yield [np.concatenate([none, *h]) for h in held]


def hot_kmers(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of the k-mers with very many contexts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rec, _ in _buffers(batches, None):
            order = np.lexsort((rec["context"], rec["kmer"]))
            kmer, context = rec["kmer"][order], rec["context"][order]
            other = np.ones(len(rec), bool)
            other[1:] = (kmer[1:] != kmer[:-1]) | (context[1:] != context[:-1])
            kmer, n = np.unique(kmer[other], return_counts=True)
            many = n >= HOT_CONTEXTS
            yield pa.RecordBatch.from_arrays([pa.array(kmer[many].view(np.int64)), pa.array(n[many])], names=["kmer", "n"])

    found = docs.select("doc_id", "text", F.lit(0).alias("mark")).mapInArrow(giving_back(run), "kmer long, n long").groupBy("kmer").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "kmer").limit(HOT_KMERS).select("kmer").toArrow()
    return np.sort(found["kmer"].to_numpy().astype(np.int64).view(U))


def _scan_anchors(docs: DataFrame, buckets: int) -> DataFrame:
    hot = docs.sparkSession.sparkContext.broadcast(hot_kmers(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for contexts, windows in _buffers(batches, hot.value):
            for kind, rec, key in (("a", contexts, "kmer"), ("w", windows, "context")):
                firsts, spans = settle(rec)
                yield from blobs(kind, firsts, hashed_bucket(firsts[key].copy(), buckets))
                yield from blobs("s", spans, row_bucket(spans, buckets))

    return docs.mapInArrow(giving_back(run), BLOBS)


def _settle_buckets(found: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, kind), parts in emptied(batches):
            if kind == "s":
                spans = merge_spans(unpacked(parts, SPAN))
                yield from blobs("s", spans, np.full(len(spans), bucket, np.int32))
                continue
            firsts, spans = settle(unpacked(parts, ANCHOR))
            yield from blobs("s", spans, row_bucket(spans, buckets))
            if len(firsts) and kind == "a":  # sorted by k-mer
                new = np.concatenate([[True], firsts["kmer"][1:] != firsts["kmer"][:-1]])
                per = np.diff(np.append(np.flatnonzero(new), len(firsts)))
                asked = firsts[np.repeat(per > 1, per)]
                yield from blobs("r", asked, row_bucket(asked, buckets))

    return dealt(found, buckets).mapInArrow(giving_back(run), BLOBS)


def _by_document(rows: DataFrame, kind: str, dtype: np.dtype, buckets: int) -> DataFrame:
    """(doc, mark, data): one row per row of documents with its records, spans merged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in emptied(batches):
            rec = unpacked(parts, dtype)
            rec = merge_spans(rec) if dtype is SPAN else rec[np.lexsort((rec["row"], rec["doc"]))]
            if not len(rec):
                continue
            first = np.flatnonzero(np.concatenate([[True], (rec["doc"][1:] != rec["doc"][:-1]) | (rec["row"][1:] != rec["row"][:-1])]))
            docs, marks, cuts = rec["doc"][first], rec["row"][first], np.append(first, len(rec)).tolist()
            if dtype is ANCHOR:  # what a document is asked for
                asked = np.empty(len(rec), REQUEST)
                for c in REQUEST.names:
                    asked[c] = rec[c]
                rec = asked
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs), pa.array(marks), pa.array([rec[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())],
                names=["doc", "mark", "data"])

    return stage(dealt(rows.filter(F.col("kind") == kind), buckets).mapInArrow(giving_back(run), "doc long, mark long, data binary"),
                 f"by-document-{kind}")


def _cut_contexts(docs: DataFrame, asked: DataFrame, buckets: int) -> DataFrame:
    """Blobs of asked contexts with their bytes: records, then all bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            recs, texts = [], []
            for text, data, doc, row in zip(*(c.to_pylist() for c in b.columns)):
                raw = text.encode("utf-8", "replace")
                asked = np.frombuffer(data, REQUEST)
                rec = np.zeros(len(asked), ANCHOR)
                rec["doc"], rec["row"] = doc, row
                for c in REQUEST.names:
                    rec[c] = asked[c]
                recs.append(rec)
                texts += [raw[s:e] for s, e in zip(rec["start"].tolist(), rec["end"].tolist())]
            rec = np.concatenate(recs)
            if not len(rec):
                continue
            bucket = hashed_bucket(rec["kmer"].copy(), buckets)
            order = np.argsort(bucket, kind="stable")
            first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            cuts = np.append(first, len(rec)).tolist()
            data = [len(order[a:c]).to_bytes(4, "little") + rec[order[a:c]].tobytes()
                    + b"".join(texts[k] for k in order[a:c].tolist()) for a, c in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(["c"] * len(data)), pa.array(bucket[order][first], pa.int32()), pa.array(data, pa.binary())],
                names=["kind", "bucket", "data"])

    place = F.coalesce(docs.doc_id, F.lit(LAST))
    joined = docs.join(broadcast_if_small(asked, "data"), (place == asked.doc) & (docs.mark == asked.mark)) \
        .select("text", "data", "doc", asked.mark)
    return joined.mapInArrow(giving_back(run), BLOBS)


class Suffixes:
    """Suffixes of contexts from their k-mer on: common extensions by hash. Ranges stay
    inside a context, so powers are counted from its start and few are held."""

    def __init__(self, rec: np.ndarray, data: np.ndarray):
        size = (rec["end"] - rec["start"]).astype(np.int64)
        base = np.cumsum(size) - size
        self.left = (rec["at"] - rec["start"]).astype(np.int64)       # bytes before the k-mer
        self.right = (rec["end"] - rec["at"]).astype(np.int64)        # bytes from it on
        self.at = base + self.left                                    # place of the k-mer in data
        up, self.down = powers(int(size.max(initial=0)) + 1)
        self.data, self.prefix = data, np.zeros(len(data) + 1, U)
        np.cumsum((data.astype(U) + U(1)) * up[spread(np.zeros(len(size), np.int64), size)], out=self.prefix[1:])

    def _hash(self, at: np.ndarray, down: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (self.prefix[at + n] - self.prefix[at]) * down

    def left_hash(self, x: np.ndarray, n: int) -> np.ndarray:
        """Hash of the n bytes before the k-mer."""
        return self._hash(self.at[x] - n, self.down[self.left[x] - n], n)

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common prefix length of suffix pairs, by binary search over prefix hashes."""
        a, b, a_down, b_down = self.at[x], self.at[y], self.down[self.left[x]], self.down[self.left[y]]
        lo, hi = np.zeros(len(x), np.int64), np.minimum(self.right[x], self.right[y])
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            same = self._hash(a, a_down, mid) == self._hash(b, b_down, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Suffix x sorts before suffix y; equal ones by their number."""
        n = self.extension(x, y)
        xe, ye = n == self.right[x], n == self.right[y]
        cx = np.where(xe, -1, self.data[np.minimum(self.at[x] + n, len(self.data) - 1)].astype(np.int64))
        cy = np.where(ye, -1, self.data[np.minimum(self.at[y] + n, len(self.data) - 1)].astype(np.int64))
        return np.where(cx != cy, cx < cy, x < y)

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Merge sort of all suffixes inside their (contiguous) groups, all groups at
        once: an element moves by the number of its sibling run's elements before it."""
        n = len(group)
        order = np.arange(n)
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.append(first, n))
        base, length = np.repeat(first, size), np.repeat(size, size)
        run = 1
        while run < (size.max() if len(size) else 0):
            slot = np.arange(n) - base
            own = slot // (2 * run) * (2 * run)
            is_left = slot - own < run
            sib_lo = np.where(is_left, own + run, own)
            sib_hi = np.minimum(np.where(is_left, own + 2 * run, own + run), length)
            lo, hi = np.minimum(sib_lo, length), np.maximum(sib_hi, np.minimum(sib_lo, length))
            start = lo.copy()
            todo = np.flatnonzero(lo < hi)
            while len(todo):
                mid = (lo[todo] + hi[todo]) >> 1
                smaller = self.before(order[base[todo] + mid], order[todo])
                lo[todo] = np.where(smaller, mid + 1, lo[todo])
                hi[todo] = np.where(smaller, hi[todo], mid)
                todo = todo[lo[todo] < hi[todo]]
            inside = np.where(is_left, slot - own, slot - own - run)
            moved = np.empty_like(order)
            moved[base + own + inside + (lo - start)] = order
            order = moved
            run *= 2
        return order

    def equal_bytes(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Do the n bytes from data places a and b on agree? In bounded portions."""
        out = np.ones(len(a), bool)
        step = max(1, PORTION // LENGTH)
        for k in range(0, len(a), step):
            cut = slice(k, k + step)
            differs = self.data[spread(a[cut], n[cut])] != self.data[spread(b[cut], n[cut])]
            owner = np.repeat(np.arange(len(n[cut])), n[cut])
            out[k + owner[differs]] = False
        return out


def context_spans(rec: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Spans of windows that also start earlier, for contexts sorted by k-mer."""
    sfx = Suffixes(rec, data)
    order = sfx.sort(rec["kmer"])
    kmer = rec["kmer"][order]
    ext = np.full(len(rec), -1, np.int64)  # with the suffix before it; -1 at a group's start
    same = np.flatnonzero(kmer[1:] == kmer[:-1]) + 1
    ext[same] = sfx.extension(order[same - 1], order[same])
    wrong = ~sfx.equal_bytes(sfx.at[order[same - 1]], sfx.at[order[same]], ext[same])
    ext[same[wrong]] = 0  # a hash collision
    place = np.lexsort((rec["row"], rec["at"], rec["doc"]))
    step = np.ones(len(rec), np.int64)
    step[1:] = (rec["doc"][place][1:] != rec["doc"][place][:-1]) | (rec["at"][place][1:] != rec["at"][place][:-1]) \
        | (rec["row"][place][1:] != rec["row"][place][:-1])
    rank = np.empty(len(rec), np.int64)
    rank[place] = np.cumsum(step)
    rec_o, at, rank = rec[order], sfx.at[order], rank[order]
    most = (rec_o["at"] - rec_o["start"]).astype(np.int64)               # largest offset of a window
    least = np.maximum(0, LENGTH - (rec_o["end"] - rec_o["at"]).astype(np.int64))
    out = []
    for o in range(int(most.max()), -1, -1):
        block = np.cumsum(ext < LENGTH - o)
        mine = np.flatnonzero((least <= o) & (o <= most))
        sizes = np.bincount(block[mine], minlength=1) if len(mine) else np.zeros(1, np.int64)
        mine = mine[sizes[block[mine]] > 1]
        if not len(mine):
            continue
        left = sfx.left_hash(order[mine], o)
        by = np.lexsort((rank[mine], left, block[mine]))
        mine, left = mine[by], left[by]
        new = np.ones(len(mine), bool)
        new[1:] = (block[mine[1:]] != block[mine[:-1]]) | (left[1:] != left[:-1])
        lead = mine[np.maximum.accumulate(np.where(new, np.arange(len(mine)), 0))]
        hit = rank[lead] < rank[mine]
        mine, lead = mine[hit], lead[hit]
        good = sfx.equal_bytes(at[lead] - o, at[mine] - o, np.full(len(mine), o))
        mine = mine[good]
        spans = np.empty(len(mine), SPAN)
        spans["doc"], spans["row"], spans["start"] = rec_o["doc"][mine], rec_o["row"][mine], rec_o["at"][mine] - o
        spans["end"] = spans["start"] + LENGTH
        out.append(spans)
    return merge_spans(np.concatenate(out)) if out else np.zeros(0, SPAN)


def _sort_buckets(contexts: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in emptied(batches):
            recs, texts = [], []
            for p in parts:
                n = int.from_bytes(p[:4], "little")
                recs.append(np.frombuffer(p, ANCHOR, n, 4))
                texts.append(np.frombuffer(p, np.uint8, offset=4 + n * ANCHOR.itemsize))
            rec, data = np.concatenate(recs), np.concatenate(texts)
            del p, parts, recs, texts
            size = (rec["end"] - rec["start"]).astype(np.int64)
            start = np.cumsum(size) - size
            order = np.argsort(rec["kmer"], kind="stable")
            # whole k-mer groups at a time, so that the arrays stay small
            group = np.cumsum(np.concatenate([[False], np.diff(rec["kmer"][order].view(np.int64)) != 0]))
            cut = np.flatnonzero(np.diff((np.cumsum(size[order]) // PORTION)[np.searchsorted(group, group)], prepend=0))
            for part in np.split(order, cut):
                if len(part):
                    spans = context_spans(rec[part], data[spread(start[part], size[part])])
                    yield from blobs("s", spans, row_bucket(spans, buckets))

    return dealt(contexts, buckets).mapInArrow(giving_back(run), BLOBS)


def _keyed(docs: DataFrame) -> DataFrame:
    """(row, mark): the rows of ``docs`` as a struct, and what tells rows with one doc_id
    apart: a hash of the text, or for rows without an id a number (these are staged,
    so that the number is the same in every scan)."""
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    named = packed.withColumn("mark", F.xxhash64(F.coalesce(F.col("row.text"), F.lit(""))))
    no_id = F.col("row.doc_id").cast("long").isNull()
    nameless = packed.filter(no_id)
    if not nameless.limit(1).count():
        return named
    return named.filter(~no_id).unionByName(
        stage(nameless.withColumn("mark", F.monotonically_increasing_id()), "nameless"))


def repeat_spans(keyed: DataFrame) -> DataFrame:
    """(doc, mark, data): byte spans to remove of each row that has some, as packed
    records (``SPAN``). ``keyed``: see ``_keyed``; rows need doc_id (long) and text."""
    small_batches(keyed.sparkSession)
    texts = keyed.select(F.col("row.doc_id").cast("long").alias("doc_id"), F.coalesce("row.text", F.lit("")).alias("text"), "mark")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wide = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, min(wide, -(-total // (1 << 20))), -(-total // BUCKET_BYTES))
    settled = stage(_settle_buckets(_scan_anchors(texts, buckets), buckets), "settled")
    asked = _by_document(settled, "r", ANCHOR, buckets)
    sorted_out = _sort_buckets(_cut_contexts(texts, asked, buckets), buckets)
    spans = settled.filter("kind = 's'").unionByName(sorted_out)
    return _by_document(spans, "s", SPAN, buckets)


def _kept(raw: bytes, data: bytes | None) -> tuple[bytes, int]:
    if not data:
        return raw, 0
    spans = np.frombuffer(data, SPAN)
    parts, at = [], 0
    for s, e in zip(spans["start"].tolist(), spans["end"].tolist()):
        parts.append(raw[at:s])
        at = max(at, min(e, len(raw)))
    return b"".join([*parts, raw[at:]]), len(spans)


def repeat_digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    keyed = _keyed(docs)
    spans = repeat_spans(keyed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[], [], [], []]
            for text, data in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                raw = (text or "").encode("utf-8", "replace")
                kept, n = _kept(raw, data)
                for col, v in zip(cols, (len(raw), len(raw) - len(kept), n, hashlib.sha256(kept).hexdigest())):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    texts = keyed.select(F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").alias("text"), "mark")
    joined = texts.join(broadcast_if_small(spans, "data"),
                        (F.coalesce(texts.doc_id, F.lit(LAST)) == spans.doc) & (texts.mark == spans.mark), "left")
    return joined.select("doc_id", "text", "data").mapInArrow(
        giving_back(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``; bytes of a character
    cut in half go too. Same columns, same rows; null stays null."""
    keyed = _keyed(docs)
    spans = repeat_spans(keyed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = []
            for text, data in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                kept.append(text if text is None or not data
                            else _kept(text.encode("utf-8", "replace"), data)[0].decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.string())], names=["row", "text"])

    joined = keyed.join(broadcast_if_small(spans, "data"),
                        (F.coalesce(F.col("row.doc_id").cast("long"), F.lit(LAST)) == spans.doc) & (keyed.mark == spans.mark), "left")
    schema = joined.select("row", F.col("row.text").alias("text"))
    out = joined.select("row", F.col("row.text").alias("text"), "data").mapInArrow(giving_back(run), schema.schema)
    return out.select(*[F.col("text").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])

"""Token ids of whole documents in succinct files: a wavelet matrix per shard.

File format (one payload per shard, little-endian): magic, number of planes,
number of ids, block size; for each plane its number of zero bits; for each
block of each plane the length of its compressed bytes and the number of ones
before it; the blocks (zstd). A plane holds one bit of every id; each plane is
ordered by the bits of the planes before it, so ``access``, ``count`` (rank) and
``find`` (select) follow one id through the planes and touch one block of each.

Plan: documents are range-partitioned by ``doc_id`` (then checksum and place, so
that no id is too frequent for a partition) and sorted inside a
partition, encoded there, and cut into shards of about ``shard_ids`` ids at
document borders, so a shard is bounded and files are in ascending doc_id order.
The shard rows are Parquet with the payload as a binary column, so Spark writes,
lists and reads them on any store and recovers lost tasks. Positions come from
the sums of ids of the range partitions alone (one row each).

Defined cases: a null or empty text is the end id alone; null doc_ids come
first; repeated doc_ids are separate documents, ordered by their text's
checksum; an empty table gives no files and no rows. Other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import small_batches, stage
from tidewater.llm.tokens import encoder

MAGIC = b"WMX1"
BLOCK = 1 << 16  # bytes of a plane that are compressed together
SHARDS = "part long, shard long, n_ids long, doc_ids binary, nulls binary, lengths binary, payload binary"


def _width(ids: np.ndarray) -> int:
    return max(1, int(ids.max()).bit_length()) if len(ids) else 1


def build(ids: np.ndarray) -> bytes:
    """The file payload of a shard's ids."""
    import zstandard
    packer = zstandard.ZstdCompressor(level=3)
    planes = _width(ids)
    rest = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    zeros, table, blocks = [], [], []
    for k in range(planes - 1, -1, -1):
        bits = (rest >> rest.dtype.type(k)) & rest.dtype.type(1) != 0
        rest = np.concatenate([rest[np.flatnonzero(~bits)], rest[np.flatnonzero(bits)]])
        zeros.append(len(bits) - int(np.count_nonzero(bits)))
        raw = np.packbits(bits, bitorder="little")
        ones = 0
        for at in range(0, len(raw), BLOCK):
            part = raw[at:at + BLOCK]
            packed = packer.compress(part.tobytes())
            table.append((len(packed), ones))
            blocks.append(packed)
            ones += int(np.bitwise_count(part).sum(dtype=np.int64))
    head = MAGIC + struct.pack("<IQI", planes, len(ids), BLOCK)
    return b"".join([head, np.array(zeros, "<u8").tobytes(), np.array(table, "<u8").tobytes(), *blocks])


class WaveletMatrix:
    """Reads one payload; blocks are decompressed when touched."""

    def __init__(self, payload: bytes):
        self.raw = memoryview(payload)
        if bytes(self.raw[:4]) != MAGIC:
            raise ValueError("not a wavelet-matrix payload")
        self.planes, self.n, self.block = struct.unpack_from("<IQI", self.raw, 4)
        at = 20
        self.zeros = np.frombuffer(self.raw, "<u8", self.planes, at).astype(np.int64)
        at += 8 * self.planes
        self.per = -(-(-(-self.n // 8)) // self.block)
        table = np.frombuffer(self.raw, "<u8", 2 * self.planes * self.per, at).astype(np.int64).reshape(-1, 2)
        at += 16 * self.planes * self.per
        self.sizes, self.ones = table[:, 0], table[:, 1]
        self.offsets = at + np.cumsum(self.sizes) - self.sizes
        self._open: dict[int, np.ndarray] = {}

    def _bytes(self, plane: int, block: int) -> np.ndarray:
        k = plane * self.per + block
        if k not in self._open:
            import zstandard
            if len(self._open) >= 4 * self.planes:
                self._open.clear()
            at = int(self.offsets[k])
            raw = zstandard.ZstdDecompressor().decompress(bytes(self.raw[at:at + int(self.sizes[k])]))
            self._open[k] = np.frombuffer(raw, np.uint8)
        return self._open[k]

    def _bit(self, plane: int, i: int) -> int:
        b, r = divmod(i, 8 * self.block)
        return int(self._bytes(plane, b)[r >> 3]) >> (r & 7) & 1

    def _rank1(self, plane: int, i: int) -> int:
        """Ones of a plane before position i."""
        if i >= self.n:
            return int(self.n - self.zeros[plane])
        b, r = divmod(i, 8 * self.block)
        data = self._bytes(plane, b)
        full = int(np.bitwise_count(data[:r >> 3]).sum(dtype=np.int64))
        part = (int(data[r >> 3]) & ((1 << (r & 7)) - 1)).bit_count() if r & 7 else 0
        return int(self.ones[plane * self.per + b]) + full + part

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for p in range(self.planes):
            bit = self._bit(p, i)
            ones = self._rank1(p, i)
            i = int(self.zeros[p]) + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` before ``end`` lie after the last plane."""
        lo, hi = 0, min(end, self.n)
        for p in range(self.planes):
            a, b = self._rank1(p, lo), self._rank1(p, hi)
            if value >> (self.planes - 1 - p) & 1:
                lo, hi = int(self.zeros[p]) + a, int(self.zeros[p]) + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, value: int, end: int | None = None) -> int:
        """Occurrences of ``value`` before ``end`` (rank)."""
        if value < 0 or value >> self.planes:
            return 0
        lo, hi = self._range(value, self.n if end is None else end)
        return hi - lo

    def _select(self, plane: int, bit: int, j: int) -> int:
        """Position of the j-th (from 0) given bit of a plane."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self._rank1(plane, mid + 1)
            if (ones if bit else mid + 1 - ones) > j:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def find(self, value: int, j: int) -> int:
        """Position of the j-th occurrence of ``value``, from 0 (select); -1 if there is none."""
        if value < 0 or value >> self.planes:
            return -1
        lo, hi = self._range(value, self.n)
        if not 0 <= j < hi - lo:
            return -1
        at = lo + j
        for p in range(self.planes - 1, -1, -1):
            bit = value >> (self.planes - 1 - p) & 1
            at = self._select(p, bit, at - int(self.zeros[p]) if bit else at)
        return at

    def ids(self) -> np.ndarray:
        """Every id in order: the planes undone from the last to the first."""
        cur = np.zeros(self.n, np.uint16 if self.planes <= 16 else np.uint32)
        one = cur.dtype.type
        for p in range(self.planes - 1, -1, -1):
            parts = [self._bytes(p, b) for b in range(self.per)]
            raw = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
            bits = np.unpackbits(raw, count=self.n, bitorder="little").view(bool)
            z, up = int(self.zeros[p]), np.empty_like(cur)
            up[np.flatnonzero(~bits)] = cur[:z]
            up[np.flatnonzero(bits)] = cur[z:] | one(1 << (self.planes - 1 - p))
            cur = up
            self._open.clear()
        return cur


def write_shards(docs: DataFrame, tokenizer_path: str, end_id: int, shard_ids: int = 500_000,
                 path: str | None = None) -> DataFrame:
    """Encode every text and write the shard files; returns them reread. ``path``
    names the folder, the session's shared folder is used without one."""
    spark = docs.sparkSession
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        enc, part, shard = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        keys, ids, lengths, held = [], [], [], 0

        def row() -> pa.RecordBatch:
            flat, n = np.concatenate(ids), np.concatenate(lengths)
            named = np.array([k if k is not None else 0 for k in keys], "<i8")
            nulls = np.array([k is None for k in keys], np.uint8)
            cells = [part, shard, len(flat), named.tobytes(), nulls.tobytes(),
                     n.astype("<u4").tobytes(), build(flat)]
            kinds = [pa.int64()] * 3 + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, kinds)],
                                              names=["part", "shard", "n_ids", "doc_ids", "nulls", "lengths", "payload"])

        for b in batches:
            flat, n = enc.batch(b.column(1).to_pylist())
            ended, per, names = np.insert(flat, np.cumsum(n), np.uint32(end_id)), n + 1, b.column(0).to_pylist()
            ends, at = np.cumsum(per), 0
            while at < len(per):  # a shard ends with the document that fills it
                begun = int(ends[at] - per[at])
                to = min(len(per), at + 1 + int(np.searchsorted(ends[at:] - begun, shard_ids - held)))
                keys += names[at:to]
                ids.append(ended[begun:int(ends[to - 1])])
                lengths.append(per[at:to])
                held += int(ends[to - 1]) - begun
                at = to
                if held >= shard_ids:
                    yield row()
                    keys, ids, lengths, held, shard = [], [], [], 0, shard + 1
        if held:
            yield row()

    # ids that repeat or are null are split by their texts' checksums, and copies by their place in the input
    order = [F.col("doc_id").asc_nulls_first(), "__crc", "__at"]
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
                          F.crc32(F.col("text").cast("binary")).alias("__crc"), F.monotonically_increasing_id().alias("__at")) \
        .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    shards = ordered.mapInArrow(run, SHARDS)
    if path is None:
        return stage(shards, "token-shards")
    shards.write.parquet(path)
    return spark.read.schema(shards.schema).parquet(path)


def read_documents(shards: DataFrame) -> DataFrame:
    """Per document from the files alone: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids = WaveletMatrix(r["payload"]).ids().astype("<u4")
                n = np.frombuffer(r["lengths"], "<u4").astype(np.int64)
                ends = np.cumsum(n)
                crc = [zlib.crc32(ids[e - k:e].tobytes()) for e, k in zip(ends.tolist(), n.tolist())]
                nulls = np.frombuffer(r["nulls"], np.uint8).astype(bool)
                keys = pa.array(np.frombuffer(r["doc_ids"], "<i8"), pa.int64(), mask=nulls)
                same = [pa.array(np.full(len(n), r[c]), pa.int64()) for c in ("part", "shard")]
                yield pa.RecordBatch.from_arrays(
                    [*same, keys, pa.array(ends - n), pa.array(n), pa.array(crc, pa.int64())],
                    names=["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"])

    totals = shards.groupBy("part", "shard").agg(F.sum("n_ids").alias("n"))
    parts = totals.groupBy("part").agg(F.sum("n").alias("n"))
    before_part = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before_part"))
    inside = Window.partitionBy("part").orderBy("shard")
    before = totals.select("part", "shard", (F.sum("n").over(inside) - F.col("n")).alias("before_shard")) \
        .join(before_part, "part") \
        .select("part", "shard", (F.col("before_part") + F.col("before_shard")).alias("before"))
    spark = shards.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # a row is a whole shard
    rows = shards.mapInArrow(run, "part long, shard long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.join(before, ["part", "shard"]).select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")

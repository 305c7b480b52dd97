"""Best-fit packing of tokenised documents into sequences of fixed length.

Bounded-space online best-fit: a packer keeps a fixed number of open bins. A
bitset (one bit for each amount of free space) tells in one step which open bin
is the fullest that still takes the next piece. When all bins are open and none
takes the piece, the fullest bin closes first. A worker holds the open bins and
nothing else, so memory does not grow with the input.

Plan: texts are encoded where they are read; only a narrow row for each piece
(place in its document, length, checksum, ids on request) is written and dealt
out evenly, by a hash of its place in what was written, to packers of
``pieces_per_packer`` pieces; so ids that are null or repeated make no packer larger. A packer sorts by length, longest first, before it
feeds its bins, since best-fit loses least when long pieces come first.

Defined cases: a null or empty text is the end id alone; a null ``doc_id`` is a
document like any other; repeated rows are separate documents with the same id
(their pieces are packed on their own); an empty table gives no rows. Other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import giving_back, small_batches, stage
from tidewater.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def cut_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, keep_ids: bool = False,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of at most ``capacity`` ids; a document is its text's
    ids and ``end_id``. Only longer documents are cut."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for b in batches:
            ids, per = enc.batch(b.column(1).to_pylist())
            keys = b.column(0).to_pylist()
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            at = 0
            for key, n in zip(keys, per.tolist()):
                doc = np.append(ids[at:at + n], np.uint32(end_id)).astype("<u4")
                at += n
                for piece, start in enumerate(range(0, n + 1, capacity)):
                    raw = doc[start:start + capacity].tobytes()
                    for col, value in zip(out, (key, piece, start, len(raw) // 4, zlib.crc32(raw),
                                                raw if keep_ids else None)):
                        out[col].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["piece"], pa.int32()),
                 *[pa.array(out[c], pa.int64()) for c in ("start", "length", "ids_crc32")],
                 pa.array(out["ids"], pa.binary())], names=list(out))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(giving_back(run), PIECES)


class BestFit:
    """Open bins keyed by free space. ``place`` returns (bin, offset)."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.limit = capacity, open_bins
        self.free_set = 0                       # bit f: some open bin has f ids free
        self.bins: dict[int, list[int]] = {}    # free space -> its open bins
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        stack = self.bins[free]
        found = stack.pop()
        if not stack:
            self.free_set &= ~(1 << free)
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        fits = self.free_set >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            found = self._take(free)
        else:
            if self.open >= self.limit:         # the fullest closes first
                self._take((self.free_set & -self.free_set).bit_length() - 1)
            found, free = self.made, self.capacity
            self.made += 1
        left = free - length
        if left:
            self.bins.setdefault(left, []).append(found)
            self.free_set |= 1 << left
            self.open += 1
        return found, self.capacity - free


def pack(pieces: DataFrame, capacity: int, open_bins: int = 4096, pieces_per_packer: int = 400_000) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; gapless from 0 in each sequence."""
    staged = stage(pieces, "pieces")
    packers = max(1, -(-staged.count() // pieces_per_packer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 40
        fit = BestFit(capacity, open_bins)
        for b in batches:
            placed = [fit.place(n) for n in b.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([base + s for s, _ in placed], pa.int64()),
                 pa.array([o for _, o in placed], pa.int64())],
                names=[*b.schema.names, "sequence_id", "offset"])

    # by place in the staged table: rows that are equal in all columns are dealt apart too
    dealt = staged.withColumn("__at", F.monotonically_increasing_id()).repartition(packers, F.xxhash64("__at")).drop("__at")
    ordered = dealt.sortWithinPartitions(F.desc("length"), "doc_id", "piece")
    return ordered.mapInArrow(giving_back(run), PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 2048,
                   keep_ids: bool = False, **options) -> DataFrame:
    """Whole documents to packed sequences; with ``keep_ids`` each piece carries
    its ids (little-endian unsigned 32-bit), so a sequence is its pieces in
    order of ``offset``."""
    packed = pack(cut_pieces(docs, tokenizer_path, end_id, capacity, keep_ids), capacity, **options)
    return packed if keep_ids else packed.drop("ids")

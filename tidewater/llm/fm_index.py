"""Benchmark decontamination with an FM-index per training shard.

A task reads documents and fills shards of bounded size. A shard is the word
sequence of its documents over the benchmark's vocabulary, in which every other
word and every document border is a separator. Its suffixes are sorted (prefix
doubling), its Burrows-Wheeler transform is held in a wavelet matrix with
popcount ranks, and every 16th suffix position is sampled. All test windows are
searched backwards at once; the rows found are walked to the next sampled
position, which gives where each window occurs. Occurrences are merged into
removal spans for each document.

Nothing is shuffled: a document's result needs its own text and the benchmark.
The benchmark travels in blocks of at most ``block_bytes`` of text, the proven
bound of each broadcast; a larger benchmark means more blocks, each searched in
turn against an index of the same shard, never a larger block (unless one item
alone is longer).

Words: A-Z lower-cased, runs of ASCII digits, letters and non-ASCII bytes.
A window: ``window`` consecutive item words; a shorter item is one window.

Defined cases: null and empty texts have no words and are never hit; an item
without words, or with a null id, is ignored; items with the same id count
once; an empty benchmark hits nothing; an empty table gives no rows; repeated
rows are judged one by one; a text longer than a shard is indexed in pieces that
overlap by a window less one word. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import WORDS, giving_back, small_batches, spread

SAMPLE = 16
RESULT = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "items array<string>, spans array<struct<start:long,end:long>>")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(WORDS).split()


class Bits:
    """A bit plane with rank: popcounts of 64-bit words and their running sums."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        counts = np.bitwise_count(self.words)
        self.before = np.cumsum(counts, dtype=np.int64) - counts

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletRanks:
    """Occurrences of a symbol before a position, over the transform of a shard."""

    def __init__(self, symbols: np.ndarray, width: int):
        self.width, self.planes, self.zeros = width, [], []
        rest = symbols.astype(np.uint16 if width <= 16 else np.uint32)
        one = rest.dtype.type(1)
        for k in range(width - 1, -1, -1):
            bits = (rest >> rest.dtype.type(k)) & one != 0
            self.planes.append(Bits(bits))
            self.zeros.append(len(bits) - int(np.count_nonzero(bits)))
            rest = np.concatenate([rest[np.flatnonzero(~bits)], rest[np.flatnonzero(bits)]])

    def walk(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where position i ends up when the planes are followed by the symbol's bits."""
        for k, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            ones = plane.rank(i)
            i = np.where((symbol >> (self.width - 1 - k)) & 1, zeros + ones, i - ones)
        return i

    def access(self, i: np.ndarray) -> np.ndarray:
        value = np.zeros(len(i), np.int64)
        for plane, zeros in zip(self.planes, self.zeros):
            ones, bit = plane.rank(i), plane.get(i)
            i = np.where(bit, zeros + ones, i - ones)
            value = value << 1 | bit
        return value


def suffix_array(seq: np.ndarray, n_symbols: int) -> np.ndarray:
    """Order of all suffixes of ``seq``; each 0 is a separator unlike any other,
    the last entry is one. Prefix doubling over the groups still tied."""
    n = len(seq)
    seps = np.flatnonzero(seq == 0)
    words = np.flatnonzero(seq)
    kind = np.uint16 if n_symbols < 1 << 16 else np.uint32
    words = words[np.argsort(seq[words].astype(kind), kind="stable")]
    order = np.concatenate([seps, words])
    rank = np.empty(n, np.int64)
    rank[seps] = np.arange(len(seps))
    sorted_ids = seq[words]
    first = np.flatnonzero(np.diff(sorted_ids, prepend=-1) != 0)
    sizes = np.diff(np.append(first, len(words)))
    rank[words] = np.repeat(len(seps) + first, sizes)
    slots = spread(len(seps) + first[sizes > 1], sizes[sizes > 1])
    width = max(1, int(n).bit_length())
    assert 3 * width <= 63, "shard too large"
    h = 1
    while len(slots):
        p = order[slots]
        key = (rank[p] << 2 * width) | (rank[p + h] << width) | np.arange(len(p))
        key.sort()
        p = p[key & ((1 << width) - 1)]
        key >>= width
        order[slots] = p
        first = np.flatnonzero(np.diff(key, prepend=-1) != 0)
        sizes = np.diff(np.append(first, len(p)))
        rank[p] = np.repeat(slots[first], sizes)
        slots = slots[spread(first[sizes > 1], sizes[sizes > 1])]
        h *= 2
    return order


class FMIndex:
    """Backward search and locate over one shard's sequence."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        order = suffix_array(seq, n_symbols)
        self.ranks = WaveletRanks(seq[order - 1], max(1, int(n_symbols).bit_length()))
        counts = np.bincount(seq, minlength=n_symbols + 2)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        symbols = np.arange(n_symbols + 2, dtype=np.int64)
        self.base = self.first[:-1] - self.ranks.walk(symbols, np.zeros(len(symbols), np.int64))
        keep = (order % SAMPLE == 0) | (seq[order - 1] == 0)
        self.marked, self.samples = Bits(keep), order[keep]

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.base[symbol] + self.ranks.walk(symbol, row)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, first row, end row) of the patterns that occur."""
        alive = np.arange(len(patterns))
        last = patterns[:, -1]
        lo, hi = self.first[last], self.first[last + 1]
        for j in range(patterns.shape[1] - 2, -1, -1):
            keep = lo < hi
            alive, lo, hi = alive[keep], lo[keep], hi[keep]
            if not len(alive):
                break
            both = self.step(np.tile(patterns[alive, j], 2), np.concatenate([lo, hi]))
            lo, hi = both[:len(alive)], both[len(alive):]
        keep = lo < hi
        return alive[keep], lo[keep], hi[keep]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffix rows: walk back until a sampled one."""
        out, steps = np.empty(len(rows), np.int64), 0
        at, which = rows, np.arange(len(rows))
        while len(at):
            found = self.marked.get(at)
            out[which[found]] = self.samples[self.marked.rank(at[found])] + steps
            at, which, steps = at[~found], which[~found], steps + 1
            at = self.step(self.ranks.access(at), at)
        return out


class Phrases:
    """The test windows of a block of items: vocabulary, patterns by length, items by window."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        found: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            w = words_of(text)
            for i in range(max(1, len(w) - window + 1) if w else 0):
                found.setdefault(tuple(w[i:i + window]), set()).add(item)
        self.vocabulary = {w: k + 1 for k, w in enumerate(sorted({w for p in found for w in p}))}
        self.longest = max(map(len, found), default=0)
        self.groups: list[tuple[np.ndarray, list[set[str]]]] = []
        for n in sorted({len(p) for p in found}):
            same = sorted(p for p in found if len(p) == n)
            ids = np.array([[self.vocabulary[w] for w in p] for p in same], np.int64)
            self.groups.append((ids, [found[p] for p in same]))


def occurrences(seqs: list[np.ndarray], phrases: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray, int, list[set[str]]]]:
    """(positions, items' index, window length, items) over the joined pieces; a
    position counts one separator after each piece."""
    joined = np.concatenate([x for s in seqs for x in (s, np.zeros(1, s.dtype))])
    keep = (joined != 0) | (np.concatenate([[1], joined[:-1]]) != 0)
    keep[0] = keep[-1] = True
    origin = np.flatnonzero(keep)
    index = FMIndex(joined[origin].astype(np.int64), len(phrases.vocabulary))
    for patterns, items in phrases.groups:
        which, lo, hi = index.search(patterns)
        if len(which):
            rows = index.locate(spread(lo, hi - lo))
            yield origin[rows], np.repeat(which, hi - lo), patterns.shape[1], items


def _byte_spans(text: str, hit: np.ndarray) -> list[dict[str, int]]:
    """Byte ranges from the first to the last word of each run of hit words."""
    raw = np.frombuffer(text.encode("utf-8", "replace").translate(WORDS), np.uint8) != 32
    edge = np.diff(np.concatenate([[0], raw.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    run = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
    a, b = np.flatnonzero(run == 1), np.flatnonzero(run == -1)
    return [{"start": int(starts[i]), "end": int(ends[j - 1])} for i, j in zip(a, b)]


class Shard:
    """Documents in flight: pieces for the next index and hits found so far."""

    def __init__(self, blocks, max_words: int):
        self.blocks, self.max_words = blocks, max_words
        self.docs: list[tuple] = []  # (doc_id, text, number of words)
        self.pieces: list[tuple[int, int, list[bytes]]] = []
        self.held = 0
        self.hits: dict[int, list[tuple[int, int]]] = {}
        self.items: dict[int, set[str]] = {}

    def add(self, doc_id, text: str | None) -> None:
        w = words_of(text)
        overlap = max([b.value.longest for b in self.blocks], default=1) - 1
        number = len(self.docs)
        self.docs.append((doc_id, text, len(w)))
        at = 0
        while at < len(w):
            room = max(self.max_words - self.held, overlap + 1)
            if room < len(w) - at and self.held:
                self.search()
                continue
            self.pieces.append((number, at, w[at:at + room]))
            self.held += len(self.pieces[-1][2]) + 1
            if at + room >= len(w):
                break
            at += room - max(overlap, 0)

    def full(self) -> bool:
        return self.held >= self.max_words * 3 // 4 or len(self.docs) >= 20_000

    def search(self) -> None:
        lengths = np.array([len(p) + 1 for _, _, p in self.pieces], np.int64)
        starts = np.cumsum(lengths) - lengths
        for block in self.blocks if self.pieces else []:
            phrases = block.value
            get = phrases.vocabulary.get
            seqs = [np.fromiter(map(get, p, repeat(0)), np.int32, len(p)) for _, _, p in self.pieces]
            if not phrases.groups:
                continue
            for at, which, n, items in occurrences(seqs, phrases):
                piece = np.searchsorted(starts, at, "right") - 1
                for p, a, k in zip(piece.tolist(), at.tolist(), which.tolist()):
                    number, first, _ = self.pieces[p]
                    start = a - int(starts[p]) + first
                    self.hits.setdefault(number, []).append((start, start + n))
                    self.items.setdefault(number, set()).update(items[k])
        self.pieces, self.held = [], 0

    def rows(self) -> pa.RecordBatch:
        self.search()
        cols: list[list] = [[] for _ in range(8)]
        for number, (doc_id, text, n) in enumerate(self.docs):
            items, spans, n_hit = sorted(self.items.get(number, ())), [], 0
            if number in self.hits:
                edge = np.zeros(n + 1, np.int64)
                a, b = np.array(self.hits[number]).T
                np.add.at(edge, a, 1)
                np.add.at(edge, b, -1)
                hit = np.cumsum(edge)[:-1] > 0
                n_hit = int(np.count_nonzero(hit))
                spans = _byte_spans(text, hit)
            digest = hashlib.sha256(",".join(items).encode()).hexdigest()
            for col, value in zip(cols, (doc_id, n, n_hit, len(items), digest, n_hit > 0 and 20 * n_hit >= n, items, spans)):
                col.append(value)
        kinds = [pa.int64()] * 4 + [pa.string(), pa.bool_(), pa.list_(pa.string()),
                                    pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)


def benchmark_blocks(benchmark: DataFrame, window: int, block_bytes: int) -> list:
    """Broadcasts of the items' windows, one for each block of at most about ``block_bytes``."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("text")) \
        .filter("item IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-2 * total // block_bytes) if total > block_bytes else 1
    blocks = []
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) if n > 1 else items
        rows = sorted((r["item"], r["text"]) for r in part.toLocalIterator())
        blocks.append(spark.sparkContext.broadcast(Phrases(rows, window)))
    return blocks


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, shard_words: int = 500_000,
                       block_bytes: int = 32 << 20) -> DataFrame:
    """One row per document: counts, digest, verdict, the items hit and the
    removal spans (byte ranges of the text, end not included)."""
    if shard_words >= 1 << 20:
        raise ValueError("a shard holds fewer than 2^20 words")
    small_batches(docs.sparkSession)
    blocks = benchmark_blocks(benchmark, window, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(blocks, shard_words)
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                shard.add(doc_id, text)
                if shard.full():
                    yield shard.rows()
                    shard = Shard(blocks, shard_words)
        if shard.docs:
            yield shard.rows()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")) \
        .mapInArrow(giving_back(run), RESULT)


def cut_spans(text: str | None, spans) -> str | None:
    """A text without its removal spans."""
    if text is None or not spans:
        return text
    raw, out, at = text.encode("utf-8", "replace"), [], 0
    for s in sorted(spans, key=lambda s: s["start"]):
        out.append(raw[at:s["start"]])
        at = max(at, s["end"])
    return b"".join([*out, raw[at:]]).decode("utf-8", "replace")

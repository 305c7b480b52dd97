"""Toxic passages: maximum-scoring segments over token log-odds.

Tokens are words and get the log-odds of toxic against clean documents under
Dirichlet priors: a word's prior is the rate of its 7-byte prefix, whose prior
is that of its 5-byte prefix, whose prior is the base rate, each worth
``strength`` documents. So an inflected form that was never seen borrows from its
stem. ``drift`` is taken off every token, so that chance runs stay short. A
document's tokens are scanned once (all maximal segments in linear
time); the best one is judged by the extreme-value law of clean documents' best
segments. The law depends on length: each class of lengths (doubling) has its own
place and scale, drawn towards those of all lengths where a class is small. So
the same segment means less in a long text, and tails of texts of any length can
be compared; a last step turns them into probabilities by labelled documents.

Labels are learnt from training rows only. For the calibration each of their four
folds is scored by the counts of the others, so no document is calibrated on
counts of its own; the final log-odds use all folds. Counts live in 2^20 hashed cells, the bound of
what is collected and broadcast; all training rows are counted.

Defined cases: null and empty texts have no tokens and get the score of a
document without any positive token; repeated rows are scored one by one; labels
repeated for a document are used once (the highest); without training rows, or
with one class only, every score is the base rate; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import WORDS, broadcast_if_small, small_batches

CELLS = 1 << 20
PREFIXES = (5, 7)
FOLDS = 4
BIN = 0.25  # width of a calibration bin
STEP = 0.4  # width of a bin of the standardised statistic
SHORT = 64  # texts of fewer words count as this long, so that few words are no evidence by themselves
LEVEL = 0.01  # tail probability below which a passage is significant
SHRINK = 200.0  # clean documents that the law of all lengths is worth in a class of lengths
SCORED = "doc_id long, score double, passages array<struct<start:int,end:int,score:double>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(WORDS).split()


def cells(word: bytes) -> list[int]:
    """Cells of a word's prefixes, shortest first, then of the word."""
    out = [zlib.crc32(word[:k], k) & (CELLS - 1) for k in PREFIXES if len(word) >= k]
    return out + [zlib.crc32(word, 1) & (CELLS - 1)]


class Odds:
    """Log-odds of words from the cells' counts of toxic and clean documents."""

    def __init__(self, toxic: np.ndarray, clean: np.ndarray, strength: float = 10.0, drift: float = 0.75,
                 max_cached: int = 400_000):
        self.toxic, self.clean = toxic, clean
        self.strength, self.drift, self.max_cached = strength, drift, max_cached
        total = float(toxic.sum()), float(clean.sum())
        self.base = total[0] / max(1.0, sum(total))
        self.known: dict[bytes, float] = {}

    def one(self, word: bytes) -> float:
        rate = self.base
        for c in cells(word):
            t = float(self.toxic[c])
            rate = (t + self.strength * rate) / (t + float(self.clean[c]) + self.strength)
        rate = min(max(rate, 1e-9), 1 - 1e-9)
        base = min(max(self.base, 1e-9), 1 - 1e-9)
        return float(np.log(rate / (1 - rate)) - np.log(base / (1 - base))) - self.drift

    def of(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.max_cached:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.one(w)
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))


def maximal_segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, sum), in order. Runs of positive
    tokens are candidates; a candidate joins back to the last one that began lower
    as long as that raises the sum. Each link is followed once."""
    up = np.concatenate([[0], (score > 0).view(np.int8), [0]])
    edge = np.diff(up)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(first):
        return []
    total = np.concatenate([[0.0], np.cumsum(score)])
    found: list[list] = []  # start, end, sum before start, sum at end, index of the last one that began lower
    for a, b, low, high in zip(first.tolist(), last.tolist(), total[first].tolist(), total[last].tolist()):
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= low:
                k = found[k][4]
            if k < 0 or found[k][3] >= high:
                found.append([a, b, low, high, k])
                break
            a, low = found[k][0], found[k][2]
            del found[k:]
    return [(a, b, high - low) for a, b, low, high, _ in found]


def train_counts(docs: DataFrame, labelled: DataFrame) -> np.ndarray:
    """Documents per cell: an array by fold and class. ``labelled``: label_id, toxic, fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Counter] = [Counter() for _ in range(2 * FOLDS)]

        def flush() -> Iterator[pa.RecordBatch]:
            for kind, words in enumerate(held):
                cell = [c for w in words for c in cells(w)]
                n = [k for w, k in words.items() for _ in cells(w)]
                if cell:
                    counts = np.bincount(np.array(cell), np.array(n), CELLS)
                    at = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)),
                         pa.array(counts[at].astype(np.int64))], names=["kind", "cell", "n"])
                words.clear()

        for b in batches:
            for text, toxic, fold in zip(*(c.to_pylist() for c in b.columns)):
                held[2 * fold + toxic].update(set(words_of(text)))
            if sum(map(len, held)) > 600_000:
                yield from flush()
        yield from flush()

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = ids.join(broadcast_if_small(labelled), ids.doc_id == labelled.label_id).select("text", "toxic", "fold")
    t = rows.mapInArrow(run, "kind int, cell int, n long").groupBy("kind", "cell").agg(F.sum("n").alias("n")).toArrow()
    kind, cell, n = (t[c].to_numpy() for c in ("kind", "cell", "n"))
    out = np.zeros((2 * FOLDS, CELLS), np.int32)
    out[kind, cell] = n
    return out.reshape(FOLDS, 2, CELLS)


def statistic(segments: list[tuple[int, int, float]], n_words: int) -> float:
    return max((s for _, _, s in segments), default=0.0) - float(np.log(max(n_words, SHORT)))


def isotonic(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Nondecreasing rate of toxic over the bins x (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for t, c in zip(toxic, clean):
        blocks.append([t, t + c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            t2, n2, k2 = blocks.pop()
            blocks[-1][0] += t2
            blocks[-1][1] += n2
            blocks[-1][2] += k2
    return np.concatenate([np.full(int(k), t / n) for t, n, k in blocks])


class Calibration:
    """Extreme-value law of clean documents by length class, and the probability of toxic
    by its tail. ``length``, ``at``: class and statistic of each bin."""

    def __init__(self, length: np.ndarray, at: np.ndarray, toxic: np.ndarray, clean: np.ndarray, base: float):
        self.base, self.usable = base, bool(toxic.sum() and clean.sum())
        self.laws: dict[int, tuple[float, float]] = {}
        if not self.usable:
            self.law = (0.0, 1.0)
            return
        whole = self._quartiles(at, clean)
        self.law = self._gumbel(*whole)
        for c in np.unique(length).tolist():
            mine = np.where(length == c, clean, 0.0)
            share = float(mine.sum()) / (float(mine.sum()) + SHRINK)
            if share:
                own = self._quartiles(at, mine)
                self.laws[c] = self._gumbel(*(share * x + (1 - share) * y for x, y in zip(own, whole)))
        z = np.array([self.standard(c, x) for c, x in zip(length.tolist(), at.tolist())])
        steps, where = np.unique(np.floor(z / STEP).astype(np.int64), return_inverse=True)
        self.rate = isotonic(steps, *(np.bincount(where, n, len(steps)) for n in (toxic, clean)))
        self.at = (steps + 0.5) * STEP

    @staticmethod
    def _quartiles(at: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
        """Median and distance of the quartiles: a few mislabelled documents don't move them."""
        where, which = np.unique(at[weight > 0], return_inverse=True)
        share = np.cumsum(np.bincount(which, weight[weight > 0])) / weight.sum()
        low, mid, high = np.interp([0.25, 0.5, 0.75], share, where)
        return float(mid), max(0.05, float(high - low))

    @staticmethod
    def _gumbel(median: float, spread: float) -> tuple[float, float]:
        """Place and scale of the Gumbel law with these quartiles: its quantile p is place - scale ln(-ln p)."""
        scale = spread / (np.log(-np.log(0.25)) - np.log(-np.log(0.75)))
        return median + scale * np.log(np.log(2.0)), scale

    def standard(self, length: int, x: float) -> float:
        place, scale = self.laws.get(length, self.law)
        return (x - place) / scale

    def tail(self, length: int, x: float) -> float:
        """Probability that a clean document of this length has so good a segment."""
        return float(-np.expm1(-np.exp(-self.standard(length, x))))

    def score(self, length: int, x: float) -> float:
        if not self.usable:
            return self.base
        return float(np.clip(np.interp(self.standard(length, x), self.at, self.rate), 0.0, 1.0))


def length_class(n_words: int) -> int:
    return int(max(n_words, SHORT)).bit_length()


def score_documents(docs: DataFrame, labels: DataFrame, train: str = "pmod(crc32(cast(doc_id AS string)), 3) <> 1",
                    strength: float = 10.0) -> DataFrame:
    """(doc_id, score, passages) for every row of ``docs``; a passage is a range of
    words. ``labels``: doc_id, toxic; ``train`` is SQL over its doc_id."""
    spark = docs.sparkSession
    small_batches(spark)
    labelled = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(train) \
        .groupBy(F.col("doc_id").cast("long").alias("label_id"), F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)).cast("int").alias("fold")) \
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic")).select("label_id", "toxic", "fold")
    found = train_counts(docs, labelled)
    counts = spark.sparkContext.broadcast(found)
    total = found.sum((0, 2), dtype=np.int64)
    base = float(total[1] / max(1, total.sum()))

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = counts.value
        every = v.sum(0)
        other = [Odds(every[1] - v[f, 1], every[0] - v[f, 0], strength, max_cached=100_000) for f in range(FOLDS)]
        seen: Counter = Counter()
        for b in batches:
            for text, toxic, fold in zip(*(x.to_pylist() for x in b.columns)):
                w = words_of(text)
                x = statistic(maximal_segments(other[fold].of(w)), len(w))
                seen[(length_class(len(w)), int(np.floor(x / BIN)), toxic)] += 1
        rows = [(c, k, n if t else 0, 0 if t else n) for (c, k, t), n in seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)],
                                         names=["length", "bin", "toxic", "clean"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = ids.join(broadcast_if_small(labelled), ids.doc_id == labelled.label_id).select("text", "toxic", "fold")
    bins = rows.mapInArrow(cross, "length long, bin long, toxic long, clean long").groupBy("length", "bin") \
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toArrow()  # classes of lengths times bins
    law = Calibration(bins["length"].to_numpy(), (bins["bin"].to_numpy() + 0.5) * BIN, bins["toxic"].to_numpy().astype(float),
                      bins["clean"].to_numpy().astype(float), base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = counts.value.sum(0)
        odds = Odds(every[1], every[0], strength)
        for b in batches:
            scores, passages = [], []
            for text in b.column(1).to_pylist():
                w = words_of(text)
                found = maximal_segments(odds.of(w))
                length, less = length_class(len(w)), float(np.log(max(len(w), SHORT)))
                scores.append(law.score(length, statistic(found, len(w))))
                passages.append([{"start": a, "end": e, "score": s} for a, e, s in found if law.tail(length, s - less) < LEVEL])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(passages, kind)],
                                             names=["doc_id", "score", "passages"])

    return ids.mapInArrow(run, SCORED)

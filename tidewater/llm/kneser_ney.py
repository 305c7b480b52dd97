"""Quality by perplexity under an interpolated modified Kneser-Ney model.

The model is over characters as they are (code points, nothing folded), order 4; below
its unigrams stands the uniform distribution over all code points, so no text is out of
vocabulary. Its tables grow with the trusted text and are never gathered: they are kept by
n-gram and by context and meet what is asked of them in joins.

Plan:
1. Texts are read once, with a flag from a table of labels for trusted documents, and
   packed into blocks: the compressed rows and the block's distinct n-grams, counted in
   its trusted texts. Documents fall into two halves by a hash of their id, a block holds
   one half, and each half has a model of its own: a document is scored by the other
   half's, so that trusted documents, which set the thresholds, are no more familiar to
   their model than any other document.
2. Lower orders count distinct left extensions of the order above. Discounts
   come from the counts of counts of each order. A join with its contexts gives each
   n-gram its discounted share and each context its back-off weight; a join with the
   order below gives its interpolated probability.
3. The distinct n-grams of all blocks look up their probability, order by order, in joins
   (unseen n-grams take the order below with the weight of their context); the answers
   go back to the blocks, whose texts are scored; a document gives a narrow row.
4. ln-perplexity is drawn towards its language's trusted mean as by
   ``prior_chars`` characters, so a short text is not judged by a few letters. A
   document is kept up to its language's ``quantile`` among trusted documents
   (of all languages together where a language has none).

``symbols``, ``codes``, ``fit`` and ``Model`` are a smaller model apart, over 64 folded
symbols with one dense table; ``judge`` does not use it.

Defined cases: null and empty texts have no n-grams and are kept, having nothing
against them; a null language is a language of its own; repeated rows are judged
one by one; without trusted documents all are kept and the threshold is null; an
empty table gives no rows. Labels repeated for a document count once. Other
columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import broadcast_if_small, give_back_memory, giving_back, small_batches, stage
from tidewater.session import ensure_checkpoint_dir

ORDER = 4
SYMBOLS = 64
BUFFER = 4 << 20  # symbols counted together

_TABLE: list[np.ndarray] = []


def symbol_table() -> np.ndarray:
    """Symbol of each code point below 2^16 in the folded model. 0 stands before a text."""
    if not _TABLE:
        out = np.empty(1 << 16, np.uint8)
        marks = ".,!?'-:;()"
        for cp in range(1 << 16):
            ch = chr(cp)
            if "a" <= ch <= "z":
                s = 1 + cp - 97
            elif ch.isupper():
                s = 27
            elif ch.isdigit():
                s = 28
            elif ch == " ":
                s = 29
            elif ch.isspace():
                s = 30
            elif ch in marks:
                s = 31 + marks.index(ch)
            elif cp < 128:
                s = 41
            else:
                s = 42 + cp % 21
            out[cp] = s
        _TABLE.append(out)
    return _TABLE[0]


def symbols(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    return symbol_table()[cp & np.uint32(0xFFFF)]


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """N-gram codes of all characters of the texts, 6 bits a symbol, and each text's length."""
    pad = np.zeros(ORDER - 1, np.uint8)
    parts = [symbols(t) for t in texts]
    n = np.array([len(p) for p in parts], np.int64)
    s = np.concatenate([x for p in parts for x in (pad, p)] or [pad]).astype(np.uint32)
    x = np.zeros(max(0, len(s) - ORDER + 1), np.uint32)
    for k in range(ORDER):
        x = x << np.uint32(6) | s[k:k + len(x)]
    # a text's own codes start where its padding starts; the ones over a border go
    real = np.ones(len(x), bool)
    ends = np.cumsum(n + ORDER - 1)[:-1]
    for k in range(1, ORDER):
        cut = ends - k
        real[cut[(cut >= 0) & (cut < len(x))]] = False
    return x[real], n


def count_ngrams(texts: DataFrame) -> DataFrame:
    """(half, code, n) of the highest order over the columns ``text`` and ``half``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], []]
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for half, parts in enumerate(held):
                if parts:
                    code, n = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(code), half, np.int32)), pa.array(code.astype(np.int64)),
                         pa.array(n.astype(np.int64))], names=["half", "code", "n"])
                parts.clear()

        for b in batches:
            rows = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            for half in (0, 1):
                x, _ = codes([t for t, h in rows if t and h == half])
                held[half].append(x)
                size += len(x)
            if size >= BUFFER:
                yield from flush()
                size = 0
        if size:
            yield from flush()

    return texts.select("text", "half").mapInArrow(run, "half int, code long, n long") \
        .groupBy("half", "code").agg(F.sum("n").alias("n"))


def level_tables(counts: DataFrame) -> list[DataFrame]:
    """For each order from 1: (half, code, share, context, backoff): an n-gram's
    discounted share of its context and the context's weight of the order below."""
    tables = [stage(counts, "ngrams")]
    for order in range(ORDER - 1, 0, -1):
        above = tables[-1]
        below = above.groupBy("half", F.col("code").bitwiseAND((1 << 6 * order) - 1).alias("code")) \
            .agg(F.count("*").alias("n"))
        tables.append(stage(below, "continuations"))
    out = []
    for table in reversed(tables):
        found = {r["half"]: r for r in table.groupBy("half").agg(
            *[F.sum((F.col("n") == k).cast("long")).alias(f"t{k}") for k in (1, 2, 3, 4)]).collect()}  # two rows
        discount = F.lit(0.5)
        for half, r in found.items():
            t = [max(1, r[f"t{k}"] or 0) for k in (1, 2, 3, 4)]
            y = t[0] / (t[0] + 2 * t[1])
            d = [min(max(k - (k + 1) * y * t[k] / t[k - 1], 0.01), k - 0.01) for k in (1, 2, 3)]
            mine = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
            discount = F.when(F.col("half") == half, mine).otherwise(discount)
        keyed = table.withColumn("context", F.shiftright("code", 6)).withColumn("discount", discount)
        contexts = keyed.groupBy("half", "context").agg(F.sum("n").alias("total"), F.sum("discount").alias("held"))
        out.append(keyed.join(contexts, ["half", "context"]).select(
            "half", "code", ((F.col("n") - F.col("discount")) / F.col("total")).alias("share"), "context",
            (F.col("held") / F.col("total")).alias("backoff")))
    return out


class Model:
    """The finished tables, at most SYMBOLS**order entries each."""

    def __init__(self, levels: list[tuple[np.ndarray, ...]]):
        self.levels = levels
        self._bits: np.ndarray | None = None

    def __getstate__(self):
        return self.levels

    def __setstate__(self, levels):
        self.levels, self._bits = levels, None

    def bits(self) -> np.ndarray:
        """-log2 p of every n-gram of the highest order."""
        if self._bits is None:
            p = np.full((1, SYMBOLS), 1 / SYMBOLS, np.float32)  # context by symbol
            for order, (code, share, context, backoff) in enumerate(self.levels, 1):
                weight = np.ones(SYMBOLS ** (order - 1), np.float32)
                weight[context] = backoff
                by_code = np.argsort(code)
                code, share = code[by_code], share[by_code]
                out = np.empty((len(weight), SYMBOLS), np.float16 if order == ORDER else np.float32)
                step = len(p)  # contexts that differ in their first symbol only share the order below
                for at in range(0, len(weight), step):
                    part = p * weight[at:at + step, None]
                    lo, hi = np.searchsorted(code, [at * SYMBOLS, (at + step) * SYMBOLS])
                    part.ravel()[code[lo:hi] - at * SYMBOLS] += share[lo:hi]
                    out[at:at + step] = -np.log2(part) if order == ORDER else part
                p = out
            self._bits = p.ravel()
        return self._bits

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(bits, characters) of each text."""
        x, n = codes(texts)
        total = np.concatenate([[0.0], np.cumsum(self.bits()[x], dtype=np.float64)])
        ends = np.cumsum(n)
        return total[ends] - total[ends - n], n


def fit(trusted: DataFrame) -> list[Model]:
    """The models of both halves of the trusted documents (columns text, half)."""
    levels: list[list[tuple[np.ndarray, ...]]] = [[], []]
    for table in level_tables(count_ngrams(trusted)):
        t = table.toArrow()
        half = t["half"].to_numpy()
        columns = [t[c].to_numpy() for c in ("code", "share", "context", "backoff")]
        kinds = (np.int64, np.float32, np.int64, np.float32)
        for h in (0, 1):
            levels[h].append(tuple(c[half == h].astype(k) for c, k in zip(columns, kinds)))
    return [Model(x) for x in levels]


#: Code points that a text can hold: the base distribution is uniform over them.
CHARACTERS = 0x110000
#: A symbol is a code point and one, 0 stands before a text; a context of three fits a long.
BITS = 21
BLOCK = 32 << 20  # characters of one half that are looked up together
CHUNK = 1 << 20  # characters held at a time


def block_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams of the texts as (context, symbol), for every character the
    place of its n-gram among them, and each text's length. Every character is itself."""
    parts = [np.frombuffer(t.encode("utf-32-le", "replace"), "<u4") for t in texts]
    n = np.array([len(p) for p in parts], np.int64)
    pad = np.zeros(ORDER - 1, np.int64)
    s = np.concatenate([x for p in parts for x in (pad, p + np.int64(1))] or [pad])
    used = np.bincount(s) > 0
    own = (np.cumsum(used) - 1)[s]  # the block's own alphabet
    count = max(0, len(s) - ORDER + 1)
    code, size, letters = own[:count], int(used.sum()), int(used.sum())
    for k in range(1, ORDER):
        if size * letters >= 1 << 63:
            seen, code = np.unique(code, return_inverse=True)
            size = len(seen)
        code, size = code * letters + own[k:k + count], size * letters
    real = np.ones(count, bool)  # n-grams over a border between texts go
    ends = np.cumsum(n + ORDER - 1)[:-1]
    for k in range(1, ORDER):
        real[ends - k] = False
    at = np.flatnonzero(real)
    place = pa.array(code[at]).dictionary_encode().indices.to_numpy()
    first = np.zeros(int(place.max(initial=-1)) + 1, np.int64)
    first[place] = at
    context = np.zeros(len(first), np.int64)
    for k in range(ORDER - 1):
        context = context << BITS | s[first + k]
    return context, s[first + ORDER - 1].astype(np.int32), place, n


def merged(grams: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(context, symbol, n) of several chunks, each n-gram once, in order."""
    context, symbol, n = (np.concatenate(x) for x in zip(*grams))
    order = np.lexsort((symbol, context))
    context, symbol = context[order], symbol[order]
    new = np.ones(len(context), bool)
    new[1:] = (context[1:] != context[:-1]) | (symbol[1:] != symbol[:-1])
    at = np.flatnonzero(new)
    return context[at], symbol[at], np.add.reduceat(n[order], at) if len(at) else n


class _Block:
    """A block that is being filled: its rows, compressed chunk by chunk, and its n-grams."""

    def __init__(self, schema: pa.Schema):
        self.sink = pa.BufferOutputStream()
        codec = pa.Codec("zstd", compression_level=6)
        self.out = pa.ipc.new_stream(self.sink, schema, options=pa.ipc.IpcWriteOptions(compression=codec))
        self.waiting: list[pa.RecordBatch] = []
        self.waiting_size = self.size = self.pending = 0
        self.grams: list[tuple[np.ndarray, ...]] = []

    def add(self, rows: pa.RecordBatch) -> None:
        size = (pc.sum(pc.utf8_length(rows.column("text"))).as_py() or 0) + 64 * rows.num_rows
        self.waiting.append(rows)
        self.size, self.waiting_size = self.size + size, self.waiting_size + size
        if self.waiting_size >= CHUNK:
            self.close_chunk()

    def close_chunk(self) -> None:
        rows = pa.Table.from_batches(self.waiting).combine_chunks()
        self.waiting, self.waiting_size = [], 0
        self.out.write_table(rows)
        context, symbol, place, n = block_grams([t or "" for t in rows["text"].to_pylist()])
        counted = place[np.repeat(rows["trusted"].to_numpy(), n)]
        self.grams.append((context, symbol, np.bincount(counted, minlength=len(context)).astype(np.int64)))
        self.pending += len(context)
        if self.pending > CHUNK:
            self.grams = [merged(self.grams)]
            self.pending = 0

    def row(self, block: int, half: int) -> pa.RecordBatch:
        if self.waiting:
            self.close_chunk()
        self.out.close()
        context, symbol, n = merged(self.grams)
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([half], pa.int32()), pa.array([self.sink.getvalue().to_pybytes()], pa.binary()),
             pa.array([context], pa.list_(pa.int64())), pa.array([symbol], pa.list_(pa.int32())),
             pa.array([n], pa.list_(pa.int64()))], names=["block", "half", "rows", "context", "symbol", "n"])


def pack_blocks(docs: DataFrame) -> str:
    """Rows of (doc_id, lang, text, half, trusted, key) packed by half into blocks: the rows
    themselves, compressed, and the block's distinct n-grams with their counts in its trusted
    texts. Written once, so that both uses see the same blocks, and as a table in buckets of
    the block (its name is returned), so that texts stay where they are when answers come."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Block] = {}
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            for half in (0, 1):
                mine = b.filter(pc.equal(b.column("half"), half))
                if not mine.num_rows:
                    continue
                block = held.setdefault(half, _Block(b.schema))
                block.add(mine)
                if block.size >= BLOCK:
                    yield held.pop(half).row(number, half)
                    number += 1
        for half in sorted(held):
            yield held.pop(half).row(number, half)
            number += 1

    spark = docs.sparkSession
    name = f"tidewater_blocks_{uuid.uuid4().hex}"
    docs.mapInArrow(giving_back(run), "block long, half int, rows binary, context array<long>, symbol array<int>, n array<long>") \
        .write.option("path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-staged/{name}").option("compression", "zstd") \
        .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").saveAsTable(name)
    return name


def _suffix(order: int) -> Column:
    """The context that an n-gram of ``order`` has within a longer one."""
    return F.col("context").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1))


def probability_tables(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1, over the counts (half, context, symbol, n) of the highest one:
    the n-grams (half, context, symbol, p) with their interpolated probability and the contexts
    (half, context, backoff) with the weight of the order below. Tables by n-gram and by
    context that grow with the trusted text; they meet in joins."""
    tables = [stage(counts, "ngrams")]
    for order in range(ORDER - 1, 0, -1):
        below = tables[-1].groupBy("half", _suffix(order).alias("context"), "symbol").agg(F.count("*").alias("n"))
        tables.append(stage(below, "continuations"))
    out: list[tuple[DataFrame, DataFrame]] = []
    for order, table in enumerate(reversed(tables), 1):
        found = table.groupBy("half").agg(  # two rows
            *[F.sum((F.col("n") == k).cast("long")).alias(f"t{k}") for k in (1, 2, 3, 4)]).collect()
        discount = F.lit(0.5)
        for r in found:
            t = [max(1, r[f"t{k}"] or 0) for k in (1, 2, 3, 4)]
            y = t[0] / (t[0] + 2 * t[1])
            d = [min(max(k - (k + 1) * y * t[k] / t[k - 1], 0.01), k - 0.01) for k in (1, 2, 3)]
            mine = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
            discount = F.when(F.col("half") == r["half"], mine).otherwise(discount)
        keyed = table.withColumn("discount", discount)
        contexts = stage(keyed.groupBy("half", "context").agg(F.sum("n").alias("total"), F.sum("discount").alias("held")), "contexts")
        shares = keyed.join(contexts, ["half", "context"]).select(
            "half", "context", "symbol", ((F.col("n") - F.col("discount")) / F.col("total")).alias("share"),
            (F.col("held") / F.col("total")).alias("backoff"))
        if order == 1:
            grams = shares.withColumn("below", F.lit(1 / CHARACTERS))
        else:
            lower = out[-1][0].select("half", F.col("context").alias("_suffix"), "symbol", F.col("p").alias("below"))
            grams = shares.withColumn("_suffix", _suffix(order - 1)).join(lower, ["half", "_suffix", "symbol"])
        grams = grams.select("half", "context", "symbol", (F.col("share") + F.col("backoff") * F.col("below")).alias("p"))
        out.append((stage(grams, "probabilities"),
                    contexts.select("half", "context", (F.col("held") / F.col("total")).alias("backoff"))))
    return out


def ngram_bits(asked: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``asked`` (half, context, symbol, each once) with ``bits``, -log2 p by that half's
    tables: of the longest n-gram that they have, with the weights of longer contexts."""
    p = F.lit(1 / CHARACTERS)
    for order, (grams, contexts) in enumerate(tables, 1):
        at = f"_at{order}"
        asked = asked.withColumn(at, _suffix(order)) \
            .join(grams.select("half", F.col("context").alias(at), "symbol", F.col("p").alias(f"_p{order}")), ["half", at, "symbol"], "left") \
            .join(contexts.select("half", F.col("context").alias(at), F.col("backoff").alias(f"_w{order}")), ["half", at], "left")
        p = F.coalesce(f"_p{order}", F.coalesce(f"_w{order}", F.lit(1.0)) * p)
    return asked.select("half", "context", "symbol", (-F.log2(p)).alias("bits"))


def score_blocks(blocks: DataFrame, tables: list[tuple[DataFrame, DataFrame]], carried: list[str]) -> DataFrame:
    """The rows of the blocks with n_chars and bits. A block's distinct n-grams go to the
    tables of the other half and come back to the block's texts."""
    asked = blocks.select(F.col("block").alias("to"), (1 - F.col("half")).alias("half"), F.explode(F.arrays_zip("context", "symbol")).alias("g")) \
        .select("to", "half", "g.context", "g.symbol")
    keys = ["half", "context", "symbol"]
    answers = asked.join(ngram_bits(asked.select(*keys).distinct(), tables), keys).select("to", "context", "symbol", "bits")

    def scored(packed: pa.Table, answer: pa.Table) -> pa.Table:
        known, symbol, bits = (answer[c].to_numpy() for c in ("context", "symbol", "bits"))
        contexts = np.unique(known)
        gram = np.searchsorted(contexts, known) << BITS | symbol
        order = np.argsort(gram)
        gram, bits = gram[order], bits[order]
        out = []
        for blob in packed["rows"].to_pylist():
            for rows in pa.ipc.open_stream(blob):
                context, symbol, place, n = block_grams([t or "" for t in rows.column("text").to_pylist()])
                mine = bits[np.searchsorted(gram, np.searchsorted(contexts, context) << BITS | symbol)]
                total = np.concatenate([[0.0], np.cumsum(mine[place])])
                ends = np.cumsum(n)
                out.append(pa.table([*[rows.column(c) for c in carried], pa.array(n), pa.array(total[ends] - total[ends - n])],
                                    names=[*carried, "n_chars", "bits"]))
        return pa.concat_tables(out)

    def run(packed: pa.Table, answer: pa.Table) -> pa.Table:
        out = scored(packed, answer)
        give_back_memory()
        return out

    kinds = {"doc_id": "long", "lang": "string", "trusted": "boolean", "key": "long"}
    return blocks.select("block", "rows").groupBy("block").cogroup(answers.groupBy("to")).applyInArrow(
        run, ", ".join(f"{c} {kinds[c]}" for c in carried) + ", n_chars long, bits double")


def judge(docs: DataFrame, labels: DataFrame, quantile: float = 0.995, prior_chars: int = 200,
          accuracy: int = 100_000, key: str | None = None) -> DataFrame:
    """One row per document: doc_id, lang, n_chars, ln_perplexity (null without
    characters), judged (drawn towards the mean), threshold, kept; then key, if
    ``key`` names a column (long) to be carried along.
    ``labels``: doc_id, quality; rows of quality 1 name the trusted documents."""
    spark = docs.sparkSession
    small_batches(spark)
    trusted = labels.filter("quality = 1").select(F.col("doc_id").cast("long").alias("trusted_id")).distinct()
    doc_id = F.col("doc_id").cast("long")
    carried = ["doc_id", "lang", "trusted", *(["key"] if key else [])]
    narrow = docs.select(doc_id.alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), "text",
                         F.pmod(F.xxhash64(doc_id), F.lit(2)).cast("int").alias("half"),
                         *([F.col(key).alias("key")] if key else []))
    packed = pack_blocks(narrow.join(broadcast_if_small(trusted), F.col("doc_id") == F.col("trusted_id"), "left")
                         .select("doc_id", "lang", F.col("trusted_id").isNotNull().alias("trusted"), "text", "half", *carried[3:]))
    blocks = spark.read.table(packed)
    counted = blocks.select("half", F.explode(F.arrays_zip("context", "symbol", "n")).alias("g")) \
        .filter("g.n > 0").groupBy("half", "g.context", "g.symbol").agg(F.sum("g.n").alias("n"))
    scored = stage(score_blocks(blocks, probability_tables(counted), carried), "perplexity")
    spark.sql(f"DROP TABLE {packed}")  # all scores are written; the files go with the other staged ones
    nats = F.col("bits") * float(np.log(2))
    flagged = scored.filter(F.col("trusted") & (F.col("n_chars") > 0))
    means = flagged.groupBy("lang").agg(F.sum(nats).alias("s"), F.sum("n_chars").alias("c"))
    overall = flagged.agg((F.sum(nats) / F.sum("n_chars")).alias("m")).first()["m"]
    means = broadcast_if_small(means.select("lang", (F.col("s") / F.col("c")).alias("mean")), "lang")

    def drawn(df: DataFrame) -> DataFrame:
        mean = F.coalesce("mean", F.lit(overall))
        return df.join(means, "lang", "left").withColumn(
            "judged", (nats + prior_chars * mean) / (F.col("n_chars") + prior_chars))

    base = drawn(flagged)
    top = F.percentile_approx("judged", quantile, accuracy)
    limits = base.groupBy("lang").agg(top.alias("threshold"))
    common = base.agg(top).first()[0]
    out = drawn(scored).join(broadcast_if_small(limits, "lang"), "lang", "left") \
        .withColumn("threshold", F.coalesce("threshold", F.lit(common)))
    kept = F.coalesce(F.col("judged") <= F.col("threshold"), F.lit(True)) | (F.col("n_chars") == 0)
    return out.select("doc_id", "lang", "n_chars",
                      F.when(F.col("n_chars") > 0, nats / F.col("n_chars")).alias("ln_perplexity"),
                      "judged", "threshold", kept.alias("kept"), *(["key"] if key else []))

"""Token, vector and sharding operators and the pipeline against brute force, with
edge rows: nulls, empty and long texts, ties, repeated rows, empty tables and
clashing extra columns."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import packing, sharding, vamana, wavelet
from tidewater.llm.tokens import SETTLED, ChunkEncoder, cut_chunks, encoder, vocabulary_path

from test_llm_text import clashing, frame, random_texts

PATH = vocabulary_path("word_bpe_49k.json")
HARD = [None, "", "  \n", "It's. we'll, x.'s ÉTÉ, Ça.   á.b", "<|endoftext|> A <|ENDOFTEXT|> b", "ΣΑΣ İ 日本語 ½ éá",
        "$$$ 12,3.4 a.b.c ...!!! a b c", "a,b , c.d . 'S 's", "ﬁ ǅ K", "x" * 5000]


@pytest.fixture(scope="module")
def tokenizer():
    return ChunkEncoder(PATH).tokenizer


def plain(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_chunked_ids_are_the_tokenizers(tokenizer, sf_small, spark):
    texts = HARD + [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect()]
    enc = ChunkEncoder(PATH, max_cached=500)  # evicts on the way
    for at in range(0, len(texts), 16):
        part = texts[at:at + 16]
        ids, per = enc.batch(part)
        assert [x.tolist() for x in np.split(ids, np.cumsum(per)[:-1])] == [plain(tokenizer, t) for t in part]
    assert encoder(PATH) is encoder(PATH)


def test_chunks_of_odd_neighbours_are_the_tokenizers(tokenizer):
    parts = [*"abzAZ09'.,-<>=|/%_ \t\n\x0b\x1c\x00\x7f", "'s", "'re", "'LL", "</w>", "<|", "<|endoftext|>", *SETTLED[::7],
             *"éÉß×÷ÿÀªºµ½٣ΣσςİıǅʹΩÅ…”’«日本語한\u0300\u0301\u0338\u20e3\u00a0\u0085\u2028\u200d\ufeff😀"]
    rng = np.random.default_rng(3)
    texts = ["".join(parts[k] for k in rng.integers(len(parts), size=rng.integers(1, 40))) for _ in range(2000)]
    texts += [f"a{a}{b}c" for a in parts for b in parts] + [f"é{a}{b}'s" for a in parts for b in parts]
    enc = ChunkEncoder(PATH, max_cached=3000)
    for at in range(0, len(texts), 500):
        part = texts[at:at + 500]
        ids, per = enc.batch(part)
        for text, got in zip(part, np.split(ids, np.cumsum(per)[:-1])):
            assert got.tolist() == plain(tokenizer, text), ascii(text)


def test_settled_letters_need_no_normalizing(tokenizer):
    words = [*SETTLED, *(a + b for a, b in zip(SETTLED, SETTLED[1:])), SETTLED]
    enc = ChunkEncoder(PATH)
    for w in words:
        assert enc.whole(w).tolist() == enc._ids(enc.settled_words, w).tolist(), ascii(w)
    assert "\u0374" not in SETTLED and "\u00c9" not in SETTLED and "\u00df" in SETTLED


def test_plain_words_skip_the_normalizer(tokenizer):
    texts = ["Over the hills", "über été, straße", "слово λόγος"]
    enc = ChunkEncoder(PATH)
    enc.batch([","])  # symbols pass the whole tokenizer once
    enc.tokenizer = None
    ids, per = enc.batch(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(per)[:-1])] == [plain(tokenizer, t) for t in texts]


def test_symbols_at_words_make_no_new_chunks():
    chunks, counts = cut_chunks([b"The (cat)'s%%% hat, cat", "été; cat= \u00d7; ".encode(), b"", b"x"])
    assert [c.decode() for c in chunks.to_pylist()] == ["the", "(", "cat", ")'s", "%%%", "hat", ",", "cat",
                                                        "été", ";", "cat", "=", "\u00d7;", "x"]
    assert counts.tolist() == [8, 5, 0, 1]


def test_equal_chunks_of_a_batch_are_looked_up_once(tokenizer):
    class Counted(dict):
        asked = 0

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)
    enc = ChunkEncoder(PATH)
    first = enc.batch(["one two one, two."] * 50)
    enc.code = type("C", (Counted, type(enc.code)), {})(enc.code)
    second = enc.batch(["one two one, two."] * 50)
    assert all((a == b).all() for a, b in zip(first, second)) and Counted.asked == 4


def test_wavelet_documents(spark, tokenizer):
    texts = HARD + random_texts(60, 1)
    ids = [*range(5, 5 + len(texts) - 3), None, 7, 7]
    rows = wavelet.read_documents(wavelet.write_shards(clashing(frame(spark, texts, ids=ids)), PATH, 1, shard_ids=300)).collect()
    assert len(rows) == len(texts)
    want = defaultdict(list)
    for i, t in zip(ids, texts):
        x = np.array([*plain(tokenizer, t), 1], "<u4")
        want[i].append((len(x), zlib.crc32(x.tobytes())))
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32))
    assert not any(want.values())
    order = [(-1 if r.doc_id is None else r.doc_id) for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order)
    assert wavelet.read_documents(wavelet.write_shards(frame(spark, []), PATH, 1)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 64, 5000])
def test_wavelet_matrix_round_trip(n):
    rng = np.random.default_rng(n)
    a = rng.zipf(1.4, n).clip(0, 70000).astype(np.uint32)
    w = wavelet.WaveletMatrix(wavelet.build(a))
    assert (w.ids() == a).all()
    for i in rng.integers(0, n, min(n, 20)).tolist():
        assert w.access(i) == a[i]
    for v in [*set(a[:5].tolist()), 69999, 1 << 20, -1]:
        at = np.flatnonzero(a == v)
        assert w.count(v) == len(at) and w.count(v, n // 2) == int((a[:n // 2] == v).sum())
        for j in {0, len(at) // 2, len(at) - 1, len(at)}:
            assert w.find(v, j) == (at[j] if 0 <= j < len(at) else -1)


def test_packing_places_every_piece(spark, tokenizer):
    texts = HARD + random_texts(80, 2) + ["w1 w2 w3 " * 3000]
    ids = [*range(len(texts) - 2), None, 3]
    rows = packing.pack_documents(clashing(frame(spark, texts, ids=ids)), PATH, 0, 256, keep_ids=True, open_bins=8, pieces_per_packer=60).collect()
    want = defaultdict(Counter)
    total = 0
    for i, t in zip(ids, texts):
        x = np.array([*plain(tokenizer, t), 0], "<u4")
        total += len(x)
        for p, s in enumerate(range(0, len(x), 256)):
            want[i][(p, s, len(x[s:s + 256]), zlib.crc32(x[s:s + 256].tobytes()), x[s:s + 256].tobytes())] += 1
    got = defaultdict(Counter)
    bins = defaultdict(list)
    for r in rows:
        got[r.doc_id][(r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids))] += 1
        bins[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for placed in bins.values():
        at = 0
        for o, n in sorted(placed):
            assert o == at
            at += n
        assert at <= 256
    assert len(bins) <= 1.2 * total / 256 + 8
    assert packing.pack_documents(frame(spark, []), PATH).count() == 0


def test_best_fit_takes_the_fullest_bin_and_closes_the_fullest():
    fit = packing.BestFit(10, 2)
    assert fit.place(4) == (0, 0) and fit.place(7) == (1, 0)
    assert fit.place(3) == (1, 7)          # the fullest that takes it
    assert fit.place(9) == (2, 0)          # two open: 0 (6 free), 2 (1 free)
    assert fit.place(8) == (3, 0)          # bin 2 closes
    assert fit.place(1) == (3, 8) and fit.place(6) == (0, 4)


def brute_nearest(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in good:
        if i % 100 == 0:
            d = sorted((float(np.sqrt(((np.float64(v) - np.float64(x)) ** 2).sum())), j) for j, x in good if j != i and len(x) == len(v))
            out[i] = d[:k]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.3 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(300)]  # one very common vector
    rows += [(5000, None), (5100, []), (5200, [0.0] * 16), (5300, [None] + [1.0] * 15), (5400, [float("nan")] + [1.0] * 15),
             (5500, [float("inf")] + [1.0] * 15), (None, [1.0] * 16), (5600, [1.0, 2.0]), (5601, [1.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("shard", F.lit("x")).withColumn("kind", F.lit(1))
    got = defaultdict(list)
    for r in vamana.nearest(df, shard_rows=400).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    want = brute_nearest(rows, 10)
    assert set(got) == {q for q, d in want.items() if d}
    hit = total = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(want[q]) + 1))
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        exact = {v: s for s, v in want[q]}
        hit += len(exact.keys() & {v for _, v, _ in found})
        total += len(exact)
        for _, v, s in found:
            assert v not in exact or abs(exact[v] - s) < 1e-12
    assert hit / total >= 0.9
    assert vamana.nearest(df.limit(0)).count() == 0
    one = spark.createDataFrame([(100, [1.0]), (7, [2.0]), (7, [2.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in vamana.nearest(one).collect()] == [(100, 1, 7, 1.0), (100, 2, 7, 1.0)]


def test_packing_and_shards_of_rows_without_an_id(spark, tokenizer):
    texts = ["the same text again"] * 1500
    docs = frame(spark, texts, ids=[None] * 1500).repartition(4)
    rows = packing.pack_documents(docs, PATH, 0, 64, pieces_per_packer=150).collect()
    packers = Counter(r.sequence_id >> 40 for r in rows)
    assert len(rows) == 1500 and len(packers) == 10 and max(packers.values()) <= 2 * 150
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = wavelet.write_shards(docs, PATH, 1, shard_ids=200)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    held = shards.collect()
    parts = Counter()
    for r in held:
        parts[r.part] += len(r.lengths) // 4
        assert r.n_ids < 200 + 10
    assert sum(parts.values()) == 1500 and max(parts.values()) <= 2 * 1500 / len(parts) and len(parts) > 4
    read = wavelet.read_documents(shards).collect()
    size = len(plain(tokenizer, texts[0])) + 1
    assert sorted(r.start for r in read) == [k * size for k in range(1500)]


def test_neighbours_of_doubles(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(300, 4)) * 1e-3)]
    rows += [(1000, [1e200, 0.0, 0.0, 0.0]), (1001, [1.5e200, 0.0, 0.0, 0.0]), (1002, [4e38, 1.0, 0.0, 0.0])]
    found = vamana.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=3, shard_rows=100).collect()
    by = {i: np.array(v) for i, v in rows}
    for r in found:
        if r.query_id < 1000 and r.vec_id < 1000:
            assert r.score == np.sqrt(((by[r.query_id] - by[r.vec_id]) ** 2).sum())
    first = {r.query_id: (r.vec_id, r.score) for r in found if r["rank"] == 1}
    assert first[1000] == (1001, 5e199)
    for q in (0, 100, 200):
        assert first[q][0] == min((i for i in range(300) if i != q), key=lambda i: ((by[i] - by[q]) ** 2).sum())


def check_shards(rows, texts, ids, shards=8):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts))
    counts = Counter(r.shard for r in rows)
    per = [counts[s] for s in range(shards)]
    assert sum(per) == len(texts) and max(per) - min(per) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(per[s]))
    groups = defaultdict(Counter)
    for r in rows:
        groups[(r.size, r.text_crc32)][r.shard] += 1
    return groups


def test_sharding_keeps_links_and_balance(spark):
    texts = [f"text {k}" for k in range(300)] + [f"copy {k % 20}" for k in range(100)] + [None, "", None]
    ids = [*range(len(texts) - 1), None]
    rows = sharding.assign_shards(clashing(frame(spark, texts, ids=ids))).collect()
    groups = check_shards(rows, texts, ids)
    assert all(len(g) == 1 for g in groups.values())  # nothing is cut when there is room


def test_sharding_spreads_a_group_larger_than_a_shard(spark):
    texts = ["hot"] * 400 + [f"s{k}" for k in range(400)]
    rows = sharding.assign_shards(frame(spark, texts), part_rows=100).collect()
    hot = max(check_shards(rows, texts, range(800)).values(), key=lambda g: sum(g.values()))
    random_kept = 8 * 50 * 49 // 2
    assert sum(n * (n - 1) // 2 for n in hot.values()) > 1.5 * random_kept


def test_sharding_cuts_no_pair_that_fits(spark):
    texts = [f"pair {k // 2}" for k in range(4000)]
    rows = sharding.assign_shards(frame(spark, texts)).collect()
    groups = check_shards(rows, texts, range(4000))
    assert len(groups) == 2000 and all(len(g) == 1 for g in groups.values())


def test_sharding_cuts_few_groups_of_mixed_sizes(spark):
    rng = np.random.default_rng(4)
    sizes = [*rng.integers(2, 12, 300), 150, 90, 60]
    texts = [f"group {k}" for k, n in enumerate(sizes) for _ in range(n)]
    texts += [f"single {k}" for k in range(100)]
    rows = sharding.assign_shards(frame(spark, texts)).collect()
    groups = check_shards(rows, texts, range(len(texts)))
    assert sum(len(g) > 1 for g in groups.values()) <= 3


def test_sharding_rows_without_an_id(spark):
    texts = ["hot"] * 900 + [f"s{k}" for k in range(700)]
    rows = sharding.assign_shards(frame(spark, texts, ids=[None] * 1600), part_rows=100).collect()
    hot = max(check_shards(rows, texts, [None] * 1600).values(), key=lambda g: sum(g.values()))
    assert len(hot) <= 6  # 900 rows need 5 shards of 200


def test_sharding_flows_swap_and_respect_quotas():
    assert sharding.accepted([[0, 5], [5, 0]], [10, 10], 10) == [[0, 5], [5, 0]]
    assert sharding.accepted([[0, 5], [0, 0]], [10, 10], 10) == [[0, 0], [0, 0]]
    assert sharding.accepted([[0, 5, 0], [0, 0, 5], [3, 0, 0]], [10, 10, 8], 10) == [[0, 5, 0], [0, 0, 5], [3, 0, 0]]


@pytest.mark.parametrize("n", [0, 1, 5])
def test_sharding_small_tables(spark, n):
    rows = sharding.assign_shards(frame(spark, ["x"] * n)).collect()
    if n:
        check_shards(rows, ["x"] * n, range(n))
    assert len(rows) == n


def test_sharding_runs_no_python(spark):
    plan = sharding.assign_shards(frame(spark, ["a", "a", "b"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline_stages_take_effect(spark, sf_small):
    import corpus_pipeline as P
    from tidewater.llm.common import stage
    from tidewater.llm.fm_index import find_contamination
    from tidewater.llm.simhash import near_duplicates
    from tidewater.llm.suffix_dedup import repeat_digest
    docs = clashing(spark.read.parquet(f"{sf_small}/documents.parquet"))
    columns, seen = docs.columns, {}
    for name, fn in P.STAGES:
        before = docs
        docs = stage(fn(spark, docs, sf_small), name)
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
            assert docs.count() == docs.select("doc_id").distinct().count() > 0
    before, after = seen["near_duplicate"]
    keep = {r.component_id for r in near_duplicates(before).collect()}
    assert {r.doc_id for r in after.collect()} == keep
    before, after = seen["repeated_text"]
    removed = {r.doc_id: r.n_removed for r in repeat_digest(before).collect()}
    old = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert (r.text == old[r.doc_id]) == (removed[r.doc_id] == 0) and r.n_chars == len(r.text)
    before, after = seen["decontaminate"]
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    bad = {r.doc_id for r in find_contamination(before, bench).collect() if r.contaminated}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - bad
    before, after = seen["packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}


def test_pipeline_repeated_ids_and_empty(spark, sf_small):
    import corpus_pipeline as P
    docs = frame(spark, ["a b c d e f", "a b c d e f", "q r s t u v", None], ids=[1, 1, 2, None])
    out = P.near_duplicate(spark, docs, sf_small).collect()
    assert sorted((r.doc_id or -1, r.text) for r in out) == [(-1, None), (1, "a b c d e f"), (2, "q r s t u v")]
    empty = frame(spark, [])
    for _, fn in P.STAGES:
        assert fn(spark, empty, sf_small).count() == 0


def test_pipeline_verdicts_go_by_row(spark, sf_small):
    import corpus_pipeline as P
    item = spark.read.parquet(f"{sf_small}/benchmark.parquet").filter("length(text) > 100").first().text
    clean = spark.read.parquet(f"{sf_small}/labels.parquet").filter("quality = 1").join(
        spark.read.parquet(f"{sf_small}/documents.parquet"), "doc_id").filter("lang = 'en' AND n_chars > 500").first().text
    junk = "@@## ZZ!! " * 60
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"))
    more = frame(spark, [junk, junk, clean], ids=[None, -5, -5])
    out = P.quality(spark, docs.unionByName(more), sf_small).filter("doc_id IS NULL OR doc_id = -5").collect()
    assert [(r.doc_id, r.text) for r in out] == [(-5, clean)]
    out = P.decontaminate(spark, frame(spark, [item, item, "plain words"], ids=[None, 5, 5]), sf_small).collect()
    assert [(r.doc_id, r.text) for r in out] == [(5, "plain words")]
    far = ["a b c d e f", "q r s t u v", "a b c d e f", "l m n o p q", "l m n o p q"]
    out = P.near_duplicate(spark, frame(spark, far, ids=[1, 1, None, None, None]), sf_small).collect()
    assert sorted((r.doc_id or -1, r.text) for r in out) == [(-1, far[3]), (1, far[0]), (1, far[1])]


def test_queries_with_sql_match_it(spark, sf_small):
    from oracle_harness import compare, duck_connection
    from tidewater.llm import queries as Q
    con = duck_connection(sf_small)
    for name, sql in Q.oracle_sql().items():
        res = compare(Q.queries()[name](spark, sf_small), con, sql)
        assert res["match"], (name, res)


def test_every_operator_is_registered():
    import __spark_entry__ as E
    names = E.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1

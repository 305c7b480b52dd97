"""Text operators against brute force, with edge rows: nulls, empty and long texts,
ties, repeated rows, empty tables and clashing extra columns."""

import hashlib
import math
import re
import tracemalloc
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewater.llm import fm_index, simhash, suffix_dedup, toxicity, wrappers
from tidewater.llm.kneser_ney import Model, codes, judge, symbols

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns named like the operators' own.
CLASH = "doc long, data string, row string, fp long, start long, kmer long, gone long, half int"


def frame(spark, texts, schema=DOCS, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, schema)


def clashing(df):
    for col in CLASH.split(", "):
        name, kind = col.split()
        df = df.withColumn(name, F.lit(1).cast(kind))
    return df


WORDS = [f"w{k}" for k in range(30)]


def random_texts(n, seed, words=60):
    rng = np.random.default_rng(seed)
    return [" ".join(rng.choice(WORDS, int(rng.integers(1, words)))) for _ in range(n)]


# --- decontamination -----------------------------------------------------------------

def brute_contamination(text, items, window=13):
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        if item is None or not v:
            continue
        n = min(window, len(v))
        for k in range(len(v) - n + 1):
            for i in range(len(w) - n + 1):
                if w[i:i + n] == v[k:k + n]:
                    hit.update(range(i, i + n))
                    found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)


def test_contamination_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    base = random_texts(6, 1, 40)
    items = [(k, t) for k, t in enumerate(base)] + [(10, "w1 w2"), (11, None), (12, "  "), (None, "w3"), (3, base[3]), (2, "w5 W6, w7")]
    texts = random_texts(30, 2) + [None, "", "!!", "W1. w2", base[0] * 3, "x " * 400 + base[1], base[2].upper(), "é ü w1-w2"]
    texts += [" ".join(rng.choice(["w1", "w2"], 500)), texts[0], texts[0]]
    df = clashing(frame(spark, texts, ids=[*range(len(texts) - 1), None]))
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = fm_index.find_contamination(df, bench).collect()
    assert len(rows) == len(texts)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows)
    ids = [*range(len(texts) - 1), -1]
    assert got == sorted((i, *brute_contamination(t, items)) for i, t in zip(ids, texts))


def test_contamination_small_shards_blocks_and_spans(spark):
    items = [(k, t) for k, t in enumerate(random_texts(8, 5, 30))]
    texts = random_texts(40, 6, 200) + [items[1][1] + " zz " + items[2][1]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = fm_index.find_contamination(frame(spark, texts), bench, shard_words=50, block_bytes=100).collect()
    for r in rows:
        want = brute_contamination(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want
        left = fm_index.cut_spans(texts[r.doc_id], r.spans)
        assert len(fm_index.words_of(left)) == r.n_words - r.n_hit


def test_contamination_empty(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in fm_index.find_contamination(frame(spark, ["a b"]), bench).collect()] == [0]
    assert fm_index.find_contamination(frame(spark, []), bench).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_fm_index_finds_every_occurrence(seed):
    rng = np.random.default_rng(seed)
    n, v = int(rng.integers(5, 300)), int(rng.integers(1, 6))
    s = rng.integers(0, v + 1, n).astype(np.int64)
    s[-1] = 0
    index = fm_index.FMIndex(s, v)
    patterns = rng.integers(1, v + 1, (20, int(rng.integers(1, 5))))
    which, lo, hi = index.search(patterns)
    got = {int(k): sorted(index.locate(np.arange(a, b)).tolist()) for k, a, b in zip(which, lo, hi)}
    m = patterns.shape[1]
    for k, p in enumerate(patterns):
        assert got.get(k, []) == [i for i in range(n - m + 1) if (s[i:i + m] == p).all()]


# --- SimHash ---------------------------------------------------------------------------

def brute_fingerprint(text):
    import xxhash
    w = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    low = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 2 and low[a] != low[b]:
                    low[a] = low[b] = min(low[a], low[b])
                    changed = True
    return low


def test_simhash_equals_brute_force(spark):
    base = random_texts(12, 9, 80)
    texts = base + [b + " w1" for b in base] + [None, "", " \n", "one", "One", "one two", "a\x0bb c\x1cd", base[0], base[0], "é É"]
    rows = simhash.near_duplicates(clashing(frame(spark, texts))).collect()
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    assert {r.doc_id: r.fp & (1 << 64) - 1 for r in rows} == fps
    assert {r.doc_id: r.component_id for r in rows} == brute_components(fps)


def test_simhash_null_ids_and_empty(spark):
    rows = simhash.near_duplicates(frame(spark, ["a b c d", "a b c d", "zz"], ids=[None, 4, None])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in rows) == [(-1, -1), (-1, 4), (4, 4)]
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_trie_join_finds_exactly_the_near_pairs():
    rng = np.random.default_rng(0)
    fps = []
    for b in rng.integers(0, 2 ** 63, 30, dtype=np.uint64).tolist():
        for _ in range(20):
            fps.append(b ^ sum(1 << int(k) for k in set(rng.integers(0, 64, int(rng.integers(0, 5))).tolist())))
    fps = np.unique(np.array(fps, np.uint64))
    a, b = simhash.trie_links(fps, np.zeros(len(fps), np.int64), 2)
    got = {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())}
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if (int(fps[i]) ^ int(fps[j])).bit_count() <= 2}
    assert got == want and len(a) == len(want)
    for x, y in want:  # every link agrees on one of the dealing patterns
        assert any(int(fps[x]) & m == int(fps[y]) & m for m in simhash.patterns())


# --- suffix dedup ------------------------------------------------------------------------

def brute_spans(texts, ids):
    first = {}
    raws = [(i, (t or "").encode()) for i, t in zip(ids, texts)]
    for i, raw in raws:
        for p in range(len(raw) - 99):
            s = raw[p:p + 100]
            first[s] = min(first.get(s, (i, p)), (i, p))
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw) + 1, int)
        for p in range(len(raw) - 99):
            if first[raw[p:p + 100]] < (i, p):
                gone[p:p + 100] = 1
        spans = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def dedup_cases():
    rng = np.random.default_rng(11)
    letters = np.array(list("abcdefgh "))
    noise = ["".join(rng.choice(letters, int(rng.integers(0, 700)))) for _ in range(14)]
    passage, other = "".join(rng.choice(letters, 260)), "".join(rng.choice(letters, 99))
    return noise + [noise[0] + passage, passage + noise[1], noise[2] + passage[:180] + noise[3], passage, passage[1:120],
                    other + "x", other + "y", "ab" * 400, "a" * 350, "é" * 120, None, "", noise[4], noise[4], "x" * 99, passage * 2]


def test_suffix_dedup_equals_brute_force(spark, monkeypatch):
    texts = dedup_cases()
    df = clashing(frame(spark, texts))
    got = sorted(tuple(r) for r in suffix_dedup.repeat_digest(df).collect())
    assert got == brute_spans(texts, range(len(texts)))


@pytest.mark.parametrize("contexts", [1, 2, 10])
def test_windows_that_travel_alone_change_no_result(spark, monkeypatch, contexts):
    rng = np.random.default_rng(12)
    letters = np.array(list("abcdefgh "))
    passage = "".join(rng.choice(letters, 300))
    texts = dedup_cases() + ["".join(rng.choice(letters, 120)) + passage + "".join(rng.choice(letters, 90)) for _ in range(25)]
    df = frame(spark, texts).coalesce(1)
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", contexts)
    hot = suffix_dedup.hot_kmers(df)
    assert len(hot) and (np.diff(hot.astype(object)) > 0).all()
    assert sorted(tuple(r) for r in suffix_dedup.repeat_digest(df).collect()) == brute_spans(texts, range(len(texts)))


def test_suffix_dedup_without_broadcasts(spark, monkeypatch):
    from tidewater.llm import common
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    texts = dedup_cases()
    got = sorted(tuple(r) for r in suffix_dedup.repeat_digest(frame(spark, texts)).collect())
    assert got == brute_spans(texts, range(len(texts)))


def test_suffix_dedup_repeated_ids_columns_and_empty(spark):
    texts = dedup_cases()[:20]
    ids = [*range(18), 17, 17]
    texts[18], texts[19] = texts[17], texts[17]
    got = sorted(tuple(r) for r in suffix_dedup.repeat_digest(frame(spark, texts, ids=ids)).collect())
    assert got == brute_spans(texts, ids)
    df = clashing(frame(spark, texts[:18] + [None]))
    out = suffix_dedup.remove_repeats(df)
    assert out.columns == df.columns and out.count() == 19
    want = {i: n - g for i, n, g, _, _ in brute_spans(texts[:18] + [None], range(19))}
    for r in out.collect():
        assert r.text is None or len(r.text.encode()) <= want[r.doc_id]
    assert suffix_dedup.repeat_digest(frame(spark, [])).count() == 0


def test_suffix_dedup_rows_without_id_or_with_one_id_are_cut_apart(spark):
    rng = np.random.default_rng(13)
    letters = np.array(list("abcdefgh "))
    a, b, c, passage = ("".join(rng.choice(letters, n)) for n in (300, 400, 350, 150))
    first = (1, passage + a)
    # no id: unique bytes at the offset of another row's repeat stay, and of equal rows one stays
    rows = [first, (None, passage + b), (None, c), (None, c), (7, a[:200] + c[:90] + b[:50]), (7, b[:45] + "x" + c[:80] + "y" * 99)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS).repartition(3)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_removed) for r in suffix_dedup.repeat_digest(df).collect())
    assert got == sorted([(1, 450, 0), (-1, 550, 150), (-1, 350, 0), (-1, 350, 350), (7, 340, 200), (7, 225, 0)])
    texts = sorted(r.text for r in suffix_dedup.remove_repeats(df).collect())
    assert texts == sorted([passage + a, b, c, "", c[:90] + b[:50], rows[5][1]])


def test_suffix_sort_is_lexicographic():
    rng = np.random.default_rng(2)
    parts = ["".join(rng.choice(list("ab"), int(rng.integers(32, 90)))).encode() for _ in range(60)]
    rec = np.zeros(60, suffix_dedup.ANCHOR)
    rec["end"] = [len(p) for p in parts]
    rec["kmer"] = np.repeat([1, 2, 3], 20)
    sfx = suffix_dedup.Suffixes(rec, np.frombuffer(b"".join(parts), np.uint8))
    order = sfx.sort(rec["kmer"]).tolist()
    for g in range(3):
        assert order[20 * g:20 * g + 20] == sorted(range(20 * g, 20 * g + 20), key=lambda k: (parts[k], k))


def test_contexts_of_a_bucket_are_sorted_in_little_memory(monkeypatch):
    n = 32_000  # contexts of 130 bytes; four at a time differ in their first byte alone
    data = np.repeat(np.random.default_rng(5).integers(97, 123, (n // 4, 130)).astype(np.uint8), 4, axis=0)
    data[:, 0] = np.arange(n) % 4
    rec = np.zeros(n, suffix_dedup.ANCHOR)
    rec["kmer"], rec["doc"], rec["at"], rec["end"] = np.arange(n) // 4, np.arange(n), 40, 130
    blob = n.to_bytes(4, "little") + rec.tobytes() + data.tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array(["c"]), pa.array([0], pa.int32()), pa.array([blob], pa.binary())], names=["kind", "bucket", "data"])

    class Frame:
        def mapInArrow(self, run, schema):
            return run
    monkeypatch.setattr(suffix_dedup, "dealt", lambda df, buckets: df)
    monkeypatch.setattr(suffix_dedup, "_POWERS", [])
    run = suffix_dedup._sort_buckets(Frame(), 1)
    tracemalloc.start()
    parts = [d for b in run(iter([batch])) for d in b.column("data").to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    spans = suffix_dedup.merge_spans(np.frombuffer(b"".join(parts), suffix_dedup.SPAN))
    assert [tuple(x) for x in spans.tolist()] == [(i, 0, 1, 130) for i in range(n) if i % 4]
    assert peak < 20 * data.nbytes


def test_memory_is_given_back_when_nothing_is_held(monkeypatch):
    from tidewater.llm import common
    alive = []

    class Held:
        pass

    def run(batches):
        held = Held()
        alive.append(weakref.ref(held))
        yield from batches
    monkeypatch.setattr(common, "give_back_memory", lambda: alive.append(alive[0]() is not None))
    assert list(common.giving_back(run)(iter([1, 2]))) == [1, 2]
    assert alive[1:] == [False]


def test_long_text_is_hashed_in_chunks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    raw = "".join(rng.choice(list("abcdefgh"), 5000)).encode()
    whole = sorted((int(s), int(e)) for _, _, start, end, _, _ in suffix_dedup.anchors(raw) for s, e in zip(start, end))
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    cut = [(int(s), int(e)) for _, _, start, end, _, _ in suffix_dedup.anchors(raw) for s, e in zip(start, end)]
    windows = lambda found: sorted(p for s, e in found for p in range(s, e - 99))
    assert windows(whole) == windows(cut) == list(range(len(raw) - 99))


# --- HTML extraction ------------------------------------------------------------------------

def page(body, title="t"):
    return (f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head>"
            f"<body><nav><ul><li><a href='/a'>A</a></li><li><a href='/b'>B</a></li></ul></nav>{body}<footer>&copy; x")


def test_pages_lose_everything_but_the_article(spark):
    pages = [
        (1, "http://a.com/1", page("<div class='ad'>buy</div><article><h1>T &amp; U</h1><p>one <b>two<br><p>three  four</p></article>")),
        (2, "http://a.com/2", page("<article><h1>X</h1><p>y</p><div class=\"notice top\">n</div><form><p>f</p></form>"
                                   "<aside>s</aside><p>z<script>q</script></p></article><section id='comments'><article>c</article></section>")),
        (3, "https://B.org", page("<header>h</header><main><p>a<!-- c -->b</p><ul><li>i<li>j</ul></main><div class=sidebar>s</div>")),
        (4, None, page("<article>&lt;k&gt; &#233;</article>")), (5, "http://a.com/3", None), (6, "http://a.com/3", ""),
        (7, "http://a.com/4", "plain <b>text</b> only"), (8, "http://a.com/1", None), (9, "http://a.com/9", "<article>" + "<div>" * 3000 + "deep"),
        (None, "http://a.com/1", page("<article>n</article>")),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("wrapper", F.lit(2))
    rows = wrappers.extract_main_text(df).collect()
    got = {r.page_id: r.text for r in rows}
    assert got == {1: "T & U one two three four", 2: "X y z", 3: "ab i j", 4: "<k> é", 5: "", 6: "", 7: "",
                   8: "", 9: "deep", None: "n"}
    assert all(r.n_chars == len(r.text) for r in rows)
    assert wrappers.extract_main_text(df.limit(0)).count() == 0


def test_wrapper_alignment_finds_groups_options_and_slots():
    a = wrappers.items_of(wrappers.parse("<ul><li>x</li><li>y</li><li>z</li></ul><p>same</p><h2>k</h2>"))
    b = wrappers.items_of(wrappers.parse("<ul><li>x</li></ul><p>same</p>"))
    assert a[0] == ["e:ul", 0, [["+", 0, [["e:li", 0, [["t", 0, None]]]]]]]
    w = wrappers.align(a, b)
    assert w[0][2][0][0] == "+" and w[1] == ["e:p", 0, [["t", 0, "same"]]] and w[2][:2] == ["e:h2", 1]
    dl = wrappers.items_of(wrappers.parse("<dl><dt>a<dd>b<dt>c<dd>d</dl>"))
    assert dl[0][2] == [["+", 0, [["e:dt", 0, [["t", 0, None]]], ["e:dd", 0, [["t", 0, None]]]]]]


def test_a_host_without_article_keeps_variable_slots():
    w = None
    for k in range(3):
        p = wrappers.parse(f"<body><div>Site name</div><ul><li><a>n{k}</a></li></ul><div class=text><p>body {k}</p></div></body>")
        items = wrappers.items_of(p)
        w = items if w is None else wrappers.align(w, items)
    assert wrappers.main_text("<body><div>Site name</div><ul><li><a>n</a></li></ul><div class=text><p>body 9</p></div></body>",
                              wrappers.slot_rules(w)) == "body 9"


def test_each_page_decides_whether_it_has_a_main_element(spark):
    plain = "<body><div>Site name</div><div class=text><p>{}</p></div></body>"
    pages = [(1, "http://a.com/1", "<body><article><p>one</p></article></body>"), (2, "http://a.com/2", plain.format("body two")),
             (3, "http://a.com/3", plain.format("the third body")), (4, "http://b.com/1", plain.format("single")),
             (5, "http://c.com/1", plain.format("copied")), (6, "http://c.com/2", plain.format("copied"))]
    rows = wrappers.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in rows} == {1: "one", 2: "body two", 3: "the third body", 4: "Site name single",
                                                 5: "Site name copied", 6: "Site name copied"}


def test_constant_blocks_go_by_their_slot(spark):
    # equal labels at different positions; a plain <p> in a run of variable ones; an optional block
    form = ("<body><main><div class=x>Read our terms, {0}</div><div class=x>Shown on every page</div><p>Share this {1}</p>"
            "<p>Write to <a>us</a> now</p><p>{2}</p><p>{3}</p>{4}</main></body>")
    pages = [(k, f"http://a.com/{k}", form.format(k, k, f"first {k}", f"second and longer text {k}", "<h4>optional</h4>" if k % 2 else ""))
             for k in range(5)]
    pages.append((9, "http://a.com/9", form.format(9, 9, "Shown on every page", "Write to us", "")))
    rows = wrappers.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)).collect()
    want = {k: f"Read our terms, {k} Share this {k} first {k} second and longer text {k}" for k in range(5)}
    want[9] = "Read our terms, 9 Share this 9 Shown on every page Write to us"
    got = {r.page_id: r.text for r in rows}
    # neighbouring divs of one label are a repeated group: what stands in it on every page goes
    assert got == want


@pytest.mark.parametrize("body, want", [
    ("<article class='post has-comments'><p>a</p></article>", "a"), ("<main id='search-results'><p>a</p></main>", "a"),
    ("<article class='post related'><p>a</p><article class='related'>r</article></article>", "a"),
    ("<div class='sidebar'><article>card</article></div><article><p>a</p></article>", "a"),
    ("<div class='ad'>buy<article><p>a</p></article>", "a"), ("<form><article><p>a</p></article></form>", "a"),
    ("<article><p>a</p><div class='top notice'>n</div></article>", "a"),
])
def test_words_mark_whole_tokens_and_never_the_frame(body, want):
    page = f"<html><body class='comments-open sidebar'>{body}</body></html>"
    assert wrappers.main_text(page, wrappers.slot_rules(wrappers.items_of(wrappers.parse(page)), set())) == want


# --- quality ----------------------------------------------------------------------------------

def test_model_is_a_distribution(spark):
    from tidewater.llm.kneser_ney import fit
    texts = random_texts(40, 21)
    df = spark.createDataFrame([(t, k % 2) for k, t in enumerate(texts)], "text string, half int")
    for m in fit(df):
        p = 2.0 ** -m.bits().astype(np.float64)
        assert np.allclose(p.reshape(-1, 64).sum(1), 1, atol=2e-2)
        bits, n = m.score([texts[0], "", "zq"])
        assert n.tolist() == [len(texts[0]), 0, 2] and bits[1] == 0
        assert bits[0] / n[0] < bits[2] / n[2]


def test_codes_do_not_cross_texts():
    x, n = codes(["ab", "", "cde"])
    assert n.tolist() == [2, 0, 3] and len(x) == 5
    s = [symbols(t) for t in ("ab", "cde")]
    want = []
    for t in s:
        padded = [0, 0, 0, *t.tolist()]
        want += [sum(v << 6 * (3 - j) for j, v in enumerate(padded[i:i + 4])) for i in range(len(t))]
    assert x.tolist() == want


def brute_bits(trusted, text):
    """-log2 p of a text by interpolated modified Kneser-Ney over its characters, by definition."""
    grams = [None] * 5
    grams[4] = Counter(tuple(p[i:i + 4]) for t in trusted for p in [[None] * 3 + list(t)] for i in range(len(t)))
    for k in (3, 2, 1):
        grams[k] = Counter(g[1:] for g in grams[k + 1])
    discounts, totals, held = {}, Counter(), Counter()
    for k in (1, 2, 3, 4):
        t = [max(1, sum(n == j for n in grams[k].values())) for j in (1, 2, 3, 4)]
        y = t[0] / (t[0] + 2 * t[1])
        discounts[k] = [min(max(j - (j + 1) * y * t[j] / t[j - 1], 0.01), j - 0.01) for j in (1, 2, 3)]
        for g, n in grams[k].items():
            totals[g[:-1]] += n
            held[g[:-1]] += discounts[k][min(n, 3) - 1]

    def prob(g):
        if not g:
            return 1 / 0x110000
        below, c, n = prob(g[1:]), g[:-1], grams[len(g)].get(g, 0)
        if c not in totals:
            return below
        return ((n - discounts[len(g)][min(n, 3) - 1] if n else 0) + held[c] * below) / totals[c]

    padded = [None] * 3 + list(text)
    return sum(-math.log2(prob(tuple(padded[i:i + 4]))) for i in range(len(text)))


def test_perplexity_is_its_definition(spark, monkeypatch):
    monkeypatch.setattr("tidewater.llm.kneser_ney.BLOCK", 500)  # several blocks of each half
    monkeypatch.setattr("tidewater.llm.kneser_ney.CHUNK", 300)
    texts = random_texts(30, 25, 20) + ["Abc ABC aBC 012 999", "\u0431\u0432\u0446 \u0446\u0432\u0431", "\x00a\x00", "\U00010061 \U0001f600a", "", None]
    labels = spark.createDataFrame([(i, 1) for i in (*range(24), 30, 31, 33)], "doc_id long, quality int")
    docs = frame(spark, texts)
    half = {r[0]: r[1] for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(2))).collect()}
    trusted = {r[0] for r in labels.collect()}
    rows = {r.doc_id: r for r in judge(docs, labels).collect()}
    assert len(rows) == 36 and rows[34].ln_perplexity is rows[35].ln_perplexity is None
    for i, t in enumerate(texts):
        if t:
            want = brute_bits([texts[j] for j in trusted if half[j] != half[i]], t) * math.log(2) / len(t)
            assert rows[i].n_chars == len(t) and rows[i].ln_perplexity == pytest.approx(want, rel=1e-9)


def test_characters_are_not_folded():
    from tidewater.llm.kneser_ney import block_grams
    # capitals, digits, code points 21 apart and beyond 2^16 had one symbol each
    for a, b in ("AB", "12", "\u0431\u0446", "a\U00010061", "\x00\x01"):
        context, symbol, place, n = block_grams([a, b, ""])
        assert len(set(symbol.tolist())) == 2 and n.tolist() == [1, 1, 0] and place[0] != place[1]
    wide = "".join(map(chr, range(0x10000, 0x1c000)))  # too many letters for four in 64 bits
    context, symbol, place, n = block_grams([wide, wide])
    assert len(context) == len(wide) and (place[:len(wide)] == place[len(wide):]).all()
    assert sorted(symbol.tolist()) == [ord(c) + 1 for c in wide]


def test_quality_edges(spark):
    texts = random_texts(60, 23) + ["@@## ZZ!! " * 40, None, ""]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)] * 2, "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in judge(clashing(frame(spark, texts)), labels).collect()}
    assert len(rows) == 63 and not rows[60].kept and rows[61].kept and rows[62].kept and rows[61].ln_perplexity is None
    assert sum(rows[i].kept for i in range(60)) >= 50
    nobody = judge(frame(spark, texts), labels.limit(0)).collect()
    assert all(r.kept for r in nobody) and len(nobody) == 63
    assert judge(frame(spark, []), labels).count() == 0


# --- toxicity ------------------------------------------------------------------------------------

def brute_segments(s):
    """Maximal segments by definition: split recursively around the best subsequence."""
    if not len(s) or max(s) <= 0:
        return []
    best = max(((sum(s[i:j]), -(j - i), -i) for i in range(len(s)) for j in range(i + 1, len(s) + 1)))
    i = -best[2]
    j = i - best[1]
    right = [(a + j, b + j, c) for a, b, c in brute_segments(s[j:])]
    return brute_segments(s[:i]) + [(i, j, best[0])] + right


@pytest.mark.parametrize("seed", range(20))
def test_segments_equal_their_definition(seed):
    rng = np.random.default_rng(seed)
    s = rng.normal(-0.3, 2, 25)
    got = toxicity.maximal_segments(s)
    want = brute_segments(s.tolist())
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([x for *_, x in got], [x for *_, x in want])


def test_toxicity_learns_and_handles_edges(spark):
    rng = np.random.default_rng(31)
    bad = ["vileful", "vileness", "nastyish"]
    texts, labels = [], []
    for i in range(400):
        w = list(rng.choice(WORDS, 40))
        toxic = i % 4 == 0
        if toxic:
            for k in rng.integers(0, 40, 4):
                w[k] = bad[int(rng.integers(0, 3))]
        texts.append(" ".join(w))
        labels.append((i, 1, int(toxic)))
    texts += [None, "", "!!"]
    labs = spark.createDataFrame(labels + labels[:5] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in toxicity.score_documents(clashing(frame(spark, texts)), labs).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(rows[i].score >= 0.7) == (i % 4 == 0) for i in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in rows.values()) and rows[400].score < 0.7
    assert any(rows[i].passages for i in held if i % 4 == 0)
    none = toxicity.score_documents(frame(spark, ["a", None]), labs.limit(0)).collect()
    assert len(none) == 2 and len({r.score for r in none}) == 1
    assert toxicity.score_documents(frame(spark, []), labs).count() == 0


def brute_scores(texts, labelled, strength=10.0, drift=0.75):
    """The score by its definition: counts in plain tables, best segment over all pairs of
    ends, quartiles of clean documents by length, rates by the minimax formula."""
    words = {i: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").lower().encode()) for i, t in enumerate(texts)}
    grams = lambda w: [*[(k, w[:k]) for k in (5, 7) if len(w) >= k], (0, w)]
    crc = {i: zlib.crc32(str(i).encode()) for i in words}
    train = {i: t for i, t in labelled.items() if crc[i] % 3 != 1}

    def best(i, without):
        n = [defaultdict(int), defaultdict(int)]
        for j, t in train.items():
            if crc[j] % 4 != without:
                for w in set(words[j]):
                    for g in grams(w):
                        n[t][g] += 1
        base = sum(n[1].values()) / max(1, sum(n[0].values()) + sum(n[1].values()))
        logit = lambda r: np.log(r / (1 - r))
        score = []
        for w in words[i]:
            rate = base
            for g in grams(w):
                rate = (n[1][g] + strength * rate) / (n[1][g] + n[0][g] + strength)
            score.append(logit(rate) - logit(base) - drift)
        top = max([0.0, *(sum(score[a:b]) for a in range(len(score)) for b in range(a + 1, len(score) + 1))])
        return top - np.log(max(64, len(words[i])))

    size = lambda i: max(64, len(words[i])).bit_length()
    bins = Counter((size(i), np.floor(best(i, crc[i] % 4) / 0.25), t) for i, t in train.items())

    def law(keep):
        at = sorted((b, n) for (c, b, t), n in bins.items() if not t and keep(c))
        where, total = sorted({b for b, _ in at}), sum(n for _, n in at)
        held = [sum(n for b2, n in at if b2 <= b) / total for b in where]
        q = [np.interp(p, held, [(b + 0.5) * 0.25 for b in where]) for p in (0.25, 0.5, 0.75)]
        return q[1], max(0.05, q[2] - q[0]), total
    every, laws = law(lambda c: True), {}
    for c in {c for c, _, t in bins if not t}:
        own = law(lambda d: d == c)
        share = own[2] / (own[2] + 200.0)
        laws[c] = [share * x + (1 - share) * y for x, y in zip(own[:2], every[:2])]

    def z(c, x):
        median, spread = laws.get(c, every[:2])
        scale = spread / (np.log(np.log(4)) - np.log(-np.log(0.75)))
        return (x - (median + scale * np.log(np.log(2)))) / scale
    steps = Counter()
    for (c, b, t), n in bins.items():
        steps[np.floor(z(c, (b + 0.5) * 0.25) / 0.4), t] += n
    at = sorted({k for k, _ in steps})
    mean = lambda a, b: sum(steps[k, 1] for k in at[a:b]) / sum(steps[k, 0] + steps[k, 1] for k in at[a:b])
    rate = [max(min(mean(a, b) for b in range(k + 1, len(at) + 1)) for a in range(k + 1)) for k in range(len(at))]
    return {i: np.interp(z(size(i), best(i, None)), [(k + 0.5) * 0.4 for k in at], rate) for i in words}


def test_toxicity_scores_equal_their_definition(spark):
    rng = np.random.default_rng(12)
    texts, labels = [], {}
    for i in range(150):
        w = list(rng.choice(WORDS, int(rng.integers(3, 150))))
        if i % 3 == 0:
            for k in rng.integers(0, len(w), 2):
                w[k] = str(rng.choice(["vileful", "vileness", "bad"]))
        texts.append(" ".join(w))
        labels[i] = int(i % 3 == 0) if i % 10 else 1 - int(i % 3 == 0)
    labs = spark.createDataFrame([(i, 1, t) for i, t in labels.items()], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_documents(frame(spark, texts), labs).collect()}
    want = brute_scores(texts, labels)
    assert len({round(x, 6) for x in got.values()}) > 5
    for i, x in want.items():
        assert abs(got[i] - x) < 1e-6, (i, got[i], x)


def test_the_law_of_best_segments_depends_on_length():
    at = np.arange(-20, 20) * 0.25
    short, long = np.exp(-(at + 2) ** 2) * 1000, np.exp(-(at - 2) ** 2) * 1000
    toxic = np.where(at > 3.5, 30.0, 0.0)
    length = np.repeat([7, 10], len(at))
    law = toxicity.Calibration(length, np.tile(at, 2), np.tile(toxic, 2), np.concatenate([short, long]), 0.1)
    assert law.tail(7, 1.0) < 0.05 < 0.5 < law.tail(10, 1.0)
    assert law.score(7, 3.0) > law.score(10, 3.0)
    assert law.laws[7][0] < law.law[0] < law.laws[10][0] and law.score(99, 0.0) >= 0.0

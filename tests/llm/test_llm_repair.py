"""Conversation repair, exact deduplication and whitening against brute force, with edge
rows: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import conversation_repair as CR
from tidewater.llm import fuse_dedup as FD
from tidewater.llm import whitening as WH
from tidewater.llm.common import join_groups
from tidewater.llm.queries import damaged

from test_llm_text import clashing, frame, random_texts

CONV = "conv_id long, turn long, role string, text string"


# --- conversation repair ---------------------------------------------------------------

def in_order(rows):
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))


def brute(rows):
    """Faults, cheapest edits and repaired hash of one conversation, row by row."""
    rows, seen, faults = in_order(rows), set(), []
    for _, role, text in rows:
        solid = re.sub("[\x20\x09-\x0d]+$", "", text)
        faults.append("b" if not solid else "d" if (role, text) in seen else "" if solid[-1] in ".!?" else "t")
        seen.add((role, text))
    to = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                for initial, role in (("u", "user"), ("a", "assistant")):
                    if (state, initial) in to:
                        new = (cost + 5, audit + "I", (*lines, f"{role}:"))
                        new_state = to[state, initial]
                        if new_state not in best or new[:2] < best[new_state][:2]:
                            best[new_state] = new
        return best
    best = inserted({"": (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        ways = {}
        for state, (cost, audit, lines) in best.items():
            found = [(state, (cost + 2, audit + "D", lines))]
            if fault not in ("b", "d"):
                extra = 5 * (fault == "t")
                if (state, role[:1]) in to:
                    found.append((to[state, role[:1]], (cost + extra, audit + "K", (*lines, f"{role}:{text}"))))
                for initial, name in (("u", "user"), ("a", "assistant")):
                    if (state, initial) in to:
                        found.append((to[state, initial], (cost + extra + 1, audit + "R", (*lines, f"{name}:{text}"))))
            for new_state, new in found:
                if new_state not in ways or new[:2] < ways[new_state][:2]:
                    ways[new_state] = new
        best = inserted(ways)
    cost, audit, lines = min(best[s] for s in ("", "a") if s in best)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": faults.count("b"),
            "duplicate": faults.count("d"), "truncated": faults.count("t"),
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def enumerated(symbols):
    """Cheapest edits of a short conversation among all edit strings, no dynamic programme."""
    best, n = None, len(symbols)
    for edits in itertools.product("DKR", repeat=n):
        for gaps in itertools.product(range(3), repeat=n + 1):
            if sum(gaps) > 4:
                continue
            cost, out, audit = 5 * sum(gaps), [], ""
            for k in range(n + 1):
                out += ["?"] * gaps[k]
                audit += "I" * gaps[k]
                if k == n:
                    break
                role, fault = symbols[k]
                audit += edits[k]
                if edits[k] == "D":
                    cost += 2
                    continue
                if fault == 2:
                    cost = 10 ** 6
                cost += 5 * (fault == 1) + (edits[k] == "R")
                out.append("?" if edits[k] == "R" else role)
            free = "".join(out)
            for head in ("", "s"):
                want = head + "ua" * ((len(free) - len(head)) // 2) if len(free) > len(head) else ""
                if len(want) == len(free) and all(a == b or a == "?" and b != "s" for a, b in zip(free, want)):
                    best = min(best, (cost, audit)) if best else (cost, audit)
    return best


def test_every_short_conversation_has_its_cheapest_edits():
    for n in range(4):
        kinds = [(c, f) for c in "suax" for f in range(3)] if n < 3 else [("s", 0), ("u", 0), ("u", 1), ("a", 0), ("a", 1), ("x", 0), ("u", 2)]
        for symbols in itertools.product(kinds, repeat=n):
            walk = CR.Walk(CR.Grammar())
            for c, f in symbols:
                walk.step(CR.symbol(CR.CLASSES.index(c), f))
            assert walk.end() == enumerated(symbols), symbols


def test_rules_give_what_single_symbols_give():
    rng = np.random.default_rng(3)
    grammar = CR.Grammar()
    texts = ["".join(chr(ord("A") + int(k)) for k in rng.integers(0, 12, int(rng.integers(1, 40)))) for _ in range(40)]
    for _ in range(8):
        seen = Counter(s[k:k + 2] for s in map(grammar.compress, texts) for k in range(len(s) - 1))
        grammar.add_round(CR.choose(seen.most_common(), 20))
    assert any(len(grammar.compress(t)) < len(t) / 3 for t in texts)
    for t in texts:
        plain, short = CR.Walk(grammar), CR.Walk(grammar)
        for c in t:
            plain.step(c)
        for c in grammar.compress(t):
            short.step(c)
        assert plain.end() == short.end()


def conversations(seed, n=60):
    rng = np.random.default_rng(seed)
    texts = ["Yes.", "no", " ", "", "\t\n", "What?", "cut off", "Well! ", "é.", "x" * 3000 + "."]
    roles = ["user", "assistant", "system", "tool", "ugh", "", "User"]
    p = [.35, .35, .12, .06, .04, .04, .04]
    rows = []
    for c in range(n):
        for t in range(int(rng.integers(0, 9))):
            rows.append((c, int(rng.integers(0, 9)) if rng.random() < .2 else t, str(rng.choice(roles, p=p)), str(rng.choice(texts))))
    return rows


def check(spark, rows, ids, **options):
    got = CR.repair(clashing(spark.createDataFrame(rows, CONV)), spark.createDataFrame([(i,) for i in ids], "conv_id long"), **options).collect()
    by = defaultdict(list)
    for c, *rest in rows:
        by[c].append(tuple(rest))
    assert sorted(r.conv_id is None for r in got) == sorted(i is None for i in set(ids)) and {r.conv_id for r in got} == set(ids)
    for r in got:
        want = brute(by[r.conv_id])
        assert {k: r[k] for k in want} == want, r.conv_id


def test_repair_against_brute_force(spark):
    rows = conversations(1) + [(None, 0, "user", "a."), (None, None, None, None), (None, 1, "assistant", "b."), (90, None, "user", "x."), (90, None, "user", "x.")]
    check(spark, rows, [*range(60), None, 90, 91])


def test_repair_of_a_conversation_longer_than_a_chunk(spark, monkeypatch):
    rng = np.random.default_rng(5)
    long = [(7, t, str(rng.choice(["user", "assistant", "system"], p=[.45, .45, .1])), str(rng.choice(["Yes.", "no", "ok", f"t{t}.", f"u{t}"]))) for t in range(900)]
    check(spark, long + [(7, 901, "user", "same.")] * 700 + [(8, 1, "user", "same.")], [7, 8])
    check(spark, conversations(2), range(60), rules=3)


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], CONV)
    assert CR.repair(none, none).count() == 0
    empty = CR.repair(none, spark.createDataFrame([(3,)], "conv_id long")).collect()
    assert [(r.conv_id, r.cost, r.audit, r.repaired_sha256) for r in empty] == [(3, 0, "", hashlib.sha256(b"").hexdigest())]


def test_damage_follows_the_key(spark):
    rows = [(c, t, "assistant", "Hm. Yes!") for c in range(20) for t in range(4)] + [(None, None, None, None)]
    got = Counter((r.conv_id, r.turn, r.role, r.text) for r in damaged(clashing(spark.createDataFrame(rows, CONV))).collect())
    want = Counter()
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        if kind:
            want[c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text] += 1 + (kind == 3)
    assert got == want


# --- exact deduplication -----------------------------------------------------------------

def test_filters_miss_nothing_and_let_little_through():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 10, 1000, 30_000):
        keys = rng.integers(-2 ** 63, 2 ** 63 - 1, n)
        made = FD.FuseFilter.of(np.append(keys, keys[:1]))
        assert made.has(keys).all()
        others = rng.integers(-2 ** 63, 2 ** 63 - 1, 20_000)
        assert made.has(others).mean() < 0.02
        assert len(made.cells) <= max(64, 1.5 * n)


def brute_groups(ids, texts):
    key = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for t in texts]
    groups = defaultdict(list)
    for i, k in zip(ids, key):
        groups[k].append(i)
    return Counter((i, min((x for x in groups[k] if x is not None), default=None), len(groups[k]), hashlib.sha256(k.encode()).hexdigest())
                   for i, k in zip(ids, key)), groups


@pytest.mark.parametrize("arrivals,digest_bytes", [(1, 32), (2, 32), (3, 32), (2, 1), (2, 0)])
def test_copies_are_found_across_batches(spark, arrivals, digest_bytes):
    texts = random_texts(40, 4) + ["a b", "a \t\nb", "a  b ", " a b", None, "", " ", "\n", " ", "x " * 30_000] + ["hot copy"] * 200
    texts += texts[:15]
    ids = [*range(500, 500 + len(texts) - 4), None, None, 3, 3]
    docs = clashing(frame(spark, texts, ids=ids))
    arrival = F.pmod(F.xxhash64("doc_id"), F.lit(arrivals))
    got = FD.deduplicate(docs, arrival, arrivals, digest_bytes).collect()
    want, groups = brute_groups(ids, texts)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_no_documents_no_copies(spark):
    assert FD.deduplicate(frame(spark, []), F.lit(0), 2).count() == 0


def test_hot_groups_meet_rows_without_a_shuffle_of_their_key(spark):
    rows = spark.range(5000).select((F.col("id") % 3000).alias("k"), F.when(F.col("id") > 100, "x").alias("s"))
    rows = rows.unionByName(spark.range(3000).select(F.lit(7).cast("long").alias("k"), F.lit(None).cast("string").alias("s")))
    groups = rows.groupBy("k", "s").agg(F.count("*").alias("n")).filter("n > 1").withColumn("mark", F.lit(True))
    joined = join_groups(rows, groups, ["k", "s"], "n")
    assert joined.count() == 8000
    assert joined.filter("mark").count() == groups.agg(F.sum("n")).first()[0]
    assert joined.filter("k = 7 and s is null and mark").count() == 3001


# --- whitening ------------------------------------------------------------------------------

def brute_whitened(vectors, components=4):
    """Rows that take part, x and S in whole numbers, directions by a symmetric eigensolver."""
    rows = []
    for i, v in vectors:
        if v is not None and all(c is not None and np.isfinite(c) for c in v):
            rows.append((i, tuple(int(np.floor(256 * float(c))) for c in v)))
    fit = sorted({x for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in fit])
    cov = centred.T @ centred / n
    values, vectors_ = np.linalg.eigh(cov)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    return rows, n, sums, values[:components], vectors_[:, :components], np.trace(cov)


def same_whitening(got, vectors):
    rows, n, sums, values, directions, trace = brute_whitened(vectors)
    assert len(got) == len(rows) * len(values)
    by = defaultdict(list)
    for r in got:
        by[r.vec_id, r.component].append(r)
    signs = None
    for i, x in rows:
        w = np.array([(n * c - s) / n for c, s in zip(x, sums)]) @ directions / np.sqrt(values)
        mine = [by[i, k + 1] for k in range(len(values))]
        assert {r.deviation for m in mine for r in m} >= {sum((n * c - s) ** 2 for c, s in zip(x, sums))}
        if signs is None and np.abs(w).min() > 1e-6:
            signs = np.sign([m[0].whitened for m in mine]) * np.sign(w)
        if signs is not None and all(len(m) == 1 for m in mine):
            assert np.allclose([m[0].whitened for m in mine], signs * w, rtol=1e-8, atol=1e-9)
    for r in got:
        assert r.n == n and r.identity_error < 1e-9 and r.deviation_exact == str(r.deviation)
        assert np.isclose(r.explained, values[r.component - 1] / trace, rtol=1e-9)


VECS = "vec_id long, embedding array<float>, label int"


def test_whitening_against_a_symmetric_solver(spark):
    rng = np.random.default_rng(2)
    mixed = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6)) * 0.3
    vectors = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(mixed)]
    vectors += [(400, vectors[0][1]), (400, vectors[1][1]), (None, vectors[2][1]), (401, None), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
                (403, [float("nan")] + [0.0] * 5), (404, [float("inf")] + [0.0] * 5), (405, [-0.0] * 6)]
    df = clashing(spark.createDataFrame([(i, v, 1) for i, v in vectors], VECS).withColumn("x", F.lit("own")).withColumn("n", F.lit(1)))
    same_whitening(WH.whiten(df.repartition(5)).collect(), vectors)


def test_whitening_of_doubles_and_wide_numbers(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, [float(c) * 10 ** 6 for c in v]) for i, v in enumerate(rng.normal(size=(50, 3)))]
    df = spark.createDataFrame([*vectors, (77, [1e300, 0.0, 0.0])], "vec_id long, embedding array<double>")
    got = WH.whiten(df).collect()
    rows, n, sums, *_ = brute_whitened(vectors)
    want = {i: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for i, x in rows}
    assert len(got) == 150 and max(want.values()) >= 1 << 63
    for r in got:
        assert r.deviation_exact == str(want[r.vec_id]) and r.deviation == (want[r.vec_id] if want[r.vec_id] < 1 << 63 else None)


def test_whitening_of_little(spark):
    def run(rows):
        return WH.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert run([]) == [] and run([(1, None), (2, [])]) == []
    assert run([(1, [0.5, 0.25]), (2, [0.5, 0.25])]) == []  # nothing varies
    line = run([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [0.5, 0.5])])
    assert [r.component for r in line] == [1, 1, 1] and all(abs(r.explained - 1) < 1e-9 for r in line)
    two = run([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.5]), (4, [0.5]), (5, [0.25])])
    assert sorted((r.vec_id, r.component) for r in two) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2), (4, 1), (5, 1)]


@pytest.mark.parametrize("values", [[3, 3, 3, 1, 0, 0], [5.0, 5 - 1e-9, 5 - 1e-7, 4, 3, 1e-9], [2.0] * 6])
def test_directions_stay_orthogonal_where_values_meet(values):
    rng = np.random.default_rng(6)
    for turn in (np.eye(6), np.linalg.qr(rng.normal(size=(6, 6)))[0]):
        r = np.linalg.qr(np.diag(values) @ turn, mode="r")
        squares, directions = WH.principal(r, 4, 100)
        assert np.allclose(np.sqrt(squares), values[:4], rtol=1e-12)
        w = r @ directions / np.sqrt(squares)
        assert np.abs(w.T @ w - np.eye(4)).max() < 1e-6

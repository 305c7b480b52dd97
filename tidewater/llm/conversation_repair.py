"""Conversation repair by a grammar-compressed dynamic programme.

A conversation's rows become a string of symbols, one a row: the role's initial (s, u, a
or another) and the row's fault (none, truncated, or blank/duplicate, which must go).
Re-Pair rounds replace the most frequent neighbouring symbols by new ones, over all
conversations at once; occurrences count, so what many conversations share becomes few
symbols. Each rule has one min-plus transfer matrix over the four states of
``(s?(ua)+)?``: the cheapest edits that lead from one state to another across all rows
the rule stands for. A matrix is the product of those of the rule's two symbols, made
bottom-up once and shared by all conversations. Its audit is a rope: an entry only notes
the state between its halves; letters are spelled out when asked for.

Ties go to the ASCII-least audit. Two audits of the same rows and the same cost are never
one the other's beginning (what is longer would hold more insertions and cost more), so
the least audit of a whole is made of least audits of its parts. Along a conversation a
vector of four states is kept; which of two audits is less is known from a rank and the
insertions at the end, so the audit itself is a chain that is read once, at the end.

Plan: narrow rows (digest instead of text) find duplicates by grouped minima, met through
``join_groups``; rows are range-partitioned by conversation and order, so a hot
conversation is spread, and leave as chunks of at most ``CHUNK`` symbols. A conversation's
chunks meet in one task as a stream. The repaired text's checksum takes the rows in order,
as SHA-256 can only be fed in order: one stream a conversation, of which nothing but the
hash, the audit and a batch of rows is held.

Defined cases: null roles and texts are one space; a conversation's rows are taken by turn
(null first), then role, then the text's SHA-256; turns repeat freely, repeated rows are
rows; a null conv_id is a conversation of its own; roles are told by their first letter,
case counts, any other letter is neither s, u nor a; conversations of ``ids`` without rows
have zeros, an empty audit and the hash of the empty string; no ids give no rows; other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import join_groups, stage

#: Edit costs: rerole, delete, insert, and what a truncated row that stays adds.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Symbols in one chunk at most; rules of the grammar at most (a limit of compression only:
#: symbols that no rule joins are taken one by one).
CHUNK, RULES = 256, 2048
CLASSES = "suax"
SOUND, CUT, GONE = 0, 1, 2
FIRST_RULE = 0x100
#: States: nothing yet, after s, after u, after a.
STATES = range(4)
#: Where an output role leads.
STEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: Cheapest insertions from one state to another: how many.
INSERTS = {(0, 0): 0, (1, 1): 0, (2, 2): 0, (3, 3): 0, (0, 2): 1, (1, 2): 1, (3, 2): 1, (2, 3): 1, (0, 3): 2, (1, 3): 2}

CHUNKS = ("conv_id long, part long, seq long, symbols string, turns long, first_turn long, last_turn long, "
          "blank long, duplicate long, truncated long, illegal long")
VERDICT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


# --- the grammar ---------------------------------------------------------------------------------

def symbol(role_class: int, fault: int) -> str:
    return chr(ord("A") + 3 * role_class + fault)


def _terminal(sym: str) -> dict[tuple[int, int], tuple[int, str]]:
    """(state, state) -> (cost, audit) of one row, insertions before it included."""
    role, fault = divmod(ord(sym) - ord("A"), 3)
    ways = [(i, i, DELETE, "D") for i in STATES]
    if fault != GONE:
        extra = TRUNCATED if fault == CUT else 0
        ways += [(i, j, extra, "K") for i, j in STEP.get(CLASSES[role], {}).items()]
        ways += [(i, j, REROLE + extra, "R") for to in "ua" for i, j in STEP[to].items()]
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for (i, k), times in INSERTS.items():
        for k2, j, cost, letter in ways:
            if k == k2:
                new = (cost + INSERT * times, "I" * times + letter)
                if (i, j) not in best or new < best[i, j]:
                    best[i, j] = new
    return best


class Grammar:
    """Rules in rounds (pair of symbols -> symbol) and a transfer matrix a symbol."""

    def __init__(self) -> None:
        self.rounds: list[dict[str, str]] = []
        self.pairs: dict[str, str] = {}
        self.costs: dict[str, dict[tuple[int, int], int]] = {}
        self.ropes: dict[str, dict[tuple[int, int], object]] = {}
        for code in range(ord("A"), ord("A") + 3 * len(CLASSES)):
            made = _terminal(chr(code))
            self.costs[chr(code)] = {k: v[0] for k, v in made.items()}
            self.ropes[chr(code)] = {k: v[1] for k, v in made.items()}

    def add_round(self, chosen: list[str]) -> None:
        names = {pair: chr(FIRST_RULE + len(self.pairs) + k) for k, pair in enumerate(chosen)}
        self.rounds.append(names)
        for pair, name in names.items():
            self.pairs[name] = pair
            left, right = self.costs[pair[0]], self.costs[pair[1]]
            costs, ropes = {}, {}
            for i, mid in left:
                for mid2, j in right:
                    if mid != mid2:
                        continue
                    cost = left[i, mid] + right[mid, j]
                    old = costs.get((i, j))
                    if old is None or cost < old or cost == old and \
                            self._spelled(pair, i, mid, j) < self._spelled(pair, i, ropes[i, j], j):
                        costs[i, j], ropes[i, j] = cost, mid
            self.costs[name], self.ropes[name] = costs, ropes

    def _spelled(self, pair: str, i: int, mid: int, j: int) -> str:
        return self.audit(pair[0], i, mid) + self.audit(pair[1], mid, j)

    def audit(self, sym: str, i: int, j: int) -> str:
        """The letters of a matrix entry, read along its rope."""
        out, open_ = [], [(sym, i, j)]
        while open_:
            sym, i, j = open_.pop()
            held = self.ropes[sym][i, j]
            if isinstance(held, str):
                out.append(held)
            else:
                pair = self.pairs[sym]
                open_ += [(pair[1], held, j), (pair[0], i, held)]
        return "".join(out)

    def compress(self, symbols: str) -> str:
        for names in self.rounds:
            if len(symbols) < 2:
                break
            out, at, end = [], 0, len(symbols)
            while at < end:
                name = names.get(symbols[at:at + 2])
                out.append(name or symbols[at])
                at += 2 if name else 1
            symbols = "".join(out)
        return symbols


def choose(counted: list[tuple[str, int]], room: int) -> list[str]:
    """Of pairs in falling frequency those that cannot overlap with one chosen before."""
    lefts, rights, out = set(), set(), []
    for pair, _ in counted:
        a, b = pair
        if len(out) < room and a not in rights and b not in lefts and (a != b or a not in lefts and b not in rights):
            out.append(pair)
            lefts.add(a)
            rights.add(b)
    return out


def learn_grammar(sequences: DataFrame, rules: int = RULES) -> Grammar:
    """Re-Pair over staged ``sequences`` (symbols, n: how often), some rules a round."""
    grammar = Grammar()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for b in batches:
            for symbols, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                short = grammar.compress(symbols)
                at = 0
                while at < len(short) - 1:
                    pair = short[at:at + 2]
                    seen[pair] += n
                    at += 2 if short[at + 2:at + 3] == pair[0] == pair[1] else 1  # xxx holds xx once
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["pair", "n"])

    while (room := rules - len(grammar.pairs)) > 0:
        pairs = sequences.mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1")
        chosen = choose([(r.pair, r.n) for r in pairs.orderBy(F.desc("n"), "pair").limit(4 * rules).collect()], room)
        if not chosen:
            break
        grammar.add_round(chosen)
    return grammar


class Walk:
    """The cheapest edits of a conversation's rows so far, for each state."""

    def __init__(self, grammar: Grammar):
        self.grammar, self.spelled = grammar, {}
        # state -> (cost, rank of the audit without the insertions at its end, these, chain)
        self.at = {0: (0, 0, 0, None)}

    def _piece(self, sym: str, i: int, j: int) -> str:
        if (sym, i, j) not in self.spelled:
            self.spelled[sym, i, j] = self.grammar.audit(sym, i, j)
        return self.spelled[sym, i, j]

    def step(self, sym: str) -> None:
        best: dict[int, tuple] = {}
        for (i, j), cost in self.grammar.costs[sym].items():
            if i in self.at:
                so_far, rank, tail, chain = self.at[i]
                if j in best and so_far + cost > best[j][0]:
                    continue
                piece = self._piece(sym, i, j)
                new = (so_far + cost, rank, "I" * tail + piece)
                if j not in best or new < best[j][:3]:
                    best[j] = (*new, (chain, piece))
        cores = {j: (v[1], v[2].rstrip("I")) for j, v in best.items()}
        ranks = {core: k for k, core in enumerate(sorted(set(cores.values())))}
        self.at = {j: (v[0], ranks[cores[j]], len(v[2]) - len(cores[j][1]), v[3]) for j, v in best.items()}

    def end(self) -> tuple[int, str]:
        cost, _, _, times, chain = min((self.at[i][0] + INSERT * n, self.at[i][1], "I" * (self.at[i][2] + n), n, self.at[i][3])
                                       for (i, j), n in INSERTS.items() if i in self.at and j in (0, 3))
        pieces = ["I" * times]
        while chain:
            chain, piece = chain
            pieces.append(piece)
        return cost, "".join(reversed(pieces))


# --- rows to chunks ------------------------------------------------------------------------------

WHITE = r"\x20\x09-\x0D"


def _clean(rows: DataFrame) -> DataFrame:
    one = F.lit(" ")
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text")) \
        .withColumn("digest", F.unhex(F.sha2("text", 256)))


def _narrow(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their number and whether their first copy is a duplicate."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    marked = rows.select("conv_id", "turn", "role", "digest", (~F.col("text").rlike(f"[^{WHITE}]")).alias("blank"),
                         (~last.isin(".", "!", "?")).alias("cut"))
    alike = stage(marked.groupBy(*marked.columns).agg(F.count("*").alias("n")), "conversation-rows")
    same = ["conv_id", "role", "digest"]
    turn = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))
    firsts = stage(alike.groupBy(*same).agg(F.count("*").alias("turns"), F.min(turn).alias("first")).filter("turns > 1"), "first-rows")
    return join_groups(alike, firsts, same, "turns") \
        .withColumn("seen", F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))).drop("first", "turns")


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order to chunks; a partition's chunks follow those of the one before."""
    from pyspark import TaskContext
    part, seq = TaskContext.get().partitionId(), 0
    names = [c.split()[0] for c in CHUNKS.split(", ")]
    out: dict[str, list] = {c: [] for c in names}
    conv, symbols, turns, first_turn, last_turn, blank, duplicate, truncated, illegal = None, [], 0, None, None, 0, 0, 0, 0

    def close() -> None:
        for name, value in zip(names, (conv, part, seq, "".join(symbols), turns, first_turn, last_turn, blank, duplicate, truncated, illegal)):
            out[name].append(value)

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(out[c], pa.string() if c == "symbols" else pa.int64()) for c in names], names=names)
        for c in names:
            out[c].clear()
        return made

    before = ""
    for b in batches:
        for new, turn, role, is_blank, cut, n, seen in zip(*(b.column(k).to_pylist() for k in range(7))):
            kind = CLASSES.find(role[0]) if role and role[0] in CLASSES else 3
            copies = 0
            while copies < n:
                if symbols and (new != conv or len(symbols) >= CHUNK):
                    close()
                    seq += 1
                    symbols, turns, first_turn, last_turn, blank, duplicate, truncated, illegal = [], 0, None, None, 0, 0, 0, 0
                conv = new
                take = min(1 if not copies else n, n - copies, CHUNK - len(symbols))  # the first copy alone
                if is_blank:
                    fault, blank = GONE, blank + take
                elif seen or copies:
                    fault, duplicate = GONE, duplicate + take
                else:
                    fault, truncated = (CUT, truncated + take) if cut else (SOUND, truncated)
                if symbols:
                    illegal += before + CLASSES[kind] not in ("su", "ua", "au")
                illegal += take - 1  # equal neighbours never fit
                before = CLASSES[kind]
                symbols += [symbol(kind, fault)] * take
                copies += take
                if turn is not None:
                    turns += turn != last_turn
                    first_turn, last_turn = turn if first_turn is None else first_turn, turn
        if len(out["conv_id"]) >= 4096:
            yield batch()
    if symbols:
        close()
    yield batch()


def _chunks(narrow: DataFrame) -> DataFrame:
    order = ["conv_id", "turn", "role", "digest"]
    dealt = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("conv_id", "turn", "role", "blank", "cut", "n", "seen").mapInArrow(_chunk, CHUNKS)


def _fold(grammar: Grammar):
    """Chunks in order to one verdict a conversation."""
    names = [c.split()[0] for c in VERDICT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        started, conv, walk, state, last = False, None, None, None, ""
        spelled: dict = {}
        known: dict[str, tuple[int, str]] = {}  # of conversations that are one chunk

        def begin(new) -> None:
            nonlocal conv, walk, state, started, last
            conv, started, last = new, True, ""
            walk, state = [], {"low": None, "high": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

        def verdict() -> tuple[int, str]:
            if isinstance(walk, Walk):
                return walk.end()
            if not walk:
                return 0, ""
            if walk[0] not in known:
                if len(known) >= 100_000:
                    known.clear()
                known[walk[0]] = follow(Walk(grammar), walk[0]).end()
            return known[walk[0]]

        def follow(on: Walk, symbols: str) -> Walk:
            on.spelled = spelled
            for sym in grammar.compress(symbols):
                on.step(sym)
            return on

        def close() -> None:
            cost, audit = verdict()
            gaps = state["high"] - state["low"] + 1 - state["turns"] if state["turns"] else 0
            out.append((conv, gaps, state["blank"], state["duplicate"], state["truncated"], state["illegal"], cost, audit))

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.string() if c == "audit" else pa.int64()) for k, c in enumerate(names)], names=names)
            out.clear()
            return made

        for b in batches:
            for r in b.to_pylist():
                if not started or r["conv_id"] != conv:
                    if started:
                        close()
                    begin(r["conv_id"])
                symbols = r["symbols"]
                if not symbols:
                    continue
                if isinstance(walk, Walk):
                    follow(walk, symbols)
                elif walk:
                    walk = follow(follow(Walk(grammar), walk[0]), symbols)
                else:
                    walk = [symbols]
                first, end = (CLASSES[(ord(c) - ord("A")) // 3] for c in (symbols[0], symbols[-1]))
                state["illegal"] += bool(last) and last + first not in ("su", "ua", "au")
                last = end
                if r["first_turn"] is not None:
                    state["turns"] += r["turns"] - (state["high"] == r["first_turn"])
                    state["low"] = r["first_turn"] if state["low"] is None else state["low"]
                    state["high"] = r["last_turn"]
                for c in ("blank", "duplicate", "truncated", "illegal"):
                    state[c] += r[c]
            if len(out) >= 4096:
                yield batch()
        if started:
            close()
        yield batch()

    return run


# --- the repaired text ---------------------------------------------------------------------------

class Rebuilt:
    """Follows an audit along a conversation's rows and hashes what is left."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.hash, self.lines = audit, 0, 0, hashlib.sha256(), 0

    def _line(self, role: str, text: str, initial: str) -> None:
        self.hash.update(("\n" if self.lines else "").encode() + role.encode() + b":" + text.encode())
        self.lines += 1
        self.state = STEP[initial][self.state]

    def _inserted(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self._due("")

    def _due(self, text: str) -> None:
        self._line(*(("assistant", text, "a") if self.state == 2 else ("user", text, "u")))

    def row(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._line(role, text, role[0])
        elif edit == "R":
            self._due(text)

    def end(self) -> str:
        self._inserted()
        return self.hash.hexdigest()


RESULT = VERDICT + ", repaired_sha256 string"


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's verdict, then its rows in order, to the verdict and the hash."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    out: list[tuple] = []
    verdict, rebuilt = None, None

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.string() if c in ("audit", "repaired_sha256") else pa.int64())
                                           for k, c in enumerate(names)], names=names)
        out.clear()
        return made

    for b in batches:
        for conv, is_row, role, text, *figures in zip(*(b.column(k).to_pylist() for k in range(b.num_columns))):
            if not is_row:
                if rebuilt:
                    out.append((*verdict, rebuilt.end()))
                verdict, rebuilt = (conv, *figures, text), Rebuilt(text)
            else:
                rebuilt.row(role, text)
        if len(out) >= 4096:
            yield batch()
    if rebuilt:
        out.append((*verdict, rebuilt.end()))
    yield batch()


def repair(rows: DataFrame, ids: DataFrame, rules: int = RULES) -> DataFrame:
    """One row for each conversation of ``ids`` (conv_id): faults, the cheapest edits of its
    ``rows`` (conv_id, turn, role, text) and the repaired text's SHA-256."""
    rows = _clean(rows)
    chunks = stage(_chunks(_narrow(rows)), "chunks")
    grammar = learn_grammar(stage(chunks.groupBy("symbols").agg(F.count("*").alias("n")), "sequences"), rules)
    none = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct() \
        .select("conv_id", F.lit(-1).cast("long").alias("part"), F.lit(0).cast("long").alias("seq"), F.lit("").alias("symbols"),
                *[F.lit(None).cast("long").alias(c.split()[0]) for c in CHUNKS.split(", ")[4:]])
    verdicts = stage(chunks.unionByName(none).repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
                     .mapInArrow(_fold(grammar), VERDICT), "verdicts")

    figures = [c.split()[0] for c in VERDICT.split(", ")[1:-1]]
    zero = F.lit(0).cast("long")
    heads = verdicts.select("conv_id", zero.alias("is_row"), F.lit("").alias("role"), F.col("audit").alias("text"), *figures,
                            zero.alias("turn"), F.lit(None).cast("binary").alias("digest"))
    lines = rows.select("conv_id", F.lit(1).cast("long").alias("is_row"), "role", "text",
                        *[F.lit(None).cast("long").alias(c) for c in figures], "turn", "digest")
    return heads.unionByName(lines).repartition("conv_id").sortWithinPartitions("conv_id", "is_row", "turn", "role", "digest") \
        .drop("turn", "digest").mapInArrow(_rebuild, RESULT)

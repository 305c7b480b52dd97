"""Main text of web pages by wrappers: union-free regular expressions over tokens.

Pages of a host come from few templates. A wrapper is such a template: a tree of
tags whose children are a sequence of elements, optional items, repeated groups
and text slots. It is inferred by folding pages in one after the other: child
sequences are aligned, equal tags are matched and folded recursively; a mismatch
becomes an optional item; a run of equal tag patterns becomes a repeated group;
texts that differ become a variable slot, equal ones stay part of the template.
Folding two wrappers is the same operation, so workers fold the pages they read
and partial wrappers meet in two steps (host and salt, then host), streaming: a
host with a third of all pages is many partial folds, never one collected group.

A host has two wrappers: of its pages with an article or main element and of those
without. On the former, main text is what stands inside that element, outside of
menus, adverts, forms, comments and the like; on the latter, what stands outside of
these and outside of lists of links. Wrappers are joined to the pages by host and
every page is matched with its wrapper, so that each block of its text has a slot: a
position in the wrapper, one for all occurrences in a group. The blocks in a slot are counted over all pages (aggregates, no key is
collected): a block that stands in a slot on every page that has the slot, and on
two different pages at least, is template and goes. Pages with the same longest
block are copies of one page.

Defined cases: null and empty html, and html without main text or without any
element, give an empty text; a null or malformed url belongs to the host ``''``; repeated rows are cut
one by one; very long pages are read whole; an empty table gives no rows. Other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import broadcast_if_small, small_batches, stage

DEPTH = 120  # levels of a tree that are told apart; all text is kept

# Fixed values of the HTML standard and of common page markup.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg iframe object select".split())
INLINE = frozenset("abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
BLOCKS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
MAIN_TAGS = frozenset(["article", "main"])
BOILERPLATE_TAGS = frozenset("head nav aside footer form menu button dialog".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright discussion disqus footer legal login masthead menu modal nav navbar navigation newsletter "
    "notice notices pager pagination popup promo promotion recommended related reply replies respond responses search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s>/]*)[^>]*>|"
                   r"<([a-zA-Z][^\s>/]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
NO_NAME = re.compile(r"[^a-z-]+")


def _label(tag: str, attributes: str) -> str:
    """Tag and the whole tokens of its class, id and role, without digits."""
    if not attributes or "=" not in attributes:
        return tag
    tokens = [w.lower() for m in NAMES.finditer(attributes) for w in (m[2] or m[3] or m[4] or "").split()]
    words = {NO_NAME.sub("_", re.sub("[0-9]+", "", w)).strip("-_") for w in tokens}
    return ".".join([tag, *sorted(words - {""})])


def parse(page: str) -> list:
    """A page as nested [label, child, ...] lists; texts are strings. Inline
    markup is transparent, end tags that were left out are supplied."""
    root: list = ["#root"]
    stack, names, at = [root], ["#root"], 0
    ended: dict[int, bool] = {}  # place of an open element's start -> does its end tag follow?
    starts = [0]

    def text(piece: str) -> None:
        if piece and not piece.isspace():
            stack[-1].append(html.unescape(piece))
        elif piece:
            stack[-1].append(" ")

    def pop_to(k: int) -> None:
        del stack[k:], names[k:], starts[k:]

    while True:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            return root
        text(page[at:m.start()])
        at = m.end()
        end, start = m[1], m[2]
        if end is not None:
            name = end.lower()
            if name in names and name not in INLINE:
                pop_to(len(names) - 1 - names[::-1].index(name))
            continue
        if start is None:
            continue
        name = start.lower()
        if name in INLINE:
            continue
        if name in RAW:  # its content is not markup
            if not m[3].endswith("/"):
                close = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
                at = len(page) if close is None else page.find(">", close.start()) + 1 or len(page)
            continue
        if name == "br":
            stack[-1].append(" ")
            continue
        if name in BLOCKS and "p" in names:
            k = len(names) - 1 - names[::-1].index("p")
            if not any(n in ("td", "th", "table", "li") for n in names[k:]):
                pop_to(k)
        for other in CLOSED_BY.get(name, ()):
            if other in names:
                k = len(names) - 1 - names[::-1].index(other)
                if not any(n in ("ul", "ol", "dl", "table", "select") for n in names[k:]):
                    pop_to(k)
        if name in MAIN_TAGS:  # a menu or notice whose end tag is missing ends here
            for k, s in enumerate(stack):
                if names[k] == "form":  # a form around the article is the page's frame
                    s[0] = "div" + s[0][len(s[0].split(".")[0]):]
                bad = _is_boilerplate(s[0], "article" in names[:k])
                if bad and names[k] not in ("aside", "footer") and not _comments(s[0]):
                    if starts[k] not in ended:
                        ended[starts[k]] = _end_follows(page, m.start(), names[k], names[k:].count(names[k]))
                    if not ended[starts[k]]:
                        pop_to(k)
                        break
        if len(stack) >= DEPTH:  # deeper elements add their text to the deepest one kept
            if name not in VOID and not m[3].endswith("/"):
                stack.append(stack[-1])
                names.append(name)
                starts.append(at)
            continue
        node: list = [_label(name, m[3])]
        stack[-1].append(node)
        if name not in VOID and not m[3].endswith("/"):
            stack.append(node)
            names.append(name)
            starts.append(at)


def _end_follows(page: str, at: int, name: str, depth: int) -> bool:
    """Does the end tag of the outermost of ``depth`` open elements come after ``at``?"""
    while (m := TOKEN.search(page, at)) is not None:
        at = m.end()
        tag = (m[1] or m[2] or "").lower()
        if m[2] and tag in RAW and not m[3].endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = len(page) if close is None else page.find(">", close.start()) + 1 or len(page)
        elif tag == name:
            depth += -1 if m[1] else not m[3].endswith("/")
            if not depth:
                return True
    return False


def _is_boilerplate(label: str, in_article: bool = False) -> bool:
    """By tag, or by a token that is such a word; tokens do not count on the frame of
    a page: html, body, main and an article that is not inside another one."""
    tag, *words = label.split(".")
    if tag in ("html", "body", "main") or (tag == "article" and not in_article):
        return False
    return tag in BOILERPLATE_TAGS or not BOILERPLATE_WORDS.isdisjoint(words) or (tag == "header")


def _comments(label: str) -> bool:
    return not {"comment", "comments", "reply", "replies", "respond", "responses", "discussion", "disqus"}.isdisjoint(label.split("."))


# A wrapper item is a list [kind, optional, body]: kind "t" with the constant text or
# None for a variable slot, kind "e:<label>" with the child items, kind "+" with the
# items of a repeated group.

def items_of(node: list) -> list:
    """The children of a parsed element as wrapper items; runs of patterns are folded."""
    out: list = []
    for child in node[1:]:
        if isinstance(child, str):
            words = " ".join(child.split())
            if not words:
                continue
            if out and out[-1][0] == "t":
                out[-1][2] = None
            else:
                out.append(["t", 0, words if len(words) <= 80 else None])
        else:
            out.append(["e:" + child[0], 0, items_of(child)])
    return fold_runs(out)


def _key(item: list) -> str:
    return item[0] if item[0] != "+" else "+(" + " ".join(_key(i) for i in item[2]) + ")"


def _merge_item(a: list, b: list) -> list:
    if a[0] == "t":
        return ["t", a[1] | b[1], a[2] if a[2] == b[2] else None]
    return [a[0], a[1] | b[1], align(a[2], b[2])]


def fold_runs(items: list) -> list:
    """Equal neighbouring patterns of up to three items become a repeated group."""
    for width in (1, 2, 3):
        out, i = [], 0
        keys = [_key(x) for x in items]
        while i < len(items):
            pattern = keys[i:i + width]
            j = i + width
            usable = len(pattern) == width and any(k.startswith("e:") for k in pattern) and not any(k.startswith("+") for k in pattern)
            if usable and keys[j:j + width] == pattern:
                group = items[i:j]
                while keys[j:j + width] == pattern:
                    group = [_merge_item(a, b) for a, b in zip(group, items[j:j + width])]
                    j += width
                out.append(["+", 0, group])
                i = j
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def _same(a: list, b: list) -> bool:
    """May two items be matched? A group takes in a single occurrence of its pattern."""
    ka, kb = _key(a), _key(b)
    return ka == kb or (a[0] == "+" and len(a[2]) == 1 and _key(a[2][0]) == kb) \
        or (b[0] == "+" and len(b[2]) == 1 and _key(b[2][0]) == ka)


def _join(a: list, b: list) -> list:
    if a[0] == "+" or b[0] == "+":
        left, right = (x[2] if x[0] == "+" else [x] for x in (a, b))
        return ["+", a[1] | b[1], [_merge_item(x, y) for x, y in zip(left, right)]]
    return _merge_item(a, b)


def align(a: list, b: list) -> list:
    """Two child sequences to one: a longest common alignment, the rest optional."""
    if len(a) == len(b) and all(_same(x, y) for x, y in zip(a, b)):
        return [_join(x, y) for x, y in zip(a, b)]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if _same(a[i], b[j]) else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and _same(a[i], b[j]) and best[i][j] == best[i + 1][j + 1] + 1:
            out.append(_join(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j >= m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], 1, a[i][2]])
            i += 1
        else:
            out.append([b[j][0], 1, b[j][2]])
            j += 1
    return fold_runs(out)


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def has_main(node: list) -> bool:
    """Does a parsed page hold an article or main element outside of boilerplate?"""
    return any(not _is_boilerplate(c[0]) and (c[0].split(".")[0] in MAIN_TAGS or has_main(c))
               for c in node[1:] if not isinstance(c, str))


class Sequence:
    """The items of an element in a row, those of a group one after the other: place,
    child items and, for an item of a group, its first and last index."""

    def __init__(self, items: list):
        self.rows: list[tuple[str, list | None, int, int]] = []
        self.by_key: dict[str, list[int]] = {}
        for k, item in enumerate(items):
            group = item[2] if item[0] == "+" else [item]
            first = len(self.rows)
            last = first + len(group) - 1 if item[0] == "+" else -1
            for q, (kind, _, body) in enumerate(group):
                self.by_key.setdefault(kind, []).append(len(self.rows))
                self.rows.append((f"{k}.{q}" if item[0] == "+" else str(k), body if kind != "t" else None, first, last))


def _places(node: list, items: list, known: dict[int, Sequence]) -> Iterator[tuple[str | None, list | None]]:
    """Place and child items of the item that each child of an element is matched with:
    a group starts again at its end, else the next item of the same kind, else the
    first one; None without such an item. ``known`` holds the sequences by items."""
    if id(items) not in known:
        known[id(items)] = Sequence(items)
    seq, at, text = known[id(items)], -1, False
    for child in node[1:]:
        if isinstance(child, str):
            key, again = "t", text or child.isspace()  # neighbouring texts are one item
            text = text or not child.isspace()
            if again:
                yield (None if at < 0 or not text else seq.rows[at][0]), None
                continue
        else:
            key, text = "e:" + child[0], False
        found = seq.by_key.get(key)
        if found is None:
            yield None, None
            continue
        if at >= 0 and seq.rows[at][3] == at and seq.rows[at][2] in found:
            at = seq.rows[at][2]
        else:
            k = bisect_right(found, at)
            at = found[k] if k < len(found) else found[0]
        yield seq.rows[at][:2]


#: The items below an element that the wrapper does not hold.
OUTSIDE: list = []


class Rules:
    """A template and the digests (slot, text) of its constant blocks."""

    def __init__(self, items: list, constant: set[tuple[int, int]]):
        self.items, self.constant = items, constant
        self.known: dict[int, Sequence] = {}


def slot_rules(items: list, constant: set[tuple[int, int]] | None = None) -> Rules:
    """The rules of a template; its own constant texts where no counted ones are given."""
    def walk(level: list, path: str) -> Iterator[tuple[int, int]]:
        for place, body, kind in ((f"{k}.{q}" if item[0] == "+" else str(k), x[2], x[0])
                                  for k, item in enumerate(level) for q, x in enumerate(item[2] if item[0] == "+" else [item])):
            if kind != "t":
                yield from walk(body, f"{path}/{place}")
            elif body is not None:
                yield from ((_digest(f"{kind_of_page}{path}/{place}"), _digest(body)) for kind_of_page in ("", "main:"))

    return Rules(items, set(walk(items, "")) if constant is None else constant)


def blocks(tree: list, rules: Rules) -> list[tuple[int | None, str]]:
    """(slot, text) of a page's blocks in page order, the slot being the place of the
    block's first text in the wrapper (None outside of it): those inside its main element or,
    on a page without one, all outside of boilerplate and lists of links. Text on a
    page without any element is in no slot."""
    out: list[tuple[int | None, str]] = []
    run: list[str] = []
    slot: list[str | None] = [None]
    wanted = has_main(tree)
    begun = [False]

    def close() -> None:
        words = " ".join("".join(run).split())
        run.clear()
        begun[0] = False
        if words:
            out.append((None if slot[0] is None else _digest(slot[0]), words))

    def walk(node: list, items: list, path: str | None, main: bool, dropped: bool, links: bool, article: bool) -> None:
        keep = not dropped and (main if wanted else not links)
        for child, (place, body) in zip(node[1:], _places(node, items, rules.known)):
            below = None if path is None or place is None else f"{path}/{place}"
            if isinstance(child, str):
                if keep:
                    if not begun[0] and not child.isspace():
                        begun[0], slot[0] = True, below
                    run.append(child)
                continue
            tag = child[0].split(".")[0]
            if tag != "a":
                close()
            bad = dropped or (_is_boilerplate(child[0], article) and not (main and tag == "header"))
            inside = [x[0].split(".")[0] for x in body] if body is not None else \
                ["e:" + c[0].split(".")[0] if not isinstance(c, str) else "t" for c in child[1:] if not isinstance(c, str) or not c.isspace()]
            listed = tag == "li" and inside in (["e:a"], [])
            walk(child, OUTSIDE if body is None else body, below, main or tag in MAIN_TAGS, bad, links or listed, article or tag == "article")
            if tag != "a":
                close()

    if any(not isinstance(c, str) for c in tree[1:]):
        walk(tree, rules.items, "main:" if wanted else "", False, False, False, False)
        close()
    return out


def main_text(page: str, rules: Rules, of_main: Rules | None = None) -> str:
    """The kept blocks of a page, joined by one space. ``of_main``: the rules of pages
    with a main element, where they have a template of their own."""
    tree = parse(page)
    if of_main is not None and has_main(tree):
        rules = of_main
    return " ".join(t for s, t in blocks(tree, rules) if (s, _digest(t)) not in rules.constant)


def _fold(df: DataFrame, keys: list[str]) -> DataFrame:
    """Partial wrappers with equal keys folded; rows of a key arrive one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int32()),
                                               pa.array([json.dumps(held)])], names=["host", "salt", "wrapper"])

        for b in batches:
            for host, salt, wrapper in zip(*(c.to_pylist() for c in b.columns)):
                now = (host, salt)
                if key is not None and now != key:
                    yield row()
                    held = None
                key = now
                w = json.loads(wrapper)
                held = w if held is None else [y if x is None else x if y is None else align(x, y) for x, y in zip(held, w)]
        if key is not None:
            yield row()

    return df.repartition(*keys).sortWithinPartitions(*keys) \
        .mapInArrow(run, "host string, salt int, wrapper string")


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): the wrappers of each host as JSON, that of its pages without a
    main element and that of its pages with one. ``pages``: host, html."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        salt = TaskContext.get().partitionId() % 32
        held: dict[str, list] = {}

        def flush() -> pa.RecordBatch:
            hosts, found = list(held), [json.dumps(w) for w in held.values()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array([salt] * len(hosts), pa.int32()),
                                               pa.array(found, pa.string())], names=["host", "salt", "wrapper"])

        for b in batches:
            for host, page in zip(*(c.to_pylist() for c in b.columns)):
                tree = parse(page)
                kind, w = has_main(tree), items_of(tree)
                mine = held.setdefault(host, [None, None])
                mine[kind] = w if mine[kind] is None else align(mine[kind], w)
            if len(held) > 2000:
                yield flush()
        yield flush()

    partial = pages.filter("html <> ''").select("host", "html").mapInArrow(run, "host string, salt int, wrapper string")
    by_salt = _fold(partial, ["host", "salt"]).withColumn("salt", F.lit(0).cast("int"))
    return _fold(by_salt, ["host"]).select("host", "wrapper")


def _rules(wrapper: str, constant: str | None = None) -> list[Rules]:
    """Both rules of a host; ``constant`` holds slot:text digests."""
    pairs = {(int(s), int(t)) for s, t in (c.split(":") for c in (constant or "").split())}
    return [slot_rules(w or [], pairs) for w in json.loads(wrapper)]


def constant_blocks(pages: DataFrame) -> DataFrame:
    """(host, constant): blocks that stand in a slot on every page of the host's template
    that has the slot, and on two different pages at least; pages with the same longest
    block are copies. ``pages``: host, html, wrapper."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list] = {}  # pages, text digest -> smallest and largest page
        rules: dict[str, list[Rules]] = {}

        def flush() -> pa.RecordBatch:
            rows = []
            for (host, slot), (n, texts) in held.items():
                rows.append((host, slot, None, n, None, None))
                rows += [(host, slot, t, n, lo, hi) for t, (lo, hi) in texts.items()]
            held.clear()
            cols = list(zip(*rows)) or [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                                              names=["host", "slot", "text", "n", "lo", "hi"])

        for b in batches:
            for host, page, wrapper in zip(*(c.to_pylist() for c in b.columns)):
                if wrapper not in rules:
                    if len(rules) > 1000:
                        rules.clear()
                    rules[wrapper] = _rules(wrapper)
                tree = parse(page)
                found = blocks(tree, rules[wrapper][has_main(tree)])
                number = _digest(max((t for _, t in found), key=lambda t: (len(t), t), default=""))
                slots: dict[int, set[int]] = {}
                for slot, text in found:
                    if slot is not None:
                        slots.setdefault(slot, set()).add(_digest(text))
                for slot, texts in slots.items():
                    mine = held.get((host, slot))
                    if mine is None:
                        held[host, slot] = [1, {t: (number, number) for t in texts}]
                    else:  # a text that a page lacks is not constant
                        mine[0] += 1
                        mine[1] = {t: (min(lo, number), max(hi, number)) for t, (lo, hi) in mine[1].items() if t in texts}
            if len(held) > 50_000:
                yield flush()
        yield flush()

    parts = pages.mapInArrow(run, "host string, slot long, text long, n long, lo long, hi long")
    found = stage(parts.groupBy("host", "slot", "text").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")), "slots")
    every = found.filter("text IS NULL").select("host", "slot", F.col("n").alias("pages"))
    return found.filter("text IS NOT NULL AND lo <> hi").join(every, ["host", "slot"]).filter("n = pages") \
        .groupBy("host").agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "slot", "text"))), " ").alias("constant"))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html)."""
    small_batches(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"))
    wrappers = stage(infer_wrappers(read), "wrappers")
    known = read.filter("html <> ''").join(broadcast_if_small(wrappers, "wrapper"), "host").select("host", "html", "wrapper")
    wrappers = stage(wrappers.join(constant_blocks(known), "host", "left"), "wrappers-constant")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules: dict[tuple[str, str], list[Rules]] = {}
        for b in batches:
            texts = []
            for page, *key in zip(*(b.column(k).to_pylist() for k in (2, 3, 4))):
                key = tuple(key)
                if not page or key[0] is None:
                    texts.append("")
                    continue
                if key not in rules:
                    if len(rules) > 1000:
                        rules.clear()
                    rules[key] = _rules(*key)
                texts.append(main_text(page, *rules[key]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    joined = read.join(broadcast_if_small(wrappers, "wrapper"), "host", "left").select("page_id", "url", "html", "wrapper", "constant")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")

"""Main text of web pages by wrappers inferred per host.

A wrapper is a union-free regular expression over the token streams of a host's
pages: elements in order, some of them optional, some repeated, with text that is
the same on every page or a slot that differs.  Inference is iterative: a page's
stream folds its repeated groups (up to ``PERIOD`` elements long), and two streams
are aligned by their longest common sequence; what only one of them has becomes
optional, neighbours that are equal become a repeated group, and texts that
differ become a slot.  Wrappers align with each other like pages do, so each task
merges its own pages per host, and only wrappers are shuffled: a host with a third
of all pages sends one wrapper per task, in two steps.

The wrapper judges its slots, and a page is read by the verdicts of its host's
slots.  Boilerplate elements (menus, headers, footers, sidebars, notices, adverts,
forms, reader comments, hidden ones), told by element, role, class or id, are out.
Of the rest, the wrapper's verdicts decide, inside articles too: a block is out if
each of its texts is the same wherever the wrapper has its place, on at least
``LEAST_PAGES`` pages with different contents, or stands in a block that only ever
holds links (inside articles and ``main``: on as many such pages).  What is left of a
page's articles is its text; without any that of its ``main`` element; without either
all that is left.  A page whose articles or ``main`` hold nothing else keeps it.

White space includes all Unicode spaces.  A ``<br>`` and the border of a table cell
are white space; other block elements begin and end blocks.

Defined results: null and empty pages have an empty text; broken markup never
fails (an element left open ends with its parent, an unclosed menu ends where the
article begins); a null url is a host of its own; repeated rows are pages of their
own; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import sys
from bisect import bisect_right, insort
from collections.abc import Iterator
from html import unescape
from itertools import accumulate
from zlib import crc32

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---- fixed values ----
CONTENT = ("article", "main")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section"
    " select summary table tbody tfoot thead tr ul".split()
)
SPACES = frozenset("br td th img input".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol menu dl table tbody select article main body".split())
OUT_TAGS = frozenset("nav footer aside form head button select menu dialog svg canvas object audio video math".split()) | RAW
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
COMMENT_WORDS = frozenset("comment comments disqus replies respond".split())
OUT_WORDS = COMMENT_WORDS | frozenset(
    "ad ads advert advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent"
    " gdpr notice notices alert popup modal overlay newsletter subscribe subscription sidebar nav navbar navigation"
    " menu breadcrumb breadcrumbs masthead footer related share sharing social widget login signup search pagination"
    " pager toolbar hidden".split()
)
# ---- end of fixed values ----
PERIOD = 3
DEPTH = 64  # elements below this level are text of the last one above it, in wrappers and in pages
LEAST_PAGES = 3
FLUSH = 2000  # hosts that a task holds before it passes its wrappers on
STEPS = 16  # wrappers of a host that are merged by one key in the first step
ALIGN = 250_000  # cells of an alignment in one table; longer lists are cut at a cell of a best path

# Other tags, such as those with a value, are ended by ``Tags``.
TOKEN = re.compile(r"<!--|<[!?][^>]*>?|</?[a-zA-Z][^'\">=<]*+>|[^<]+|<")
TAG_STEP = re.compile(r">|=\s*([\"'])")
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?=[\s/>\"']|$)", re.I)
MARKED = re.compile(r"class|id|role|hidden|style", re.I)
OPENING = re.compile("</?[a-zA-Z]")
NAME = re.compile(r"</?([a-zA-Z][^\s/<>]*)")
WORDS = re.compile(r"[a-z]+")
LINES = re.compile(r"\d+")


def _key(tag: str, token: str, inside: bool) -> str:
    """The element's name in a wrapper; with ``-`` first if it is boilerplate, ``~`` if comments."""
    values: dict[str, str] = {}
    if MARKED.search(token):
        for name, *options in ATTRIBUTE.findall(token, len(tag) + 1):
            values.setdefault(name.lower(), next((o for o in options if o), "").lower())
    words = set(WORDS.findall(values.get("class", "") + " " + values.get("id", "")))
    hidden = (
        "hidden" in values
        or values.get("aria-hidden") == "true"
        or "display:none" in values.get("style", "").replace(" ", "")
    )
    label = tag
    for name, mark in (("class", "."), ("id", "#"), ("role", "@")):
        if values.get(name):
            label += mark + LINES.sub("0", ".".join(values[name].split()))
    label = label.replace("/", "_")
    if tag in ("html", "body", "main"):
        return label
    if words & COMMENT_WORDS:
        return "~" + label
    out = tag in OUT_TAGS or (tag == "header" and not inside) or values.get("role") in OUT_ROLES or hidden
    return ("-" if out or (tag != "article" and words & OUT_WORDS) else "") + label


class Tags:
    """Ends of tags: the first ">" outside a quoted value; quotes elsewhere mean nothing.

    Searches that found no end are remembered, so that all of them take linear time together.
    """

    def __init__(self, html: str):
        self.html = html
        self.dead: list[tuple[int, int]] = []  # ranges outside of values from which no end comes, in order
        self.dead_from = len(html)  # no more steps
        self.last = {q: html.rfind(q) for q in "\"'"}

    def end(self, at: int) -> int:
        """After the end of the tag that begins at ``at``, or -1."""
        passed = []
        while at < self.dead_from:
            known = bisect_right(self.dead, (at, len(self.html))) - 1
            if known >= 0 and at <= self.dead[known][1]:
                break
            step = TAG_STEP.search(self.html, at)
            if step is None:
                self.dead_from = at
                break
            if step.group() == ">":
                return step.end()
            passed.append((at, step.start()))
            quote = step.group(1)
            closed = self.last[quote] >= step.end()
            at = self.html.index(quote, step.end()) + 1 if closed else step.end()
        for some in passed:
            insort(self.dead, some)
        return -1


def events(html: str) -> Iterator[tuple[str, str]]:
    """``open`` and ``close`` with a key, ``text`` with a decoded text, ``break`` and ``space``."""
    stack: list[tuple[str, str]] = []
    at, size, content = 0, len(html), 0  # content: articles and main elements that are open
    last = html.rfind(">")
    tags = Tags(html)

    def pop(n: int) -> Iterator[tuple[str, str]]:
        nonlocal content
        while len(stack) > n:
            tag, key = stack.pop()
            content -= tag in CONTENT
            yield "close", key
            if tag in BLOCKS:
                yield "break", ""

    while at < size:
        if at > last and OPENING.match(html, at):
            break  # the page ends inside a tag
        match = TOKEN.match(html, at)
        token, begin, at = match.group(), at, match.end()
        if token == "<" and OPENING.match(html, begin):
            end = tags.end(begin)
            if end > 0:
                token, at = html[begin:end], end
        if token[0] != "<" or token == "<":
            yield "text", unescape(token)
            continue
        if token == "<!--":
            end = html.find("-->", at)
            at = size if end < 0 else end + 3
            continue
        if token[1] in "!?":
            continue
        tag = NAME.match(token).group(1).lower()
        if token[1] == "/":
            for n in range(len(stack) - 1, -1, -1):
                if stack[n][0] == tag:
                    yield from pop(n)
                    break
            if tag in BLOCKS:
                yield "break", ""
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}", re.I).search(html, at)
            at = end.start() if end else size
            close = html.find(">", at)
            at = size if close < 0 else close + 1
            continue
        if tag in CONTENT:
            # A menu, header or advert that was left open ends here; comments do not.
            for n, (_, key) in enumerate(stack):
                if key[0] == "~":
                    break
                if key[0] == "-":
                    yield from pop(n)
                    break
        if tag in CLOSES:
            for n in range(len(stack) - 1, -1, -1):
                if stack[n][0] in CLOSES[tag]:
                    yield from pop(n)
                if n >= len(stack) or stack[n][0] in HOLDS:
                    break
        elif tag in BLOCKS:
            for n in range(len(stack) - 1, -1, -1):
                if stack[n][0] == "p":
                    yield from pop(n)
                    break
                if stack[n][0] in BLOCKS:
                    break
        if tag in BLOCKS:
            yield "break", ""
        elif tag in SPACES:
            yield "space", ""
        if tag not in VOID and not token.endswith("/>"):
            key = _key(tag, token, content > 0)
            stack.append((tag, key))
            content += tag in CONTENT
            yield "open", key
    yield from pop(0)


# A node of a wrapper is [key, repeated, optional, text, children]; the key of a
# text is "#", that of a repeated group of elements "+".  ``text`` is a hash of the
# text that all pages have there, or "*" for a slot.  In place of children a text has
# hashes of the contents of pages that have it: ``LEAST_PAGES`` different ones at most.


def content_level(key: str) -> int:
    """Which of ``CONTENT`` an element is, or their number."""
    if key.startswith(CONTENT):
        name = re.split("[.#@]", key, maxsplit=1)[0]
        if name in CONTENT:
            return CONTENT.index(name)
    return CONTENT.index("main") if key.endswith("@main") else len(CONTENT)


def stream(html: str) -> list:
    """The folded token stream of a page, as the node of its root."""
    root = ["", False, False, None, []]
    path = [root]
    deeper = 0
    own: list[int] = []  # filled at the end; merged nodes of one page still share it
    levels: list[int | None] = [len(CONTENT)]  # of every open element: where its text counts
    contents = [0] * (len(CONTENT) + 1)
    for kind, value in events(html):
        if kind == "open":
            level = levels[-1]
            levels.append(None if level is None or value[0] in "-~" else min(level, content_level(value)))
        elif kind == "close":
            levels.pop()
        if kind == "open":
            if len(path) > DEPTH:
                deeper += 1
                continue
            node = [value, False, False, None, []]
            path[-1][4].append(node)
            path.append(node)
        elif kind == "close":
            if deeper:
                deeper -= 1
                continue
            node = path.pop()
            node[4] = fold(node[4])
        elif kind == "text" and not value.isspace():
            if deeper and levels[-1] is None:
                continue  # boilerplate is no part of the last element's text
            words = " ".join(value.split()).encode("utf-8", "replace")
            path[-1][4].append(["#", False, False, f"{crc32(words):x}", own])
            if levels[-1] is not None:
                contents[levels[-1]] = crc32(words, contents[levels[-1]])
    root[4] = fold(root[4])
    own.append(next((c for c in contents if c), 0))
    return root


def shape(node: list) -> tuple:
    """What must agree for two nodes to be the same element or group."""
    return (node[0], *map(shape, node[4])) if node[0] == "+" else (node[0],)


def fold(nodes: list) -> list:
    """Make one repeated node or group of neighbours that repeat."""
    for period in range(1, PERIOD + 1):
        out: list = []
        for node in nodes:
            out.append(node)
            while len(out) >= 2 * period and period == 1 and shape(out[-1]) == shape(out[-2]):
                last = out.pop()
                out[-1] = merge(out[-1], last)
                out[-1][1] = True
            if period == 1:
                continue
            tail = out[-period:]
            before = out[-2 * period : -period]
            group = out[-period - 1] if len(out) > period else None
            if group and group[0] == "+" and list(map(shape, group[4])) == list(map(shape, tail)):
                out[-period - 1 :] = [["+", True, group[2], None, [merge(a, b) for a, b in zip(group[4], tail)]]]
            elif len(before) == period and "+" not in {n[0] for n in before + tail}:
                if list(map(shape, before)) == list(map(shape, tail)):
                    out[-2 * period :] = [["+", True, False, None, [merge(a, b) for a, b in zip(before, tail)]]]
        nodes = out
    return nodes


def merge(a: list, b: list) -> list:
    """The wrapper of all that two nodes of the same shape match."""
    text = a[3] if a[3] == b[3] else "*"
    if a[0] == "#":
        pages = a[4] if a[4] is b[4] else sorted({*a[4], *b[4]})[:LEAST_PAGES]
        return ["#", a[1] or b[1], a[2] or b[2], text, pages]
    return [a[0], a[1] or b[1], a[2] or b[2], text, align(a[4], b[4])]


def common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """The pairs of a longest common sequence, in linear memory (Hirschberg)."""
    m, n = len(a), len(b)
    pairs = []
    if m * n <= ALIGN:
        longest = [[0] * (n + 1) for _ in range(m + 1)]
        for i in range(m - 1, -1, -1):
            for j in range(n - 1, -1, -1):
                same = a[i] == b[j]
                longest[i][j] = longest[i + 1][j + 1] + 1 if same else max(longest[i + 1][j], longest[i][j + 1])
        i = j = 0
        while i < m and j < n:
            if a[i] == b[j]:
                pairs.append((i, j))
                i, j = i + 1, j + 1
            elif longest[i + 1][j] >= longest[i][j + 1]:
                i += 1
            else:
                j += 1
        return pairs
    if m == 1:
        return [(0, b.index(a[0]))] if a[0] in b else []
    half = m // 2
    upper, lower = prefixes(a[:half], b), prefixes(a[:half - 1 : -1], b[::-1])
    cut = max(range(n + 1), key=lambda j: upper[j] + lower[n - j])
    pairs = common(a[:half], b[:cut])
    return pairs + [(half + i, cut + j) for i, j in common(a[half:], b[cut:])]


def prefixes(a: list[int], b: list[int]) -> list[int]:
    """Lengths of the longest common sequences of ``a`` and every prefix of ``b``, a row of bits at a time."""
    places: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    kept: dict[int, int] = {}  # rows of frequent numbers
    full = row = (1 << len(b)) - 1
    for x in a:
        if x not in places:
            continue
        bits = kept.get(x)
        if bits is None:
            own = bytearray(len(b) // 8 + 1)
            for j in places[x]:
                own[j >> 3] |= 1 << (j & 7)
            bits = int.from_bytes(own, "little")
            if len(places[x]) > 64:
                kept[x] = bits
        seen = row & bits
        row = ((row + seen) | (row - seen)) & full
    return [0, *accumulate(int(bit == "0") for bit in f"{row:0{len(b)}b}"[::-1])]


def align(a: list, b: list) -> list:
    """Align two lists; what only one has becomes optional."""
    left, right = list(map(shape, a)), list(map(shape, b))
    if left == right:
        return [merge(x, y) for x, y in zip(a, b)]
    start = 0
    while start < min(len(a), len(b)) and left[start] == right[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and left[-1 - end] == right[-1 - end]:
        end += 1
    pairs = [(n, n) for n in range(start)]
    m, n = len(a) - start - end, len(b) - start - end
    numbers: dict[tuple, int] = {}
    middles = ([numbers.setdefault(x, len(numbers)) for x in some] for some in (left[start : start + m], right[start : start + n]))
    pairs += [(start + i, start + j) for i, j in common(*middles)]
    pairs += [(len(a) - k, len(b) - k) for k in range(end, 0, -1)]
    out: list = []
    i = j = 0
    for x, y in [*pairs, (len(a), len(b))]:
        out += [[n[0], n[1], True, n[3], n[4]] for n in a[i:x]]
        out += [[n[0], n[1], True, n[3], n[4]] for n in b[j:y]]
        if x < len(a):
            out.append(merge(a[x], b[y]))
        i, j = x + 1, y + 1
    return fold(out)


def expression(node: list) -> str:
    """A wrapper as text: ``(...)+`` repeated, ``(...)?`` optional, ``#`` a text all pages have, ``*`` a slot."""
    inner = "" if node[0] == "#" else " ".join(map(expression, node[4]))
    own = ("*" if node[3] == "*" else "#") if node[0] == "#" else inner if node[0] in ("", "+") else f"<{node[0]}>{inner}</>"
    for flag, mark in ((node[1], "+"), (node[2], "?")):
        own = f"({own}){mark}" if flag else own
    return own


def below(path: int, key: str) -> int:
    """The number of a path with one more element."""
    return (path * 1_000_003 + crc32(key.encode("utf-8", "replace")) + 1) & 0xFFFFFFFFFFFFFFFF


def slots(wrapper: list, pages: int) -> dict[int, bool]:
    """Path -> whether its text belongs to a page."""
    found: dict[int, bool] = {}
    links: list[tuple[int, int, bool]] = []  # path, block around the link, whether the pages suffice
    held: set[int] = set()  # blocks that hold text besides links

    def visit(node: list, path: int, block: int, link: bool, content: bool) -> None:
        for child in node[4]:
            if child[0] == "#":
                known = pages >= LEAST_PAGES and len(child[4]) >= LEAST_PAGES
                keeps = not (known and child[3] != "*")
                if link and keeps:
                    links.append((path, block, content and not known))
                    continue
                found[path] = found.get(path, False) or keeps
                if keeps:
                    held.add(block)
            elif child[0] == "+":
                visit(child, path, block, link, content)
            else:
                at = below(path, child[0])
                name = re.split("[.#@]", child[0].lstrip("-~"), maxsplit=1)[0]
                inside = content or content_level(child[0]) < len(CONTENT)
                visit(child, at, at if name in BLOCKS else block, link or name == "a", inside)

    visit(wrapper, 0, 0, False, False)
    for path, block, keeps in links:
        found[path] = found.get(path, False) or keeps or block in held
    return found


def host_of(url: str | None) -> str | None:
    if url is None:
        return None
    rest = url.partition("://")[2]
    return re.split(r"[/?#]", rest, maxsplit=1)[0].lower()


def _wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(host, wrapper, pages, part)`` of the pages ``(url, html)`` of a task."""
    known: dict[str | None, list] = {}
    for batch in batches:
        for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            host = host_of(url)
            page = stream(html or "")
            old = known.get(host)
            known[host] = [merge(old[0], page), old[1] + 1] if old else [page, 1]
        if len(known) >= FLUSH:
            yield _rows(known)
            known = {}
    yield _rows(known)


def _rows(known: dict) -> pa.RecordBatch:
    part = [crc32(json.dumps(w).encode()) % STEPS for w, _ in known.values()]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(known), pa.string()),
            pa.array([json.dumps(w) for w, _ in known.values()], pa.string()),
            pa.array([n for _, n in known.values()], pa.int64()),
            pa.array(part, pa.int32()),
        ],
        ["host", "wrapper", "pages", "part"],
    )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge wrappers that follow each other with the same host and part."""
    current, wrapper, pages = None, None, 0
    for batch in batches:
        for host, text, n, part in zip(*(c.to_pylist() for c in batch.columns)):
            node = json.loads(text)
            if wrapper is not None and current == (host, part):
                wrapper, pages = merge(wrapper, node), pages + n
                continue
            if wrapper is not None:
                yield _row(*current, wrapper, pages)
            current, wrapper, pages = (host, part), node, n
    if wrapper is not None:
        yield _row(*current, wrapper, pages)


def _row(host, part, wrapper, pages) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([host], pa.string()),
            pa.array([json.dumps(wrapper)], pa.string()),
            pa.array([pages], pa.int64()),
            pa.array([part], pa.int32()),
        ],
        ["host", "wrapper", "pages", "part"],
    )


SCHEMA = "host string, wrapper string, pages long, part int"


def infer(pages: DataFrame) -> DataFrame:
    """``(host, wrapper, pages)``: the wrapper of every host, as JSON."""
    rows = pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    found = rows.mapInArrow(_wrappers, SCHEMA)
    for keys in (["host", "part"], ["host"]):
        dealt = found.repartition(*keys).sortWithinPartitions(*keys, "pages", "wrapper")
        found = dealt.withColumn("part", F.lit(0) if keys == ["host"] else F.col("part")).mapInArrow(_merged, SCHEMA)
    return found.drop("part")


def main_text(html: str, verdicts: dict[int, bool]) -> str:
    """The blocks of a page that its host's wrapper calls text, one per line."""
    # Of every open element: below an article, below a main element, number of its path; None if out.
    path: list[tuple[bool, bool, int] | None] = [(False, False, 0)]
    texts: list[tuple[int, tuple[bool, bool, int], str]] = []
    block = 0
    for kind, value in events(html):
        if kind == "open":
            last = path[-1]
            if last is None or value[0] in "-~":
                path.append(None)
            else:
                level = content_level(value)
                at = below(last[2], value) if len(path) <= DEPTH else last[2]  # as in stream()
                path.append((last[0] or level == 0, last[1] or level == 1, at))
        elif kind == "close":
            path.pop()
        elif kind == "break":
            block += 1
        elif path[-1] is not None:
            texts.append((block, path[-1], " " if kind == "space" else value))
    belongs = {t[0] for t in texts if verdicts.get(t[1][2], True) and not t[2].isspace()}
    own = [[t for t in texts if t[1][level]] for level in range(len(CONTENT))]
    left = [[t for t in some if t[0] in belongs] for some in (*own, texts)]
    # Each judged, then articles and main elements as they are.
    for some in (*left[:-1], *own, left[-1]):
        if any(not t[2].isspace() for t in some):
            texts = some
            break
    else:
        texts = []
    blocks: dict[int, list[str]] = {}
    for number, _, text in texts:
        blocks.setdefault(number, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row."""
    wrappers = stored(infer(pages), "wrappers").withColumnRenamed("pages", "n_pages")
    url = F.col("url").cast("string")
    rows = pages.select("page_id", url.alias("url"), F.col("html").cast("string").alias("html"))
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring(F.col("url"), at + 3, F.length("url"))).otherwise("")
    host = F.when(F.col("url").isNotNull(), F.lower(F.regexp_extract(rest, "^[^/?#]*", 0)))
    # Spark broadcasts the wrappers where they are small and splits a hot host where not.
    joined = rows.withColumn("host", host).join(wrappers, "host", "left")
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[int, bool]] = {}
        for batch in batches:
            texts = []
            for html, wrapper, n in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4))):
                if wrapper is not None and wrapper not in known:
                    if len(known) >= FLUSH:
                        known.clear()
                    known[wrapper] = slots(json.loads(wrapper), n)
                texts.append(main_text(html or "", known.get(wrapper, {})))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    columns = joined.select("page_id", "url", "html", "wrapper", "n_pages")
    return columns.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")

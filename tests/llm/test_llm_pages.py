"""Operators on pages and vectors against brute force and on awkward rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyarrow import fs

from salescope.llm import embedding_dedup, html_extraction, url_filter, warc
from salescope.session import fresh

SCHEMA = "page_id long, url string, html string, host string, path string, rule string, digest string, payload string"

# ---- url filters ----


def slow_rule(url, rules):
    rest = url.partition("://")[2] if url and "://" in url else ""
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fits = []
    for h, p, v in rules:
        if h and (host == h or host.endswith("." + h)) and path.startswith(p or ""):
            fits.append((len(h + (p or "")), len(h), v, h + (p or "")))
    best = max(fits, default=(0, 0, "allow", None))
    return host, path, best[3], best[2]


def check_urls(spark, urls, rules):
    pages = spark.createDataFrame([(n, u, *[None] * 6) for n, u in enumerate(urls)], SCHEMA).repartition(3)
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    rows = url_filter.filter_urls(pages, table).collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert tuple(r[1:]) == slow_rule(urls[r.page_id], rules), urls[r.page_id]


def test_url_filter_against_brute_force(spark):
    rng = random.Random(4)
    labels, parts = ["a", "b", "com", "org", "a-b", ""], ["", "/", "/a", "/a/", "/a/b", "/ab", "/a/b/c1", "//"]
    urls = [None, "", "no scheme", "://", "http://", "http:///a", "HTTP://A.COM?x=/a#y", "x://a.com#/a/b", "http://é.org/a\u0001b"]
    for _ in range(400):
        host = ".".join(rng.choices(labels, k=rng.randrange(1, 4)))
        urls.append(f"http://{host}{rng.choice(parts)}{rng.choice(['', '?q=/a', '#t', 'x'])}")
    urls += ["http://a.com/a/b"] * 300
    rules = []
    for _ in range(60):
        host = ".".join(rng.choices(labels[:5], k=rng.randrange(1, 3)))
        rules.append((host, rng.choice(parts), rng.choice(["allow", "block"])))
    seen = {}
    for h, p, v in rules:  # a rule with both verdicts blocks
        seen[h, p] = max(v, seen.get((h, p), v))
    rules = [(h, p, v) for (h, p), v in seen.items()] + [("", "/", "block"), (None, "/a", "block"), ("b.org", None, "allow")]
    check_urls(spark, urls, rules)


def test_url_filter_without_rules_or_pages(spark):
    check_urls(spark, ["http://a.com/", None], [])
    check_urls(spark, [], [("com", "/", "block")])


def test_url_filter_runs_no_python(spark, small):
    rules = spark.createDataFrame([("com", "/", "block")], "host string, path string, verdict string")
    found = url_filter.filter_urls(spark.read.parquet(f"{small}/pages.parquet"), rules)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# ---- archives ----


def awkward_pages():
    rng = random.Random(6)
    big = "".join(chr(rng.randrange(32, 1000)) for _ in range(300_000))
    rows = [
        (1, "http://a/", "x" * 200),
        (2, "http://b/\r\nWARC-Type: evil", "x" * 200),
        (3, None, "short"),
        (4, "http://c/", "short"),
        (5, "http://d/", None),
        (6, "", ""),
        (7, "http://e/é", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n\r\n" * 5),
        (8, "http://f/", big),
        (8, "http://f/", big),
        (9, "http://g/", big),
        (None, "http://h/", "y" * 100),
        (10, "http://i/", "y" * 100),
        (None, None, None),
        (11, "http://j/", "z" * 100),
        (11, "http://j/", "z" * 100),
    ]
    return [(*r, *["x"] * 5) for r in rows]


def expected_records(rows):
    first = {}
    for r in rows:
        payload = (r[2] or "").encode()
        if r[0] is not None:
            first[payload] = min(r[0], first.get(payload, r[0]))
    out = []
    for r in rows:
        payload = (r[2] or "").encode()
        one = first.get(payload)
        revisit = len(payload) >= 100 and one is not None and r[0] != one
        page = None if r[0] is None else str(r[0])
        out.append(
            (page, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", str(one) if revisit else None)
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [64, 1000, 5000, 8 << 20])
def test_archives_come_back_whole_for_any_split(spark, split):
    rows = awkward_pages()
    path = fresh(spark, "warc")
    assert warc.write(spark.createDataFrame(rows, SCHEMA).repartition(3), path) == len(rows)
    if split == 64:  # many tiny ranges
        size = sum(f.size for f in fs.LocalFileSystem().get_file_info(fs.FileSelector(path.removeprefix("file:"))))
        split = size // 150 + 1
    found = warc.read(spark, path, split_bytes=split).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=str) == expected_records(rows)
    for r in found:
        if r.record_type == "response":
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest
    assert {r.url for r in found if r.page_id == "2"} == {"http://b/ WARC-Type: evil"}


def test_page_ids_come_back_whole(spark):
    names = [" a ", "a", "a\nb", "a b", "%20", "", "\tü\r\n:", None]
    rows = [(n, "http://a/", "same payload " * 20) for n in names]
    path = fresh(spark, "warc")
    warc.write(spark.createDataFrame(rows, "page_id string, url string, html string"), path)
    found = warc.read(spark, path).collect()
    assert sorted((r.page_id for r in found), key=str) == sorted(names, key=str)
    assert {r.refers_to for r in found} == {None, ""}


def test_damaged_members_are_passed_over(tmp_path):
    records = [warc.record([("WARC-Type", "response"), ("X-Page-Id", str(n))], b"h\r\n\r\n" + bytes([n]) * 999) for n in range(5)]
    broken = bytearray(records[2])
    broken[len(broken) // 2 : len(broken) // 2 + 8] = b"\x00" * 8
    stored = zlib.compressobj(0, zlib.DEFLATED, warc.GZIP)
    noise = stored.compress(b"not a record " + warc.MAGIC + b"x" * 50) + stored.flush()
    name = tmp_path / "a.warc.gz"
    data = b"".join([records[0], noise, records[1], bytes(broken), records[3], b"junk" + warc.MAGIC, records[4]])
    name.write_bytes(data)
    for step in (1, 37, 500, len(data)):
        found = []
        with fs.LocalFileSystem().open_input_file(str(name)) as file:
            for start in range(0, len(data), step):
                found += [warc.parse(c)[0]["x-page-id"] for c in warc.members(file, start, min(start + step, len(data)))]
        assert found == ["0", "1", "3", "4"], step


def test_archives_of_nothing(spark):
    path = fresh(spark, "warc")
    assert warc.write(spark.createDataFrame([], SCHEMA), path) == 0
    assert warc.read(spark, path).count() == 0


# ---- extraction ----

PAGES = {
    "article": (
        "<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header>"
        "<nav><ul><li><a href=x>Menu</a><li>b</ul><div id='cookie-notice'>We use cookies</div><main>"
        "<article class='post'><header><h1>T &amp; x</h1></header><p>One <b>two</b>\n\t three&nbsp;3<p>four<br>five"
        "<script>var a='</p>';</script><table><tr><td>a<td>b<tr><td>c</table><aside>side</aside><form>f</form>"
        "<div class='ads'>buy</div><!-- no --><p hidden>h</p>1 &lt; 2<section class='comments'><article>cm</article>"
        "</section></article></main><footer>f</footer>",
        "T & x\nOne two three 3\nfour five\na b\nc\n1 < 2",
    ),
    "main": ("<body><p>out</p><main><h2>A</h2>text<ul><li>1<li>2</ul></main><p>out</p>", "A\ntext\n1\n2"),
    "plain": ("<div><p>a</p>b</div><nav>n</nav>&#99; <i>d</i>", "a\nb\nc d"),
    "open menu": ("<nav><ul><li>m<article><p>x</article>", "x"),
    "empty": ("", ""),
    "none": (None, ""),
    "broken": ("a < b <p class='x' <<p>c</p", "a < b\nc"),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    html, text = PAGES[name]
    assert html_extraction.main_text(html or "", {}) == text


def test_wrapper_of_a_host():
    pages = [
        "<div><b>Shop</b><ul><li>a</li><li>b</li></ul><p>x</p></div>",
        "<div><b>Shop</b><ul><li>c</li></ul><p>y</p><i>new</i></div>",
        "<div><b>Shop</b><h2>q</h2><p>z</p><h2>r</h2><p>w</p></div>",
    ]
    wrapper = html_extraction.stream(pages[0])
    for page in pages[1:]:
        wrapper = html_extraction.merge(wrapper, html_extraction.stream(page))
    text = html_extraction.expression(wrapper)
    assert text.startswith("<div><b>#</>")
    assert "(<ul>(<li>*</>)+</>)?" in text and "(<i>#</>)?" in text
    verdicts = html_extraction.slots(wrapper, 3)
    assert html_extraction.main_text(pages[0], verdicts) == "a\nb\nx"


def articles(n, body="<p>Text {0} of <a>link {0}</a>.</p><p>More {0}</p>", same="<div class='x7'>Notice of the house</div>"):
    links = "<ul class='x8'><li><a>To {0}</a></li><li><a>And {0}</a></li></ul>"
    return [f"<body><article>{same}{body}{links}</article></body>".format(i) for i in range(n)]


def wrapper_of(pages):
    wrapper = html_extraction.stream(pages[0])
    for page in pages[1:]:
        wrapper = html_extraction.merge(wrapper, html_extraction.stream(page))
    return wrapper


def test_wrapper_decides_inside_articles(spark):
    """Neutral names: only the other pages of the host tell what is boilerplate."""
    pages = articles(4)
    found = html_extraction.extract(spark.createDataFrame([(n, "http://h/", p, *["x"] * 5) for n, p in enumerate(pages)], SCHEMA).repartition(3))
    assert {r.page_id: r.text for r in found.collect()} == {n: f"Text {n} of link {n}.\nMore {n}" for n in range(4)}
    assert html_extraction.main_text(pages[1], {}) == "Notice of the house\nText 1 of link 1.\nMore 1\nTo 1\nAnd 1"
    # a notice that only some pages have
    pages = articles(3) + articles(3, same="", body="<p>Other {0}</p>")
    verdicts = html_extraction.slots(wrapper_of(pages), 6)
    assert [html_extraction.main_text(p, verdicts) for p in (pages[0], pages[4])] == ["Text 0 of link 0.\nMore 0", "Other 1"]


def test_copies_are_no_evidence_against_an_article():
    for pages in (articles(1) * 5, articles(2)):
        verdicts = html_extraction.slots(wrapper_of(pages), len(pages))
        assert all(html_extraction.main_text(p, verdicts) == html_extraction.main_text(p, {}) for p in pages)
    pages = [f"<main><ul><li><a>{n}</a></li></ul></main>" for n in range(5)]
    verdicts = html_extraction.slots(wrapper_of(pages), 5)
    assert html_extraction.main_text(pages[3], verdicts) == "3"


def test_long_lists_are_aligned_exactly(monkeypatch):
    rng = random.Random(8)
    for _ in range(60):
        a, b = ([rng.randrange(9) for _ in range(rng.randrange(40))] for _ in range(2))
        longest = len(html_extraction.common(a, b))
        monkeypatch.setattr(html_extraction, "ALIGN", 4)
        pairs = html_extraction.common(a, b)
        monkeypatch.undo()
        assert len(pairs) == longest and all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))

    def page(n):  # unlike siblings around a notice
        own = [f"<div class={chr(112 + n)}{''.join(chr(97 + int(c)) for c in str(k))}>" for k in range(600)]
        return "".join(f"{d}t{n}{k}</div>" for k, d in enumerate(own[:300] + ["<h5>"] + own[300:])).replace(f"t{n}300", "Notice")

    pages = [page(n) for n in range(3)]
    verdicts = html_extraction.slots(wrapper_of(pages), 3)
    for n, html in enumerate(pages):
        lines = html_extraction.main_text(html, verdicts).split("\n")
        assert "Notice" not in lines and len(lines) == 600


def test_deep_boilerplate_is_judged():
    pages = [f"<p>Text {n}</p>" + "<div>" * 70 + f"Notice<nav>m{n}</nav>" + "</div>" * 70 for n in range(3)]
    wrapper = wrapper_of(pages)
    assert html_extraction.main_text(pages[0], html_extraction.slots(wrapper, 3)) == "Text 0"


def test_ends_of_tags():
    import re

    for quote in "\"'":
        html = f"<p title={quote}{'x' * 9000}> spill{quote}>text</p>"
        assert html_extraction.main_text(html, {}) == "text"
    slow = re.compile(r"<[a-z](?:[^'\">=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?|['\"])*+>")
    rng = random.Random(5)
    for _ in range(4000):
        html = "".join(rng.choices(["<a", "=", '"', "'", ">", " ", "x"], k=rng.randrange(1, 30)))
        tags = html_extraction.Tags(html)
        for at in [m.start() for m in re.finditer("<a", html)]:
            found = slow.match(html, at)
            assert tags.end(at) == (found.end() if found else -1), (html, at)


def test_extraction_of_awkward_rows(spark):
    rows = [(n, "http://h/", html, *["x"] * 5) for n, (html, _) in enumerate(PAGES.values())]
    rows += [(50, None, "<article>n</article>", *[None] * 5), (None, "x", None, *[None] * 5), (51, "http://h/", "<p>" * 30_000 + "deep" + "<div>" * 3000 + "end", *[None] * 5)]
    rows += [rows[0]]
    found = html_extraction.extract(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_chars == len(r.text)
        if r.page_id is not None and r.page_id < len(PAGES):
            assert r.text == list(PAGES.values())[r.page_id][1]
    assert {r.text for r in got if r.page_id == 51} == {"deep\nend"}
    assert html_extraction.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_extraction_of_pages_by_pattern(spark, medium):
    """The test pages have one article each, without boilerplate inside."""
    import re
    from html import unescape

    for r in html_extraction.extract(spark.read.parquet(f"{medium}/pages.parquet")).join(
        spark.read.parquet(f"{medium}/pages.parquet").select("page_id", "html"), "page_id"
    ).collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S).group(1)
        parts = re.split(r"<(?:/?p|/?h1|br)>", article)
        blocks = (" ".join(unescape(re.sub("</?b>", "", p)).split()) for p in parts)
        assert r.text == "\n".join(b for b in blocks if b)


# ---- vectors ----


def check_vectors(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, key string")
    found = {}
    for r in embedding_dedup.near_duplicates(frame.repartition(3), **options).collect():
        found.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    usable = [bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    assert all((0, i, True) in found[i] for (i, _), good in zip(rows, usable) if not good)
    for length in {len(v) for (_, v), good in zip(rows, usable) if good}:
        check_length(found, [r for r, good in zip(rows, usable) if good and len(r[1]) == length])


def check_length(found, rows):
    ids, unit = [i for i, _ in rows], np.array([v for _, v in rows], dtype=np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links = unit @ unit.T >= 0.95
    np.fill_diagonal(links, False)
    label = np.arange(len(ids))
    for _ in range(len(ids)):
        new = np.minimum(label, np.where(links, label[None, :], len(ids)).min(axis=1))
        if (new == label).all():
            break
        label = new
    for n, i in enumerate(ids):
        members = [ids[k] for k in range(len(ids)) if label[k] == label[n] and ids[k] is not None]
        name = min(members, default=None)
        assert (int(links[n].sum()), name, i == name) in found[i]


@pytest.mark.parametrize("options", [{}, {"cell": 20, "slack": 1.0}, {"cell": 15, "part": 8, "slack": 1.0}])
def test_vectors_against_brute_force(spark, options):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 8))
    vectors = [b + rng.normal(size=8) * s for b in base for s in (0, 0.02, 0.1, 0.25, 0.3)]
    vectors += [base[0] * 7] * 4 + [base[1]] * 3 + [base[2] + rng.normal(size=8) * 0.02 for _ in range(60)]
    rows = [(n, [float(x) for x in v]) for n, v in enumerate(vectors)]
    rows += [
        (900, None),
        (901, []),
        (902, [0.0] * 8),
        (903, [float("nan")] + [1.0] * 7),
        (904, [float("inf")] + [1.0] * 7),
        (905, [None] + [1.0] * 7),
        (906, [1.0, 2.0]),
        (911, [2.0, 4.0]),
        (912, [2.0, -4.0]),
        (913, [3.0]),
        (914, [-3.0]),
        *[(1000 + n, v[:5]) for n, (_, v) in enumerate(rows[:150])],
        (907, [1e30] * 8),
        (908, [1e-30] * 8),
        (909, [-0.0, 0.0, 1.0] + [0.0] * 5),
        (910, [0.0, 0.0, 1.0] + [0.0] * 5),
        (None, rows[8][1]),
        (5, rows[5][1]),
    ]
    check_vectors(spark, rows, **options)


def test_vectors_without_any_that_link(spark):
    check_vectors(spark, [])
    check_vectors(spark, [(1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0])])


def test_recall_of_the_default_slack(spark, medium):
    """Copies that are barely similar enough, of vectors without any other neighbours."""
    rng = np.random.default_rng(9)
    rows = []
    for vec_id, v, _ in spark.read.parquet(f"{medium}/embeddings.parquet").collect():
        v = np.array(v) / np.linalg.norm(v)
        away = rng.normal(size=len(v))
        away -= away @ v * v
        away /= np.linalg.norm(away)
        rows += [(vec_id, v.tolist()), (vec_id + 10_000, (0.951 * v + np.sqrt(1 - 0.951**2) * away).tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    counts = {}
    for slack in (0.5, 1.0):
        found = embedding_dedup.near_duplicates(vectors, cell=25, slack=slack)
        counts[slack] = found.agg({"n_links": "sum"}).first()[0]
    assert counts[1.0] == len(rows)
    assert counts[0.5] >= 0.99 * len(rows)

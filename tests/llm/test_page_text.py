import random
import time
import tracemalloc

import pytest
from helpers import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from docflow.llm import page_text


def text_of(source):
    return [t for t, k in zip(*page_text.page_lines(source), strict=True) if k == 2]


@given(st.lists(st.sampled_from("abcd"), max_size=9), st.lists(st.sampled_from("abcd"), max_size=9))
def test_shared_lines_are_a_longest_common_subsequence(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    shared = [a[i] for i in sorted(page_text.shared_lines(a, b))]
    rest = iter(b)
    assert len(shared) == best[-1][-1] and all(x in rest for x in shared)


@pytest.mark.parametrize(
    ("source", "lines"),
    [
        ("<article><h1>T &amp;lt; &eacute;</h1><p>a <b>b</b>\n c<br>d<p>e</article>", ["T &lt; é", "a b c d", "e"]), ("<article><header><h1>T</h1></header><p>x</p><footer>f</footer></article>", ["T", "x"]),
        ("<article><p>x<div class='ad'>buy</div>y<aside>s</aside><p>z", ["x", "y", "z"]), ("<main><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table></main>", ["a", "b", "c d", "e"]),
        ("<article><script>var t='</p>'</script>x<style>p{}</style><form>f<input>g</form>y<!-- <p>no</p> -->z</article>", ["x", "yz"]), ("<article class='post comments-open'><p>x</article><article class='comment'>no</article>", ["x"]), ("<article>a<section class='comments'><article>no</article></section>b</article>", ["a", "b"]),
        ("<article><div id='cookie-notice'>c</div><div class='share2'>s</div><div role='navigation'>n</div><p class='shady'>keep</p></article>", ["keep"]), ("<article><b>x<p>y</b>z</article><p>out", ["x", "yz"]),
        ("<article>a &nbsp; b c", ["a b c"]), ("<article><p>a<a href='x>y'>b</a>c", ["abc"]), ("<article>x<!-- never closed", ["x"]), ("<article>x<b", ["x"]), ("<article>5 < 6 <p class=\"share\">own</p><div class=\"share\">x</div>", ["5 < 6", "own"]), ("<article><p title=it's>a</p><p>don't</p>", ["a", "don't"]), ("", []), (None, []),
    ],
)
def test_page_lines(source, lines):
    assert text_of(source) == lines


def page(i, host, path, body):
    return (i, f"https://{host}/{path}", body)


def texts(spark, rows):
    return {r["page_id"]: r["text"] for r in page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_differencing_without_content_elements(spark):
    frame_of = lambda s: f"<div>Welcome</div><p>{s}</p><p>own {s} line</p><div>All rights reserved</div>"
    rows = [page(i, "a.example", f"x/{i}", frame_of(f"story {i} of the site, told at some length")) for i in range(5)]
    rows += [page(10, "b.example", "x", frame_of("alone")), page(11, "c.example", "x", frame_of("twin")), page(12, "c.example", "x?y", frame_of("twin"))]
    got = texts(spark, rows)
    assert all(got[i] == f"story {i} of the site, told at some length\n\nown story {i} of the site, told at some length line" for i in range(5))
    assert got[10] == "Welcome\n\nalone\n\nown alone line\n\nAll rights reserved" and got[11] == got[12] == "Welcome\n\ntwin\n\nown twin line\n\nAll rights reserved"


def test_content_is_never_deleted_and_odd_rows(spark):
    same = "<nav>n</nav><article><p>same story</p></article>"
    rows = [page(1, "a.example", "1", same), page(2, "a.example", "2", same), (3, None, same), (4, "http://[bad", None), (None, "https://a.example/1", ""), page(1, "a.example", "1", same)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = page_text.extract(frame).collect()
    assert sorted((r["page_id"] or 0, r["text"]) for r in out) == [(0, ""), (1, "same story"), (1, "same story"), (2, "same story"), (3, "same story"), (4, "")]
    assert page_text.extract(frame.limit(0)).count() == 0


def test_many_ranges_equal_one(spark):
    rng = random.Random(4)
    rows = [page(i, rng.choice(("h.example", "h.example", f"h{i % 7}.example")), f"p/{rng.randrange(40)}/{i}", f"<div>menu {i % 3}</div><p>text {i} of a page</p><div>end {i % 5}</div>") for i in range(120)]
    one = None
    for n in ("1", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            got = texts(spark, rows)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert one is None or got == one
        one = got


def test_query(spark):
    rows = page_text.op9_page_differencing(spark, SMALL).collect()
    assert len(rows) == 50 and all(r["n_chars"] == len(r["text"]) > 0 for r in rows) and not any("track(" in r["text"] or "&copy;" in r["text"] for r in rows)


def test_long_page(spark):
    lines = "".join(f"<p>line {i}</p>" for i in range(4000))
    got = texts(spark, [page(1, "a.example", "1", f"<div>top</div>{lines}"), page(2, "a.example", "2", f"<div>top</div><p>short own text here</p>")])
    assert got[2] == "short own text here" and got[1].count("\n\n") == 3999


def test_lines_inside_content_are_differenced(spark):
    whole = lambda i: f"<main><p>Site notice for all readers</p><p>story {i} told at some length, unlike others {i * 7919}</p></main><p>by line {i}</p><p>All rights reserved</p>"
    got = texts(spark, [page(i, "a.example", f"x/{i}", whole(i)) for i in range(4)])
    assert got == {i: f"story {i} told at some length, unlike others {i * 7919}\n\nby line {i}" for i in range(4)}
    alone = texts(spark, [page(1, "a.example", "1", whole(1))])[1]
    assert alone == "Site notice for all readers\n\nstory 1 told at some length, unlike others 7919\n\nby line 1\n\nAll rights reserved"


def test_short_pages_and_runs_of_copies(spark):
    site = "".join(f"<p>site line {k} that every page of the host repeats</p>" for k in range(6))  # far over half of the page
    own = lambda i: f"own story {i} of some words, all told differently each time {i * 7919}"
    rows = [page(i, "a.example", f"x/{i}", f"{site}<p>{own(i)}</p><p>and more of it: {own(i + 100)}</p>") for i in range(3)]
    copies = f"{site}<p>{own(50)}</p><p>and more of it: {own(51)}</p>"
    rows += [page(10 + k, "a.example", f"x/1?print={k}", copies + f"<p>v{k % 3}</p>") for k in range(30)]
    for n in ("1", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            got = texts(spark, rows)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert all(got[i] == f"{own(i)}\n\nand more of it: {own(i + 100)}" for i in range(3))
        assert all(got[10 + k] == f"{own(50)}\n\nand more of it: {own(51)}\n\nv{k % 3}" for k in range(30))


@pytest.mark.parametrize("source", ['<a ' + '"' * 10_000, "<a b " * 100_000, "<a b='" * 30_001, "<" * 200_000, "<b>" * 100_000 + "</i>" * 100_000, "<!--" * 100_000, "<p " + "x" * 300_000, "<a " + "= " * 100_000])
def test_odd_markup_is_parsed_in_time(source):
    began = time.perf_counter()
    page_text.page_lines(source)
    assert time.perf_counter() - began < 1


def test_short_articles_in_a_long_frame(spark):
    frame = "".join(f"<p>common line {k} of the site</p>" for k in range(12))
    rows = [page(i, "a.example", f"x/{i}", f"{frame}<p>own line {i * 7919}</p>") for i in range(3)]
    assert texts(spark, rows) == {i: f"own line {i * 7919}" for i in range(3)}


def test_lines_outside_content_are_not_lost(spark):
    whole = "<h1>The title</h1><p>Lead paragraph.</p><div>Home</div><article><p>Body text.</p></article>"
    assert texts(spark, [page(1, "a.example", "1", whole)])[1] == "The title\n\nLead paragraph.\n\nBody text."
    two = [page(i, "a.example", f"{i}", whole.replace("Body text.", f"Body of {i * 7919}.").replace("Lead", f"Lead {i}")) for i in range(2)]
    assert texts(spark, two) == {i: f"Lead {i} paragraph.\n\nBody of {i * 7919}." for i in range(2)}


def test_copies_of_an_article_in_other_frames(spark):
    story = "".join(f"<p>paragraph {k} of one story, as long as others are</p>" for k in range(9))
    rows = [page(i, "a.example", f"x?page={i}", f"<div>Menu</div><article>{story}<p>seen {i} times</p></article>") for i in range(4)]
    got = texts(spark, rows)
    assert all(got[i].count("paragraph") == 9 and got[i].endswith(f"seen {i} times") for i in range(4))


def longest_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = best[i][j] + a[i][1] if a[i][0] == b[j][0] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def brute_partner(pages, i):
    """The page that i is differenced with, by walks over all pages in order."""

    def alike(a, b):
        if a["lines"] == b["lines"]:
            return True, True
        x, y = ([(t, len(t)) for t, k in zip(z["lines"], z["kinds"], strict=True) if k == 2] for z in (a, b))
        if x and y:
            copy = longest_common(x, y) >= 0.8 * max(sum(v for _, v in z) for z in (x, y))
            return copy, copy
        x, y = ([(t, len(t)) for t in z["lines"]] for z in (a, b))
        return False, longest_common(x, y) >= 0.8 * max(sum(v for _, v in z) for z in (x, y))

    for which in (1, 0):
        found = []
        for step in (-1, 1):
            j = i + step
            while 0 <= j < len(pages) and pages[j]["host"] == pages[i]["host"]:
                if not alike(pages[i], pages[j])[which]:
                    found.append(pages[j])
                    break
                j += step
        if found:
            same = lambda x: next((n for n, (p, q) in enumerate(zip(x["path"], pages[i]["path"], strict=False)) if p != q), min(len(x["path"]), len(pages[i]["path"])))
            return sorted(found, key=same, reverse=True)
    return []


def test_query_equals_brute_force_and_differencing_decides(spark):
    folder = SMALL.replace("sf0.001", "sf0.01")
    got = {r["page_id"]: r["text"] for r in page_text.op9_page_differencing(spark, folder).collect()}
    pages = []
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        lines = [(t, k) for t, k in zip(*page_text.page_lines(r["html"]), strict=True) if k]
        host, path = page_text._address(r["url"])
        pages.append({"host": host, "path": path, "page_id": r["page_id"], "lines": [x[0] for x in lines], "kinds": [x[1] for x in lines]})
    pages.sort(key=lambda x: (x["host"], x["path"], x["page_id"]))
    paired = 0
    for i, x in enumerate(pages):
        partners = brute_partner(pages, i)
        structure = [t for t, k in zip(x["lines"], x["kinds"], strict=True) if k >= 2 or 2 not in x["kinds"]]
        text = got[x["page_id"]]
        if not partners:
            assert text == "\n\n".join(structure)
            continue
        paired += 1
        kept, mine = (text.split("\n\n") if text else []), [(t, 1) for t in x["lines"]]
        sizes = {len(x["lines"]) - longest_common(mine, [(t, 1) for t in p["lines"]]) for p in partners}
        rest = iter(x["lines"])
        assert len(kept) in sizes and kept and all(t in rest for t in kept)  # so many lines less as a longest common subsequence has
    assert paired > 50


def test_differencing_changes_shipped_pages(spark):
    folder = SMALL.replace("sf0.001", "sf0.1")
    changed = 0
    got = {r["page_id"]: r["text"] for r in page_text.op9_page_differencing(spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        lines = [t for t, k in zip(*page_text.page_lines(r["html"]), strict=True) if k]
        changed += got[r["page_id"]] != "\n\n".join(lines)
    assert changed > 20



@pytest.mark.parametrize("ranges", [1, 3, 9, 40])
@pytest.mark.parametrize("beside", [2, 8])
def test_borders_do_not_change_texts(spark, ranges, beside, monkeypatch):
    """Long runs of copies and of pages that look alike, over many borders, against one range."""
    rng = random.Random(11)
    rows, frame = [], [f"frame line {k} of the site" for k in range(30)]
    for host in ("a.org", "b.org"):
        at = 0
        while at < 150:
            story = [f"story {rng.randrange(10**6)} text {k}" for k in range(rng.choice((0, 1, 2, 25)))]
            for _ in range(rng.choice((1, 2, 30, 60))):
                own = [*story, *([f"own {rng.randrange(10**6)}"] if rng.random() < 0.5 else [])]
                rows.append((len(rows), f"http://{host}/{at:05d}", "".join(f"<p>{x}</p>" for x in [*frame, *own])))
                at += 1
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    texts = {}
    for name, n, most in (("whole", 1, 1 << 20), ("ranges", ranges, beside)):
        monkeypatch.setattr(page_text, "BESIDE", most)
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            texts[name] = {r["page_id"]: r["text"] for r in page_text.extract(pages).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert texts["whole"] == texts["ranges"] and len({*texts["whole"].values()}) > 10


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=40), st.lists(st.integers(0, 5), max_size=40), st.integers(1, 60))
def test_halving_finds_as_long_a_subsequence(a, b, bits):
    old, page_text.MOST_BITS = page_text.MOST_BITS, bits
    try:
        shared = sorted(page_text.shared_lines(a, b))
    finally:
        page_text.MOST_BITS = old
    assert len(shared) == len(page_text.shared_lines(a, b))
    rest = iter(b)
    assert all(any(x == a[i] for x in rest) for i in shared)


def test_long_pages_that_differ_take_little_memory(monkeypatch):
    rng = random.Random(3)
    a, b = ([rng.randrange(30_000) for _ in range(20_000)] for _ in range(2))
    tracemalloc.start()
    monkeypatch.setattr(page_text, "MOST_BITS", 1 << 24)
    shared = page_text.shared_lines(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6 and len(shared) > 100  # rows of all lines would take 50 MB

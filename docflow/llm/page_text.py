"""Operator 9, main text of web pages by nearest-URL page differencing.

A page becomes block lines in page order. Lines of scripts, menus, forms, adverts, comments and the like are marked as chrome by
their elements, roles and class words, and go. Pages of a host are ordered by URL path, and each is paired with the neighbour
whose path begins most like its own. All lines of the two but chrome, inside and outside article and main elements, are aligned by
longest common subsequence, and shared lines are deleted as what the site repeats; what is left is the text.

Copies of one article must not delete it. Of two pages with article or main elements, one is a copy of the other if their lines
inside these share COPY of the longer one's characters; of other pages, if all lines are equal. Pages without such elements that
share as much as a whole are looked past, too, if the host has a page beyond that shares less: what that one repeats is the
site's. If it has none, they are differenced, so that short articles lose a frame that is longer than they are.
Structure decides only where differencing has no partner or leaves nothing: there, a page with an article or main element keeps
that and the headings, paragraphs, quotations and preformatted text outside it.

Scale: pages are parsed where they are read, once; a page's path and its lines' hashes, sizes and kinds are ordered, by host and
path in ranges, so a host may be spread over any number of tasks. A range sees the next runs of copies over either border, whatever
their length: BESIDE of them, and four times as many again for as long as one of its pages has found no partner among them. What
ranges show passes from neighbour to neighbour in doubling steps. Texts meet what is kept of them in one join. Parsing takes time in
proportion to a page's length; aligning two pages takes memory for MOST_BITS at a time, whatever their length.

Edge cases: null or empty html gives empty text; a null or odd URL has its own spelling as path; unclosed elements end with
the element around them; unclosed comments, scripts and tags run to the end; a quote opens a value only behind an equals sign, and
only if another one closes it; a page that is alone on its host, or has only copies there,
is only parsed; pages with equal URLs are neighbours; pages without lines are nobody's partner; repeated rows are
rows. Character references are decoded once.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Callable, Collection, Iterable, Iterator
from functools import reduce
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

#: What makes a copy; runs of copies that a range sees over a border at first; pages of a range; bits of the rows of one alignment.
COPY, BESIDE, RANGE_PAGES, MOST_BITS = 0.8, 8, 8192, 1 << 28
# Possessive, and matching to the end what is not closed: no text is scanned twice.
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:"[^"]*+"|'[^']*+')?+|[^>=]++)*+)(?:>|\Z)""", re.DOTALL)
ATTRIBUTE = re.compile(r"""(?<![a-zA-Z_:-])([a-zA-Z_:-]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CHROME = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "fieldset", "label", "datalist", "head", "object", "canvas", "audio", "video", "header"}
CONTENT = {"article", "main"}
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html"
    " legend li main menu nav ol option p pre section select summary table tbody tfoot thead tr ul".split()
)
CLOSES_P = BLOCKS - {"body", "html", "caption", "dd", "dt", "li", "tr", "tbody", "thead", "tfoot", "option", "legend", "head", "summary", "figcaption"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
CLASS_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner banners sponsor sponsored promo promotion nav navbar navigation menu menus topnav breadcrumb breadcrumbs"
    " sidebar sidebars sidenav footer masthead topbar cookie cookies consent gdpr disclaimer popup modal overlay newsletter subscribe"
    " comment comments commentlist disqus recommended pagination pager toolbar".split()
)
# Words that tell of chrome on a container; a paragraph or table of that class inside an article may be the author's own.
CONTAINER_WORDS = frozenset("aside widget widgets notice notices notification subscription signup login respond reply replies share sharing social related skip".split())
CONTAINERS = frozenset("div section ul ol dl nav aside header footer details iframe a span".split())
ARTICLE_WORDS = {"ad", "ads", "advert", "advertisement", "comment", "promo", "related", "reply", "sponsored"}  # of article and main, whose classes tell much else
SITE_WORDS = {"header"}  # chrome outside content only: an article's own header holds its title
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre".split())
SPACE = re.compile(r"\s+")


def _marks(name: str, attributes: str, inside: bool) -> bool:
    """Whether class, id or role say that an element is chrome."""
    telling = ARTICLE_WORDS if name in CONTENT else CLASS_WORDS | CONTAINER_WORDS if name in CONTAINERS or not inside else CLASS_WORDS
    for key, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if key.lower() == "role" and value.strip() in ROLES:
            return True
        if key.lower() in ("class", "id"):
            words = set(re.split(r"[^a-z0-9]+", re.sub(r"\b([a-z]+)\d+\b", r"\1", value)))
            if words & telling or (not inside and words & SITE_WORDS):
                return True
        if key.lower() == "aria-hidden" and value == "true":
            return True
    return False


def page_lines(source: str | None) -> tuple[list[str], list[int]]:
    """Block lines in page order, and for each 0: chrome, 1: other, 2: content, 3: prose outside content."""
    lines: list[str] = []
    kinds: list[int] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # element, chrome, content, prose
    opened: Counter = Counter()  # of the stack's elements

    def flush() -> None:
        text = SPACE.sub(" ", html.unescape("".join(held))).strip()
        held.clear()
        if text:
            top = stack[-1] if stack else ("", False, False, False)
            lines.append(text)
            kinds.append(0 if top[1] else 2 if top[2] else 3 if top[3] else 1)

    def cut(i: int) -> None:
        for x in stack[i:]:
            opened[x[0]] -= 1
        del stack[i:]

    def close(names: Collection[str], limits: Collection[str] = ()) -> None:
        """End the innermost of names and all inside it, unless one of limits was begun inside it."""
        if any(opened[x] for x in names):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in names:
                    return cut(i)
                if stack[i][0] in limits:
                    return None

    at, source = 0, source or ""
    while m := TAG.search(source, at):
        held.append(source[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name, chrome, content = m[2].lower(), bool(stack and stack[-1][1]), bool(stack and stack[-1][2])
        if m[1]:
            if name in BLOCKS:
                flush()
            if name in BLOCKS or name in CHROME:
                if opened[name]:
                    flush()
                close({name})
            else:
                close({name}, BLOCKS)
            continue
        if name in ("br", "td", "th"):
            held.append(" ")
            if name == "br":
                continue
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}[^>]*>", re.IGNORECASE).search(source, at)
            at = end.end() if end else len(source)
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name in BLOCKS:
            flush()
            if name in CLOSES_P:
                close({"p"}, {"button", "td", "th", "li", "dd", "dt", "blockquote", "div", "section", "article", "main", "body"})
            if name == "li":
                close({"li"}, {"ul", "ol", "menu"})
            if name in ("dd", "dt"):
                close({"dd", "dt"}, {"dl"})
            if name in ("tr", "tbody", "tfoot"):
                close({"tr"}, {"table"})
            if name == "body":
                close({"head"}, {"html"})
            chrome, content = bool(stack and stack[-1][1]), bool(stack and stack[-1][2])
        own = (name in CHROME and not (name == "header" and content)) or (bool(m[3].strip()) and name not in ("html", "body") and _marks(name, m[3], content))
        if own and not chrome:
            flush()
        stack.append((name, chrome or own, content or (name in CONTENT and not (chrome or own)), name in PROSE or bool(stack and stack[-1][3])))
        opened[name] += 1
    held.append(source[at:])
    flush()
    return lines, kinds


def shared_lines(mine: list, theirs: list) -> set[int]:
    """Which of mine are on a longest common subsequence of lines; ends are matched first, the middle by bit rows, which are halved until they are few."""
    a, b = 0, 0
    while a < min(len(mine), len(theirs)) and mine[a] == theirs[a]:
        a += 1
    while b < min(len(mine), len(theirs)) - a and mine[-1 - b] == theirs[-1 - b]:
        b += 1
    return {*range(a), *range(len(mine) - b, len(mine)), *_aligned(mine[a : len(mine) - b], theirs[a : len(theirs) - b], a)}


def _bit_rows(x: list, y: list) -> Iterator[int]:
    """After each of x, a row of bits over y whose zeros are the columns where the subsequence grows."""
    places: dict = {}
    for j, line in enumerate(y):
        places[line] = places.get(line, 0) | 1 << j
    row = full = (1 << len(y)) - 1
    for line in x:
        match = row & places.get(line, 0)
        row = ((row + match) | (row - match)) & full
        yield row


def _lengths(x: list, y: list) -> np.ndarray:
    """Length of the longest common subsequence of x and each beginning of y."""
    row = (1 << len(y)) - 1
    for row in _bit_rows(x, y):  # noqa: B007  the last one
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(-(-len(y) // 8), "little"), np.uint8), bitorder="little", count=len(y))
    return np.concatenate([[0], np.cumsum(bits == 0)])


def _aligned(x: list, y: list, at: int) -> set[int]:
    if not x or not y:
        return set()
    if len(x) > 1 and len(x) * len(y) > MOST_BITS:  # the half of x that its best part of y belongs to, and the other
        half = len(x) // 2
        best = int(np.argmax(_lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]))
        return _aligned(x[:half], y[:best], at) | _aligned(x[half:], y[best:], at + half)
    found, full, rows, j = set(), (1 << len(y)) - 1, [*_bit_rows(x, y)], len(y)
    for i in range(len(x) - 1, -1, -1):
        above = rows[i - 1] if i else full
        while j and rows[i] >> (j - 1) & 1:
            j -= 1
        if not j:
            break
        low = (1 << j) - 1
        if (~rows[i] & low).bit_count() > (~above & low).bit_count():
            while y[j - 1] != x[i]:
                j -= 1
            found.add(at + i)
            j -= 1
    return found


def _address(url: str | None) -> tuple[str, str]:
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or ""), (parts.path.rstrip("/") or "/") + ("?" + parts.query if parts.query else "")
    except ValueError:
        return "", url or ""


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of a page without chrome, packed, and their kinds, hashes and sizes."""
    for whole in batches:
        for i in range(0, len(whole), 512):
            batch = whole.slice(i, 512)
            texts, kept_kinds, hashes, sizes = [], [], [], []
            for source in batch.column("html"):
                lines, kinds = page_lines(source.as_py())
                texts.append([t.replace("\0", "\ufffd") for t, k in zip(lines, kinds, strict=True) if k])
                kept_kinds.append([k for k in kinds if k])
                hashes.append(np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for t in texts[-1]], np.uint64).view(np.int64))
                sizes.append([len(t) for t in texts[-1]])
            address = [_address(x.as_py()) for x in batch.column("url")]
            hosts, paths = (pa.array([x[j] for x in address], pa.string()) for j in (0, 1))
            lists = [pa.array([zlib.compress("\0".join(x).encode("utf-8", "surrogatepass"), 6) for x in texts], pa.binary()), *(pa.array(x, pa.list_(t)) for x, t in ((kept_kinds, pa.int8()), (hashes, pa.int64()), (sizes, pa.int32())))]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), hosts, paths, *lists], ["page_id", "url", "host", "path", "lines", "kinds", "hashes", "sizes"])


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _main(page: dict) -> tuple[list[int], int, list[int]]:
    """Hashes, characters and sizes of a page's lines inside article and main elements."""
    if "main" not in page:
        at = [i for i, k in enumerate(page["kinds"]) if k == 2]
        page["main"] = [page["hashes"][i] for i in at], sum(page["sizes"][i] for i in at), [page["sizes"][i] for i in at]
    return page["main"]


def _alike(page: dict, other: dict) -> tuple[bool, bool]:
    """Whether the pages are copies of one article, and whether they look like it."""
    if page["hashes"] == other["hashes"]:
        return True, True
    (mine, all_mine, sizes), (theirs, all_theirs, _) = _main(page), _main(other)
    if mine and theirs:
        copy = mine == theirs or sum(sizes[i] for i in shared_lines(mine, theirs)) >= COPY * max(all_mine, all_theirs)
        return copy, copy
    shared = sum(page["sizes"][i] for i in shared_lines(page["hashes"], other["hashes"]))
    return False, shared >= COPY * max(sum(page["sizes"]), sum(other["sizes"]))


def _nearest(pages: list[dict], step: int) -> tuple[list[int | None], list[int | None]]:
    """For each page, where in this direction the nearest page of its host is that is no copy, and the nearest that does not look like one."""
    near: list[int | None] = [None] * len(pages)
    far: list[int | None] = [None] * len(pages)
    for i in range(len(pages))[:: -step]:
        for found, which in ((near, 0), (far, 1)):
            j: int | None = i + step
            while j is not None and 0 <= j < len(pages) and pages[j]["host"] == pages[i]["host"]:
                if not _alike(pages[i], pages[j])[which]:
                    found[i] = j
                    break
                j = found[j]  # all up to there are copies of the copy
    return near, far


def _runs(pages: Iterable[dict], most: int) -> tuple[list[dict], str]:
    """The first page of each of the first runs of equals of the first page's host, and how they end: "host" with the host, "cut" after most runs, "open" with the pages given."""
    runs: list[dict] = []
    for page in pages:
        if runs and page["host"] != runs[0]["host"]:
            return runs, "host"
        if not runs or not _alike(runs[-1], page)[1] or (len(runs) + 1 < most and not _alike(runs[-1], page)[0]):
            if len(runs) == most:
                return runs, "cut"
            runs.append(page)
    return runs, "open"


VIEW = pa.struct([("host", pa.string()), ("path", pa.string()), ("hashes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("kinds", pa.list_(pa.int8()))])
SEEN = "array<struct<host:string,path:string,hashes:array<bigint>,sizes:array<int>,kinds:array<tinyint>>>"
SIDES = f"way int, range int, reach int, ends string, runs {SEEN}"
SIDE = pa.schema([("way", pa.int32()), ("range", pa.int32()), ("reach", pa.int32()), ("ends", pa.string()), ("runs", pa.list_(VIEW))])


def _sides(rows: list[tuple[int, int, int, tuple[list[dict], str]]]) -> pa.RecordBatch:
    plain = [[{f.name: x[f.name] for f in VIEW} for x in runs] for *_, (runs, _) in rows]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int32()) for k in range(3)] + [pa.array([r[3][1] for r in rows]), pa.array(plain, pa.list_(VIEW))], schema=SIDE)


def _views(rows: pa.Table) -> tuple[pa.Table, list[dict]]:
    rows = rows.sort_by([("host", "ascending"), ("path", "ascending"), ("page_id", "ascending"), ("row", "ascending")])
    return rows, rows.select([f.name for f in VIEW]).to_pylist()


def _showing(most: int) -> Callable[[pa.Table], pa.Table]:
    def ends(rows: pa.Table) -> pa.Table:
        """Of a range, the runs that are seen from the range after it, looking back (way -1), and from the one before it, looking on (way 1)."""
        _, pages = _views(rows)
        at = rows.column("range")[0].as_py()
        return pa.Table.from_batches([_sides([(-1, at, 1, _runs(reversed(pages), most)), (1, at, 1, _runs(pages, most))])])

    return ends


def _exchange(sides: DataFrame, most: int) -> DataFrame:
    """Sides whose runs end with their range go on with those of the range next to what they have seen, which has seen as much: steps double."""

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for r in batch.to_pylist():
                runs, ends = (r["runs"], "host") if r["next_ends"] is None else _runs([*r["runs"], *r["next_runs"]], most)
                made.append((r["way"], r["range"], r["reach"] + (r["next_reach"] or 0), (runs, r["next_ends"] if ends == "open" else ends)))
            yield _sides(made)

    while not sides.where("ends = 'open'").isEmpty():
        beyond = sides.select("way", F.col("range").alias("next"), F.col("reach").alias("next_reach"), F.col("ends").alias("next_ends"), F.col("runs").alias("next_runs"))
        going = sides.where("ends = 'open'").withColumn("next", F.col("range") + F.col("way") * F.col("reach")).join(beyond, ["way", "next"], "left")
        sides = materialize(going.drop("next").mapInArrow(go_on, SIDES).unionByName(sides.where("ends <> 'open'")), "page_sides")
    return sides


def _difference(rows: pa.Table, beside: pa.Table) -> pa.Table:
    """Which lines of each page its partner does not share; null for a page without one, or of which nothing would be left. ``cut`` if the range must see more runs for that."""
    if not len(rows):
        return pa.table({"range": pa.array([], pa.int32()), "row": pa.array([], pa.int64()), "kept": pa.array([], pa.list_(pa.bool_())), "cut": pa.array([], pa.bool_())})
    rows, own = _views(rows)
    sides = {r["way"]: r for r in beside.to_pylist()}
    before, after = (sides[way]["runs"] if way in sides else [] for way in (-1, 1))
    # Views of other hosts are nobody's partners.
    pages = [*before[::-1], *own, *after]
    back, on, kept = _nearest(pages, -1), _nearest(pages, 1), []
    cut = False
    for i in range(len(before), len(before) + len(own)):
        page = pages[i]
        for way, near, side in ((-1, back, before), (1, on, after)):
            # It has looked through all of a side that goes on.
            cut |= bool(side) and sides[way]["ends"] == "cut" and side[0]["host"] == page["host"] and (near[0][i] is None or near[1][i] is None)
        beside_it = [[j for j in (back[k][i], on[k][i]) if j is not None] for k in (1, 0)]
        near = sorted((pages[j] for j in beside_it[0] or beside_it[1]), key=lambda x: -_common(x["path"], page["path"]))
        left = ([k not in shared for k in range(len(page["hashes"]))] for shared in (shared_lines(page["hashes"], x["hashes"]) for x in near))
        kept.append(next((x for x in left if any(x)), None))
    return pa.table({"range": rows.column("range"), "row": rows.column("row"), "kept": pa.array(kept, pa.list_(pa.bool_())), "cut": pa.array([cut] * len(kept), pa.bool_())})


def _differences(ordered: DataFrame) -> DataFrame:
    """(row, kept) of ordered pages. Ranges that see too few runs over a border look again, at four times as many."""
    most, done, todo = BESIDE, [], ordered
    while True:
        sides = _exchange(materialize(ordered.groupBy("range").applyInArrow(_showing(most), SIDES), "page_ends"), most)
        # What a range sees looking back is what the range before it shows, and so on.
        shown = sides.withColumn("range", F.col("range") - F.col("way"))
        found = materialize(todo.groupBy("range").cogroup(shown.groupBy("range")).applyInArrow(_difference, "range int, row long, kept array<boolean>, cut boolean"), "page_kept")
        done.append(found.where("not cut").select("row", "kept"))
        short = found.where("cut").select("range").distinct()
        if short.isEmpty():
            return reduce(DataFrame.unionByName, done)
        todo, most = todo.join(short, "range", "left_semi"), most * 4


def _text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for packed, kept in zip(batch.column("lines"), batch.column("kept"), strict=True):
            lines = zlib.decompress(packed.as_py()).decode("utf-8", "surrogatepass").split("\0")
            texts.append("\n\n".join(t for t, k in zip(lines, kept.as_py(), strict=False) if k))  # no lines are one empty one
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) -> (page_id, url, text), a row for each page."""
    kind = pages.schema["page_id"].dataType.simpleString()
    parsed = pages.select("page_id", "url", "html").mapInArrow(
        _parse, f"page_id {kind}, url string, host string, path string, lines binary, kinds array<tinyint>, hashes array<long>, sizes array<int>"
    )
    parsed = materialize(parsed.withColumn("row", F.monotonically_increasing_id()), "pages")
    # Every bound of a range is a key that some row has, so only the last ranges can be empty, and neighbours have consecutive numbers.
    key = ["host", "path", "page_id", "row"]
    order = parsed.where(F.size("hashes") > 0).select(*key, "hashes", "sizes", "kinds")
    ranges = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-order.count() // RANGE_PAGES))
    ordered = materialize(order.repartitionByRange(ranges, *key).withColumn("range", F.spark_partition_id()), "page_order")
    kept = _differences(ordered)
    both = parsed.select("row", "page_id", "url", "lines", "kinds").hint("merge").join(kept, "row", "left")  # never a broadcast: kept grows with the pages
    by_structure = F.transform("kinds", lambda k: (k >= 2) | ~F.array_contains("kinds", F.lit(2).cast("tinyint")))
    return both.select("page_id", "url", "lines", F.coalesce("kept", by_structure).alias("kept")).mapInArrow(_text, f"page_id {kind}, url string, text string")


def op9_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

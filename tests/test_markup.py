import unicodedata

import pytest
from hypothesis import assume, given, settings
from hypothesis import strategies as st

from docflow.markup import article, inline, records, tables
from docflow.markup.fixed import GONE
from docflow.markup.html import html_markdown
from docflow.markup.tree import parse_xml, to_xml

X = 'xmlns:xlink="http://www.w3.org/1999/xlink"'


def body(inner: str, **kw) -> str:
    return article.convert(parse_xml(f"<article {X}><body>{inner}</body></article>"), "T", **kw).removeprefix("# T\n\n## Abstract\n\n").removeprefix("## Main text\n\n").rstrip("\n")


@pytest.mark.parametrize(
    ("xml", "markdown"),
    [
        ("<p>a <italic> b </italic>c</p>", "a *b* c"), ("<p>10<sup>9</sup>/L H<sub>2</sub>O</p>", "10<sup>9</sup>/L H<sub>2</sub>O"), ("<p>x (<xref ref-type='bibr'>1</xref>, <xref ref-type='bibr'>2</xref>).</p>", "x."),
        ("<p>x<sup><xref ref-type='bibr'>1</xref>,<xref ref-type='bibr'>2</xref></sup> y</p>", "x y"), ("<p>see <xref ref-type='table'>Table 2</xref></p>", "see Table 2"),
        ("<p><ext-link xlink:href='https://e.org/a'>guide</ext-link></p>", "[guide](https://e.org/a)"), ("<p><ext-link xlink:href='https://e.org/a'>https://e.org/a</ext-link></p>", "https://e.org/a"),
        ("<p><ext-link xlink:href='ftp://e.org'>f</ext-link></p>", "f"), ("<p>1. x</p><p># y</p>", "1\\. x\n\n\\# y"), ("<p>a_b &lt;i> c &lt; d</p>", "a\\_b &lt;i> c < d"),
        ("<disp-formula><alternatives><math>x=1</math><tex-math>$$x = 1$$</tex-math></alternatives></disp-formula>", "$$x = 1$$"), ("<p><inline-formula><math>a</math></inline-formula></p>", "a"),
        ("<list list-type='order'><list-item><p>a</p><list><list-item><p>b</p></list-item></list></list-item><list-item/><list-item><p>c</p><p>d</p></list-item></list>", "1. a\n   - b\n2. c\n\n   d"),
        ("<def-list><def-item><term>K</term><def><p>potassium</p></def></def-item><def-item><term>x</term></def-item></def-list>", "- **K**: potassium\n- x"),
        ("<disp-quote><p>a</p><p>b</p></disp-quote>", "> a\n>\n> b"), ("<boxed-text><caption><title>Key</title></caption><p>x</p></boxed-text>", "**Key**\n\nx"),
        ("<preformat>\n a\n  b\n</preformat>", "```\n a\n  b\n```"), ("<statement><label>L</label><title>T</title><p>x</p></statement>", "**L T**\n\nx"),
        ("<fig id='F 1'><label>Figure 1.</label><caption><p>Flow.</p><p>More.</p></caption><graphic/></fig>", "::: figure id=F_1\n\n**Figure 1. Flow.**\n\nMore.\n\n:::"),
        ("<p>before <fig><label>F</label></fig> after</p>", "before\n\n::: figure id=f1\n\n**F.**\n\n:::\n\nafter"), ("<sec><title>1. Funding.</title><p>x</p></sec><p>y</p>", "y"),
        ("<sec sec-type='COI-statement'><title>S</title><p>x</p></sec><p>y</p>", "y"), ("<sec><sec><title>Deep</title><p>x</p></sec></sec>", "## Deep\n\nx"), ("<unknown><p>x</p></unknown>", "x"),
        ("<table-wrap><label>Table 1</label><table><tr><th>A</th></tr><tr><td>b|c</td></tr></table><table-wrap-foot><fn><label>a</label><p>n</p></fn><p>- m</p></table-wrap-foot></table-wrap>",
         "::: table id=t1\n\n**Table 1.**\n\n| A |\n| --- |\n| b\\|c |\n\n<sup>a</sup> n\n\n\\- m\n\n:::"),
    ],
)
def test_blocks(xml, markdown):
    assert body(xml) == markdown


def test_headings_stop_at_six():
    deep = "".join(f"<sec><title>L{i}</title>" for i in range(7)) + "<p>x</p>" + "</sec>" * 7
    assert "###### L4\n\n###### L5\n\n###### L6" in body(deep)


def grid(xml: str) -> str:
    return tables.table_markdown(parse_xml(f"<table>{xml}</table>"))


def test_tables():
    head = "<thead><tr><th rowspan='2'>N</th><th colspan='2'>M</th></tr><tr><th>HD</th><th>PD</th></tr></thead>"
    assert grid(head + "<tbody><tr><td>P</td><td>1</td><td>2</td></tr></tbody>") == "| N | M / HD | M / PD |\n| --- | --- | --- |\n| P | 1 | 2 |"
    assert grid("<tr><td rowspan='9'>a</td><td>b</td></tr><tr><td>c</td></tr>") == "| a | b |\n| --- | --- |\n| a | c |"
    assert grid("<thead/><tr><td>a</td></tr>") == "|  |\n| --- |\n| a |"
    assert grid("<tr><td colspan='x'>a</td><td rowspan='0'>b</td></tr><tr><td>c</td></tr>") == "| a | b |\n| --- | --- |\n| c |  |"
    assert grid("") == ""


def test_abstracts():
    def with_abstract(inner: str) -> str:
        return article.convert(parse_xml(f"<article><front><article-meta>{inner}</article-meta></front></article>"), "T", [("LABEL", "1. of the record"), (None, "b")])

    assert with_abstract("<abstract abstract-type='graphical'><p>g</p></abstract><abstract><sec><title>B</title><p>x</p></sec></abstract>") == "# T\n\n## Abstract\n\n### B\n\nx\n"
    assert with_abstract("<abstract abstract-type='toc'><p>g</p></abstract>") == "# T\n\n## Abstract\n\n### LABEL\n\n1\\. of the record\n\nb\n"


def test_no_abstract_no_body_and_normal_form():
    assert article.convert(parse_xml("<article/>"), "T") == "# T\n\n## Abstract\n"
    out = body("<p>cafe&#769;</p>")
    assert out == "café" and unicodedata.is_normalized("NFC", out)


def test_parser_is_safe_and_round_trips():
    evil = b'<!DOCTYPE a [<!ENTITY x "boom"><!ENTITY f SYSTEM "file:///etc/passwd">]><a>1&x;2&f;3<!-- c --><?pi?>4&amp;</a>'
    assert parse_xml(evil).text == "1234&"
    source = f'<a {X} id="1"><b xlink:href="u&amp;v">t&lt;</b>x<c/></a>'
    again = to_xml(parse_xml(source))
    assert to_xml(parse_xml(again)) == again and parse_xml(again).first("b").get("href", "http://www.w3.org/1999/xlink") == "u&v"
    with pytest.raises(ValueError, match="well-formed"):
        parse_xml("<a>")


RECORD = """<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>7</PMID><Article><Journal><Title>J</Title><JournalIssue><PubDate><MedlineDate>2023 Jan-Feb</MedlineDate></PubDate></JournalIssue></Journal>
<ArticleTitle>On <i>x</i>.</ArticleTitle><Abstract><AbstractText Label=" AIM ">a<sup>2</sup></AbstractText><AbstractText> </AbstractText></Abstract><AuthorList><Author><LastName>Rossi</LastName><Initials>M</Initials></Author>
<Author><CollectiveName>Group</CollectiveName></Author><Author/></AuthorList><Language>eng</Language><PublicationTypeList><PublicationType>RETRACTED publication</PublicationType></PublicationTypeList></Article>
<CommentsCorrectionsList><CommentsCorrections RefType="Cites"/></CommentsCorrectionsList></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType="pmc"> </ArticleId><ArticleId IdType="pmc">PMC9</ArticleId></ArticleIdList>
<ReferenceList><Reference><ArticleIdList><ArticleId IdType="doi">no</ArticleId></ArticleIdList></Reference></ReferenceList></PubmedData></PubmedArticle></PubmedArticleSet>"""


def test_records():
    (r,) = records.parse_records(RECORD)
    assert (r["pmid"], r["title"], r["authors"], r["journal"], r["free_date"], r["pmcid"], r["doi"], r["retracted"]) == ("7", "On x.", ["M Rossi", "Group"], "J", "2023 Jan-Feb", "PMC9", None, True)
    assert r["abstract"] == [{"label": "AIM", "text": "a<sup>2</sup>"}]
    assert not next(records.parse_records(RECORD.replace("RETRACTED publication", "Review")))["retracted"]
    assert next(records.parse_records(RECORD.replace("RETRACTED publication", "Review").replace("Cites", "RetractionIn")))["retracted"]
    with pytest.raises(ValueError, match="no id"):
        list(records.parse_records("<PubmedArticle/>"))


def test_articles():
    meta = "<front><article-meta><article-id pub-id-type='pmc-uid'>5</article-id><article-id pub-id-type='pmcid'>PMC4.1</article-id><permissions>{}</permissions></article-meta></front>"
    xml = f"<s {X}><article>{meta.format('<license license-type=\"open\"><p><ext-link xlink:href=\" u \"/></p></license>')}<body> <p> </p></body></article><article/><article>{meta.format('<license/><license license-type=\"t\"/>')}<body>x</body></article></s>"
    found = list(records.parse_articles(xml))
    assert [(a["pmcid"], a["license_raw"], a["has_body"]) for a in found] == [("PMC41", "u", False), ("PMC41", "t", True)]


def test_html():
    page = "<html><head><title>x</title><style>p{}</style></head><body><nav>menu</nav><div class='ad'>buy</div><article><h1>A &amp; b</h1><p>x <b>y</b><br>z<p>q<ul><li>1<li>2</ul><table><tr><th>a<th>b<tr><td>1<td>2</table></article><script>var t='</p>'</script><footer>f</footer>"
    assert html_markdown(page) == "# A & b\n\nx **y** z\n\nq\n\n- 1\n- 2\n\n| a | b |\n| --- | --- |\n| 1 | 2 |\n"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 4)), max_size=4), max_size=6))
def test_spans_fill_a_plane(shapes):
    """Cells on squared paper, where none runs into another."""
    rows, taken = [[tables.Cell(f"{i}.{k}", *shape) for k, shape in enumerate(row)] for i, row in enumerate(shapes)], {}
    for y, row in enumerate(rows):
        x = 0
        for cell in row:
            while (y, x) in taken:
                x += 1
            assume(not any((y, x + k) in taken for k in range(cell.across)))
            taken.update({(y + dy, x + dx): cell.text for dy in range(cell.down) for dx in range(cell.across)})
    width = [max((x + 1 for at, x in taken if at == y), default=0) for y in range(len(rows))]
    assert tables.fill_grid(rows) == [[taken.get((y, x), "") for x in range(width[y])] for y in range(len(rows))]


@pytest.mark.parametrize(
    ("rows", "grid"),
    [
        ([[("a", 1, 1), ("b", 1, 3)], [("c", 2, 1)], [("d", 1, 1)], [("e", 1, 1)]], ["a b", "c c", "d b", "e b"]),  # b waits under c for a row
        ([[("a", 1, 1), ("b", 1, 3)], [("c", 2, 2)], [("d", 1, 1)], [("e", 1, 1)]], ["a b", "c c", "c c d", "e"]),  # c goes on, and b is gone
        ([[("a", 1, 1), ("b", 2, 3)], [("c", 2, 1)], []], ["a b b", "c c b", " b b"]),
    ],
)
def test_cells_that_run_into_others(rows, grid):
    assert [" ".join(r) for r in tables.fill_grid([[tables.Cell(*c) for c in row] for row in rows])] == grid


def test_a_table_of_too_many_cells_is_an_error():
    for span in ("colspan='1000000000'", "colspan='2000' rowspan='2000'"):
        xml = f"<table><tr><td {span}>x</td></tr>" + "<tr><td>y</td></tr>" * 2000 + "</table>"
        with pytest.raises(ValueError, match="cells"):
            tables.table_markdown(parse_xml(xml))
    many = "<table>" + "<tr>" + "<td>x</td>" * 20_000 + "</tr>" + "<tr><td rowspan='3'>y</td></tr>" * 40 + "</table>"
    assert tables.table_markdown(parse_xml(many)).count("\n") == 41


@pytest.mark.parametrize(
    ("text", "tidied"),
    [
        ("x (G).", "x."), ("x [G, G; G] y", "x y"), ("x (see G) y", "x (see) y"), ("x (G, see y)", "x (see y)"), ("x (y; G)", "x (y)"), ("x G, G y", "x y"), ("x G and G.", "x and."), ("(G", "("), ("G)", ")"), ("((G) G)", "()"),
        ("G", ""), ("a G–G b", "a b"), ("a  (  G  )b", "ab"), ("(G (G) G)", "()"), ("[G;(G,x)]", "[(x)]"), ("a,G)", "a)"), ("a ,G b", "a , b"), ("(G]x", "x"), ("no", "no"), ("", ""),
    ],
)
def test_tidy(text, tidied):
    assert inline.tidy(text.replace("G", GONE)) == tidied


@pytest.mark.parametrize(
    ("text", "guarded"),
    [
        ("1. x", "1\\. x"), ("12) x", "12\\) x"), ("1.x", "1.x"), ("1.", "1."), ("٣. x", "٣\\. x"), ("# x", "\\# x"), ("###### x", "\\###### x"), ("####### x", "####### x"), ("#x", "#x"), ("> x", "\\> x"), ("+ x", "\\+ x"),
        ("- x", "\\- x"), ("-x", "-x"), ("---", "\\---"), ("--", "--"), (":::x", "\\:::x"), ("", ""), ("x", "x"), ("-", "-"),
    ],
)
def test_guard(text, guarded):
    assert inline.guard(text) == guarded

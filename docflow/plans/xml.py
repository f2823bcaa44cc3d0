"""Queries on records, articles and pages: documents are written as markup, read back by the product's parsers and converter, and held
against SQL that makes the same Markdown from the documents themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import udfs
from ..functions import clean_title
from ..operators import ranking
from .records import table

XLINK = 'xmlns:xlink="http://www.w3.org/1999/xlink"'


def xml_text(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, id (as a string), source, lang, first (line, escaped for XML) and lines (escaped for XML) of whole texts."""
    text = xml_text(F.coalesce("text", F.lit("")))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("id"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"), text.alias("text"))
    return rows.withColumn("lines", F.split("text", "\n")).withColumn("first", F.col("lines")[0])


def _each(make) -> Column:
    """make(line, number from 0) for every line, joined."""
    return F.array_join(F.transform("lines", make), "")


def _by(number: int, *cases: Column | str) -> Column:
    """The case that doc_id chooses, by remainder."""
    return F.element_at(F.array(*[F.lit(c) if isinstance(c, str) else c for c in cases]), (F.pmod(F.col("doc_id"), F.lit(number)) + 1).cast("int"))


def _cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


# SQL forms of the contract's text rules.
def _esc(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '([\\*_`])', '\\\1', 'g'), '<([A-Za-z/!?])', '&lt;\1', 'g')"


def _sq(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '\s+', ' ', 'g'), '^ | $', '', 'g')"


def _guard(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '^(\d+)([.)])(\s)', '\1\\\2\3'), '^(#{{1,6}}\s|[>+\-]\s|:::|---)', '\\\1')"


def _case(number: int, *cases: str) -> str:
    return f"CASE doc_id % {number} " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(cases)) + " END"


_NL = "chr(10) || chr(10)"
_DOCS = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
t AS (SELECT *, list_transform(lines, lambda l: {_sq(_esc('l'))}) AS tidy, {_sq('lines[1]')} AS first FROM d)"""


def _joined(make: str, keep: str = "x <> ''", sep: str = _NL) -> str:
    """make: SQL of a block from x, a tidy line, and i, its number from 1; blocks of lines that are kept, joined."""
    numbered = "list_transform(tidy, lambda x, i: {'x': x, 'i': i})"
    return f"array_to_string(list_transform(list_filter({numbered}, lambda r: {keep.replace('x ', 'r.x ')}), lambda r: {make}), {sep})"


def _blocks(*parts: str) -> str:
    """Blocks with a blank line between; empty ones are left out."""
    return f"array_to_string(list_filter([{', '.join(parts)}], lambda b: b <> ''), {_NL})"


def _digest(markdown: str) -> str:
    return f"length({markdown})::BIGINT AS chars, sha256({markdown}) AS markdown_sha256"


def _digested(markdown: Column) -> list[Column]:
    return [F.length(markdown).cast("long").alias("chars"), F.sha2(markdown, 256).alias("markdown_sha256")]


# Records.
def xml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    person = _cat("<Author><LastName>Byron", F.col("id"), "</LastName><ForeName>Ada</ForeName><Initials>A</Initials></Author>")
    authors = _by(
        4, person, _cat("<Author><LastName>Byron</LastName><Initials>B", F.col("id"), "</Initials></Author><Author/>"), _cat("<Author><CollectiveName>Group ", F.col("id"), "</CollectiveName></Author>"),
        _cat(person, "<Author><LastName>X</LastName><CollectiveName> The  group </CollectiveName></Author>"),
    )
    date = _by(
        5, _cat("<Year>2020</Year><Month>Mar</Month><Day>", (F.pmod("doc_id", F.lit(28)) + 1).cast("string"), "</Day>"), "<Year>2021</Year><Month>7</Month>", "<MedlineDate>1998 Dec-1999 Jan</MedlineDate>",
        "<Year>2019</Year><Season>Winter</Season><Day>3</Day>", "<MedlineDate>undated</MedlineDate>",
    )
    abstract = _each(lambda x, i: _cat("<AbstractText", F.when(i % 2 == 0, F.concat(F.lit(' Label=" L'), i.cast("string"), F.lit(' "'))).otherwise(""), ">", x, "</AbstractText>"))
    ids = _cat(
        _by(3, _cat('<ArticleId IdType="pmc"> </ArticleId><ArticleId IdType="pmc">PMC', F.col("id"), "</ArticleId>"), "", _cat('<ArticleId IdType="pmc">PMC', F.col("id"), "</ArticleId>")),
        _by(2, _cat('<ArticleId IdType="doi">10.1/x', F.col("id"), "</ArticleId>"), ""),
    )
    page = _cat(
        "<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>", F.col("id"), "</PMID><Article><Journal><Title>", xml_text(F.col("source")), "</Title><JournalIssue><PubDate>", date, "</PubDate></JournalIssue></Journal><ArticleTitle>On <i>",
        F.col("first"), "</i>.</ArticleTitle><Abstract>", abstract, "</Abstract><AuthorList>", authors, "</AuthorList><Language>", F.col("lang"), "</Language><Language>eng</Language><PublicationTypeList><PublicationType>",
        _by(7, "Review", "RETRACTED publication", "Letter", "Review", "Retraction of Publication", "Review", "Editorial"), "</PublicationType></PublicationTypeList></Article><CommentsCorrectionsList><CommentsCorrections RefType=\"",
        _by(7, "Cites", "Cites", "RetractionIn", "ErratumIn", "Cites", "Cites", "Cites"), "\"/></CommentsCorrectionsList><MeshHeadingList><MeshHeading><DescriptorName>Adult</DescriptorName><QualifierName>no</QualifierName></MeshHeading><MeshHeading><DescriptorName>",
        xml_text(F.col("source")), "</DescriptorName></MeshHeading></MeshHeadingList></MedlineCitation><PubmedData><ArticleIdList>", ids,
        '</ArticleIdList><ReferenceList><Reference><ArticleIdList><ArticleId IdType="doi">no</ArticleId></ArticleIdList></Reference></ReferenceList></PubmedData></PubmedArticle></PubmedArticleSet>',
    )
    parsed = udfs.parse_records(_docs(spark, sf_dir).select(F.col("doc_id").alias("page"), page.alias("xml")))
    told = F.array_join(F.transform("abstract", lambda s: F.concat(F.coalesce(s["label"], F.lit("-")), F.lit(":"), s["text"], F.lit("\n"))), "")
    return parsed.select(
        "pmid", "title", F.array_join("authors", "; ").alias("authors"), F.coalesce("journal", F.lit("")).alias("journal"), "published", F.array_join("languages", ",").alias("languages"), F.array_join("mesh_terms", ",").alias("mesh_terms"),
        F.array_join("publication_types", ",").alias("publication_types"), "doi", "pmcid", F.size("abstract").cast("long").alias("sections"), F.sha2(told, 256).alias("abstract_sha256"), "retracted",
    )


_SECTIONS = "list_filter(list_transform(tidy, lambda x, i: {'x': x, 'l': CASE WHEN i % 2 = 1 THEN 'L' || (i - 1) ELSE '-' END}), lambda r: r.x <> '')"
XML_RECORDS = f"""{_DOCS}
SELECT doc_id::VARCHAR AS pmid, {_sq("'On ' || lines[1] || '.'")} AS title, {_case(4, "'Ada Byron' || doc_id", "'B' || doc_id || ' Byron'", "'Group ' || doc_id", "'Ada Byron' || doc_id || '; The group'")} AS authors, source AS journal,
  {_case(5, "'2020-03-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0')", "'2021-07'", "'1998-12'", "'2019'", "NULL")} AS published, lang || ',eng' AS languages, 'Adult,' || source AS mesh_terms,
  {_case(7, "'Review'", "'RETRACTED publication'", "'Letter'", "'Review'", "'Retraction of Publication'", "'Review'", "'Editorial'")} AS publication_types, CASE WHEN doc_id % 2 = 0 THEN '10.1/x' || doc_id END AS doi,
  CASE WHEN doc_id % 3 <> 1 THEN 'PMC' || doc_id END AS pmcid, len({_SECTIONS})::BIGINT AS sections, sha256(array_to_string(list_transform({_SECTIONS}, lambda r: r.l || ':' || r.x || chr(10)), '')) AS abstract_sha256, doc_id % 7 IN (1, 2, 4) AS retracted FROM t"""


# Article sets: of articles with one id, the last counts.
def xml_article_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    license_ = _by(
        4, _cat('<license/><license license-type="open" xlink:href="no"><license_ref> ref ', F.col("id"), " </license_ref></license>"), _cat('<license license-type="open" xlink:href="own ', F.col("id"), '"><p><ext-link xlink:href="no"/></p></license>'),
        _cat('<license license-type="open"><license-p>x <ext-link xlink:href="link ', F.col("id"), '"/></license-p></license>'), '<license/><license license-type="open-access"/><license license-type="later"/>',
    )
    kind = _by(3, "pmcid", "pmc", "pmc-uid")
    own = F.pmod(F.col("doc_id"), F.lit(50)).cast("string")
    page = _cat(
        "<pmc-articleset ", XLINK, "><article><front><article-meta><article-id pub-id-type='doi'>1</article-id></article-meta></front><body>no</body></article><article><front><article-meta><article-id pub-id-type='pmid'>7</article-id><article-id pub-id-type='", kind,
        "'>PMC", own, "</article-id><permissions>", license_, "</permissions></article-meta></front><body><sec><p> ", _each(lambda x, i: F.concat(F.lit("<b>"), x, F.lit("</b> "))), "</p></sec></body></article></pmc-articleset>",
    )
    found = udfs.parse_articles(_docs(spark, sf_dir).select(F.col("doc_id").alias("page"), page.alias("xml")))
    return ranking.last_seen(found, ["pmcid"], ["page", "at"]).select("pmcid", F.col("page").alias("doc_id"), "license_raw", "has_body")


XML_ARTICLE_SETS = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (PARTITION BY doc_id % 50 ORDER BY doc_id DESC) AS r FROM documents)
SELECT 'PMC' || doc_id % 50 AS pmcid, doc_id, {_case(4, "'ref ' || doc_id", "'own ' || doc_id", "'link ' || doc_id", "'open-access'")} AS license_raw, regexp_matches(text, '\S') AS has_body FROM d WHERE r = 1"""


# Articles to Markdown.
def _article(body: Column, front: Column | str = "") -> Column:
    return _cat("<article ", XLINK, ' xmlns:mml="http://www.w3.org/1998/Math/MathML">', front, "<body>", body, "</body><back><ack><p>thanks</p></ack><ref-list><title>References</title><ref>r</ref></ref-list></back></article>")


NO_ABSTRACT = "array<struct<label:string,text:string>>"


def _converted(docs: DataFrame, body: Column) -> DataFrame:
    """Markdown of an article of this body, without its opening."""
    made = udfs.convert_article(F.encode(_article(body), "UTF-8"), F.lit("T"), F.array().cast(NO_ABSTRACT))["body"]
    return docs.select("doc_id", made.alias("m")).select("doc_id", *_digested(F.col("m")))


_OPENING = f"'# T' || {_NL} || '## Abstract'"


def _body_sql(*blocks: str) -> str:
    """The whole Markdown of an article whose body makes these blocks, none of them a heading of level two."""
    inside = _blocks(*blocks)
    return f"{_OPENING} || CASE WHEN {inside} <> '' THEN {_NL} || '## Main text' || {_NL} || {inside} ELSE '' END || chr(10)"


def article_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles, the choice of abstract, sections that are nested, untitled or hidden, and paragraphs."""
    front = _cat(
        "<front><article-meta>", _by(2, _cat("<title-group><article-title>", F.col("first"), "</article-title></title-group>"), ""),
        _by(3, _cat("<abstract abstract-type='graphical'><p>no</p></abstract><abstract><sec><title>Aim</title><p>", F.col("first"), "</p></sec></abstract>"), "<abstract abstract-type='toc'><p>no</p></abstract>", ""), "</article-meta></front>",
    )
    body = _cat(
        _by(2, "", "<p>Opening <xref ref-type='bibr'>1</xref>.</p>"), "<sec><title>1. Findings</title>", _each(lambda x, i: F.concat(F.lit("<p>"), x, F.lit("</p>"))),
        "<sec><sec><title>Deep</title><p>end</p></sec></sec></sec><sec><title>2. Funding.</title><p>no</p></sec><sec sec-type='COI-statement'><title>S</title><p>no</p></sec><supplementary-material><p>no</p></supplementary-material>",
    )
    fallback = F.when(F.pmod("doc_id", F.lit(3)) == 1, F.array(F.struct(F.lit("BACK_GROUND").alias("label"), F.concat(F.lit("told by "), "id").alias("text")), F.struct(F.lit(None).cast("string").alias("label"), F.lit("1. numbered").alias("text")))).otherwise(F.array().cast(NO_ABSTRACT))
    rows = _docs(spark, sf_dir).withColumn("given", clean_title(F.lit(None).cast("string"), F.concat(F.lit("[Record "), "id", F.lit("]."))))
    made = rows.select("doc_id", udfs.convert_article(F.encode(_article(body, front), "UTF-8"), F.col("given"), fallback).alias("m"))
    return made.select("doc_id", F.col("m.title").alias("title"), *_digested(F.col("m.body")))


_TITLE = "CASE WHEN doc_id % 2 = 0 AND first <> '' THEN first ELSE 'Record ' || doc_id END"
_SECTIONED = f"""'# ' || {_esc(_TITLE)} || {_NL} || '## Abstract' || {_NL} ||
  {_case(3, f"'### Aim' || {_NL} || CASE WHEN tidy[1] <> '' THEN {_guard('tidy[1]')} || {_NL} ELSE '' END", rf"'### BACK\_GROUND' || {_NL} || 'told by ' || doc_id || {_NL} || '1\. numbered' || {_NL}", "''")}
  || {_case(2, "''", f"'## Main text' || {_NL} || 'Opening.' || {_NL}")} || '## 1. Findings' || {_NL} || {_blocks(_joined(_guard('r.x')), "'### Deep'", "'end'")} || chr(10)"""
ARTICLE_SECTIONS = f"{_DOCS}, m AS (SELECT doc_id, {_TITLE} AS title, {_SECTIONED} AS m FROM t) SELECT doc_id, title, {_digest('m')} FROM m"


def article_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered and plain lists with lists inside, empty items, and definitions."""
    nested = lambda x, i: F.when((i % 3 == 0) & x.rlike(r"\S"), F.concat(F.lit("<list><list-item><p>sub "), i.cast("string"), F.lit("</p></list-item></list>"))).otherwise("")
    items = _each(lambda x, i: F.concat(F.lit("<list-item><p>"), x, F.lit("</p>"), nested(x, i), F.lit("</list-item>")))
    terms = _each(lambda x, i: F.concat(F.lit("<def-item><term>"), x, F.lit("</term><def><p>d"), i.cast("string"), F.lit("</p></def></def-item>")))
    return _converted(_docs(spark, sf_dir), _cat("<list list-type='", _by(2, "order", "bullet"), "'>", items, "<list-item/></list><def-list>", terms, "</def-list>"))


_ITEM = "CASE WHEN doc_id % 2 = 0 THEN r.n || '. ' ELSE '- ' END"
_ITEMS = f"""array_to_string(list_transform(list_transform(list_filter(list_transform(tidy, lambda x, i: {{'x': x, 'i': i}}), lambda r: r.x <> ''), lambda r, n: {{'x': r.x, 'i': r.i, 'n': n}}),
  lambda r: {_ITEM} || r.x || CASE WHEN (r.i - 1) % 3 = 0 THEN chr(10) || repeat(' ', length({_ITEM})) || '- sub ' || (r.i - 1) ELSE '' END), chr(10))"""
_TERMS = "array_to_string(list_transform(tidy, lambda x, i: CASE WHEN x <> '' THEN '- **' || x || '**: d' ELSE '- d' END || (i - 1)), chr(10))"
ARTICLE_LISTS = f"{_DOCS}, m AS (SELECT doc_id, {_body_sql(_ITEMS, _TERMS)} AS m FROM t) SELECT doc_id, {_digest('m')} FROM m"


def article_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and tables in fences, with labels, captions, cells and footnotes."""
    paragraphs = _each(lambda x, i: F.concat(F.lit("<p>"), x, F.lit("</p>")))
    rows = _each(lambda x, i: F.concat(F.lit("<tr><td>"), i.cast("string"), F.lit("</td><td>"), x, F.lit("</td></tr>")))
    figure = _cat("<fig id='F ", F.col("id"), "'><label>Figure 1.</label><caption>", _by(2, "<title>Shown</title>", ""), paragraphs, "</caption><graphic/></fig>")
    grid = _cat(
        "<table-wrap><label>Table 1:</label><caption><title>Lines</title></caption><table><thead><tr><th>n</th><th>text</th></tr></thead><tbody>", rows,
        "</tbody></table><table-wrap-foot><fn><label>a</label><p>note</p></fn><p>- plain</p></table-wrap-foot></table-wrap>",
    )
    return _converted(_docs(spark, sf_dir), _cat(figure, grid))


_FULL = "list_filter(tidy, lambda x: x <> '')"
_CAPTION = f"CASE WHEN doc_id % 2 = 0 THEN {_FULL} ELSE {_FULL}[2:] END"
_HEAD = f"'**Figure 1.' || CASE WHEN doc_id % 2 = 0 THEN ' Shown' WHEN len({_FULL}) > 0 THEN ' ' || {_FULL}[1] ELSE '' END || '**'"
_FIGURE = _blocks("'::: figure id=F_' || doc_id", _HEAD, f"array_to_string(list_transform({_CAPTION}, lambda x: {_guard('x')}), {_NL})", "':::'")
_ROWS = "array_to_string(list_transform(tidy, lambda x, i: '| ' || (i - 1) || ' | ' || replace(x, '|', '\\|') || ' |'), chr(10))"
_GRID = _blocks("'::: table id=t1'", "'**Table 1. Lines**'", f"'| n | text |' || chr(10) || '| --- | --- |' || chr(10) || {_ROWS}", "'<sup>a</sup> note'", r"'\- plain'", "':::'")
ARTICLE_CAPTIONS = f"{_DOCS}, m AS (SELECT doc_id, {_body_sql(_FIGURE, _GRID)} AS m FROM t) SELECT doc_id, {_digest('m')} FROM m"


def article_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emphasis, raised text, citations that go, links, references that stay, formulas."""
    kinds = lambda x, i: F.element_at(F.array(
        F.concat(F.lit("<italic> "), x, F.lit(" </italic> end")), F.concat(F.lit("x<sup>"), x, F.lit("</sup> y")), F.concat(x, F.lit(" <xref ref-type='bibr'>1</xref>.")),
        F.concat(F.lit("<ext-link xlink:href='https://e.org/"), i.cast("string"), F.lit("'>"), x, F.lit("</ext-link>")), F.concat(F.lit("see <xref ref-type='table'>"), x, F.lit("</xref> ok")),
    ), (i % 5 + 1).cast("int"))
    formula = _cat("<disp-formula><label>(1)</label><alternatives><mml:math><mml:mi>no</mml:mi></mml:math><tex-math>$$x = ", F.col("id"), "$$</tex-math></alternatives></disp-formula><p>so <inline-formula><mml:math><mml:mi>a_b</mml:mi></mml:math></inline-formula></p>")
    return _converted(_docs(spark, sf_dir), _cat(_each(lambda x, i: F.concat(F.lit("<p>"), kinds(x, i), F.lit("</p>"))), formula))


_INLINE = """CASE (r.i - 1) % 5 WHEN 0 THEN CASE WHEN r.x <> '' THEN '*' || r.x || '* end' ELSE 'end' END WHEN 1 THEN CASE WHEN r.x <> '' THEN 'x<sup>' || r.x || '</sup> y' ELSE 'x y' END WHEN 2 THEN r.x || '.'
  WHEN 3 THEN CASE WHEN r.x <> '' THEN '[' || r.x || '](https://e.org/' || (r.i - 1) || ')' ELSE '' END ELSE regexp_replace('see ' || r.x || ' ok', ' +', ' ', 'g') END"""
_INLINE_BLOCKS = f"array_to_string(list_filter(list_transform(list_transform(tidy, lambda x, i: {{'x': x, 'i': i}}), lambda r: {_guard(_INLINE)}), lambda b: b <> ''), {_NL})"
ARTICLE_INLINE = f"{_DOCS}, m AS (SELECT doc_id, {_body_sql(_INLINE_BLOCKS, "'$$x = ' || doc_id || '$$'", r"'so a\_b'")} AS m FROM t) SELECT doc_id, {_digest('m')} FROM m"


def article_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxed text, quotations, code and statements."""
    paragraphs = _each(lambda x, i: F.concat(F.lit("<p>"), x, F.lit("</p>")))
    parts = ["<boxed-text><caption><title>Key <bold>points</bold></title></caption>", paragraphs, "</boxed-text><disp-quote>", paragraphs, "</disp-quote><preformat>", F.col("text"), "</preformat><statement><label>Rule 1</label><title>T_t</title><p>x</p></statement>"]
    return _converted(_docs(spark, sf_dir), _cat(*parts))


_QUOTE = _joined("'> ' || r.x", sep="chr(10) || '>' || chr(10)")
_CODE = r"CASE WHEN regexp_matches(text, '\S') THEN '```' || chr(10) || regexp_replace(text, '^\n+|\n+$', '', 'g') || chr(10) || '```' ELSE '' END"
ARTICLE_BOXES = f"{_DOCS}, m AS (SELECT doc_id, {_body_sql("'**Key **points****'", _joined(_guard('r.x')), _QUOTE, _CODE, r"'**Rule 1 T\_t**'", "'x'")} AS m FROM t) SELECT doc_id, {_digest('m')} FROM m"


# Web pages.
def html_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", udfs.html_to_markdown("html").alias("markdown"))


_ENTITIES = "replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"
_PLAIN = _sq(_esc(_ENTITIES.format(x="regexp_replace(b, '<[^>]*>', ' ', 'g')")))
#: The tables' pages have a heading and paragraphs, some of which begin in bold, inside one article.
HTML_TO_MARKDOWN = rf"""
WITH a AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS inside FROM pages),
b AS (SELECT page_id, list_filter(string_split_regex(inside, '</p>|<p>|</h1>'), lambda b: regexp_matches(b, '\S')) AS blocks FROM a)
SELECT page_id, array_to_string(list_transform(blocks, lambda b: CASE WHEN starts_with(b, '<h1>') THEN '# ' || {_PLAIN} WHEN starts_with(b, '<b>') THEN '**' || {_PLAIN} || '**' ELSE {_guard(_PLAIN)} END), {_NL}) || chr(10) AS markdown FROM b"""

QUERIES = {
    "xml_records": xml_records, "xml_article_sets": xml_article_sets, "article_sections": article_sections, "article_lists": article_lists, "article_captions": article_captions, "article_inline": article_inline,
    "article_boxes": article_boxes, "html_to_markdown": html_to_markdown,
}
ORACLES = {
    "xml_records": XML_RECORDS, "xml_article_sets": XML_ARTICLE_SETS, "article_sections": ARTICLE_SECTIONS, "article_lists": ARTICLE_LISTS, "article_captions": ARTICLE_CAPTIONS, "article_inline": ARTICLE_INLINE,
    "article_boxes": ARTICLE_BOXES, "html_to_markdown": HTML_TO_MARKDOWN,
}

"""Python functions, row by row or in small batches, for what needs a tree, YAML or Unicode normal forms; all else is built-in expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import frontmatter, schemas
from .functions.dates import partial_date
from .markup import article, html, inline, records, tables, tree

# Types and not DDL: this module is imported before there is a session.
KINDS = {"int": T.IntegerType(), "string": T.StringType(), "boolean": T.BooleanType(), "array<string>": T.ArrayType(T.StringType())}
FRONT = T.StructType([T.StructField(name, KINDS[kind]) for name, kind in schemas.FRONT_MATTER])
CONVERTED = T.StructType([T.StructField("title", T.StringType()), T.StructField("body", T.StringType()), T.StructField("error", T.StringType())])
ARROW = {"string": pa.string(), "boolean": pa.bool_(), "long": pa.int64(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()), f"array<{schemas.SECTION}>": pa.list_(pa.struct([("label", pa.string()), ("text", pa.string())]))}
#: Rows that a parser gathers before it passes them on.
ROWS = 128
#: Front matter with its fences, up to the first line that closes it.
FRONT_LINES = r"(?s)\A---\r?\n(?:.*?\n)??---\r?\n"
HEAD = T.StructType([T.StructField("front_matter", FRONT), T.StructField("error", T.StringType()), T.StructField("problems", T.ArrayType(T.StringType()))])


def _columns(ddl: str) -> pa.Schema:
    return pa.schema([(name, ARROW[kind]) for name, kind in (c.split(" ", 1) for c in ddl.split(", "))])


def _parsed(parse: Callable[[bytes], Iterator[dict]], columns: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What parse gives for each page of batches (page, xml), with page and position. A page is a Python value in its turn, and rows leave as soon as there are ROWS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for page, data in zip(*batch.columns, strict=True):
                for i, row in enumerate(parse(data.as_py())):
                    rows.append({"page": page.as_py(), "at": i, **row})
                    if len(rows) == ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema=columns)
                        rows.clear()
        yield pa.RecordBatch.from_pylist(rows, schema=columns)
        rows, batch = [], None
        pa.default_memory_pool().release_unused()  # the worker may wait long for its next task, beside others at work

    return run


def parse_records(pages: DataFrame, xml: str = "xml") -> DataFrame:
    """One row for each record in the pages' XML, with page and position; fails on a record without an id."""
    ddl = f"page long, at long, {schemas.PARSED}"
    parsed = pages.select("page", xml).mapInArrow(_parsed(records.parse_records, _columns(ddl)), ddl)
    dated = parsed.withColumn("published", partial_date(F.col("year"), F.col("month"), F.col("day"), F.col("free_date")))
    return dated.select("page", "at", *(c.split(" ")[0] for c in schemas.RECORDS.split(", ")))


def parse_articles(pages: DataFrame, xml: str = "xml") -> DataFrame:
    """One row for each article with an id in the pages' XML, with page and position; repeats are kept."""
    ddl = f"page long, at long, {schemas.ARTICLES}"
    return pages.select("page", xml).mapInArrow(_parsed(records.parse_articles, _columns(ddl)), ddl)


def _by_rows(kind: T.DataType):
    """A function of a row's values. Spark sends and takes 100 rows at a time, where an Arrow batch is up to 10,000: a worker holds few texts, whatever their number."""
    return F.udf(returnType=kind, useArrow=False)


@_by_rows(CONVERTED)
def convert_article(xml: bytes, title: str | None, abstract: list | None) -> tuple[str | None, str | None, str | None]:
    """Title and Markdown of an article, or why there is none; a failure stays with its document. title is that of the record, for an article without its own."""
    try:
        root, fallback = tree.parse_xml(xml), [(s["label"], s["text"]) for s in abstract or []]
        shown = article.title_of(root) or title or ""
        return shown, article.convert(root, shown, fallback), None
    except Exception as problem:  # noqa: BLE001
        return title, None, f"{type(problem).__name__}: {problem}"


@_by_rows(T.ArrayType(T.StringType()))
def contract_problems(front_matter: T.Row | None) -> list[str] | None:
    """What in drafted front matter breaks the contract of its keys."""
    return None if front_matter is None else sorted(frontmatter.problems(_given(front_matter)))


def _given(front_matter: T.Row) -> dict:
    """Front matter without nulls; lists without them, too."""
    return {k: [str(x) for x in v] if isinstance(v, list) else v for k, v in front_matter.asDict().items() if v is not None}


def _text_function(how: Callable[[str], str]):
    return _by_rows(T.StringType())(lambda text: None if text is None else how(text))


escape_markdown, protect_block_start, citation_cleanup, nfc = map(_text_function, (inline.escape, inline.guard, inline.tidy, inline.nfc))


@_by_rows(T.StringType())
def html_to_markdown(source: str | None) -> str:
    return html.html_markdown(source or "")


@_by_rows(T.StringType())
def table_to_markdown(xml: str | None) -> str | None:
    """The first table in a piece of XML, spans expanded."""
    root = tree.parse_xml(xml) if xml else None
    found = next((n for n in root.walk() if n.name == "table"), None) if root is not None else None
    return tables.table_markdown(found) if found is not None else None


@_by_rows(HEAD)
def _read_head(head: str) -> tuple:

    def shaped(kind: str, value):
        if value is None:
            return None
        if kind.startswith("array"):
            return [str(x) for x in value] if isinstance(value, list) else [str(value)]
        if kind == "int":
            return value if isinstance(value, int) and not isinstance(value, bool) and -(1 << 31) <= value < 1 << 31 else None
        return (value if isinstance(value, bool) else None) if kind == "boolean" else str(value)

    try:
        keys, _ = frontmatter.read(head)
    except ValueError as problem:
        return (None,) * len(FRONT), str(problem), []
    return tuple(shaped(kind, keys.get(k)) for k, kind in schemas.FRONT_MATTER), None, sorted(frontmatter.problems(keys))


def read_document(text: Column | str) -> Column:
    """Front matter and body of a document; error says why they could not be read, problems what breaks the contract. Python sees the front matter alone: bodies are cut off by Spark."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    most = F.lit((1 << 31) - 1)
    head = F.regexp_extract(text, FRONT_LINES, 0)
    # CRLF is read as LF; a first empty line is the front matter's. No lambda is in what goes to Python.
    rest = F.replace(F.substring(text, F.length(head) + 1, most), F.lit("\r\n"), F.lit("\n"))
    body = F.transform(F.array(rest), lambda rest: F.when(F.startswith(rest, F.lit("\n")), F.substring(rest, F.lit(2), most)).otherwise(rest))[0]
    read = _read_head(F.when((head == "") & text.rlike(r"\A---\r?\n"), frontmatter.FENCE).otherwise(head))
    return F.struct(read["front_matter"].alias("front_matter"), F.when(read["error"].isNull(), body).alias("body"), read["error"].alias("error"), read["problems"].alias("problems"))


@_by_rows(T.StringType())
def write_head(front_matter: T.Row | None) -> str | None:
    return None if front_matter is None else frontmatter.write(_given(front_matter), "")


def write_document(front_matter: Column | str, body: Column | str) -> Column:
    """A document with its front matter, which alone Python sees: Spark puts the body behind it. Null without front matter."""
    return F.concat(write_head(front_matter), F.coalesce(F.col(body) if isinstance(body, str) else body, F.lit("")))


def struct_of(row: dict[str, Column]) -> Column:
    """A front-matter struct; keys that are not given are null."""
    return F.struct(*[row.get(k, F.lit(None)).cast(kind).alias(k) for k, kind in schemas.FRONT_MATTER])

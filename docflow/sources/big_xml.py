"""Records from XML files of any size, in ranges of bytes.

Spark's text source cuts files into ranges and rows at the record's end tag, so that a range begins at the first record after its begin. That
is wrong only where the end tag stands in a comment or a CDATA section, in which a range may also begin. So each range is scanned for
all three states that it may begin in; the ranges' outcomes, in their order, say which state each began in; and rows that begin
inside a comment or section are put behind the row that they continue. Only those rows move; no task holds more than a record.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import materialize

TEXT, COMMENT, CDATA = range(3)
#: Rows that a task has as Python values at a time.
ROWS = 128
OPENS = {"<!--": COMMENT, "<![CDATA[": CDATA}
CLOSES = {COMMENT: "-->", CDATA: "]]>"}
OPENING = re.compile(r"<!--|<!\[CDATA\[")
SCANNED = "file string, block long, at long, piece string, starts array<int>, owners array<long>, ends array<int>"
SCHEMA = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("piece", pa.string()), ("starts", pa.list_(pa.int32())), ("owners", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32()))])


def state_after(piece: str, state: int) -> int:
    """Whether text, a comment or a CDATA section is open behind a piece that begins in a state."""
    at = 0
    while True:
        if state == TEXT:
            found = OPENING.search(piece, at)
            if not found:
                return TEXT
            state, at = OPENS[found[0]], found.end()
        end = piece.find(CLOSES[state], at)
        if end < 0:
            return state
        state, at = TEXT, end + len(CLOSES[state])


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in slices, so that few rows are Python values at a time; Spark's may have 10,000."""
    for batch in batches:
        yield from (batch.slice(at, ROWS) for at in range(0, batch.num_rows, ROWS))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range with the state each begins in, and the row that it continues, by the state that the range begins in; behind them, a row for the range's end."""
    here, states, owners = None, [], []

    def end() -> list[dict]:
        return [] if here is None else [{"file": here[0], "block": here[1], "owners": owners, "ends": states}]

    for batch in _small(batches):
        rows: list[dict] = []
        for piece, file, block, at in zip(*[batch.column(c).to_pylist() for c in ("value", "file", "block", "at")], strict=True):
            if (file, block) != here:
                rows += end()
                here, states, owners = (file, block), [TEXT, COMMENT, CDATA], [None] * 3
            owners = [at if state == TEXT else owner for state, owner in zip(states, owners, strict=True)]
            rows.append({"file": file, "block": block, "at": at, "piece": piece, "starts": states, "owners": owners})
            after = {state: state_after(piece, state) for state in {*states}}
            states = [after[state] for state in states]
        yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)
    yield pa.RecordBatch.from_pylist(end(), schema=SCHEMA)


def _begins(scanned: DataFrame) -> DataFrame:
    """(file, block, number, state, carried): each range's place among all, its first row's state, and the row of an earlier range that it may continue. As many rows as ranges."""
    ranges = scanned.where("ends is not null").groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "ends", "owners"))).alias("ranges"))
    none = F.lit(None).cast("long")
    kind = "array<struct<block:long,state:int,carried:long>>"
    first = F.struct(F.lit(TEXT).alias("state"), none.alias("carried"), F.array().cast(kind).alias("out"))

    def pass_on(so_far, r):
        state = so_far["state"]
        begin = F.struct(r["block"].alias("block"), state.alias("state"), so_far["carried"].alias("carried"))
        return F.struct(r["ends"][state].alias("state"), F.coalesce(r["owners"][state], so_far["carried"]).alias("carried"), F.concat(so_far["out"], F.array(begin)).alias("out"))

    begins = ranges.select("file", F.explode(F.aggregate("ranges", first, pass_on, lambda s: s["out"])).alias("b")).select("file", "b.*")
    return begins


def read_records(spark: SparkSession, path: str, record: str = "PubmedArticle", root: str = "<set>") -> DataFrame:
    """(page, xml): a document for each record element below ``path``, within a root of its own whose start tag is ``root``; pages ascend as records do in their file.

    Declarations and the files' own root elements are left out, so ``root`` has the namespaces that records take from theirs. An end tag has
    no space in it. Record elements do not hold others of their name.
    """
    tag, close, name = f"</{record}>", f"</{root[1:-1].split()[0]}>", re.compile(rf"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<{re.escape(record)}(?=[\s/>])", re.DOTALL)
    rows = spark.read.option("lineSep", tag).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    scanned = materialize(rows.mapInArrow(_scan, SCANNED), "xml_pieces")
    pieces = scanned.where("piece is not null").join(_begins(scanned), ["file", "block"])
    owner = F.coalesce(F.col("owners")[F.col("state")], F.col("carried"))
    pieces = pieces.select("file", "at", "piece", owner.alias("owner"), (F.col("starts")[F.col("state")] != TEXT).alias("goes_on"))
    # A row that continues another, and the one that it continues, are put together; all others pass.
    continued = pieces.where("goes_on").select("file", "owner").distinct().withColumn("continued", F.lit(True))
    marked = pieces.join(continued, ["file", "owner"], "left")
    whole = marked.where("continued").groupBy("file", "owner").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda p: p["piece"]), tag).alias("piece"))
    texts = marked.where("continued is null").select(F.col("owner").alias("at"), "piece").unionByName(whole.select(F.col("owner").alias("at"), "piece"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            pages, made = [], []
            for at, piece in zip(batch.column("at").to_pylist(), batch.column("piece").to_pylist(), strict=True):
                begin = next((m.start() for m in name.finditer(piece) if m[0].startswith(f"<{record}")), None)
                if begin is not None:
                    pages.append(at)
                    made.append(f"{root}{piece[begin:]}{tag}{close}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(pages, pa.int64()), pa.array(made, pa.binary())], ["page", "xml"])

    return texts.mapInArrow(build, "page long, xml binary")

"""Operator 8, line dedup: later copies of maximal repeated runs of lines go.

The corpus is one sequence of line ids (128-bit hashes of lines) with a border after each document. Its suffixes are put in order
by distributed prefix doubling: a suffix's rank at depth 2^(k+1) is the place, among all suffixes, of the pair of its rank at depth
2^k and the rank of the suffix 2^k lines on. A round counts pairs, sorts the distinct ones by ranges over the cluster (a few, in one
task), numbers them by a prefix sum over ranges, and hands the numbers back. Suffixes that no other equals at a depth leave the rounds, so that
only repeated lines go past the first.

What matters is whether a run of ``min_words`` words has an earlier copy. From every line, the shortest run of so many words
that begins (or, for a run's tail, ends) there has a depth; suffixes with equal ranks over that depth, the rank of its first and
of its last 2^k lines, are an interval of the suffix order whose longest common prefix reaches it. The first occurrence in
(doc_id, text hash, line) order stays and the others are cut. The union of the cuts of an interval and its neighbours is the
maximal repeated run, from its first to its last line.

This equals deleting every line inside any run of at least min_words words of which an earlier copy exists: such a run is
the union of the shortest long-enough runs that begin, or end, at its lines.

Scale: a document's lines are in one row; all else is rows of a few numbers, dealt out by pairs of ranks or by document. Rounds are the
logarithm of the most lines that a run of min_words words has. Ranks are exact, so lines are taken for equal only if their 128-bit
ids are: at 1e11 lines, the chance that any two others meet is 2e-17.

Edge cases: null text stays null; empty text has one empty line; lines are compared exactly; runs do not cross documents
but may repeat within one; rows equal in doc_id and text are one document and share its cuts; rows that share only the doc_id
are documents of their own; a null doc_id sorts first; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import materialize_counting
from .common import materialize, table

MIN_WORDS, SLICE = 50, 512
#: Different pairs of ranks that one task may put in order.
FEW_PAIRS = 10_000


def run_windows(words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First line and end of the shortest runs of min_words words that begin or end at each line."""
    n = len(words)
    upto = np.concatenate([[0], np.cumsum(words)])
    first = np.arange(n)
    ahead = np.searchsorted(upto, upto[:-1] + min_words)  # least end with enough words
    behind = np.searchsorted(upto, upto[1:] - min_words, "right") - 1  # greatest begin with enough words
    fits, back = ahead <= n, behind >= 0
    begin = np.concatenate([first[fits], behind[back]])
    end = np.concatenate([ahead[fits], first[back] + 1])
    return tuple(np.unique(np.stack([begin, end]), axis=1)) if len(begin) else (begin, end)


def _levels(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of each run, the greatest k so that 2^k lines fit into it."""
    return np.floor(np.log2(np.maximum(end - begin, 1))).astype(np.int64)


def _covered(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Lines in any of the runs."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, begin, 1)
    np.add.at(steps, np.maximum(end, begin), -1)
    return np.cumsum(steps)[:n] > 0


def _numbers(values: list, kind: pa.DataType = None) -> pa.Array:
    return pa.array(np.concatenate(values) if values else np.zeros(0, np.int64), kind or pa.int64())


def _lines(min_words: int):
    """Documents -> their runs, and the two halves of the ids of the lines in these; documents without a run have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, len(whole), SLICE):
                batch, rows = whole.slice(i, SLICE), []
                for text in batch.column("text"):
                    lines = text.as_py().encode("utf-8", "surrogatepass").split(b"\n")
                    begin, end = run_windows(np.fromiter((len(x.split()) for x in lines), np.int64, len(lines)), min_words)
                    ids = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines)), np.int64) if len(begin) else np.zeros(0, np.int64)
                    rows.append((len(lines), begin, end, ids[0::2], ids[1::2]))
                cols = [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[j] for r in rows], pa.list_(k)) for j, k in ((1, pa.int32()), (2, pa.int32()), (3, pa.int64()), (4, pa.int64())))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), *cols], ["doc_id", "th", "n", "begins", "ends", "high", "low"])

    return run


def _places(row_pos: pa.Scalar, row_rank: pa.Scalar, n: int) -> np.ndarray:
    """Rank of the suffix at each line; -1 where no other suffix is equal to it at this depth."""
    out = np.full(n, -1, np.int64)
    out[np.asarray(row_pos.values)] = np.asarray(row_rank.values)
    return out


def _alive(batch: pa.RecordBatch, i: int, level: int) -> tuple[np.ndarray, ...]:
    """Ranks of a document's lines, and those of its runs of 2^level lines and more whose ends are no lone suffixes."""
    n = batch.column("n")[i].as_py()
    ranks = _places(batch.column("pos")[i], batch.column("rank")[i], n)
    begin, end = (np.asarray(batch.column(c)[i].values).astype(np.int64) for c in ("begins", "ends"))
    keep = end - begin >= 1 << level
    begin, end = begin[keep], end[keep]
    keep = (ranks[begin] >= 0) & (ranks[end - (1 << level)] >= 0) if len(begin) else np.zeros(0, bool)
    return ranks, begin[keep], end[keep]


def _pairs(level: int):
    """Suffixes that a longer run of their document needs, with their rank at 2^level and that of the suffix 2^level lines on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = 1 << level
        for whole in batches:
            for s in range(0, len(whole), SLICE):
                batch, docs, at, a, b = whole.slice(s, SLICE), [], [], [], []
                for i in range(len(batch)):
                    ranks, begin, end = _alive(batch, i, level)
                    longer = end - begin >= 2 * step
                    pos = np.flatnonzero(_covered(begin[longer], end[longer] - 2 * step + 1, len(ranks)))
                    pos = pos[(ranks[pos] >= 0) & (ranks[pos + step] >= 0)]
                    docs.append(np.full(len(pos), batch.column("d")[i].as_py(), np.int64)), at.append(pos), a.append(ranks[pos]), b.append(ranks[pos + step])
                yield pa.RecordBatch.from_arrays([_numbers(docs), _numbers([x.astype(np.int32) for x in at], pa.int32()), _numbers(a), _numbers(b)], ["d", "pos", "a", "b"])

    return run


def _intervals(level: int):
    """Runs of 2^level lines and more but under twice as many, with the ranks of their first and last 2^level lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, len(whole), SLICE):
                batch, at, cols = whole.slice(s, SLICE), [], ([], [], [], [])
                for i in range(len(batch)):
                    ranks, begin, end = _alive(batch, i, level)
                    own = end - begin < 2 << level
                    begin, end = begin[own], end[own]
                    at.append(np.full(len(begin), i, np.int64))
                    for c, x in zip(cols, (begin.astype(np.int32), (end - begin).astype(np.int32), ranks[begin], ranks[end - (1 << level)]), strict=True):
                        c.append(x)
                at = _numbers(at)
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in ("doc_id", "th", "n")] + [_numbers(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "th", "n", "begin", "lines", "a", "b"])

    return run


def suffix_ranks(pairs: DataFrame) -> DataFrame:
    """pairs(a, b) -> (a, b, rank) for the pairs that occur more than once: how many of the suffixes with such pairs come before."""
    counts = pairs.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
    counts, seen = materialize_counting(counts, "suffix_pairs", different=F.count(F.lit(1)))
    if seen["different"] <= FEW_PAIRS:  # counted: one task may put them in order
        order = Window.partitionBy(F.lit(0)).orderBy("a", "b")
        return counts.select("a", "b", (F.sum("n").over(order) - F.col("n")).alias("rank"))
    ranged = materialize(counts.repartitionByRange("a", "b").withColumn("range", F.spark_partition_id()), "suffix_ranges")
    sizes = ranged.groupBy("range").agg(F.sum("n").alias("size"))
    sizes = sizes.select("range", (F.sum("size").over(Window.orderBy("range")) - F.col("size")).alias("before"))  # a row for each range
    within = Window.partitionBy("range").orderBy("a", "b")
    return ranged.join(F.broadcast(sizes), "range").select("a", "b", (F.col("before") + F.sum("n").over(within) - F.col("n")).alias("rank"))


def _handed_back(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """docs with the places and ranks of their suffixes that are not alone; documents without any leave."""
    ranked = pairs.join(suffix_ranks(pairs).hint("merge"), ["a", "b"]).groupBy("d").agg(F.collect_list(F.struct("pos", "rank")).alias("r"))
    return ranked.select("d", F.col("r.pos").alias("pos"), F.col("r.rank").alias("rank")).join(docs, "d")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, th, cut, kept): the sorted line numbers to delete, and for each line whether it stays; only documents that lose lines."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.where("text is not null").select("doc_id", "text", F.xxhash64("text").alias("th"))
    shape = f"doc_id {kind}, th long, n int, begins array<int>, ends array<int>, high array<long>, low array<long>"
    found = texts.mapInArrow(_lines(min_words), shape).where(F.size("begins") > 0).withColumn("d", F.monotonically_increasing_id())
    found, seen = materialize_counting(found, "lines", longest=F.max(F.array_max(F.zip_with("ends", "begins", lambda e, b: e - b))))
    longest = seen["longest"] or 1

    static = ["d", "doc_id", "th", "n", "begins", "ends"]
    pairs = found.select("d", F.posexplode(F.arrays_zip("high", "low")).alias("pos", "x")).select("d", "pos", F.col("x.high").alias("a"), F.col("x.low").alias("b"))
    held = materialize(_handed_back(pairs, found.select(static)), "suffixes")
    parts = []
    for level in range(int(longest).bit_length()):
        if level:
            pairs = materialize(held.mapInArrow(_pairs(level - 1), "d long, pos int, a long, b long"), "pairs")
            held = materialize(_handed_back(pairs, held.select(static)), "suffixes")
        parts.append(held.mapInArrow(_intervals(level), f"doc_id {kind}, th long, n int, begin int, lines int, a long, b long").withColumn("level", F.lit(level)))
    spots = parts[0]
    for part in parts[1:]:
        spots = spots.unionByName(part)
    key = ["level", "lines", "a", "b"]
    spots = materialize(spots.select(*key, F.struct("doc_id", "th", "begin").alias("at"), "n"), "spots")
    repeated = spots.groupBy(key).agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first <> last").drop("last")
    repeated = materialize(repeated, "repeated")  # apart from the join, which Spark can then split where an interval is large
    later = spots.join(repeated, key).where("at <> first").groupBy("at.doc_id", "at.th").agg(F.first("n").alias("n"), F.collect_set(F.struct("at.begin", "lines")).alias("runs"))
    return later.select("doc_id", "th", "n", F.col("runs.begin").alias("begins"), F.col("runs.lines").alias("sizes")).mapInArrow(_cuts, f"doc_id {kind}, th long, cut array<int>, kept array<boolean>")


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone = []
        for n, begins, sizes in zip(batch.column("n").to_pylist(), batch.column("begins"), batch.column("sizes"), strict=True):
            begin = np.asarray(begins.values).astype(np.int64)
            gone.append(_covered(begin, begin + np.asarray(sizes.values), n))
        cut, kept = pa.array([np.flatnonzero(x).astype(np.int32) for x in gone], pa.list_(pa.int32())), pa.array([~x for x in gone], pa.list_(pa.bool_()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), cut, kept], ["doc_id", "th", "cut", "kept"])


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, text, cut): each row of docs as a struct, its text less the cut lines, and those; cut is null where nothing goes."""
    cuts = repeated_lines(docs, min_words)
    rows = docs.select(F.struct("*").alias("row")).withColumn("hash", F.xxhash64("row.text"))
    rows = rows.join(cuts, F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("th")), "left")
    lines = F.arrays_zip(F.split("row.text", "\n", -1).alias("line"), F.col("kept").alias("kept"))
    left = F.transform(F.filter(lines, lambda x: x["kept"]), lambda x: x["line"])
    text = F.when(F.col("cut").isNull(), F.col("row.text")).otherwise(F.array_join(left, "\n"))
    return rows.select("row", text.alias("text"), "cut")


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with later copies of line runs cut; a document of which no word is left was a copy as a whole and goes."""
    out = dedup_lines(docs, min_words)
    emptied = F.col("cut").isNotNull() & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return out.where(~emptied).select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_cut, cut (comma-joined line numbers from 0), text (without the cut lines), of all documents."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        F.col("row.doc_id").alias("doc_id"), F.coalesce(F.size(F.split("row.text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("cut").isNull(), 0).otherwise(F.size("cut")).cast("long").alias("n_cut"), F.coalesce(F.array_join("cut", ","), F.lit("")).alias("cut"), "text",
    )

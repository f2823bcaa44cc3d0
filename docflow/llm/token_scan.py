"""Operator 2, token counts by separator scan.

Flat token files are a stream of little-endian ids in which an end-of-document id closes each document; there is no index. A file
is read as blocks cut anywhere. Each block finds its separators in one vectorised comparison; a prefix scan over blocks carries
tokens, documents and the last separator's place over block borders, which stitches documents that span blocks.

The prefix scan has two levels, SUPER blocks to a group, so that one file's blocks are spread over tasks and no task holds more
than SUPER rows of a file or one row a group.

Edge cases: adjacent separators are empty documents; tokens after the last separator are a last document that is not
finished; an empty block or file has no documents; block numbers need order, not closeness; empty tables give no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table

BLOCK_TOKENS, SUPER = 1 << 16, 1024


def token_type(separator: int) -> np.dtype:
    """Two bytes an id if the vocabulary, whose last id the separator is taken to be, allows it."""
    return np.dtype("<u2" if separator < 1 << 16 else "<u4")


def scan_separators(blocks: DataFrame, separator: int) -> DataFrame:
    """blocks(file, block, tokens binary) -> (file, ordinal, start, n_tokens, finished): each document's place, without its separator."""
    file_kind, kind = blocks.schema["file"].dataType.simpleString(), token_type(separator)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends = [], []
            for data in batch.column("tokens"):
                tokens = np.frombuffer(data.as_py() or b"", kind)
                sizes.append(len(tokens))
                ends.append(np.flatnonzero(tokens == separator))
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), pa.array(sizes, pa.int64()), pa.array(ends, pa.list_(pa.int64()))], ["file", "block", "size", "ends"])

    found = blocks.select("file", F.col("block").cast("long").alias("block"), "tokens").mapInArrow(find, f"file {file_kind}, block long, size long, ends array<long>")
    found = materialize(found.withColumn("group", F.floor(F.col("block") / SUPER)), "block_ends")
    near = Window.partitionBy("file", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy("file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")

    # Places relative to the group's begin, then the groups' own sums, then both together.
    rows = found.withColumn("at", F.coalesce(F.sum("size").over(near), zero)).withColumn("seen", F.coalesce(F.sum(F.size("ends")).over(near), zero))
    rows = rows.withColumn("last", F.col("at") + F.element_at(F.when(F.size("ends") > 0, F.col("ends")), -1)).withColumn("before", F.max("last").over(near))
    groups = rows.groupBy("file", "group").agg(F.sum("size").alias("g_size"), F.sum(F.size("ends")).alias("g_ends"), F.max("last").alias("g_last"))
    groups = groups.withColumn("g_at", F.coalesce(F.sum("g_size").over(far), zero)).withColumn("g_seen", F.coalesce(F.sum("g_ends").over(far), zero))
    groups = groups.withColumn("g_before", F.max(F.col("g_at") + F.col("g_last")).over(far))
    rows = rows.join(groups.select(F.col("file").alias("f"), F.col("group").alias("g"), "g_at", "g_seen", "g_before"), F.col("file").eqNullSafe(F.col("f")) & (F.col("group") == F.col("g")))
    base = F.col("g_at") + F.col("at")
    previous = F.coalesce(F.col("g_at") + F.col("before"), F.col("g_before"), F.lit(-1).cast("long"))
    stops = F.transform("ends", lambda e: base + e)
    docs = F.transform(stops, lambda e, k: F.struct(k.alias("k"), F.when(k == 0, previous).otherwise(stops[k - 1]).alias("from"), e.alias("to")))
    out = rows.select("file", (F.col("g_seen") + F.col("seen")).alias("base"), F.explode(docs).alias("d"))
    out = out.select("file", (F.col("base") + F.col("d.k")).alias("ordinal"), (F.col("d.from") + 1).alias("start"), (F.col("d.to") - F.col("d.from") - 1).alias("n_tokens"), F.lit(True).alias("finished"))
    whole = groups.groupBy("file").agg(F.sum("g_size").alias("size"), F.sum("g_ends").alias("ordinal"), (F.coalesce(F.max(F.col("g_at") + F.col("g_last")), F.lit(-1)) + 1).alias("start"))
    tail = whole.where("size > start").select("file", "ordinal", "start", (F.col("size") - F.col("start")).alias("n_tokens"), F.lit(False).alias("finished"))
    return out.unionByName(tail)


def read_flat_files(spark: SparkSession, path: str, separator: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of flat token files. A file is one row of Spark's binaryFile source, so it has 2 GB at most; shards do."""
    step = token_type(separator).itemsize * block_tokens

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                view = memoryview(content.as_buffer())
                for block, at in enumerate(range(0, len(view), step)):
                    yield pa.RecordBatch.from_arrays([pa.array([path.as_py()]), pa.array([block], pa.int64()), pa.array([bytes(view[at : at + step])], pa.binary())], ["file", "block", "tokens"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(cut, "file string, block long, tokens binary")


def load_encoder(path: str, pattern: str):
    """A byte-pair encoder from a file of ranks."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), len(ranks)


def default_tokenizer() -> tuple[str, str, int]:
    """(path, pattern, separator) of the installed 50k byte vocabulary; every machine has its own copy of the library."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 50256


def write_flat_tokens(docs: DataFrame, tokenizer: tuple[str, str, int], block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """docs(doc_id, text) -> a stored table (file, block, tokens, doc_ids, first).

    One file for each task. Rows with tokens are the flat stream, cut into blocks wherever they are full; the others list the
    documents in order, doc_ids from ordinal first on. Null text is an empty document.
    """
    path, pattern, separator = tokenizer
    kind, id_kind = token_type(separator), docs.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = load_encoder(path, pattern)
        file, block, first = TaskContext.get().partitionId(), 0, 0
        held, size = [], 0
        for whole in batches:
            id_type = pa.list_(whole.schema.field("doc_id").type)
            for i in range(0, len(whole), 1024):
                batch, blocks = whole.slice(i, 1024), []
                for text in batch.column("text"):
                    ids = np.array(encoder.encode_ordinary(text.as_py() or "") + [separator], kind)
                    held.append(ids)
                    size += len(ids)
                    while size >= block_tokens:
                        stream = np.concatenate(held)
                        blocks.append(stream[:block_tokens].tobytes())
                        held, size = [stream[block_tokens:]], size - block_tokens
                n = len(blocks)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file] * (n + 1), pa.int64()), pa.array([*range(block, block + n), None], pa.int64()), pa.array([*blocks, None], pa.binary()),
                        pa.array([None] * n + [batch.column("doc_id").to_pylist()], id_type), pa.array([None] * n + [first], pa.int64()),
                    ],
                    ["file", "block", "tokens", "doc_ids", "first"],
                )
                block, first = block + n, first + len(batch)
        if size:
            last = [pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([np.concatenate(held).tobytes()], pa.binary()), pa.array([None], id_type), pa.array([None], pa.int64())]
            yield pa.RecordBatch.from_arrays(last, ["file", "block", "tokens", "doc_ids", "first"])

    return materialize(docs.select("doc_id", "text").mapInArrow(encode, f"file long, block long, tokens binary, doc_ids array<{id_kind}>, first long"), "tokens")


def count_tokens(docs: DataFrame, tokenizer: tuple[str, str, int] | None = None) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, n_tokens), read back from the flat files by the separator scan."""
    tokenizer = tokenizer or default_tokenizer()
    flat = write_flat_tokens(docs, tokenizer)
    found = scan_separators(flat.where("tokens is not null").select("file", "block", "tokens"), tokenizer[2])
    listed = flat.where("tokens is null").select("file", "first", F.posexplode("doc_ids").alias("k", "doc_id"))
    listed = listed.select("file", (F.col("first") + F.col("k")).alias("ordinal"), "doc_id")
    return listed.join(found, ["file", "ordinal"]).select("doc_id", "n_tokens")


def op2_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))

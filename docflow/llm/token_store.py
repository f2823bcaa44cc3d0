"""Operator 12, token ids in shards with a minimal perfect hash index.

Documents are encoded in ascending doc_id. A folder holds two tables. ``shards`` has rows of three sorts:

* (shard, block, first, ids): the ids of whole documents in a row, two bytes each, little-endian, with nothing between; ``first`` is the
  number of the shard's ids before the block. A block ends with the document that fills it.
* (shard, block, doc_ids, copies, begins, sizes): the documents of a block.
* (shard, first, doc_ids, sizes): the end of a shard, with the number of its ids, its first and last doc_id and how often it has them.

``index`` (bucket, buckets, levels, bits, prints, places) has one row for each bucket of keys.

A bucket's keys are told apart by a minimal perfect hash of levels of bits: a key owns the bit it falls on if no other key of its
level falls there, and keys that meet go to the next level. The number of set bits before a key's own bit is its slot; nothing else of the
key is kept but a fingerprint of 32 bits in the slot, beside the place (shard, block, begin, size). To find a key takes one row and a few
bits of it, however many keys there are; a key that is not there is found with a probability of 2 ** -32.

A key is a doc_id and the number of its copy, as rows may share a doc_id. Keys are dealt to buckets by hash, so that an id with a
third of all rows is spread as others are.

Edge cases: null text is empty, and so are texts without tokens: their one id is the end; rows with one doc_id stand in the order
of their texts' hashes, null first, each with a copy number of its own; rows without a doc_id come first and have keys, too; a very long
document is a block of its own; of an empty table there are empty tables; other columns are not read.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator
from itertools import chain
from types import ModuleType
from typing import TYPE_CHECKING
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import scratch_path
from .common import ranks_within, table
from .words import mix

END = 2
if TYPE_CHECKING:
    from tokenizers import Tokenizer

#: Ids from which on a block is full, keys of a bucket on average, and rounds of one bucket's levels (keys are left over with a probability below 1e-12).
BLOCK_IDS, BUCKET_KEYS, MOST_LEVELS = 1 << 16, 2048, 64
#: Words whose ids a task remembers before it forgets them all, bytes of text that it cuts into words at a time, words joined to be encoded, and strings encoded in one call.
CACHED_WORDS, SLICE_BYTES, JOINED, AT_ONCE = 250_000, 4 << 20, 100, 64
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CLASS = r"!-/:-@\[-`{-~"
IDS = np.dtype("<u2")


#: Below this, what is a letter has not changed for long, so that the tokenizer and Python agree on it.
LONG_KNOWN = "\u0590"
#: Words of these letters alone stay what they are under NFC, and words of letters when lower-cased (see _stays); most words that are not ASCII.
LATIN = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+$"

Pieces = tuple[np.ndarray, np.ndarray]  # ids in a row, and how many each piece has


class WordIds:
    """The ids of texts, from those of their words.

    The tokenizer drops white space and joins nothing over it, so a text's ids are those of its words in a row, and a word that
    comes again needs no second look. Words are cut, told apart and looked up as Arrow arrays.

    A word of letters, with ASCII punctuation before or behind, has a piece for each of these. Letters are encoded many in one call and
    told apart by the mark of a word's end, which the last id of a piece alone has; they are lower-cased first where they are ASCII, as
    the tokenizer does, unless that would let them join with marks. All other words are encoded one by one.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks have the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        if max(vocabulary.values()) > np.iinfo(IDS).max:
            raise ValueError("ids of this vocabulary need more than two bytes")
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends = np.zeros(1 << 16, bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.plain = _without_normalizer(self.tokenizer)
        self.forget()

    def forget(self) -> None:
        self.words, self.ids, self.begins, self.sizes = pa.array([], pa.large_string()), np.zeros(0, IDS), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _whole(self, words: list[str], tokenizer: Tokenizer | None = None) -> Pieces:
        # A few at a time: what the library gives for a word is much larger than its ids.
        encode = (tokenizer or self.tokenizer).encode_batch_fast
        found = [e.ids for i in range(0, len(words), AT_ONCE) for e in encode(words[i : i + AT_ONCE], add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), IDS), np.fromiter(map(len, found), np.int64, len(found))

    def _texts(self, words: pa.Array) -> Pieces:
        return self._whole(_strings(words))

    def _letters(self, words: pa.Array) -> Pieces:
        """Each word's ids: ASCII words, which are lower-cased already, without the tokenizer's own normal form."""
        plain = _flags(pc.string_is_ascii(words))
        ids, lengths = _joined([self._runs(_strings(words.filter(pa.array(plain))), self.plain), self._runs(_strings(words.filter(pa.array(~plain))), self.tokenizer)])
        order = np.where(plain, np.cumsum(plain), plain.sum() + np.cumsum(~plain)) - 1
        return _gather(ids, (np.cumsum(lengths) - lengths)[order], lengths[order]), lengths[order]

    def _runs(self, words: list[str], tokenizer: Tokenizer) -> Pieces:
        """Each word's ids, from a few words a text if every word is one piece."""
        if not words:
            return self._whole(words)
        ids, _ = self._whole([" ".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)], tokenizer)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(words) and stops[-1] == len(ids):
            return ids, np.diff(stops, prepend=0)
        # A letter that is none to the tokenizer: its word is found by halving.
        half = len(words) // 2
        return _joined([self._runs(words[:half], tokenizer), self._runs(words[half:], tokenizer)]) if half else self._whole(words)

    def _simple(self, words: pa.Array, core: pa.Array, lower: pa.Array, bare: np.ndarray) -> np.ndarray:
        """Which words are letters with nothing but ASCII punctuation around them."""
        plain = _flags(pc.ascii_is_alpha(core))
        rest = np.flatnonzero(~plain)
        plain[rest] = _flags(pc.match_substring_regex(core.take(pa.array(rest)), LATIN))
        rest = rest[~plain[rest]]
        other = rest[_flags(pc.utf8_is_alpha(core.take(pa.array(rest))))]
        cases = zip(_strings(core.take(pa.array(other))), _strings(lower.take(pa.array(other))), bare[other].tolist(), strict=True)
        plain[other] = np.fromiter((_stays(a, b) and (alone or max(a) < LONG_KNOWN) for a, b, alone in cases), bool, len(other))
        for special in self.special:
            plain &= ~_flags(pc.match_substring(words, special))
        return plain

    def _learn(self, words: pa.Array) -> None:
        core = pc.utf8_trim(words, characters=PUNCTUATION)
        lower = pc.ascii_lower(core)
        bare = _flags(pc.equal(core, words))
        simple = self._simple(words, core, lower, bare)
        edged = np.flatnonzero(simple & ~bare)
        dressed = words.take(pa.array(edged))
        head = pc.replace_substring_regex(dressed, rf"^([{CLASS}]*).*$", r"\1")
        tail = pc.replace_substring_regex(dressed, rf"^.*?([{CLASS}]*)$", r"\1")
        taking = edged[_flags(pc.match_substring(head, "'"))]  # an apostrophe takes a letter with it
        simple[taking] = False
        rest = np.flatnonzero(~simple)

        # In order of words: head, core and tail of simple ones, others as a whole; -1 is no piece.
        columns, parts, known = np.full((len(words), 3), -1, np.int64), [], 0
        for at, places, texts, encode in ((0, edged, head, self._texts), (2, edged, tail, self._texts), (1, np.flatnonzero(simple), lower.filter(pa.array(simple)), self._letters)):
            coded = texts.dictionary_encode()
            columns[places, at] = known + coded.indices.to_numpy()
            parts.append(encode(coded.dictionary))
            known += len(coded.dictionary)
        columns[rest] = -1
        columns[rest, 0] = known + np.arange(len(rest))
        flat, lengths = _joined([*parts, self._texts(words.take(pa.array(rest))), (np.zeros(0, IDS), np.zeros(1, np.int64))])
        order = columns.ravel()
        made, sizes = _gather(flat, (np.cumsum(lengths) - lengths)[order], lengths[order]), lengths[columns].sum(1)
        begins = len(self.ids) + np.cumsum(sizes) - sizes
        self.words = pa.concat_arrays([self.words, words])
        self.ids, self.begins, self.sizes = np.concatenate([self.ids, made]), np.concatenate([self.begins, begins]), np.concatenate([self.sizes, sizes])

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Each text's ids as bytes; null is empty."""
        cut = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        there = pc.not_equal(cut.flatten(), "")
        seen = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
        counts = seen[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        coded = cut.flatten().filter(there).dictionary_encode()
        if len(self.words) > CACHED_WORDS:
            self.forget()
        known = pc.index_in(coded.dictionary, value_set=self.words)
        new = pc.is_null(known)
        place = pc.fill_null(known, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        first = len(self.words)
        if (n := pc.sum(new).as_py() or 0) > 0:
            self._learn(coded.dictionary.filter(new))
            place[new.to_numpy(zero_copy_only=False)] = np.arange(first, first + n)
        words = place[coded.indices.to_numpy()]
        sizes = self.sizes[words]
        ids = _gather(self.ids, self.begins[words], sizes)
        stops = np.concatenate([[0], np.cumsum(sizes)])[counts]
        return (ids[a:b].tobytes() for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True))


def _stays(core: str, lower: str) -> bool:
    """Whether a word of letters is still one when lower-cased, and its ASCII letters can be lower-cased first."""
    return core.lower().isalpha() and is_normalized("NFC", core) and is_normalized("NFC", lower)


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()  # several times as fast as to_pylist


def _flags(mask: pa.Array) -> np.ndarray:
    return mask.to_numpy(zero_copy_only=False).astype(bool)


def _joined(parts: list[Pieces]) -> Pieces:
    return np.concatenate([ids for ids, _ in parts]), np.concatenate([lengths for _, lengths in parts])


def _without_normalizer(tokenizer: Tokenizer) -> Tokenizer:
    """The same model, cutting at white space alone, if it does the same to lower-case ASCII words; else the tokenizer itself."""
    from tokenizers import Tokenizer, pre_tokenizers

    bare = Tokenizer(tokenizer.model)
    bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    probe = "the quick brown fox jumps over a lazy dog bcdfgh mnpqrst vwxz internationalization s t re ve m ll d"
    same = bare.encode(probe, add_special_tokens=False).ids == tokenizer.encode(probe, add_special_tokens=False).ids
    return bare if same else tokenizer


def kept_words(path: str) -> WordIds:
    """The words that this Python worker has learned in its tasks so far: Spark uses a worker again, but unpickles a task's functions anew."""
    kept = sys.modules.setdefault("docflow_kept", ModuleType("docflow_kept"))
    if path not in vars(kept):
        setattr(kept, path, WordIds(path))
    return getattr(kept, path)


def _gather(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[begin : begin + size] of each place, in a row."""
    return flat[np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about SLICE_BYTES of text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(batch):
        stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def default_tokenizer() -> str:
    """The installed 49k word vocabulary; every machine has its own copy of the library."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def hashes(doc_id: Column, copy: Column) -> list[Column]:
    """Two hashes of a key of 64 bits each; nulls differ from all values."""
    known = F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit("/"), copy.cast("string"))
    return [F.xxhash64(known).alias("h1"), F.xxhash64(F.reverse(known), F.lit(1)).alias("h2")]


def bucket_of(h1: Column, buckets: int) -> Column:
    return F.pmod(h1, F.lit(buckets))


def _slots(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    return mix(h1.view(np.uint64) ^ mix(h2.view(np.uint64) + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))) % np.uint64(size)


def build(h1: np.ndarray, h2: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(sizes of levels, the levels' bits in a row, slot of each key)."""
    left, sizes, bits = np.arange(len(h1)), [], []
    owners = []
    while len(left):
        if len(sizes) == MOST_LEVELS:
            raise ValueError("two keys have the same hashes")
        size = -(-len(left) * 2 // 64) * 64
        at = _slots(h1[left], h2[left], len(sizes), size)
        counts = np.bincount(at.astype(np.int64), minlength=size)
        alone = counts[at] == 1
        owners.append((sum(sizes) + at[alone].astype(np.int64), left[alone]))
        sizes.append(size)
        bits.append(counts == 1)
        left = left[~alone]
    every = np.concatenate(bits) if bits else np.zeros(0, bool)
    before, slots = np.cumsum(every) - every, np.zeros(len(h1), np.int64)
    for at, keys in owners:
        slots[keys] = before[at]
    return sizes, every, slots


def find(levels: list[int], bits: np.ndarray, prints: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 for those that are not there."""
    slots, left, base = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
    before = np.cumsum(bits) - bits
    for level, size in enumerate(levels):
        at = base + _slots(h1[left], h2[left], level, size).astype(np.int64)
        own = bits[at]
        slots[left[own]] = before[at[own]]
        left, base = left[~own], base + size
    there = np.flatnonzero(slots >= 0)
    slots[there[prints[slots[there]] != fingerprint(h2[there])]] = -1
    return slots


def fingerprint(h2: np.ndarray) -> np.ndarray:
    return (mix(h2.view(np.uint64)) >> np.uint64(32)).astype("<u4")


def _shard_schema(id_kind: str) -> str:
    return f"shard int, block int, first long, ids binary, doc_ids array<{id_kind}>, copies array<long>, begins array<long>, sizes array<long>"


class _Shard:
    """What a task writes of its range of documents, in order."""

    def __init__(self, id_type: pa.DataType) -> None:
        lists = pa.list_(pa.int64())
        self.schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("ids", pa.binary()), ("doc_ids", pa.list_(id_type)), ("copies", lists), ("begins", lists), ("sizes", lists)])
        self.shard, self.block, self.first, self.copy, self.ends = 0, 0, 0, -1, []
        self.clear()

    def clear(self) -> None:
        self.ids, self.doc_ids, self.copies, self.begins, self.size = [], [], [], [], 0

    def add(self, doc_id: object, raw: bytes) -> None:
        self.copy = self.copy + 1 if self.ends and self.ends[-1][0] == doc_id else 0
        if self.copy:
            self.ends[-1][1] += 1
        else:
            self.ends = [*self.ends[:1], [doc_id, 1]]
        self.ids.append(raw)
        self.doc_ids.append(doc_id)
        self.copies.append(self.copy)
        self.begins.append(self.size)
        self.size += len(raw) // IDS.itemsize

    def close(self) -> pa.RecordBatch:
        sizes = np.diff([*self.begins, self.size]).tolist()
        rows = [{"ids": b"".join(self.ids)}, {"doc_ids": self.doc_ids, "copies": self.copies, "begins": self.begins, "sizes": sizes}]
        out = self.batch([{"shard": self.shard, "block": self.block, "first": self.first, **row} for row in rows])
        self.block, self.first = self.block + 1, self.first + self.size
        self.clear()
        return out

    def end(self) -> pa.RecordBatch:
        ends = [self.ends[0], self.ends[-1]]
        return self.batch([{"shard": self.shard, "first": self.first, "doc_ids": [e[0] for e in ends], "sizes": [e[1] for e in ends]}])

    def batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([row.get(f.name) for row in rows], f.type) for f in self.schema], schema=self.schema)


def _write_shards(docs: DataFrame, tokenizer: str, folder: str, block_ids: int) -> None:
    # Rows with one doc_id may be more than a range: their texts' hashes, and then their places, divide them.
    order = ["doc_id", "_hash", "_tie"]
    rows = docs.select("doc_id", "text", F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("_hash"), F.monotonically_increasing_id().alias("_tie"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text", F.spark_partition_id().alias("shard"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, out = kept_words(tokenizer), None
        for whole in batches:
            out = out or _Shard(whole.schema.field("doc_id").type)
            for batch in _slices(whole):
                out.shard = batch.column("shard")[0].as_py()
                for doc_id, raw in zip(batch.column("doc_id").to_pylist(), words.encode(batch.column("text")), strict=True):
                    out.add(doc_id, raw + END.to_bytes(IDS.itemsize, "little"))
                    if out.size >= block_ids:
                        yield out.close()
        if out is not None and out.ends:
            if out.ids:
                yield out.close()
            yield out.end()
        pa.default_memory_pool().release_unused()  # the worker may wait long for its next task

    ordered.mapInArrow(run, _shard_schema(docs.schema["doc_id"].dataType.simpleString())).write.option("compression", "zstd").parquet(f"{folder}/shards")


def _payload(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/shards").where("ids is not null").select("shard", "block", "first", "ids")


def _shard_ends(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, before, first_id, copies_before): ids of all shards before, and copies of its first doc_id in them. A row for each task that wrote."""
    ends = spark.read.parquet(f"{folder}/shards").where("block is null").select("shard", "first", F.col("doc_ids")[0].alias("first_id"), F.col("doc_ids")[1].alias("last_id"), F.col("sizes")[1].alias("n"))
    earlier = lambda window: window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("before", F.coalesce(F.sum("first").over(earlier(Window.partitionBy(F.lit(0)))), F.lit(0)))
    # Of a doc_id that begins a shard, earlier shards hold copies at their ends alone.
    begins = ends.select(F.col("first_id").alias("id"), "shard", F.lit(0).cast("long").alias("n"), "before", F.lit(1).alias("begin"))
    stops = ends.select(F.col("last_id").alias("id"), "shard", "n", "before", F.lit(0).alias("begin"))
    both = begins.unionByName(stops).withColumn("copies_before", F.coalesce(F.sum("n").over(Window.partitionBy("id").orderBy("shard", F.desc("begin")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return both.where("begin = 1").select("shard", "before", F.col("id").alias("first_id"), "copies_before")


PLACES = np.dtype([("shard", "<i4"), ("block", "<i4"), ("begin", "<i8"), ("size", "<i8")])


def _columns(structs: pa.StructArray, names: list[str]) -> list[np.ndarray]:
    return [structs.field(name).to_numpy(zero_copy_only=False) for name in names]


def _write_index(spark: SparkSession, folder: str, bucket_keys: int) -> None:
    listed = spark.read.parquet(f"{folder}/shards").where("copies is not null").select("shard", "block", "doc_ids", "copies", "begins", "sizes")
    n = listed.agg(F.sum(F.size("doc_ids"))).first()[0] or 0
    buckets = max(1, -(-n // bucket_keys))
    # As many rows as tasks have written shards.
    listed = listed.join(F.broadcast(_shard_ends(spark, folder).drop("before")), "shard")
    places = F.arrays_zip("doc_ids", "copies", "begins", "sizes")
    docs = listed.select("shard", "block", "first_id", "copies_before", F.explode(places).alias("d"))
    copy = F.col("d.copies") + F.when(F.col("d.doc_ids").eqNullSafe(F.col("first_id")), F.col("copies_before")).otherwise(0)
    keyed = docs.select(*hashes(F.col("d.doc_ids"), copy), "shard", "block", F.col("d.begins").alias("begin"), F.col("d.sizes").alias("size"))
    rows = keyed.groupBy(bucket_of(F.col("h1"), buckets).alias("bucket")).agg(F.collect_list(F.struct(*keyed.columns)).alias("keys"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, keys in zip(batch.column("bucket"), batch.column("keys"), strict=True):
                h1, h2, *fields = _columns(keys.values, ["h1", "h2", *PLACES.names])
                levels, bits, slots = build(h1, h2)
                prints, held = np.zeros(len(h1), "<u4"), np.zeros(len(h1), PLACES)
                prints[slots] = fingerprint(h2)
                for name, values in zip(PLACES.names, fields, strict=True):
                    held[name][slots] = values
                made = [np.packbits(bits).tobytes(), prints.tobytes(), held.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([bucket.as_py()], pa.int64()), pa.array([levels], pa.list_(pa.int32())), *[pa.array([m], pa.binary()) for m in made]], ["bucket", "levels", "bits", "prints", "places"])

    made = rows.mapInArrow(run, "bucket long, levels array<int>, bits binary, prints binary, places binary")
    made.withColumn("buckets", F.lit(buckets).cast("long")).write.option("compression", "zstd").parquet(f"{folder}/index")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, block_ids: int = BLOCK_IDS, bucket_keys: int = BUCKET_KEYS) -> None:
    """docs(doc_id, text) as tables below ``folder``, which must be new; ``tokenizer`` is a vocabulary file's path on every machine."""
    _write_shards(docs, tokenizer or default_tokenizer(), folder, block_ids)
    _write_index(docs.sparkSession, folder, bucket_keys)


def locate(keys: DataFrame, folder: str) -> DataFrame:
    """keys(doc_id, copy) -> (doc_id, copy, shard, block, begin, size) of those that the index has; keys should be distinct."""
    spark, id_kind = keys.sparkSession, keys.schema["doc_id"].dataType.simpleString()
    index = spark.read.parquet(f"{folder}/index")
    known = index.select("buckets").first()
    keyed = keys.select("doc_id", F.col("copy").cast("long").alias("copy"), *hashes(F.col("doc_id"), F.col("copy").cast("long")))
    asked = keyed.groupBy(bucket_of(F.col("h1"), known["buckets"] if known else 1).alias("bucket")).agg(F.collect_list(F.struct("doc_id", "copy", "h1", "h2")).alias("keys"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                keys = row["keys"].values
                levels, (bits, prints, places) = row["levels"].as_py(), [row[name].as_py() for name in ("bits", "prints", "places")]
                slots = find(levels, np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(levels)).astype(bool), np.frombuffer(prints, "<u4"), *_columns(keys, ["h1", "h2"]))
                there = np.flatnonzero(slots >= 0)
                found = np.frombuffer(places, PLACES)[slots[there]]
                held = keys.take(pa.array(there))
                yield pa.RecordBatch.from_arrays([held.field("doc_id"), held.field("copy"), *[pa.array(np.ascontiguousarray(found[name])) for name in PLACES.names]], ["doc_id", "copy", *PLACES.names])

    joined = asked.join(index, "bucket").select("keys", "levels", "bits", "prints", "places")
    return joined.mapInArrow(run, f"doc_id {id_kind}, copy long, shard int, block int, begin long, size long")


def read_ids(keys: DataFrame, folder: str) -> DataFrame:
    """keys(doc_id, copy) -> (doc_id, copy, start, ids): the number of all ids before, and the document's ids with the end id, four bytes each, little-endian."""
    spark, id_kind = keys.sparkSession, keys.schema["doc_id"].dataType.simpleString()
    wanted = locate(keys, folder).groupBy("shard", "block").agg(F.collect_list(F.struct("doc_id", "copy", "begin", "size")).alias("docs"))
    ends = _shard_ends(spark, folder).select("shard", "before")
    blocks = wanted.join(_payload(spark, folder), ["shard", "block"]).join(F.broadcast(ends), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                ids, docs = np.frombuffer(batch.column("ids")[i].as_buffer(), IDS), batch.column("docs")[i].values
                begins, sizes = _columns(docs, ["begin", "size"])
                made = [ids[a : a + n].astype("<u4").tobytes() for a, n in zip(begins.tolist(), sizes.tolist(), strict=True)]
                starts = pa.array(begins + batch.column("at")[i].as_py(), pa.int64())
                yield pa.RecordBatch.from_arrays([docs.field("doc_id"), docs.field("copy"), starts, pa.array(made, pa.binary())], ["doc_id", "copy", "start", "ids"])

    return blocks.select("docs", "ids", (F.col("before") + F.col("first")).alias("at")).mapInArrow(run, f"doc_id {id_kind}, copy long, start long, ids binary")


def keys_of(docs: DataFrame) -> DataFrame:
    """(doc_id, copy) of every row: the key of each row's tokens."""
    return ranks_within(docs.select("doc_id"), "doc_id", [], "token_keys").select("doc_id", F.col("_rank").alias("copy"))


def op12_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "token_files")
    write_token_files(docs, folder)
    out = read_ids(keys_of(docs), folder)
    return out.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))

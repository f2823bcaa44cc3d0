"""Operator 1, I-Match fingerprints.

The lexicon is the terms whose normalised inverse document frequency, log(N / df) / log N, lies in a band. A fingerprint has
SEEDS hashes for each of RATES: each hash is of the sorted distinct terms of the text in one random subset of the lexicon, of
that rate; all subsets are independent, as each looks at bits of its own of a term's keyed hashes. Equal texts have equal
fingerprints. The likeness of two fingerprints is the share of equal hashes among subsets that
either text has terms in, at the sparsest rate at which half the subsets do, and below; there, a subset holds few terms
of a text, so that the share estimates the overlap of terms whatever the texts' length.

Document frequencies are counted exactly, by 63-bit term hash, over all documents. Executors are sent the terms above the band as a list, of
at most all terms of all documents over N^0.8, and those in the band as a Bloom filter of 16 bits a term, which takes about 1 % of the
terms below it for members. The filter has MOST_BITS at most (32 MB); past 17 million terms in the band, its error grows.
Texts that need their successor are sorted into ranges of (doc_id, text hash), each text moved once and compressed; equal rows are
counted before they are moved; a range gets a copy of the next range's first document.

Edge cases: null text is empty; a text without a lexicon term uses all its terms; one without terms uses itself; terms are
white-space words without outer punctuation, A-Z in lower case. Order: doc_id descending (numbers by value, others as strings), null last, then
text hash; rows equal in both are neighbours; a single document is its own successor; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import global_rank
from .common import materialize, table
from .words import CACHED_WORDS, P, WordHashes, mix, plain_words

BAND, TERM_BITS, MOST_BITS = (0.2, 0.95), 16, 1 << 28
RATES, SEEDS = tuple(4.0**-k for k in range(1, 7)), 16
RANGE_ROWS, MOST_RANGES, HELD_TERMS = 8192, 100_000, 1 << 20
NONE, DIGITS = "----", 4
OUTER = b".,;:!?\"'()[]{}<>|*#$%&"
LAST = -(1 << 63)


class Lexicon:
    """The band as a Bloom filter of 64-bit words, and the terms above it."""

    def __init__(self, bits: np.ndarray, above: frozenset[int]) -> None:
        self.bits, self.above, self.shift = bits, above, 64 - int(len(bits)).bit_length() + 1

    def __contains__(self, term: int) -> bool:
        g = term * int(P) & (1 << 64) - 1
        mask = 1 << (g >> 58) | 1 << (g >> 52 & 63) | 1 << (g >> 46 & 63)
        return int(self.bits[term >> self.shift]) & mask == mask and term not in self.above


def _places(terms: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word of the filter and bits in it, of each term; as in Lexicon."""
    g, one = terms * P, np.uint64(1)
    mask = one << (g >> np.uint64(58)) | one << (g >> np.uint64(52) & np.uint64(63)) | one << (g >> np.uint64(46) & np.uint64(63))
    return terms >> np.uint64(64 - int(words).bit_length() + 1), mask


class TermHashes(WordHashes):
    """Even hashes of terms, plus one if the lexicon has the term."""

    def __init__(self, lexicon: Lexicon | None = None) -> None:
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = xxhash.xxh64_intdigest(word.strip(OUTER) or word) & ~1
        value = self[word] = value | (self.lexicon is not None and value in self.lexicon)
        return value

    def terms(self, text: str) -> np.ndarray:
        return np.unique(self.of(plain_words(text)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache, held, size = TermHashes(), [], 0

    def counted() -> pa.RecordBatch:
        terms, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n.astype(np.int64))], ["term", "n"])

    for batch in batches:
        for text in batch.column("text"):
            held.append(cache.terms(text.as_py() or ""))
            size += len(held[-1])
            if size >= HELD_TERMS:
                yield counted()
                held, size = [], 0
    if held:
        yield counted()


def lexicon(docs: DataFrame, total: int, band: tuple[float, float] = BAND) -> Lexicon:
    """From the document frequencies of all documents."""
    low, high = max(1, total) ** (1 - band[1]), max(1, total) ** (1 - band[0])
    counts = docs.select("text").mapInArrow(_count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = materialize(counts.where(F.col("n") >= low), "term_counts")
    above = frozenset(r["term"] % (1 << 64) for r in counts.where(F.col("n") > high).select("term").collect())
    inside = counts.where(F.col("n") <= high)
    words = min(MOST_BITS, 1 << max(12, (TERM_BITS * inside.count()).bit_length())) >> 6
    part = min(words, 4096)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, mask = _places(batch.column("term").to_numpy().view(np.uint64), words)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(mask.view(np.int64))], ["at", "bits"])

    def pack(rows: pa.Table) -> pa.Table:
        out, at = np.zeros(part, "<i8"), rows.column("at").to_numpy()
        out[at % part] = rows.column("bits").to_numpy()
        return pa.table({"part": pa.array([int(at[0]) // part], pa.int64()), "packed": pa.array([out.tobytes()], pa.binary())})

    placed = inside.select("term").mapInArrow(place, "at long, bits long").groupBy("at").agg(F.expr("bit_or(bits)").alias("bits"))
    parts = placed.groupBy(F.floor(F.col("at") / part)).applyInArrow(pack, "part long, packed binary").collect()  # MOST_BITS at most
    bits = np.zeros(words, "<u8")
    for r in parts:
        bits[r["part"] * part : (r["part"] + 1) * part] = np.frombuffer(r["packed"], "<u8")
    return Lexicon(bits, above)


class Fingerprinter:
    def __init__(self, lexicon: Lexicon | None) -> None:
        self.cache = TermHashes(lexicon)
        rng = np.random.default_rng(1)
        self.seeds = rng.integers(0, 1 << 63, (SEEDS, 1), np.uint64)
        # A subset of rate 4^-k takes the terms whose next 2k bits are all zero.
        self.bits = [np.uint64((1 << 2 * k) - 1 << k * (k - 1)) for k in range(1, len(RATES) + 1)]

    def __call__(self, text: str) -> str:
        terms = self.cache.terms(text)
        chosen = terms[terms & np.uint64(1) == 1]
        if not len(chosen):
            chosen = terms if len(terms) else np.array([xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))], np.uint64)
        picked: list[list[bytes]] = [[] for _ in range(len(RATES) * SEEDS)]
        for i in range(0, len(chosen), 4096):  # bounded memory for very long texts
            part = chosen[i : i + 4096]
            draws = mix(part[None, :] ^ self.seeds)
            for k, bits in enumerate(self.bits):
                held = draws & bits == 0
                for j in np.flatnonzero(held.any(axis=1)).tolist():
                    picked[k * SEEDS + j].append(part[held[j]].tobytes())
        return "".join(xxhash.xxh32_hexdigest(b"".join(x))[:DIGITS] if x else NONE for x in picked)


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    x, y = ([s[i : i + DIGITS] for i in range(0, len(s), DIGITS)] for s in (a, b))
    used, same = [], []
    for i in range(len(RATES)):
        pairs = [(p, q) for p, q in zip(x[i * SEEDS : (i + 1) * SEEDS], y[i * SEEDS : (i + 1) * SEEDS], strict=True) if p != NONE or q != NONE]
        used.append(len(pairs))
        same.append(sum(p == q for p, q in pairs))
    first = max([i for i in range(len(RATES)) if 2 * used[i] >= SEEDS], default=0)
    return sum(same[first:]) / max(1, sum(used[first:]))


def _order_key(docs: DataFrame) -> DataFrame:
    """(doc_id, key, th, text): documents are in order of falling key and rising th."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        return rows.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("key"), "th", "text")
    ranks = global_rank(docs.select(F.col("doc_id").alias("_id")).where("_id is not null").distinct(), ["_id"], "key")
    return rows.join(ranks, F.col("doc_id") == F.col("_id"), "left").select("doc_id", F.coalesce("key", F.lit(LAST)).alias("key"), "th", "text")


def _sortable(key: np.ndarray, th: np.ndarray) -> np.ndarray:
    """Strings of 16 bytes in the documents' order."""
    pairs = np.stack([~key, th], axis=1).view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(pairs.astype(">u8")).view("S16").ravel()


def _heads(rows: DataFrame, total: int) -> list[tuple[int, int]]:
    """(key, th) of the first document of each range, in order; at most MOST_RANGES, which are then larger than RANGE_ROWS rows."""
    n = min(MOST_RANGES, max(1, math.ceil(total / RANGE_ROWS)))
    keys = rows.select(F.bitwise_not("key").alias("down"), "th")
    ranged = keys.repartitionByRange(n, "down", "th") if n > 1 else keys.coalesce(1)
    firsts = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct("down", "th")).alias("head")).collect()
    return [(-1 - down, th) for down, th in sorted((r["head"]["down"], r["head"]["th"]) for r in firsts)]


def fingerprints(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last third replaced by the beginning of the next document's, by descending doc_id.
    """
    spark, total = docs.sparkSession, docs.count()
    sent = spark.sparkContext.broadcast(lexicon(docs, total, band))
    rows = _order_key(docs)
    heads = _heads(rows, total)
    ranges = max(1, len(heads))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, again = zstandard.ZstdCompressor(level=3), {}  # (key, th) of this task's rows -> how many more there were
        borders = _sortable(*(np.array([h[i] for h in heads[1:]], np.int64) for i in (0, 1)))
        led = {h: (i - 1) % ranges for i, h in enumerate(heads)}
        names, kinds = ["range", "guest", "doc_id", "down", "th", "n", "packed"], None

        def made(cols: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        for whole in batches:
            kinds = [pa.int32(), pa.int8(), whole.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            for i in range(0, len(whole), 2048):
                batch, cols = whole.slice(i, 2048), [[] for _ in names]
                key, th = (batch.column(c).to_numpy() for c in ("key", "th"))
                at = np.searchsorted(borders, _sortable(key, th), "right").tolist()
                for j, (k, t) in enumerate(zip(key.tolist(), th.tolist(), strict=True)):
                    if (k, t) in again:
                        again[k, t][-1] += 1
                        continue
                    doc_id = batch.column("doc_id")[j].as_py()
                    again[k, t] = [at[j], doc_id, 0]
                    data = press.compress(batch.column("text")[j].as_py().encode("utf-8", "surrogatepass"))
                    for row in ((at[j], 0, doc_id, ~k, t, 1, data), *([(led[k, t], 1, doc_id, ~k, t, 1, data)] if (k, t) in led else [])):
                        for c, x in zip(cols, row, strict=True):
                            c.append(x)
                yield made(cols)
        more = [(place, 0, doc_id, ~k, t, n, None) for (k, t), (place, doc_id, n) in again.items() if n]
        if more:
            yield made([list(c) for c in zip(*more, strict=True)])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer, unpress, held = Fingerprinter(sent.value), zstandard.ZstdDecompressor(), None
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        for batch in batches:
            out, kinds = [], [batch.schema.field("doc_id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

            def flush(out=out, kinds=kinds) -> pa.RecordBatch:
                cols = list(zip(*out, strict=True)) or [()] * len(names)
                out.clear()
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

            for place, guest, doc_id, down, th, n, data in zip(*(batch.column(c).to_pylist() for c in ("range", "guest", "doc_id", "down", "th", "n", "packed")), strict=True):
                if not guest and held is not None and held[:3] == [place, down, th]:
                    held[3] += n  # a row that is there again
                    continue
                if guest and (held is None or held[0] != place):
                    continue  # a further copy of a row that has served
                text = unpress.decompress(data).decode("utf-8", "surrogatepass")
                mark = printer(text)
                if held is not None and held[0] == place:
                    own, times = held[4:], held[3]
                    if times > 1:  # all but the last of equal rows are followed by their like
                        row = _compared(printer, *own, *own[1:])
                        for i in range(0, times - 1, 4096):
                            out.extend([row] * min(4096, times - 1 - i))
                            yield flush()
                    out.append(_compared(printer, *own, text, mark))
                held = None if guest else [place, down, th, n, doc_id, text, mark]
            yield flush()

    kind = docs.schema["doc_id"].dataType.simpleString()
    moved = rows.mapInArrow(send, f"range int, guest byte, doc_id {kind}, down long, th long, n long, packed binary")
    moved = moved.repartitionById(ranges, F.col("range")).sortWithinPartitions("range", "guest", "down", "th", F.col("packed").isNull())
    shape = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return moved.mapInArrow(pair, shape)


def _compared(printer: Fingerprinter, doc_id, text: str, mark: str, following: str, next_mark: str) -> tuple:
    cut = len(text) // 3
    edited = text[: len(text) - cut] + following[:cut]
    edited_mark = printer(edited)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), digest, mark, edited_mark, likeness(mark, edited_mark), likeness(mark, next_mark)


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))

"""Operator 4, benchmark decontamination by template canonicalisation.

Words lose their outer punctuation and case; numbers, units (after a number) and names (capitalised within a sentence)
become typed placeholders. Windows of WINDOW canonical words of a benchmark item are probed with every window of a document.
Matched windows pair each slot of the item with what the document has there. Within one occurrence, a range of offsets
between document and item, windows whose pairs contradict the majority's, value for value, are dropped unless they are the item's own, so a re-parameterised question counts only if its slots change together. An item
has leaked into a document if the windows left of any one occurrence cover at least COVER of the item's words and EVIDENCE words,
or an unbroken run with RUN plain words. Items of fewer than 3 * WINDOW words have windows of a third of their length.

Scale: documents are scanned, not shuffled. The benchmark is sent in blocks of at most BLOCK_WINDOWS windows, one job a
block: between blocks the documents are stored, so a task has one index and the driver one block at a time, whatever the benchmark's
size. A benchmark of one block, which is the rule, costs one scan and stores nothing. Texts are read as a whole.

Edge cases: null and empty texts leak nothing; an item of up to WINDOW words is one window; windows with under half of their words
plain prove nothing; items that such windows or fewer than LEAST_PLAIN plain words hide are matched word for word, if they have EXACT
words (``exact``, a parameter) with a plain one, or RUN words; shorter ones prove nothing, and can be asked for by a smaller ``exact``; null items are left out, ids may be
of any type or null; items with equal texts all leak; repeated rows are rows; find_leaks replaces a column named leaks, all others are passed on.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, table
from .words import CACHED_WORDS, windows

WINDOW, COVER, LEAST_PLAIN, BLOCK_WINDOWS = 8, 0.5, 4, 500_000
SHORTEST, EVIDENCE, RUN, EXACT = 4, 8, 13, 5
SHIFT = 0.25  # of an item's words may be put in or left out within one occurrence
NUMBER, NAME, UNIT = (np.uint64(xxhash.xxh64_intdigest(x) & ~15) for x in (b"<number>", b"<name>", b"<unit>"))
IS_NUMBER, IS_TITLE, ENDS, IS_UNIT = (np.uint64(x) for x in (1, 2, 4, 8))
UNITS = frozenset(
    "km m cm mm mi mile miles ft foot feet inch inches yd kg g mg lb lbs oz ton tons l ml litre litres liter liters gallon gallons"
    " s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years"
    " % percent usd eur gbp dollar dollars euro euros pound pounds cent cents mph kmh kph w kw mw v kv a hz khz mhz ghz j kj cal kcal"
    " °c °f degrees kb mb gb tb people items pieces".split()
)
OUTER = re.compile(r"^\W+|\W+$")
FIGURE = re.compile(r"^[$€£#+-]?\d[\d.,:/-]*(%|st|nd|rd|th|k|m)?$|^(one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|twenty|thirty|forty|fifty|hundred|thousand)$", re.IGNORECASE)


class Canon(dict):
    """word -> hash with four low bits that say what it is; bounded like WordHashes."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        core = OUTER.sub("", word) or word
        value = xxhash.xxh64_intdigest(core.lower().encode("utf-8", "surrogatepass")) & ~15
        value |= bool(FIGURE.match(core)) | (2 if core[:1].isupper() and core[1:].islower() else 0)
        value |= (4 if word[-1:] in ".!?:;" else 0) | (8 if core.lower() in UNITS else 0)
        self[word] = value
        return value


def canonical(words: list[str], canon: Canon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Canonical word hashes, which are placeholders, and the hashes of the words themselves."""
    raw = np.fromiter(map(canon.__getitem__, words), np.uint64, len(words))
    number = raw & IS_NUMBER != 0
    begins = np.concatenate([[True], raw[:-1] & ENDS != 0])[: len(raw)]
    name = (raw & IS_TITLE != 0) & ~begins & ~number
    unit = (raw & IS_UNIT != 0) & np.concatenate([[False], number[:-1]])[: len(raw)] & ~number & ~name
    plain = raw & ~np.uint64(15)
    out = plain.copy()
    out[number], out[name], out[unit] = NUMBER, NAME, UNIT
    return out, number | name | unit, plain


def informative(slots: np.ndarray, width: int) -> np.ndarray:
    """Windows of which at least half the words are plain."""
    upto = np.concatenate([[0], np.cumsum(~slots)])
    return 2 * (upto[width:] - upto[:-width]) >= width


class Index:
    """The windows of a block of items."""

    def __init__(self, items: list[tuple[int, str]], canon: Canon, exact: int = EXACT) -> None:
        self.items, found, self.least = [], [], exact
        self.exact: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
        for item_id, text in items:
            words = text.split()
            tokens, slots, plain = canonical(words, canon)
            n, n_plain = len(words), int((~slots).sum())
            width = n if n <= WINDOW else min(WINDOW, max(SHORTEST, n // 3))
            use = np.flatnonzero(informative(slots, width)) if n else np.zeros(0, np.int64)
            reach = np.zeros(n, bool)
            for q in use.tolist():
                reach[q : q + width] = True
            if n_plain < LEAST_PLAIN or reach.sum() < max(COVER * n, min(n, EVIDENCE)):  # templates cannot show it
                if n >= RUN or n >= exact and (n_plain or exact < EXACT):
                    self.exact[int(windows(plain[:exact], exact)[0])].append((item_id, plain))
            if n_plain < LEAST_PLAIN:
                continue
            keys = windows(tokens, width)
            found.append(np.stack([keys[use], np.full(len(use), len(self.items), np.uint64), use.astype(np.uint64)]))
            self.items.append((item_id, words, slots, width))
        self.heads = np.array(sorted(self.exact), np.uint64)
        self.widths = sorted({x[3] for x in self.items})
        rows = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.uint64)
        rows = rows[:, np.argsort(rows[0], kind="stable")]
        self.keys, self.item, self.at = rows[0], rows[1].astype(np.int64), rows[2].astype(np.int64)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.keys & np.uint64((1 << 20) - 1)] = True

    def leaks(self, text: str | None, canon: Canon) -> list[tuple[int, float]]:
        words = text.split() if text else []
        if not words or not (len(self.keys) or len(self.heads)):
            return []
        tokens, _, plain = canonical(words, canon)
        whole: set[tuple[int, float]] = set()
        if len(self.heads) and len(words) >= self.least:
            heads = windows(plain, self.least)
            for p in np.flatnonzero(np.isin(heads, self.heads)).tolist():
                whole.update((item_id, 1.0) for item_id, own in self.exact[int(heads[p])] if np.array_equal(plain[p : p + len(own)], own))
        hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for width in self.widths:
            if len(words) < width:
                continue
            keys = windows(tokens, width)
            spots = np.flatnonzero(self.seen[keys & np.uint64((1 << 20) - 1)])
            if not len(spots):
                continue
            low, high = np.searchsorted(self.keys, keys[spots]), np.searchsorted(self.keys, keys[spots], "right")
            for p, a, b in zip(spots.tolist(), low.tolist(), high.tolist(), strict=True):
                for k in range(a, b):
                    if self.items[item := int(self.item[k])][3] == width:
                        hits[item].append((p, int(self.at[k])))
        found = []
        for item, pairs in hits.items():
            item_id, own, slots, width = self.items[item]
            share, run = _covered(words, own, slots, width, pairs)
            if share * len(own) >= max(COVER * len(own), min(len(own), EVIDENCE)) - 1e-9 or run >= RUN:
                found.append((item_id, share))
        seen = {x[0] for x in whole}
        return sorted([*(x for x in found if x[0] not in seen), *whole], key=lambda x: (x[0] is not None, x[0] if x[0] is not None else 0, x[1]))


def _covered(words: list[str], own: list[str], slots: np.ndarray, width: int, pairs: list[tuple[int, int]]) -> tuple[float, int]:
    """Largest share of the item's words, and most plain words in one unbroken run, that one occurrence covers: hits whose offsets in the document are at most SHIFT of the item apart."""
    strip = lambda w: OUTER.sub("", w).lower()
    pairs = sorted(pairs, key=lambda x: (x[0] - x[1], x[1]))
    filled = [[(strip(own[q + i]), strip(words[p + i])) for i in range(width) if slots[q + i]] for p, q in pairs]
    offsets, apart = [p - q for p, q in pairs], max(4, int(SHIFT * len(own)))
    best, most, last = 0.0, 0, None
    for anchor in offsets:
        if anchor == last:
            continue
        last = anchor
        low, high = bisect_left(offsets, anchor - apart), bisect_right(offsets, anchor + apart)
        share, run = _agreed(pairs[low:high], filled[low:high], slots, width)
        best, most = max(best, share), max(most, run)
        if best == 1:
            break
    return best, most


def _agreed(pairs: list[tuple[int, int]], filled: list[list[tuple[str, str]]], slots: np.ndarray, width: int) -> tuple[float, int]:
    """Share, and plain words of the longest run, under windows that have the item's own values, or values that agree with the majority's of the occurrence."""
    votes: dict[str, Counter] = defaultdict(Counter)
    for window in filled:
        for mine, theirs in window:
            votes[mine][theirs] += 1
    agreed = {mine: max(sorted(c), key=lambda x: (c[x], x == mine)) for mine, c in votes.items()}
    covered, upto = np.zeros(len(slots), bool), np.concatenate([[0], np.cumsum(~slots)])
    most, begin, end, on = 0, 0, -1, None  # a run goes on while windows of one offset touch
    for (p, q), window in zip(pairs, filled, strict=True):
        if all(mine == theirs for mine, theirs in window) or all(agreed[mine] == theirs for mine, theirs in window):
            covered[q : q + width] = True
            if on != p - q or q > end:
                on, begin = p - q, q
            end = q + width
            most = max(most, int(upto[end] - upto[begin]))
    return float(covered.mean()), most


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Non-null items, in blocks of at most BLOCK_WINDOWS words (one item at least)."""
    block, held = [], 0
    for row in benchmark.where("text is not null").select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        size = len(row["text"].split())
        if block and held + size > BLOCK_WINDOWS:
            yield block
            block, held = [], 0
        block.append((row["item_id"], row["text"]))
        held += size
    if block:
        yield block


def _by_blocks(docs: DataFrame, benchmark: DataFrame, scan: Callable[[pa.RecordBatch, Index, Canon], pa.RecordBatch], exact: int) -> DataFrame:
    """docs after a scan for each block of the benchmark, in a job of its own but for the last."""
    sent = None
    for block in item_blocks(benchmark):
        if sent is not None:
            docs = materialize(docs, "scanned")
            sent.unpersist()
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            canon = Canon()
            index = Index(sent.value, canon, exact)
            for batch in batches:
                yield scan(batch, index, canon)

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def find_leaks(docs: DataFrame, benchmark: DataFrame, exact: int = EXACT) -> DataFrame:
    """docs with a column leaks: array of (item_id, covered). Items that templates cannot show are matched word for word from ``exact`` words on."""
    leak = T.ArrayType(T.StructType([T.StructField("item_id", benchmark.schema["item_id"].dataType), T.StructField("covered", T.DoubleType())]))

    def scan(batch: pa.RecordBatch, index: Index, canon: Canon) -> pa.RecordBatch:
        at = batch.schema.get_field_index("leaks")
        old = batch.column(at).to_pylist()
        new = [a + [{"item_id": i, "covered": c} for i, c in index.leaks(t.as_py(), canon)] for a, t in zip(old, batch.column("text"), strict=True)]
        columns = [*batch.columns]
        columns[at] = pa.array(new, batch.schema.field(at).type)
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return _by_blocks(docs.withColumn("leaks", F.array().cast(leak)), benchmark, scan, exact)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, exact: int = EXACT) -> DataFrame:
    """docs in which no item has leaked, with all their columns."""
    return _by_blocks(docs, benchmark, lambda batch, index, canon: batch.filter(pa.array([not index.leaks(t.as_py(), canon) for t in batch.column("text")], pa.bool_())), exact)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids (comma-joined), covered (of the item covered most; 0 if none)."""
    out = find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", (F.size("leaks") > 0).alias("contaminated"), F.size("leaks").cast("long").alias("n_items"),
        F.array_join(F.transform("leaks", lambda x: x["item_id"].cast("string")), ",").alias("item_ids"), F.coalesce(F.array_max("leaks.covered"), F.lit(0.0)).alias("covered"),
    )

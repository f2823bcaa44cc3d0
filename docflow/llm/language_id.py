"""Operator 7, language identification by rank-order profiles.

A profile is a text's PROFILE most frequent letter n-grams (1 to 3 letters, words padded with a border), by rank. A
language's profile comes from its training texts; a document goes to the language whose profile is nearest by the out-of-place
distance, the sum over the document's n-grams of how far ranks are apart (PROFILE where the n-gram is not in the profile).
The score is 1 - distance / largest possible distance.

Training is bounded: at most SAMPLE different labelled texts a language (whole ones, least keyed hash first), a parameter; copies
of a text count once, under whatever doc_id. Profiles,
PROFILE rows a language, are all that executors are sent; every text is scored as a whole, in one scan with no exchange.

Edge cases: a text that is null, empty or without a letter is 'und' with score 0, as is every text when nothing is labelled;
equal counts rank by n-gram hash and equal distances go to the first language by name; repeated rows are rows; a null
doc_id is not held out and is not trained on; languages may be any non-null values of lang.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table
from .words import P

PROFILE, LONGEST, SAMPLE, SPARE = 300, 3, 500, 4
UNKNOWN = "und"


def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(1 << 16)), bool, 1 << 16)


def ngrams(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams as hashes, and their counts. A border may only begin or end an n-gram of two or more."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters[np.minimum(codes, 0xFFFF)]
    if len(codes) and codes.max() > 0xFFFF:
        far = np.flatnonzero(codes > 0xFFFF)
        is_letter = is_letter.copy()
        is_letter[far] = [chr(c).isalpha() for c in codes[far]]
    codes = np.concatenate([[0], np.where(is_letter, codes, 0), [0]]).astype(np.uint64)
    codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]
    if len(codes) < 2:
        return codes[:0], codes[:0].astype(np.int64)
    border, codes, found = codes == 0, codes + np.uint64(1), []
    value = codes
    found.append(value[~border])
    for n in range(2, LONGEST + 1):
        value = value[:-1] * P + codes[n - 1 :]
        inner = np.zeros(len(value), bool)
        for i in range(1, n - 1):
            inner |= border[i : i + len(value)]
        found.append(value[~inner])
    return np.unique(np.concatenate(found), return_counts=True)


def top_ranks(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return grams[np.lexsort((grams, -counts))[:PROFILE]]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = _letters()
    for batch in batches:
        langs, rows = batch.column("lang").to_pylist(), batch.column("text")
        for lang in sorted(set(langs)):
            parts = [ngrams(rows[i].as_py(), letters) for i, x in enumerate(langs) if x == lang]
            grams, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([p[1] for p in parts]), len(grams)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(counts)], ["lang", "gram", "n"])


def learn_profiles(labelled: DataFrame, sample: int = SAMPLE) -> dict[str, list[int]]:
    """labelled(text, lang) -> n-gram hashes of each language, most frequent first."""
    usable = labelled.where("text is not null and lang is not null").select("text", F.col("lang").cast("string").alias("lang")).withColumn("h", F.xxhash64(F.lit(7), "text"))
    keys = materialize(usable.select("lang", "h").distinct(), "lang_keys")
    # Least hashes are under a limit that, on average, SPARE times as many are under: few texts of a language meet in one task.
    limits = {r["lang"]: min(1.0, SPARE * sample / r["count"]) for r in keys.groupBy("lang").count().collect()}  # a number a language
    below = F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair])[F.col("lang")] if limits else F.lit(1.0)
    few = keys.where(F.pmod("h", F.lit(1 << 40)) < below * (1 << 40))
    rank = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 40)), "h")
    chosen = materialize(few.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= sample).select("lang", "h"), "lang_sample")
    texts = usable.join(chosen, ["lang", "h"], "left_semi").groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text")
    counts = texts.mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("r", F.row_number().over(by_count)).where(F.col("r") <= PROFILE)
    profiles: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "r").collect():  # PROFILE rows a language
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


class Identifier:
    def __init__(self, profiles: dict[str, list[int]]) -> None:
        self.letters, self.names, self.tables = _letters(), sorted(profiles), []
        for name in self.names:
            grams = np.array(profiles[name], np.int64).view(np.uint64)
            order = np.argsort(grams)
            self.tables.append((grams[order], order))

    def __call__(self, text: str | None) -> tuple[str, float]:
        top = top_ranks(*ngrams(text, self.letters)) if text else ()
        if not len(top) or not self.names:
            return UNKNOWN, 0.0
        ranks, best = np.arange(len(top)), (len(top) * PROFILE + 1, UNKNOWN)
        for name, (grams, places) in zip(self.names, self.tables, strict=True):
            at = np.minimum(np.searchsorted(grams, top), len(grams) - 1)
            away = np.where(grams[at] == top, np.abs(places[at] - ranks), PROFILE).sum()
            best = min(best, (int(away), name))
        return best[1], 1 - best[0] / (len(top) * PROFILE)


def identify(docs: DataFrame, profiles: dict[str, list[int]]) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, lang_pred, score), a row for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(profiles)
        for batch in batches:
            found = [identifier(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, profiles: dict[str, list[int]], least: float = 0.0) -> DataFrame:
    """docs whose language is known with a score over least, with all their columns, in one scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(profiles)
        for batch in batches:
            found = [identifier(t.as_py()) for t in batch.column("text")]
            yield batch.filter(pa.array([f[0] != UNKNOWN and f[1] > least for f in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE) -> dict[str, list[int]]:
    return learn_profiles(docs.where(~held_out() & F.col("doc_id").isNotNull()), sample)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")

"""Classification against vocabularies of any size.

``functions.classify`` turns a configured vocabulary into literals of the plan, which is right for some dozens of terms. Here a
vocabulary is a table (term, label): terms are looked up by a join, a record's labels come together as bits of a few long numbers,
folded by bit_or in partial aggregates, and are read back in the labels' order. What a plan holds does not grow with the terms, and a term
that a third of all records have is one row on its side of the join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MODALITIES, Mapping

BITS = 63


@dataclass(frozen=True)
class Vocabulary:
    """terms(term, label_no): lower-cased terms, one row for each of a term's labels; labels in their order, as many as a plan can hold."""

    terms: DataFrame
    labels: tuple[str, ...]


def of_mapping(spark: SparkSession, labelled: dict[str, list[str]]) -> Vocabulary:
    """A vocabulary from a configuration's label -> terms."""
    rows = [(term.lower(), i) for i, terms in enumerate(labelled.values()) for term in terms]
    return Vocabulary(spark.createDataFrame(rows, "term string, label_no int").distinct(), tuple(labelled))


def of_table(table: DataFrame, labels: tuple[str, ...]) -> Vocabulary:
    """A vocabulary from a table (term, label); terms of other labels are left out."""
    numbers = F.create_map(*[F.lit(x) for pair in zip(labels, range(len(labels)), strict=True) for x in pair])
    rows = table.select(F.lower("term").alias("term"), numbers[F.col("label")].cast("int").alias("label_no")).where("term is not null and label_no is not null")
    return Vocabulary(rows.distinct(), labels)


def labels_of(records: DataFrame, key: str, terms: str, vocabulary: Vocabulary) -> DataFrame:
    """records(key, terms array<string>) -> (key, labels): the labels of any of a record's terms, in their order; a row for each key, null included."""
    words = -(-len(vocabulary.labels) // BITS) or 1
    given = records.select(F.col(key).alias("_key"), F.explode_outer(F.array_distinct(F.transform(F.array_compact(F.coalesce(terms, F.array().cast("array<string>"))), F.lower))).alias("term"))
    found = given.join(vocabulary.terms, "term", "left")
    bit = lambda w: F.when(F.floor(F.col("label_no") / BITS) == w, F.call_function("shiftleft", F.lit(1).cast("long"), F.col("label_no") % BITS)).otherwise(F.lit(0).cast("long"))
    folded = found.groupBy("_key").agg(*[F.bit_or(bit(w)).alias(f"_{w}") for w in range(words)])
    return folded.select(F.col("_key").alias(key), _set_bits([F.col(f"_{w}") for w in range(words)], vocabulary.labels).alias("labels"))


def _set_bits(words: list[Column], labels: tuple[str, ...]) -> Column:
    names, held = F.array(*map(F.lit, labels)).cast("array<string>"), F.array(*words)
    on = lambda i: F.expr("1L") == (F.call_function("shiftrightunsigned", F.element_at(held, (F.floor(i / BITS) + 1).cast("int")), (i % BITS).cast("int")).bitwiseAND(F.lit(1)))
    return F.filter(names, lambda name, i: on(i))


def topics_of(records: DataFrame, key: str, terms: str, mapping: Mapping) -> DataFrame:
    return labels_of(records, key, terms, of_mapping(records.sparkSession, mapping.topics))


def modalities_of(records: DataFrame, key: str, terms: str, mapping: Mapping) -> DataFrame:
    """As ``functions.modality``: no ckd_non_dialysis beside dialysis, and 'unspecified' if there is none."""
    order = [m for m in MODALITIES if m != "unspecified"]
    labelled = {m: [t for t, own in mapping.mesh_modality.items() if own == m] for m in order} | {"": mapping.dialysis_mesh_terms}
    found = labels_of(records, key, terms, of_mapping(records.sparkSession, labelled))
    dialysis = F.arrays_overlap("labels", F.array(F.lit(""), F.lit("hemodialysis"), F.lit("peritoneal_dialysis")))
    kept = F.filter("labels", lambda m: (m != "") & ~((m == "ckd_non_dialysis") & dialysis))
    return found.select(key, F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit("unspecified"))).alias("labels"))

"""Classification of records against the configured vocabularies (docflow.config).

Vocabularies become literals; terms are compared in lower case, which for these ASCII words equals case folding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import LANGUAGES, MODALITIES, Mapping


def _words(values) -> Column:
    return F.array(*[F.lit(v.lower()) for v in values]).cast("array<string>")


def _lowered(terms: Column) -> Column:
    return F.array_compact(F.transform(F.coalesce(terms, F.array().cast("array<string>")), lambda t: F.lower(t)))


def _has(terms: Column, values) -> Column:
    return F.arrays_overlap(_lowered(terms), _words(values)) if values else F.lit(False)


def _lookup(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for k, v in pairs.items() for x in (k.lower(), v)]) if pairs else F.create_map().cast("map<string,string>")


def language(codes: Column) -> Column:
    """Two-letter code of the first code that has one."""
    return F.get(F.array_compact(F.transform(_lowered(codes), lambda c: _lookup(LANGUAGES)[c])), F.lit(0))


def doc_type(publication_types: Column, mapping: Mapping) -> Column:
    """(doc_type, method) of the first rule that applies, in the rules' order; ('other', 'rule') if none does."""
    found = F.coalesce(*[F.when(_has(publication_types, [r.publication_type]), F.lit(r.doc_type)) for r in mapping.publication_type_doc_type], F.lit(None).cast("string"))
    return F.struct(F.coalesce(found, F.lit("other")).alias("doc_type"), F.when(found.isNotNull(), "source").otherwise("rule").alias("method"))


def evidence_tier(kind: Column, mapping: Mapping) -> Column:
    return _lookup({k: str(v) for k, v in mapping.evidence_tier.items()})[kind].cast("int")


def modality(terms: Column, mapping: Mapping) -> Column:
    """Modalities in the enumeration's order; no ckd_non_dialysis beside dialysis; ['unspecified'] if none."""
    found = F.array_compact(F.transform(_lowered(terms), lambda t: _lookup(mapping.mesh_modality)[t]))
    dialysis = _has(terms, mapping.dialysis_mesh_terms) | F.arrays_overlap(found, F.array(F.lit("hemodialysis"), F.lit("peritoneal_dialysis")))
    in_order = F.array(*[F.lit(m) for m in MODALITIES if m != "unspecified"])
    kept = F.filter(in_order, lambda m: F.array_contains(found, m) & ~((m == "ckd_non_dialysis") & dialysis))
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit("unspecified")))


def topics(terms: Column, mapping: Mapping) -> Column:
    """Topics in the configuration's order; may be empty."""
    return F.array_compact(F.array(*[F.when(_has(terms, words), F.lit(topic)) for topic, words in mapping.topics.items()]).cast("array<string>"))


def population(terms: Column, mapping: Mapping) -> Column:
    young, grown = _has(terms, mapping.population_pediatric_mesh), _has(terms, mapping.population_adult_mesh)
    return F.when(young & grown, "mixed").when(young, "pediatric").when(grown, "adult").otherwise("unspecified")

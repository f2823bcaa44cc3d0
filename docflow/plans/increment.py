"""An incremental run: documents that have arrived, against what earlier arrivals left in the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Quality
from ..functions import content_hash, normalize_license
from ..operators import ranking, waterfall
from ..storage import materialize

OUTCOMES = ("new", "updated", "unchanged", "duplicate", "excluded")
#: What a decision tells of an arrival; batch is null unless the document goes into one.
DECISIONS = "doc_id long, lang string, source string, license string, content_hash string, tier int, reasons array<string>, outcome string, batch long"
STATE = "doc_id long, content_hash string, epoch long"


def body_of(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def prefixed(doc_id: Column) -> Column:
    return F.concat(F.lit("pmid-"), doc_id.cast("string"))


def tier_of(lang: Column, tiers: dict[str, int]) -> Column:
    """A language's tier; the last one for all others."""
    known = F.create_map(*[F.lit(x) for pair in tiers.items() for x in pair]) if tiers else F.create_map().cast("map<string,int>")
    return F.coalesce(known[lang], F.lit(max(tiers.values(), default=0) + 1)).cast("int")


def latest(accepted: DataFrame) -> DataFrame:
    """accepted(doc_id, content_hash, epoch) -> the last accepted version of each document."""
    return ranking.last_seen(accepted.select("doc_id", "content_hash", "epoch"), ["doc_id"], ["epoch", "content_hash"])


def decide(arrivals: DataFrame, corpus: DataFrame, registry: DataFrame, protected: DataFrame, rules: Quality, tiers: dict[str, int], size: int) -> DataFrame:
    """arrivals(doc_id, text, lang, source) -> a stored table as DECISIONS, a row for each doc_id that arrived.

    corpus(doc_id, content_hash): the last version of each stored document. registry(doc_id, quality, toxic): what is known of
    documents; toxic ones are retracted, those of quality 0 rejected. protected(item_id): ids that another change set holds.

    An excluded document has its reasons: the first that holds of its metadata, or all of the gate. Of documents with one text, the
    first that is in the corpus or, before that, the one with the smallest id stays; others are duplicates. Of rows that repeat a
    doc_id the one with the smallest hash, language and source counts; rows without a doc_id are excluded, each as a row. Texts are read once and
    take part in no shuffle.
    """
    text = body_of(F.col("text"))
    license_name = normalize_license(text)
    rows = arrivals.select(
        "doc_id", F.col("doc_id").cast("string").alias("pmid"), "lang", F.col("source").alias("pmcid"), license_name.alias("license"), content_hash(text).alias("content_hash"),
        tier_of(F.col("lang"), tiers).alias("tier"), waterfall.gate_reasons(F.col("lang"), license_name, text, rules).alias("gate"),
    )
    rows = materialize(rows, "arrivals")
    known = registry.where("doc_id is not null").groupBy(F.col("doc_id").cast("string").alias("pmid")).agg(F.max(F.col("toxic") == 1).alias("retracted"), F.max(F.col("quality") == 0).alias("poor"))
    records = ranking.first_seen(rows.where("doc_id is not null"), ["pmid"], ["content_hash", "lang", "pmcid"]).join(known.select("pmid", "retracted"), "pmid", "left")
    none = F.lit(None).cast("string")
    stored = corpus.select(prefixed(F.col("doc_id")).alias("id"), none.alias("status"), "content_hash", none.alias("review_notes"), none.alias("error"))
    ids = lambda df, column: df.select(prefixed(F.col(column)).alias("id")).where("id is not null")
    flagged = waterfall.with_state(records, stored, ids(known.where("poor"), "pmid"), ids(protected, "item_id"))
    reason = waterfall.first_reason(waterfall.record_rules())
    flagged = flagged.withColumn("reasons", F.when(reason.isNotNull(), F.array(reason)).otherwise(F.col("gate")))
    same = F.col("stored") & (F.col("stored_hash") == F.col("content_hash"))
    flagged = materialize(flagged.withColumn("outcome", F.when(F.size("reasons") > 0, "excluded").when(same, "unchanged")), "flagged")

    # The first holder of each text: a stored document, or else the smallest id that has just arrived; two partial aggregates.
    held = corpus.groupBy("content_hash").agg(F.min("doc_id").alias("holder"))
    first = flagged.where("outcome is null").groupBy("content_hash").agg(F.min("doc_id").alias("first"))
    owners = first.join(held, "content_hash", "left").select("content_hash", F.coalesce("holder", "first").alias("owner"))
    fresh = flagged.where("outcome is null").join(owners, "content_hash")
    fresh = fresh.withColumn("outcome", F.when(F.col("owner") != F.col("doc_id"), "duplicate").when(F.col("stored"), "updated").otherwise("new")).drop("owner")
    decided = materialize(fresh.unionByName(flagged.where("outcome is not null")), "decided")

    ranks = ranking.global_rank(decided.where(F.col("outcome").isin("new", "updated")).select("tier", "pmid"), ["tier", "pmid"])
    out = decided.join(ranks.select("pmid", ranking.batch_number(F.col("rank"), size).alias("batch")), "pmid", "left").withColumnRenamed("pmcid", "source")
    nameless = rows.where("doc_id is null").withColumnsRenamed({"pmcid": "source"}).withColumns({"reasons": F.array(F.lit("no_id")), "outcome": F.lit("excluded"), "batch": F.lit(None).cast("long")})
    columns = [F.col(c.strip().split(" ")[0]).cast(c.strip().split(" ")[1]) for c in DECISIONS.split(", ")]
    return materialize(out.select(columns).unionByName(nameless.select(columns)), "decisions")

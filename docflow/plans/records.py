"""Queries on identity, exclusion, gates, diffs and batches.

The driver's tables stand in for the pipeline's: documents are candidate records, labels the corpus and its review registry (toxic: retracted,
quality 0: rejected), benchmark the ids in open batches, pages the full texts by id. The functions are those that a run calls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import udfs
from ..config import Quality
from ..functions import content_hash, normalize_license
from ..functions.licenses import ADDRESS, NAME
from ..operators import ranking, sinks, snapshot, waterfall
from ..storage import materialize, scratch_path

GATE = Quality(min_body_chars=1500, allowed_languages=["en", "fr"], allowed_licenses=["CC0-1.0", "CC-BY-4.0", "CC-BY-3.0", "CC-BY-SA-4.0", "CC-BY-SA-3.0", "CC-BY-NC-4.0"])
#: Texts that documents lack: every turn that a licence's name can take.
LICENSE_CASES = (
    "https://creativecommons.org/licenses/by/4.0/", "http://creativecommons.org/licenses/BY-NC-ND/3.0/", "https://creativecommons.org/publicdomain/zero/1.0/", "https://creativecommons.org/publicdomain/mark/1.0/",
    "CC BY 4.0", "CC-BY-SA-3.0", "cc by nc nd 4.0", "CC0", "CC0 1.0", "CC BY", "BYNCND CC BYNCND 4.0", "CC BY 4.0x", "CC BY see https://creativecommons.org/licenses/by-sa/4.0/", "all rights reserved", "",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dedup_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_hash"))
    return ranking.first_seen(docs, ["text_hash"], ["doc_id"])


DEDUP_FIRST_SEEN = """
SELECT doc_id, lang, text_hash FROM (
  SELECT doc_id, lang, sha256(coalesce(text, '')) AS text_hash, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) AS r FROM documents) WHERE r = 1"""


def _prefixed(column: str) -> Column:
    return F.concat(F.lit("pmid-"), F.col(column).cast("string"))


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of different texts as records, with what the corpus holds of them: a registry of decisions, unreadable files, open batches."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    gate = F.size(waterfall.gate_reasons(F.col("lang"), normalize_license(F.col("text")), F.col("text"), GATE)) > 0
    first = ranking.first_seen(docs.select("doc_id", "source", gate.alias("gated"), F.sha2("text", 256).alias("text_hash")), ["text_hash"], ["doc_id"])
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    records = first.join(labels.select("doc_id", (F.col("toxic") == 1).alias("retracted")), "doc_id", "left").withColumn("pmid", F.col("doc_id").cast("string")).withColumnRenamed("source", "pmcid")
    poor, even, none = F.col("quality") == 0, F.col("doc_id") % 2 == 0, F.lit(None).cast("string")
    corpus = labels.where(~(poor & even)).select(
        _prefixed("doc_id").alias("id"), F.when(poor, "rejected").otherwise("approved").alias("status"), none.alias("content_hash"), none.alias("review_notes"), F.when(~poor & (F.col("doc_id") % 5 == 0), "unreadable").alias("error"),
    )
    opened = table(spark, sf_dir, "benchmark").select(F.explode(F.array(_prefixed("item_id"), F.concat(F.lit("web-"), F.col("item_id").cast("string")))).alias("id"))
    flagged = waterfall.with_state(records, corpus, labels.where(poor & even).select(_prefixed("doc_id").alias("id")), opened)
    bodies = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), (F.length("html") > 0).alias("has_body")).distinct()
    return flagged.join(bodies, "doc_id", "left")


def exclusion_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = [("no_open_access_fulltext", ~F.coalesce(F.col("has_body"), F.lit(False))), ("quality", F.col("gated"))]
    reason = waterfall.first_reason(waterfall.record_rules() + late)
    return _flagged(spark, sf_dir).select("doc_id", F.coalesce(reason, F.lit("kept")).alias("reason"))


_ADDRESS, _NAME = (p.replace("(?iU)", "(?i)") for p in (ADDRESS, NAME))
LICENSE_SQL = r"""
CASE WHEN regexp_matches({c}, '@A') THEN
  CASE WHEN lower(regexp_extract({c}, '@A', 1)) = 'licenses'
    THEN 'CC-' || upper(regexp_extract({c}, '@A', 2)) || '-' || regexp_extract({c}, '@A', 3)
    WHEN upper(regexp_extract({c}, '@A', 2)) = 'ZERO' THEN 'CC0-1.0' END
WHEN regexp_matches({c}, '@N') THEN
  CASE WHEN regexp_extract({c}, '@N', 1) = '0' THEN 'CC0-1.0'
  ELSE 'CC-' || regexp_replace(regexp_replace(upper(regexp_extract({c}, '@N', 1)), '[\s-]+', '-', 'g'), 'BY(NC|ND|SA)', 'BY-\1', 'g')
    || CASE WHEN regexp_extract({c}, '@N', 2) <> '' THEN '-' || regexp_extract({c}, '@N', 2) ELSE '' END END
END""".replace("@A", _ADDRESS).replace("@N", _NAME)
_ALLOWED = ", ".join(f"'{x}'" for x in GATE.allowed_licenses)
_FLAGGED_SQL = f"""
WITH docs AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) AS r FROM documents),
flagged AS (
  SELECT d.doc_id, d.lang, d.source, length(d.text) AS chars, {LICENSE_SQL.format(c='d.text')} AS license, coalesce(l.toxic = 1, false) AS retracted, coalesce(l.quality = 0, false) AS rejected,
    coalesce(l.quality <> 0 AND d.doc_id % 5 = 0, false) AS unreadable, b.item_id IS NOT NULL AS opened, coalesce(length(p.html) > 0, false) AS has_body
  FROM docs d LEFT JOIN labels l USING (doc_id) LEFT JOIN (SELECT DISTINCT item_id FROM benchmark) b ON b.item_id = d.doc_id LEFT JOIN pages p ON p.page_id = d.doc_id WHERE d.r = 1),
reasoned AS (
  SELECT doc_id, CASE WHEN retracted THEN 'retracted' WHEN rejected THEN 'rejected_in_corpus' WHEN unreadable THEN 'error_read_corpus' WHEN opened THEN 'in_open_pr' WHEN coalesce(source, '') = '' THEN 'no_pmcid'
    WHEN NOT has_body THEN 'no_open_access_fulltext'
    WHEN lang IS NULL OR lang NOT IN ('en', 'fr') OR license IS NULL OR license NOT IN ({_ALLOWED}) OR chars < {GATE.min_body_chars} THEN 'quality' ELSE 'kept' END AS reason FROM flagged)"""
EXCLUSION_WATERFALL = _FLAGGED_SQL + " SELECT doc_id, reason FROM reasoned"


def exclusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return waterfall.reason_counts(exclusion_waterfall(spark, sf_dir))


EXCLUSION_COUNTS = _FLAGGED_SQL + " SELECT reason, count(*)::BIGINT AS n FROM reasoned GROUP BY reason"


def quality_gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    reasons = waterfall.gate_reasons(F.col("lang"), normalize_license(F.coalesce("text", F.lit(""))), F.col("text"), GATE)
    return docs.select("doc_id", F.explode(reasons).alias("reason"))


QUALITY_GATE_REASONS = f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents), x AS (SELECT doc_id, lang, length(text) AS chars, {LICENSE_SQL.format(c='text')} AS license FROM d)
SELECT doc_id, CASE WHEN lang IS NULL THEN 'language_missing' ELSE 'language_not_allowed' END AS reason FROM x WHERE lang IS NULL OR lang NOT IN ('en', 'fr')
UNION ALL SELECT doc_id, CASE WHEN license IS NULL THEN 'license_missing' ELSE 'license_not_allowed' END FROM x WHERE license IS NULL OR license NOT IN ({_ALLOWED})
UNION ALL SELECT doc_id, 'body_too_short' FROM x WHERE chars < {GATE.min_body_chars}"""


def license_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(LICENSE_CASES)], "doc_id long, text string")
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text").unionByName(cases)
    return rows.select("doc_id", normalize_license(F.col("text")).alias("license"))


_CASES_SQL = " UNION ALL ".join(f"SELECT {-1 - i}, '{t}'" for i, t in enumerate(LICENSE_CASES))
LICENSE_NAMES = f"WITH d AS (SELECT doc_id, text FROM documents UNION ALL {_CASES_SQL}) SELECT doc_id::BIGINT AS doc_id, {LICENSE_SQL.format(c='text')} AS license FROM d"


def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", content_hash(F.col("text")).alias("content_hash"))


CONTENT_HASHES = "SELECT doc_id, 'sha256:' || sha256(text) AS content_hash FROM documents"


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot before holds the labelled documents; those labelled toxic had another body."""
    docs = table(spark, sf_dir, "documents").select("doc_id", content_hash(F.col("text")).alias("hash"), content_hash(F.concat("text", F.lit("\n"))).alias("other"))
    before = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("stored"), (F.col("toxic") == 1).alias("changed"))
    rows = docs.join(before, "doc_id", "left").withColumn("stored", F.coalesce("stored", F.lit(False)))
    stored_hash = F.when(F.col("changed"), F.col("other")).otherwise(F.col("hash"))
    return rows.select("doc_id", waterfall.diff_status(F.col("stored"), stored_hash, F.col("hash")).alias("status"))


SNAPSHOT_DIFF = """
SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'new' WHEN sha256(d.text) = sha256(CASE WHEN l.toxic = 1 THEN d.text || chr(10) ELSE d.text END) THEN 'unchanged' ELSE 'updated' END AS status
FROM documents d LEFT JOIN labels l USING (doc_id)"""

TIERS = {"en": 1, "fr": 2, "es": 3, "de": 4}
BATCH = 20


def _batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as changes, in batches as a run makes them."""
    tier = F.coalesce(F.create_map(*[F.lit(x) for p in TIERS.items() for x in p])[F.col("lang")], F.lit(5))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("pmid"), "lang", "source", tier.alias("tier"))
    lang = F.coalesce("lang", F.lit(""))
    front = F.struct(
        F.concat(F.lit("pmid-"), "pmid").alias("id"), F.concat(F.coalesce("source", F.lit("")), F.lit("|"), lang).alias("title"), F.concat(F.lit("kind_"), F.col("tier").cast("string")).alias("doc_type"),
        F.col("tier").alias("evidence_tier"), F.array(F.lit("unspecified"), lang).alias("modality"), F.array().cast("array<string>").alias("topics"),
    )
    return sinks.batches(docs.select("pmid", front.alias("front_matter"), F.lit("new").alias("outcome")), BATCH)


def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batched(spark, sf_dir).select("pmid", F.col("front_matter.evidence_tier").alias("tier"), "rank", "batch")


_BATCHED_SQL = f"""
WITH d AS (SELECT doc_id::VARCHAR AS pmid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, CASE lang {' '.join(f"WHEN '{k}' THEN {v}" for k, v in TIERS.items())} ELSE 5 END AS tier FROM documents),
ranked AS (SELECT *, row_number() OVER (ORDER BY tier, pmid) AS rank FROM d), batched AS (SELECT *, (rank - 1) // {BATCH} + 1 AS batch FROM ranked)"""
BATCH_ASSIGN = _BATCHED_SQL + " SELECT pmid, tier, rank::BIGINT AS rank, batch::BIGINT AS batch FROM batched"


def batch_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.descriptions(_batched(spark, sf_dir))


_ROW = r"'| `pmid-' || pmid || '` | ' || source || '\|' || lang || ' | kind_' || tier || ' | unspecified, ' || lang || ' |  | new | [' || pmid || '](https://pubmed.ncbi.nlm.nih.gov/' || pmid || '/) |'"
BATCH_DESCRIPTION = f"""{_BATCHED_SQL} SELECT batch::BIGINT AS batch, count(*)::BIGINT AS documents,
  '{sinks.HEADER}' || chr(10) || string_agg({_ROW}, chr(10) ORDER BY rank) || chr(10) || chr(10) || '{sinks.NOTICE}' AS description FROM batched GROUP BY batch"""


def run_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics of a run whose records the waterfall excludes and whose other outcomes are those of the diff."""
    reasons = exclusion_waterfall(spark, sf_dir).where("reason <> 'kept'").select("reason")
    made = sinks.run_statistics(table(spark, sf_dir, "documents").count(), reasons, snapshot_diff(spark, sf_dir).select(F.col("status").alias("outcome")))
    listed = F.array_join(F.transform(F.map_entries("excluded"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return made.withColumn("excluded", listed)


RUN_STATISTICS = _FLAGGED_SQL + """, n AS (SELECT reason, count(*) AS n FROM reasoned WHERE reason <> 'kept' GROUP BY reason), s AS (@DIFF)
SELECT (SELECT count(*) FROM documents) AS found, (SELECT string_agg(reason || '=' || n, ',' ORDER BY reason) FROM n) AS excluded, (SELECT sum(n) FROM n)::BIGINT AS excluded_total,
  count(*) FILTER (WHERE status = 'new') AS "new", count(*) FILTER (WHERE status = 'updated') AS updated, count(*) FILTER (WHERE status = 'unchanged') AS unchanged, (SELECT n FROM n WHERE reason = 'error_read_corpus') AS errors FROM s""".replace("@DIFF", SNAPSHOT_DIFF)


def front_matter_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written with front matter and read again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    front = udfs.struct_of({
        "id": _prefixed("doc_id"), "title": F.split("text", "\n")[0], "language": F.col("lang"), "evidence_tier": F.col("doc_id") % 5 + 1, "retracted": F.col("doc_id") % 2 == 0, "published": F.lit("2024-03-05"),
        "modality": F.array(F.lit("transplant"), F.coalesce("lang", F.lit("none"))), "topics": F.array().cast("array<string>"), "review_notes": F.concat(F.lit("a: "), F.reverse("text")),
    })
    read = docs.select("doc_id", udfs.read_document(udfs.write_document(front, "text")).alias("d"))
    keys = F.col("d.front_matter")
    return read.select(
        "doc_id", keys["title"].alias("title"), keys["language"].alias("language"), keys["evidence_tier"].cast("long").alias("tier"), keys["retracted"].alias("retracted"), keys["published"].alias("published"),
        F.array_join(keys["modality"], ",").alias("modality"), keys["topics"].isNull().alias("no_topics"), F.sha2(keys["review_notes"], 256).alias("notes_sha256"), F.sha2("d.body", 256).alias("body_sha256"), F.col("d.error").alias("error"),
    )


FRONT_MATTER_ROUND_TRIP = """
SELECT doc_id, string_split(coalesce(text, ''), chr(10))[1] AS title, lang AS language, (doc_id % 5 + 1)::BIGINT AS tier, doc_id % 2 = 0 AS retracted, '2024-03-05' AS published, 'transplant,' || coalesce(lang, 'none') AS modality,
  true AS no_topics, sha256('a: ' || reverse(coalesce(text, ''))) AS notes_sha256, sha256(coalesce(text, '')) AS body_sha256, NULL::VARCHAR AS error FROM documents"""


def free_branch_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = -(-table(spark, sf_dir, "documents").count() // BATCH)
    taken = materialize(table(spark, sf_dir, "benchmark").where("item_id > 0").select(F.col("item_id").cast("long").alias("number")).distinct(), "taken")
    return ranking.free_numbers(spark, wanted, taken, taken.count())


FREE_BRANCH_NUMBERS = f"""
WITH n AS (SELECT (count(*) + {BATCH - 1}) // {BATCH} AS wanted FROM documents), taken AS (SELECT DISTINCT item_id AS number FROM benchmark WHERE item_id > 0),
free AS (SELECT g.number, row_number() OVER (ORDER BY g.number) AS batch FROM (SELECT unnest(range(1, (SELECT wanted FROM n) + (SELECT count(*) FROM taken) + 1)) AS number) g ANTI JOIN taken USING (number))
SELECT batch::BIGINT AS batch, number::BIGINT AS number FROM free WHERE batch <= (SELECT wanted FROM n)"""


def page_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.page_ranges(spark, table(spark, sf_dir, "documents").count(), 100)


PAGE_OFFSETS = """
WITH n AS (SELECT count(*) AS total FROM documents)
SELECT start::BIGINT AS start, least(100, total - start)::BIGINT AS count FROM n, (SELECT unnest(range(0, (SELECT total FROM n), 100)) AS start)"""

QUERIES = {
    "dedup_first_seen": dedup_first_seen, "exclusion_waterfall": exclusion_waterfall, "exclusion_counts": exclusion_counts, "quality_gate_reasons": quality_gate_reasons, "normalize_license": license_names,
    "content_hash": content_hashes, "snapshot_diff": snapshot_diff, "batch_assign": batch_assign, "batch_description": batch_description, "free_branch_numbers": free_branch_numbers, "page_offsets": page_offsets,
    "run_statistics": run_statistics, "front_matter_round_trip": front_matter_round_trip,
}
ORACLES = {
    "dedup_first_seen": DEDUP_FIRST_SEEN, "exclusion_waterfall": EXCLUSION_WATERFALL, "exclusion_counts": EXCLUSION_COUNTS, "quality_gate_reasons": QUALITY_GATE_REASONS, "normalize_license": LICENSE_NAMES,
    "content_hash": CONTENT_HASHES, "snapshot_diff": SNAPSHOT_DIFF, "batch_assign": BATCH_ASSIGN, "batch_description": BATCH_DESCRIPTION, "free_branch_numbers": FREE_BRANCH_NUMBERS, "page_offsets": PAGE_OFFSETS,
    "run_statistics": RUN_STATISTICS, "front_matter_round_trip": FRONT_MATTER_ROUND_TRIP,
}


def snapshot_buckets_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As snapshot_diff, against a snapshot that is stored in buckets, of which only those that differ are read; labels of missing documents are removed ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", content_hash(F.coalesce("text", F.lit(""))).alias("hash"))
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("changed"))
    ident, path = F.col("doc_id").cast("string"), scratch_path(spark, "snapshot")
    before = docs.join(labels, "doc_id").select(ident.alias("id"), F.when(F.col("changed"), F.concat("hash", F.lit("-"))).otherwise(F.col("hash")).alias("content_hash"), F.lit("approved").alias("status"))
    snapshot.write_snapshot(before, path, 64)
    now = docs.where("doc_id % 10 > 0").select(ident.alias("id"), F.col("hash").alias("content_hash"), F.when(F.col("doc_id") % 50 == 1, "rejected").otherwise("approved").alias("status"))
    return snapshot.diff(now, path)


SNAPSHOT_BUCKETS_DIFF = """
WITH d AS (SELECT d.doc_id, l.doc_id IS NOT NULL AS stored, l.toxic = 1 AS changed FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 10 = 0 THEN 'removed' WHEN NOT stored THEN 'new' WHEN changed THEN 'updated' WHEN doc_id % 50 = 1 THEN 'moved' ELSE 'unchanged' END AS change
FROM d WHERE stored OR doc_id % 10 > 0"""

QUERIES["snapshot_buckets_diff"] = snapshot_buckets_diff
ORACLES["snapshot_buckets_diff"] = SNAPSHOT_BUCKETS_DIFF

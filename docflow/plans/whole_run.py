"""A whole run over the driver's tables: documents as the service's records and full texts, labels as the corpus, benchmark as open batches.

Everything that a run does happens: pages are parsed, records excluded in order, full texts fetched for survivors alone and converted,
drafts gated, compared with the corpus, ordered into batches and given free branch numbers. The texts keep letters and digits alone, so
that SQL can say what their Markdown is.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import udfs
from ..config import default_config
from ..functions import content_hash
from ..sources import big_xml
from ..storage import materialize, scratch_path
from . import ingest
from .records import table

NOW = datetime(2026, 1, 2, 3, 4, 5, tzinfo=UTC)
PAGE = 100
#: What a document's number makes of it: a value by the remainder.
TYPES = ("Review", "Practice Guideline", "Letter", "Meta-Analysis", "Randomized Controlled Trial")
TERMS = ("Potassium", "Kidney Transplantation", "Renal Insufficiency, Chronic", "Diet, Vegan", "Renal Dialysis", "Peritoneal Dialysis")
AGES = ("Adult", "Child", "Infant", "Aged")
LICENSES = ("licenses/by/4.0", "licenses/by-sa/3.0", "publicdomain/zero/1.0", "licenses/by-nc/4.0", "licenses/by/3.0")
LANGUAGES = {"en": "eng", "es": "ita", "fr": "fre"}
#: A table that would be too large for any memory: its document's conversion fails, and no other.
BOMB = '<table-wrap><table><tr><td colspan="1000000000">x</td></tr></table></table-wrap>'


def _pick(values: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


def _tag(name: str, *inner: Column | str) -> Column:
    return F.concat(F.lit(f"<{name}>"), *[F.lit(x) if isinstance(x, str) else x for x in inner], F.lit(f"</{name.split(' ')[0]}>"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n, id, lang, source, words) and what is known of each document."""
    # Found and joined: to replace what is between them takes eight times as long.
    words = F.array_join(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z0-9]+"), F.lit(0)), " ")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("n"), F.col("doc_id").cast("string").alias("id"), "lang", "source", words.alias("words"))
    return docs.join(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("n"), "quality", "toxic"), "n", "left")


def _record_pages(docs: DataFrame) -> DataFrame:
    n = F.col("n")
    date = F.concat(_tag("Year", (2000 + n % 25).cast("string")), F.when(n % 3 > 0, _tag("Month", (n % 12 + 1).cast("string"))).otherwise(""), F.when(n % 3 == 2, _tag("Day", (n % 28 + 1).cast("string"))).otherwise(""))
    language = F.coalesce(F.create_map(*[F.lit(x) for pair in LANGUAGES.items() for x in pair])[F.col("lang")], F.lit("xxx"))
    retracted = F.when(F.col("toxic") == 1, _tag("PublicationType", "Retracted Publication")).otherwise("")
    heading = lambda term: _tag("MeshHeading", _tag("DescriptorName", term))
    article = _tag(
        "Article", _tag("Journal", _tag("JournalIssue", _tag("PubDate", date)), _tag("Title", F.coalesce("source", F.lit("")))), _tag("ArticleTitle", "Title ", F.col("id"), "."), _tag("Language", language),
        _tag("PublicationTypeList", _tag("PublicationType", _pick(TYPES, n)), retracted),
    )
    mesh = _tag("MeshHeadingList", heading(_pick(TERMS, n)), heading(_pick(TERMS, F.floor(n / 7))), heading(_pick(AGES, F.floor(n / 5))))
    ids = _tag("ArticleIdList", F.when(n % 17 > 0, _tag('ArticleId IdType="pmc"', "PMC", F.col("id"))).otherwise(""))
    record = _tag("PubmedArticle", _tag("MedlineCitation", _tag("PMID", F.col("id")), article, mesh), _tag("PubmedData", ids))
    rows = docs.select(F.floor(n / PAGE).cast("long").alias("page"), F.struct(n, record.alias("record")).alias("r"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["record"]), "")
    return rows.groupBy("page").agg(_tag("PubmedArticleSet", listed).cast("binary").alias("xml"))


def _article_pages(docs: DataFrame) -> ingest.Fetch:
    n = F.col("n")
    license_tag = F.concat(F.lit("<license xlink:href='https://creativecommons.org/"), _pick(LICENSES, n), F.lit("/'/>"))
    front = _tag("front", _tag("article-meta", _tag("article-id pub-id-type='pmc'", F.col("id")), _tag("permissions", license_tag)))
    body = _tag("body", F.when(F.col("words") != "", _tag("p", F.col("words"))).otherwise(""), F.when(n % 19 == 0, BOMB).otherwise(""))
    articles = docs.where(n % 13 > 0).select(F.concat(F.lit("PMC"), "id").alias("pmcid"), n.alias("page"), _tag("article xmlns:xlink='http://www.w3.org/1999/xlink'", front, body).cast("binary").alias("xml"))

    def fetch(survivors: DataFrame) -> DataFrame:
        return articles.join(survivors.select("pmcid").distinct(), "pmcid").select("page", "xml")

    return fetch


def _corpus(docs: DataFrame) -> DataFrame:
    """Labelled documents: poor ones are rejected, of the others every third is stored, some with another body, some damaged."""
    n = F.col("n")
    body = F.concat(F.lit("# Title "), "id", F.lit("\n\n## Abstract\n\n## Main text\n\n"), "words", F.lit("\n"))
    front = F.struct(F.when(n % 5 == 0, "rejected").otherwise("approved").alias("curation_status"), content_hash(F.when(n % 2 == 0, body).otherwise("other")).alias("content_hash"), F.lit("kept").alias("review_notes"))
    ident = F.concat(F.lit("pmid-"), "id")
    stored = docs.where((F.col("quality") == 0) | (n % 3 == 0) & F.col("quality").isNotNull())
    folder = F.when(F.col("quality") == 0, "rejected").otherwise("corpus")
    return stored.select(F.concat(folder, F.lit("/"), ident, F.lit(".md")).alias("path"), folder.alias("folder"), F.lit(False).alias("nested"), ident.alias("id"), front.alias("front_matter"), F.when(n % 11 == 0, "damaged").alias("error"))


def ingest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each record, and of changes their front matter, rank and branch; rank 0 is none."""
    docs = materialize(_documents(spark, sf_dir), "run_documents")
    benchmark = table(spark, sf_dir, "benchmark").select("item_id").distinct()
    opened = benchmark.select(F.concat(F.lit("pmid-"), F.col("item_id").cast("string")).alias("id"))
    taken = materialize(benchmark.where("item_id % 3 = 1").select(F.col("item_id").cast("long").alias("number")), "taken")
    run = ingest.process(spark, default_config(), _record_pages(docs), _article_pages(docs), _corpus(docs), opened, taken, NOW)
    late = run.prepared.select("pmid", "outcome", F.array_join("reasons", ",").alias("reasons"), "front_matter", F.col("error").isNotNull().alias("failed"))
    placed = run.batches.select("pmid", "rank", "batch").join(run.branches, "batch").select("pmid", "rank", "branch")
    front, changed = F.col("front_matter"), F.col("outcome").isin("new", "updated")
    return run.records.select("pmid", "reason").join(late, "pmid", "left").join(placed, "pmid", "left").select(
        "pmid", F.coalesce("outcome", "reason").alias("outcome"), F.coalesce("reasons", F.lit("")).alias("reasons"), F.coalesce("failed", F.lit(False)).alias("failed"),
        *[F.when(changed, front[c].cast("string")).alias(c) for c in ("title", "language", "doc_type", "classification_method", "evidence_tier", "population", "license", "published", "review_notes", "content_hash", "retrieved_at", "source_uri", "original_uri", "journal")],
        *[F.when(changed, F.array_join(front[c], ",")).alias(c) for c in ("modality", "topics", "mesh_terms")], F.coalesce("rank", F.lit(0)).alias("rank"), "branch",
    )


def _of(values: tuple[str, ...], number: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"[{listed}][CAST(({number}) % {len(values)} AS INT) + 1]"


_C = default_config()
INGEST_RUN = rf"""
WITH d AS (SELECT doc_id AS n, CAST(doc_id AS VARCHAR) AS id, lang, nullif(coalesce(source, ''), '') AS journal, trim(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9]+', ' ', 'g')) AS words, l.quality, l.toxic, b.item_id IS NOT NULL AS opened
  FROM documents LEFT JOIN labels l USING (doc_id) LEFT JOIN (SELECT DISTINCT item_id FROM benchmark) b ON b.item_id = doc_id),
e AS (SELECT *, '# Title ' || id || chr(10) || chr(10) || '## Abstract' || chr(10) || chr(10) || '## Main text' || chr(10) || chr(10) || words || chr(10) AS body, coalesce(quality <> 0 AND n % 3 = 0, false) AS stored,
    CASE lang WHEN 'en' THEN 'en' WHEN 'es' THEN 'it' WHEN 'fr' THEN 'fr' END AS language,
    CASE n % 5 WHEN 0 THEN 'CC-BY-4.0' WHEN 1 THEN 'CC-BY-SA-3.0' WHEN 2 THEN 'CC0-1.0' WHEN 3 THEN 'CC-BY-NC-4.0' ELSE 'CC-BY-3.0' END AS license,
    {_of(TYPES, 'n')} AS kind, {_of(TERMS, 'n')} AS t1, {_of(TERMS, 'n // 7')} AS t2, {_of(AGES, 'n // 5')} AS age FROM d),
r AS (SELECT *, CASE WHEN toxic = 1 THEN 'retracted' WHEN quality = 0 THEN 'rejected_in_corpus' WHEN stored AND n % 5 = 0 THEN 'rejected_in_corpus' WHEN stored AND n % 11 = 0 THEN 'error_read_corpus' WHEN opened THEN 'in_open_pr'
    WHEN n % 17 = 0 THEN 'no_pmcid' WHEN n % 13 = 0 OR (words = '' AND n % 19 > 0) THEN 'no_open_access_fulltext' WHEN n % 19 = 0 THEN 'error' END AS reason,
    concat_ws(',', CASE WHEN language IS NULL THEN 'language_missing' WHEN language = 'fr' THEN 'language_not_allowed' END, CASE WHEN license = 'CC-BY-NC-4.0' THEN 'license_not_allowed' END,
      CASE WHEN length(body) < {_C.quality.min_body_chars} THEN 'body_too_short' END) AS gate FROM e),
o AS (SELECT *, CASE WHEN reason IS NOT NULL THEN reason WHEN gate <> '' THEN 'quality' WHEN stored AND n % 2 = 0 THEN 'unchanged' WHEN stored THEN 'updated' ELSE 'new' END AS outcome,
    CASE WHEN kind = 'Practice Guideline' THEN 'guideline' WHEN kind = 'Meta-Analysis' THEN 'meta_analysis' WHEN kind = 'Randomized Controlled Trial' THEN 'rct' WHEN kind = 'Review' THEN 'narrative_review' ELSE 'other' END AS doc_type,
    CASE kind WHEN 'Practice Guideline' THEN 1 WHEN 'Meta-Analysis' THEN 1 WHEN 'Randomized Controlled Trial' THEN 2 WHEN 'Review' THEN 4 ELSE 5 END AS tier FROM r),
k AS (SELECT *, outcome IN ('new', 'updated') AS changed, CASE WHEN outcome IN ('new', 'updated') THEN row_number() OVER (PARTITION BY outcome IN ('new', 'updated') ORDER BY tier, id) ELSE 0 END AS rank FROM o),
free AS (SELECT g.number, row_number() OVER (ORDER BY g.number) AS batch FROM (SELECT unnest(range(1, (SELECT count(*) FROM documents) + (SELECT count(DISTINCT item_id) FROM benchmark) + 1)) AS number) g
  ANTI JOIN (SELECT DISTINCT item_id AS number FROM benchmark WHERE item_id % 3 = 1) t USING (number))
SELECT id AS pmid, outcome, CASE WHEN outcome = 'quality' THEN gate ELSE '' END AS reasons, outcome = 'error' AS failed,
  CASE WHEN changed THEN 'Title ' || id END AS title, CASE WHEN changed THEN language END AS language, CASE WHEN changed THEN doc_type END AS doc_type, CASE WHEN changed THEN CASE doc_type WHEN 'other' THEN 'rule' ELSE 'source' END END AS classification_method,
  CASE WHEN changed THEN CAST(tier AS VARCHAR) END AS evidence_tier, CASE WHEN changed THEN CASE WHEN age IN ('Adult', 'Aged') THEN 'adult' ELSE 'pediatric' END END AS population, CASE WHEN changed THEN license END AS license,
  CASE WHEN changed THEN CAST(2000 + n % 25 AS VARCHAR) || CASE WHEN n % 3 > 0 THEN '-' || lpad(CAST(n % 12 + 1 AS VARCHAR), 2, '0') ELSE '' END || CASE WHEN n % 3 = 2 THEN '-' || lpad(CAST(n % 28 + 1 AS VARCHAR), 2, '0') ELSE '' END END AS published,
  CASE WHEN changed AND stored THEN 'kept' END AS review_notes, CASE WHEN changed THEN 'sha256:' || sha256(body) END AS content_hash, CASE WHEN changed THEN '2026-01-02T03:04:05Z' END AS retrieved_at,
  CASE WHEN changed THEN 'https://pmc.ncbi.nlm.nih.gov/articles/PMC' || id || '/' END AS source_uri, CASE WHEN changed THEN 'file://originals/pmid-' || id || '.xml' END AS original_uri, CASE WHEN changed THEN journal END AS journal,
  CASE WHEN changed THEN coalesce(nullif(concat_ws(',', CASE WHEN 'Peritoneal Dialysis' IN (t1, t2) THEN 'peritoneal_dialysis' END,
    CASE WHEN 'Renal Insufficiency, Chronic' IN (t1, t2) AND 'Renal Dialysis' NOT IN (t1, t2) AND 'Peritoneal Dialysis' NOT IN (t1, t2) THEN 'ckd_non_dialysis' END, CASE WHEN 'Kidney Transplantation' IN (t1, t2) THEN 'transplant' END), ''), 'unspecified') END AS modality,
  CASE WHEN changed THEN concat_ws(',', CASE WHEN 'Potassium' IN (t1, t2) THEN 'potassium' END, CASE WHEN 'Diet, Vegan' IN (t1, t2) THEN 'dietary_patterns' END) END AS topics,
  CASE WHEN changed THEN CASE WHEN t1 = t2 THEN t1 ELSE t1 || ',' || t2 END || ',' || age END AS mesh_terms, rank,
  CASE WHEN changed THEN 'ingest/2026-01-02-pubmed-' || f.number END AS branch
FROM k LEFT JOIN free f ON changed AND f.batch = (rank - 1) // {_C.corpus.max_pr_size} + 1"""

QUERIES = {"ingest_run": ingest_run}
ORACLES = {"ingest_run": INGEST_RUN}


def incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run over pages that arrive as files, three at a time: what became of each record, and the texts in batches."""
    from ..streaming import arrivals  # which needs this package's plans

    docs = materialize(_documents(spark, sf_dir), "run_documents")
    opened = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("pmid-"), F.col("item_id").cast("string")).alias("id")).distinct()
    source, out = scratch_path(spark, "arriving"), scratch_path(spark, "arrived_runs")
    _record_pages(docs).repartitionByRange(9, "page").write.parquet(source)
    pages = spark.readStream.schema("page long, xml binary").option("maxFilesPerTrigger", 3).parquet(source)
    # Without documents in other open batches: arrivals know of the batches that arrivals have made.
    corpus = materialize(_corpus(docs).join(opened, "id", "left_anti"), "run_corpus")  # each epoch reads it
    arrivals.ingest_arrivals(pages, default_config(), corpus, _article_pages(docs), out, f"{out}/checkpoint", NOW)
    texts = arrivals.batches(spark, out).select(F.substring("id", 6, 1 << 20).alias("pmid"), F.col("front_matter.content_hash").alias("content_hash"), F.col("front_matter.doc_type").alias("doc_type"))
    rows = arrivals.outcomes(spark, out).select("pmid", "outcome", F.array_join("reasons", ",").alias("reasons"))
    return rows.join(texts, "pmid", "left").join(opened.select(F.substring("id", 6, 1 << 20).alias("pmid")), "pmid", "left_anti")


INCREMENTAL_RUN = f"""
SELECT pmid, outcome, reasons, content_hash, doc_type FROM ({INGEST_RUN}) WHERE CAST(pmid AS BIGINT) NOT IN (SELECT item_id FROM benchmark WHERE item_id IS NOT NULL)"""

QUERIES["incremental_run"] = incremental_run
ORACLES["incremental_run"] = INCREMENTAL_RUN


def large_xml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as large XML files of records, some with end tags in comments and sections, read in ranges of bytes and parsed."""
    n = F.col("n")
    docs = _documents(spark, sf_dir)
    odd = F.when(n % 3 == 0, "<!-- </PubmedArticle> <PubmedArticle> -->").when(n % 3 == 1, "<![CDATA[ </PubmedArticle> <!-- ]]>").otherwise("")
    record = _tag("PubmedArticle", odd, _tag("MedlineCitation", _tag("PMID", F.col("id")), _tag("Article", _tag("Journal", _tag("Title", F.coalesce("source", F.lit("")))), _tag("ArticleTitle", F.col("words")))))
    files = 4
    rows = docs.select(F.pmod(n, F.lit(files)).alias("file"), n.alias("at"), record.alias("value"))
    ends = [spark.range(files).select(F.col("id").alias("file"), F.lit(at).cast("long").alias("at"), F.lit(text).alias("value")) for at, text in ((-(1 << 62), '<?xml version="1.0"?><PubmedArticleSet>'), (1 << 62, "</PubmedArticleSet>"))]
    path = scratch_path(spark, "large_xml")
    rows.unionByName(ends[0]).unionByName(ends[1]).repartition(files, "file").sortWithinPartitions("file", "at").select("file", "value").write.partitionBy("file").text(path)
    found = udfs.parse_records(big_xml.read_records(spark, path))
    return found.select("pmid", F.sha2("title", 256).alias("title_sha256"), "journal")


LARGE_XML_RECORDS = """
SELECT CAST(doc_id AS VARCHAR) AS pmid, sha256(trim(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9]+', ' ', 'g'))) AS title_sha256, nullif(source, '') AS journal FROM documents"""

QUERIES["large_xml_records"] = large_xml_records
ORACLES["large_xml_records"] = LARGE_XML_RECORDS

"""Queries on scalar functions: classification, dates, titles, Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions, udfs
from ..config import LANGUAGES, default_config
from ..markup.fixed import GONE
from ..operators import vocabulary
from .records import table

#: Vocabulary terms that documents carry in these queries, by language, source and label.
BY_LANG = {"en": ("Guideline", "Renal Dialysis"), "fr": ("review", "Peritoneal Dialysis"), "es": ("Systematic Review", "Child"), "de": ("Letter", "Kidney Transplantation")}
BY_SOURCE = {
    "src0": ("Meta-Analysis", "Potassium"), "src1": ("Observational Study", "Hemodiafiltration"), "src2": ("Randomized Controlled Trial", "renal insufficiency, chronic"), "src3": ("Journal Article", "Adult"),
    "src4": ("Practice Guideline", "Diet, Vegan"), "src5": ("Patient Education Handout", "Aged, 80 and over"), "src6": ("Editorial", "Malnutrition"), "src7": ("Consensus Development Conference", "Infant, Newborn"),
}
BY_TOXIC = {"0": ("Comment", "Thirst"), "1": ("Retracted Publication", "Adolescent")}


def _map(pairs: dict[str, tuple[str, str]], key: Column, which: int) -> Column:
    return F.create_map(*[F.lit(x) for k, v in pairs.items() for x in (k, v[which])])[key]


def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")

    def terms(which: int) -> Column:
        return F.array_compact(F.array(_map(BY_SOURCE, F.col("source"), which), _map(BY_LANG, F.col("lang"), which), _map(BY_TOXIC, F.col("toxic").cast("string"), which)))

    return docs.select("doc_id", "lang", terms(0).alias("types"), terms(1).alias("terms"))


def _case(column: str, pairs: dict[str, tuple[str, str]], which: int) -> str:
    return f"CASE {column} " + " ".join("WHEN '{}' THEN '{}'".format(k, v[which]) for k, v in pairs.items()) + " END"


def _terms_sql(which: int) -> str:
    return f"list_filter([lower({_case('source', BY_SOURCE, which)}), lower({_case('lang', BY_LANG, which)}), lower({_case('toxic::VARCHAR', BY_TOXIC, which)})], lambda x: x IS NOT NULL)"


_DESCRIBED_SQL = f"WITH t AS (SELECT d.doc_id, d.lang, {_terms_sql(0)} AS types, {_terms_sql(1)} AS terms FROM documents d LEFT JOIN labels l USING (doc_id))"
_MAPPING = default_config().mapping
_TYPE_SQL = "CASE " + " ".join(f"WHEN list_contains(types, '{r.publication_type.lower()}') THEN '{r.doc_type}'" for r in _MAPPING.publication_type_doc_type) + " ELSE 'other' END"
_ANY_TYPE = " OR ".join(f"list_contains(types, '{r.publication_type.lower()}')" for r in _MAPPING.publication_type_doc_type)


def _has_sql(words: list[str]) -> str:
    return "list_has_any(terms, [" + ", ".join(f"'{w.lower()}'" for w in words) + "])"


def doc_type_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return described(spark, sf_dir).select("doc_id", functions.doc_type(F.col("types"), _MAPPING).alias("d")).select("doc_id", "d.doc_type", "d.method")


DOC_TYPE_PRIORITY = f"{_DESCRIBED_SQL} SELECT doc_id, {_TYPE_SQL} AS doc_type, CASE WHEN {_ANY_TYPE} THEN 'source' ELSE 'rule' END AS method FROM t"


def evidence_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = described(spark, sf_dir).select("doc_id", functions.doc_type(F.col("types"), _MAPPING)["doc_type"].alias("doc_type"))
    return rows.groupBy(functions.evidence_tier(F.col("doc_type"), _MAPPING).alias("tier"), "doc_type").agg(F.count("*").alias("n"))


_TIER_SQL = "CASE doc_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _MAPPING.evidence_tier.items()) + " END"
EVIDENCE_TIERS = f"{_DESCRIBED_SQL}, k AS (SELECT {_TYPE_SQL} AS doc_type FROM t) SELECT {_TIER_SQL}::INTEGER AS tier, doc_type, count(*)::BIGINT AS n FROM k GROUP BY doc_type"


def topic_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return described(spark, sf_dir).select("doc_id", F.array_join(functions.topics(F.col("terms"), _MAPPING), ",").alias("topics"))


TOPIC_LISTS = f"{_DESCRIBED_SQL} SELECT doc_id, concat_ws(',', " + ", ".join(f"CASE WHEN {_has_sql(w)} THEN '{t}' END" for t, w in _MAPPING.topics.items()) + ") AS topics FROM t"


def modality_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return described(spark, sf_dir).select("doc_id", F.array_join(functions.modality(F.col("terms"), _MAPPING), ",").alias("modality"))


def _modality_sql(kind: str) -> str:
    return _has_sql([k for k, v in _MAPPING.mesh_modality.items() if v == kind])


_DIALYSIS_SQL = f"({_has_sql(_MAPPING.dialysis_mesh_terms)} OR {_modality_sql('hemodialysis')} OR {_modality_sql('peritoneal_dialysis')})"
MODALITY_LISTS = f"""{_DESCRIBED_SQL}, m AS (SELECT doc_id, concat_ws(',', CASE WHEN {_modality_sql('hemodialysis')} THEN 'hemodialysis' END, CASE WHEN {_modality_sql('peritoneal_dialysis')} THEN 'peritoneal_dialysis' END,
  CASE WHEN {_modality_sql('ckd_non_dialysis')} AND NOT {_DIALYSIS_SQL} THEN 'ckd_non_dialysis' END, CASE WHEN {_modality_sql('transplant')} THEN 'transplant' END) AS modality FROM t)
SELECT doc_id, CASE WHEN modality = '' THEN 'unspecified' ELSE modality END AS modality FROM m"""


def populations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return described(spark, sf_dir).select("doc_id", functions.population(F.col("terms"), _MAPPING).alias("population"))


POPULATIONS = f"""{_DESCRIBED_SQL}, p AS (SELECT doc_id, {_has_sql(_MAPPING.population_pediatric_mesh)} AS young, {_has_sql(_MAPPING.population_adult_mesh)} AS grown FROM t)
SELECT doc_id, CASE WHEN young AND grown THEN 'mixed' WHEN young THEN 'pediatric' WHEN grown THEN 'adult' ELSE 'unspecified' END AS population FROM p"""

#: Codes that stand for a document's languages: unknown ones first, in either case.
CODES = {"en": "und,ENG,fre", "fr": "fre", "es": "xxx,zzz", "de": "Ger,eng"}


def language_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.split(F.create_map(*[F.lit(x) for p in CODES.items() for x in p])[F.col("lang")], ",")
    return table(spark, sf_dir, "documents").select("doc_id", functions.language(codes).alias("language"))


_CODE_SQL = "CASE lower(x) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANGUAGES.items()) + " END"
LANGUAGE_MAP = f"""
WITH c AS (SELECT doc_id, string_split(CASE lang {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in CODES.items())} END, ',') AS codes FROM documents)
SELECT doc_id, list_filter(list_transform(codes, lambda x: {_CODE_SQL}), lambda x: x IS NOT NULL)[1] AS language FROM c"""


def partial_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as publication dates: in full, without a day, as free text, with a month in digits, with a season."""
    kind, ts = F.col("event_type"), F.col("ts")
    year = F.when(kind != "error", F.date_format(ts, "yyyy"))
    month = F.when(kind == "click", F.date_format(ts, "M")).when(kind == "purchase", "Winter").when(kind != "error", F.upper(F.date_format(ts, "MMM")))
    day = F.when(kind.isin("view", "click", "purchase"), F.date_format(ts, "d"))
    free = F.when(kind == "error", F.concat(F.date_format(ts, "yyyy MMM"), F.lit("-Dec")))
    return table(spark, sf_dir, "events").select("event_id", functions.partial_date(year, month, day, free).alias("published"))


PARTIAL_DATES = """
SELECT event_id, strftime(ts, '%Y') || CASE WHEN event_type = 'purchase' THEN '' ELSE strftime(ts, '-%m') END || CASE WHEN event_type IN ('view', 'click') THEN strftime(ts, '-%d') ELSE '' END AS published FROM events"""


def title_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.get(F.split(F.coalesce("text", F.lit("")), "\n"), F.lit(0))
    given = F.when(F.col("lang") == "es", F.concat(F.lit(" ["), first, F.lit("]. "))).otherwise(first)
    return table(spark, sf_dir, "documents").select("doc_id", functions.clean_title(F.when(F.col("lang") == "de", first), given).alias("title"))


TITLE_CLEANUP = r"""
WITH f AS (SELECT doc_id, lang, string_split(coalesce(text, ''), chr(10))[1] AS first FROM documents),
s AS (SELECT doc_id, lang, first, regexp_replace(CASE WHEN lang = 'es' THEN ' [' || first || ']. ' ELSE first END, '^\s+|\s+$', '', 'g') AS bare FROM f),
u AS (SELECT doc_id, lang, first, CASE WHEN starts_with(bare, '[') AND ends_with(bare, '].') AND length(bare) >= 2 THEN substr(bare, 2, greatest(length(bare) - 3, 0)) ELSE bare END AS title FROM s)
SELECT doc_id, CASE WHEN lang = 'de' AND first <> '' THEN first ELSE regexp_replace(title, '\.$', '') END AS title FROM u"""


def markdown_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = udfs.escape_markdown(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.length(made).cast("long").alias("chars"), F.sha2(made, 256).alias("escaped_sha256"))


_ESCAPED_SQL = r"regexp_replace(regexp_replace(text, '([\\*_`])', '\\\1', 'g'), '<([A-Za-z/!?])', '&lt;\1', 'g')"
MARKDOWN_ESCAPE = f"SELECT doc_id, length({_ESCAPED_SQL})::BIGINT AS chars, sha256({_ESCAPED_SQL}) AS escaped_sha256 FROM documents"


def block_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    marks = F.element_at(F.array(*[F.lit(x) for x in ("", "1. ", "# ", "- ", "::: ", "2) ", "---", "> ")]), F.col("line_no") % 8 + 1)
    made = udfs.protect_block_start(F.concat(marks, "line"))
    return lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.sha2(made, 256).alias("line_sha256"), F.substring(made, 1, 4).alias("start"))


BLOCK_STARTS = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
m AS (SELECT doc_id, line_no, ['', '1. ', '# ', '- ', '::: ', '2) ', '---', '> '][line_no % 8 + 1] || line AS line FROM l),
g AS (SELECT doc_id, line_no, regexp_replace(regexp_replace(line, '^(\d+)([.)])(\s)', '\1\\\2\3'), '^(#{1,6}\s|[>+\-]\s|:::|---)', '\\\1') AS line FROM m)
SELECT doc_id, line_no::BIGINT AS line_no, sha256(line) AS line_sha256, substr(line, 1, 4) AS start FROM g"""


def citation_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commas and full stops in documents become removed citations, alone, in brackets and in series."""
    gone = GONE
    marked = F.replace(F.replace(F.col("text"), F.lit(", "), F.lit(f" ({gone}, {gone}) ")), F.lit(". "), F.lit(f" [{gone}; see {gone}–{gone}]. "))
    made = udfs.citation_cleanup(marked)
    return table(spark, sf_dir, "documents").select("doc_id", F.length(made).cast("long").alias("chars"), F.sha2(made, 256).alias("clean_sha256"))


CITATION_MARKS = """
WITH m AS (SELECT doc_id, replace(replace(text, ', ', ' (' || chr(57344) || ', ' || chr(57344) || ') '), '. ', ' [' || chr(57344) || '; see ' || chr(57344) || '–' || chr(57344) || ']. ') AS t FROM documents),
a AS (SELECT doc_id, regexp_replace(t, '\\s+', ' ', 'g') AS t FROM m), b AS (SELECT doc_id, regexp_replace(t, '@@(?:\\s*[,;–—-]?\\s*@@)+', '@@', 'g') AS t FROM a),
c AS (SELECT doc_id, regexp_replace(t, '\\s*[(\\[]\\s*@@\\s*[)\\]]', '', 'g') AS t FROM b), d AS (SELECT doc_id, regexp_replace(t, '([(\\[])\\s*@@\\s*[,;]\\s*', '\\1', 'g') AS t FROM c),
e AS (SELECT doc_id, regexp_replace(t, '[,;]\\s*@@\\s*([)\\]])', '\\1', 'g') AS t FROM d), f AS (SELECT doc_id, regexp_replace(t, '\\s*@@', '', 'g') AS t FROM e),
g AS (SELECT doc_id, regexp_replace(regexp_replace(t, '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS t FROM f)
SELECT doc_id, length(t)::BIGINT AS chars, sha256(t) AS clean_sha256 FROM g""".replace("@@", GONE)


def table_grid_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each region: its name spans its nations' rows, and a footer spans the columns."""
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    names = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x)
    grouped = nations.groupBy("r_regionkey", "r_name").agg(names.alias("nations"))
    first = F.concat(F.lit('<tr><td rowspan="'), F.size("nations").cast("string"), F.lit('">'), "r_name", F.lit("</td>"))
    rows = F.transform("nations", lambda x, i: F.concat(F.when(i == 0, first).otherwise("<tr>"), F.lit("<td>"), x["n_nationkey"].cast("string"), F.lit("</td><td>"), x["n_name"], F.lit("</td></tr>")))
    xml = F.concat(F.lit("<x><table><thead><tr><th>Region</th><th colspan='2'>Nation</th></tr></thead><tbody>"), F.array_join(rows, ""), F.lit("</tbody><tfoot><tr><td colspan='3'>end</td></tr></tfoot></table></x>"))
    return grouped.select("r_regionkey", udfs.table_to_markdown(xml).alias("markdown"))


TABLE_GRID = r"""
SELECT r_regionkey, '| Region | Nation | Nation |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || r_name || ' | ' || n_nationkey || ' | ' || replace(n_name, '_', '\_') || ' |', chr(10) ORDER BY n_nationkey)
  || chr(10) || '| end | end | end |' AS markdown FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_regionkey, r_name"""

LABELS = tuple(f"group {i}" for i in range(97))


def large_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by a vocabulary from a table: long words of benchmark's items, in groups of items."""
    words = lambda text: F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[a-z]{7,}"), 0)
    items = table(spark, sf_dir, "benchmark").select(F.explode(words(F.col("text"))).alias("term"), F.concat(F.lit("group "), (F.col("item_id") % len(LABELS)).cast("string")).alias("label"))
    docs = table(spark, sf_dir, "documents").select("doc_id", words(F.col("text")).alias("words"))
    return vocabulary.labels_of(docs, "doc_id", "words", vocabulary.of_table(items, LABELS)).select("doc_id", F.array_join("labels", ",").alias("labels"))


LARGE_VOCABULARY = f"""
WITH v AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[a-z]{{7,}}')) AS term, item_id % {len(LABELS)} AS no FROM benchmark),
d AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[a-z]{{7,}}')) AS term FROM documents),
f AS (SELECT DISTINCT d.doc_id, v.no FROM d JOIN v USING (term))
SELECT documents.doc_id, coalesce(string_agg('group ' || f.no, ',' ORDER BY f.no), '') AS labels FROM documents LEFT JOIN f USING (doc_id) GROUP BY documents.doc_id"""

QUERIES = {
    "large_vocabulary": large_vocabulary, "doc_type_priority": doc_type_priority, "evidence_tier": evidence_tiers, "topics": topic_lists, "modality": modality_lists, "population": populations, "language_map": language_map, "partial_date": partial_dates,
    "title_cleanup": title_cleanup, "markdown_escape": markdown_escape, "protect_block_start": block_starts, "citation_cleanup": citation_marks, "table_grid_expand": table_grid_expand,
}
ORACLES = {
    "large_vocabulary": LARGE_VOCABULARY, "doc_type_priority": DOC_TYPE_PRIORITY, "evidence_tier": EVIDENCE_TIERS, "topics": TOPIC_LISTS, "modality": MODALITY_LISTS, "population": POPULATIONS, "language_map": LANGUAGE_MAP, "partial_date": PARTIAL_DATES,
    "title_cleanup": TITLE_CLEANUP, "markdown_escape": MARKDOWN_ESCAPE, "protect_block_start": BLOCK_STARTS, "citation_cleanup": CITATION_MARKS, "table_grid_expand": TABLE_GRID,
}

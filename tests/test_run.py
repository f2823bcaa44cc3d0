"""A whole run over answers from files: first, again after its batches were taken, with a change, and rejections."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from docflow import frontmatter, udfs
from docflow.cli import main
from docflow.config import default_config
from docflow.operators import ranking, review, sinks, waterfall
from docflow.operators.validate import validate
from docflow.plans import ingest
from docflow.sources.corpus import read_corpus

NOW = datetime(2026, 1, 2, 3, 4, 5, tzinfo=UTC)


def record(pmid, pmcid, types=("Practice Guideline",), mesh=("Potassium", "Adult")):
    return (
        f"<PubmedArticle><MedlineCitation><PMID>{pmid}</PMID><Article><Journal><JournalIssue><PubDate><Year>2024</Year></PubDate></JournalIssue></Journal><ArticleTitle>Title {pmid}.</ArticleTitle>"
        f"<Language>eng</Language><PublicationTypeList>{''.join(f'<PublicationType>{t}</PublicationType>' for t in types)}</PublicationTypeList></Article>"
        f"<MeshHeadingList>{''.join(f'<MeshHeading><DescriptorName>{m}</DescriptorName></MeshHeading>' for m in mesh)}</MeshHeadingList></MedlineCitation>"
        f"<PubmedData><ArticleIdList>{f'<ArticleId IdType=\"pmc\">{pmcid}</ArticleId>' if pmcid else ''}</ArticleIdList></PubmedData></PubmedArticle>"
    )


def full_text(pmcid, words="word", body=True):
    text = f"<sec><title>Methods</title><p>{(words + ' ') * 400}</p></sec>" if body else ""
    return (
        f"<article xmlns:xlink='http://www.w3.org/1999/xlink'><front><article-meta><article-id pub-id-type='pmc'>{pmcid}</article-id><permissions><license xlink:href='https://creativecommons.org/licenses/by/4.0/'/>"
        f"</permissions></article-meta></front><body>{text}</body></article>"
    )


@pytest.fixture
def service(tmp_path):
    top = tmp_path / "service"
    (top / "articles").mkdir(parents=True)
    (top / "search.json").write_text(json.dumps({"esearchresult": {"count": "6", "idlist": ["1", "2", "3", "4", "5", "1"], "webenv": "w", "querykey": "1"}}))
    pages = {0: [record(1, "PMC1"), record(2, "PMC2", ["Review"])], 2: [record(3, "PMC3"), record(4, "PMC4", ["Retracted Publication"])], 4: [record(5, None), record(1, "PMC1")]}
    for start, rows in pages.items():
        (top / f"records-{start}.xml").write_text(f"<PubmedArticleSet>{''.join(rows)}</PubmedArticleSet>")
    for name, xml in (("PMC1", full_text("1")), ("PMC2", full_text("2")), ("PMC3", full_text("3", body=False)), ("PMC4", full_text("4"))):
        (top / "articles" / f"{name}.xml").write_text(xml)
    return top


def go(spark, service, corpus, opened=(), taken=(1, 3)):
    config = default_config().model_copy(deep=True)
    config.ncbi.batch_size, config.corpus.max_pr_size = 2, 1
    ids = spark.createDataFrame([(i,) for i in opened], "id string")
    return ingest.run(spark, config, read_corpus(spark, str(corpus)), ids, spark.createDataFrame([(n,) for n in taken], "number long"), NOW, folder=str(service))


def stats(run):
    r = run.statistics.first()
    return r["found"], dict(r["excluded"] or {}), r["new"], r["updated"], r["unchanged"], r["errors"]


@pytest.fixture
def corpus(tmp_path):
    for folder in ("corpus", "rejected"):
        (tmp_path / "c" / folder).mkdir(parents=True)
    return tmp_path / "c"


def accept(run, corpus):
    for row in run.changes.collect():
        (corpus / "corpus" / f"pmid-{row['pmid']}.md").write_text(row["text"], encoding="utf-8")


def test_runs(spark, service, corpus):
    first = go(spark, service, corpus)
    gate = first.prepared.select(F.explode("reasons").alias("reason")).select(F.concat(F.lit("quality:"), "reason").alias("reason"))
    reasons = first.records.where("reason is not null").select("reason").unionByName(gate).unionByName(first.prepared.where("outcome = 'no_open_access_fulltext'").select(F.col("outcome").alias("reason")))
    assert sinks.run_statistics(first.records.count(), reasons, first.prepared).first() == first.statistics.first()  # what was observed, counted again
    assert stats(first) == (5, {"no_open_access_fulltext": 1, "no_pmcid": 1, "retracted": 1}, 2, 0, 0, 0)
    rows = {r["pmid"]: r for r in first.batches.collect()}
    assert [(rows[p]["rank"], rows[p]["batch"]) for p in ("1", "2")] == [(1, 1), (2, 2)]
    assert sorted(r["branch"] for r in first.branches.collect()) == ["ingest/2026-01-02-pubmed-2", "ingest/2026-01-02-pubmed-4"]
    keys, body = frontmatter.read(rows["1"]["text"])
    assert list(keys)[:5] == ["schema_version", "id", "title", "source_type", "source_uri"] and keys["published"] == "2024" and keys["pmid"] == "1" and "doi" not in keys
    assert not list(frontmatter.problems(keys)) and body.startswith("# Title 1\n\n## Abstract\n\n## Methods")
    text = {r["batch"]: r["description"] for r in first.descriptions.collect()}[1]
    assert "| `pmid-1` | Title 1 | guideline | unspecified | potassium | new | [1](https://pubmed.ncbi.nlm.nih.gov/1/) |" in text

    accept(first, corpus)
    assert stats(go(spark, service, corpus))[2:] == (0, 0, 2, 0)

    (service / "articles" / "PMC2.xml").write_text(full_text("2", "other"))
    second = go(spark, service, corpus)
    assert stats(second)[2:] == (0, 1, 1, 0)

    (corpus / "rejected" / "pmid-2.md").write_text((corpus / "corpus" / "pmid-2.md").read_text())
    (corpus / "corpus" / "pmid-1.md").write_text("broken")
    assert stats(go(spark, service, corpus))[1:] == ({"error_read_corpus": 1, "no_open_access_fulltext": 1, "no_pmcid": 1, "rejected_in_corpus": 1, "retracted": 1}, 0, 0, 0, 1)
    assert stats(go(spark, service, corpus, opened=["pmid-1", "web-x"]))[1]["error_read_corpus"] == 1


def test_gate_and_conversion_errors(spark, service, corpus):
    (service / "articles" / "PMC1.xml").write_text(full_text("1", "w").replace("by/4.0", "by-nc/4.0").replace("w " * 400, "short"))
    run = go(spark, service, corpus)
    assert stats(run)[1] == {"no_open_access_fulltext": 1, "no_pmcid": 1, "quality:body_too_short": 1, "quality:license_not_allowed": 1, "retracted": 1}
    draft = spark.createDataFrame([(b"<article/>", "t")], "xml binary, title string").select(udfs.struct_of({"source_type": F.lit("pmc_fulltext"), "id": F.lit("pmid-1")}).alias("f"))
    assert "license: missing" in draft.select(udfs.contract_problems("f").alias("p")).first()["p"]
    bad = spark.createDataFrame([(b"<a>", "t")], "xml binary, title string").select(udfs.convert_article("xml", "title", F.lit(None).cast("array<struct<label:string,text:string>>")).alias("m")).first()["m"]
    assert bad["body"] is None and "well-formed" in bad["error"]


def test_review_and_validation(spark, service, corpus, tmp_path):
    accept(go(spark, service, corpus), corpus)
    docs = read_corpus(spark, str(corpus))
    assert {r["message"] for r in validate(docs).collect()} == {"curation_status must be approved"}
    approved = review.apply_decision(docs, "approve", ["all-pending"], None)
    assert validate(approved).count() == 0
    rejected = review.apply_decision(approved, "reject", ["pmid-2", "pmid-2"], " poor ")
    state = {r["id"]: (r["folder"], r["front_matter"]["curation_status"], r["front_matter"]["review_notes"]) for r in rejected.collect()}
    assert state == {"pmid-1": ("corpus", "approved", None), "pmid-2": ("rejected", "rejected", "poor")} and validate(rejected).count() == 0
    for decision, ids, notes in (("reject", ["pmid-1"], " "), ("reject", ["all-pending"], "x"), ("approve", ["1"], None), ("approve", [], None), ("approve", ["pmid-9"], None), ("maybe", ["pmid-1"], None), ("reject", ["pmid-2"], "x")):
        with pytest.raises(ValueError):
            review.apply_decision(rejected, decision, ids, notes)
    (corpus / "corpus" / "sub").mkdir()
    (corpus / "corpus" / "sub" / "pmid-3.md").write_text("x")
    (corpus / "rejected" / "pmid-1.md").write_text((corpus / "corpus" / "pmid-1.md").read_text().replace("\n", "\r\n"))
    (corpus / "corpus" / "Bad.md").write_text("x")
    messages = sorted((r["path"], r["message"]) for r in validate(read_corpus(spark, str(corpus))).collect())
    assert ("corpus/sub/pmid-3.md", "file in a folder below") in messages and ("corpus/Bad.md", "file name is not an id") in messages
    assert ("rejected/pmid-1.md", "id is there already") in messages and ("rejected/pmid-1.md", "rejected without review_notes") in messages


def test_command_line(spark, service, corpus, tmp_path, capsys):
    schema = tmp_path / "schema.json"
    assert main(["schema", "--output", str(schema)]) == 0 and main(["schema", "--output", str(schema), "--check"]) == 0
    schema.write_text("{}")
    assert main(["schema", "--output", str(schema), "--check"]) == 1
    accept(go(spark, service, corpus), corpus)
    assert main(["validate", "--corpus", str(corpus)]) == 1 and "2 errors" in capsys.readouterr().out
    assert main(["review", "--corpus", str(corpus), "--out", str(tmp_path / "new"), "--decision", "approve", "--ids", "pmid-1, pmid-2"]) == 0
    assert spark.read.parquet(str(tmp_path / "new")).where("text like '%curation_status: approved%'").count() == 2
    assert main(["review", "--corpus", str(corpus), "--out", str(tmp_path / "x"), "--decision", "reject", "--ids", "pmid-1"]) == 1


def test_sinks(spark, service, corpus, tmp_path):
    run = go(spark, service, corpus)
    read = lambda: sorted((r["branch"], r["file"]) for r in spark.read.parquet(str(tmp_path / "b")).collect())
    for _ in range(2):  # a second time, as if the first one's end had not been heard of
        sinks.write_batches(run.batches, str(tmp_path / "b"), run.branches)
        sinks.write_originals(run.batches, str(tmp_path / "o"), run.branches)
        sinks.write_change_sets(run.branches, run.descriptions, str(tmp_path / "c"))
        assert read() == [("ingest/2026-01-02-pubmed-2", "corpus/pmid-1.md"), ("ingest/2026-01-02-pubmed-4", "corpus/pmid-2.md")]
        originals = spark.read.parquet(str(tmp_path / "o")).collect()
        assert sorted(r["file"] for r in originals) == ["pmid-1.xml", "pmid-2.xml"] and all(b"<article" in r["xml"] for r in originals)
        sets = {r["branch"]: r for r in spark.read.json(str(tmp_path / "c")).collect()}
        assert sets["ingest/2026-01-02-pubmed-4"]["title"] == "Ingestion PubMed 2026-01-02 #4: 1 documenti" and "`pmid-2`" in sets["ingest/2026-01-02-pubmed-4"]["description"]
    other = run.branches.withColumn("branch", F.concat("branch", F.lit("9")))
    sinks.write_batches(run.batches.where("batch = 1"), str(tmp_path / "b"), other)
    assert len(read()) == 3
    failing = run.batches.withColumn("text", F.when(F.col("batch") == 2, F.raise_error(F.lit("lost"))).otherwise(F.lit("changed")))
    before = sorted(map(str, spark.read.parquet(str(tmp_path / "b")).collect()))
    with pytest.raises(Exception, match="lost"):
        sinks.write_batches(failing, str(tmp_path / "b"), run.branches)
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "b")).collect())) == before


def test_ranking(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", None, "z")], "k string, o int, v string")
    assert sorted(map(tuple, ranking.first_seen(rows, ["k"], ["o"]).collect())) == [("a", 1, "y"), ("b", None, "z")]
    assert sorted(map(tuple, ranking.last_seen(rows, ["k"], ["o"]).collect())) == [("a", 2, "x"), ("b", None, "z")]
    ranked = ranking.global_rank(spark.range(1000).select((F.col("id") % 7).alias("g"), "id"), ["g", "id"]).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 1001)) and [(r["g"], r["id"]) for r in ranked] == sorted((i % 7, i) for i in range(1000))
    assert ranking.global_rank(spark.range(0).select("id"), ["id"]).count() == 0
    taken = spark.createDataFrame([(1,), (2,), (4,), (4,)], "number long")
    assert [r["number"] for r in ranking.free_numbers(spark, 3, taken, 4).orderBy("batch").collect()] == [3, 5, 6]


def test_drafts_that_break_the_contract_do_not_pass(spark, service, corpus):
    (service / "articles" / "PMC1.xml").write_text(full_text("1"))
    (service / "records-0.xml").write_text(f"<PubmedArticleSet>{record('1', 'PMC1')}{record('2', 'X2')}</PubmedArticleSet>".replace("X2", "PMC2"))
    config = default_config().model_copy(deep=True)
    config.ncbi.batch_size, config.mapping.evidence_tier = 2, {**config.mapping.evidence_tier, "guideline": 9}
    run = ingest.run(spark, config, read_corpus(spark, str(corpus)), spark.createDataFrame([], "id string"), spark.createDataFrame([], "number long"), NOW, folder=str(service))
    assert stats(run)[1]["quality:schema_invalid"] == 2 and stats(run)[2] == 0


def test_comments(spark, service, corpus, tmp_path, capsys):
    accept(go(spark, service, corpus), corpus)
    docs = read_corpus(spark, str(corpus))
    said = [
        (1, "/approve", "pmid-1", "NONE"), (2, "/approve", "pmid-1", "OWNER"), (3, " /Approve", "pmid-1", "MEMBER"), (4, "/reject", "pmid-1", "OWNER"), (5, "/reject poor", "pmid-1", "COLLABORATOR"), (6, "/approve", "pmid-1", "OWNER"),
        (7, "/reject again", "pmid-1", "OWNER"), (8, "a question", "pmid-1", "OWNER"), (9, "/approve", "pmid-99", "OWNER"), (10, "/approve", "pmid-2", "OWNER"),
    ]
    comments = spark.createDataFrame([(i, b, f"corpus/{p}.md", a) for i, b, p, a in said] + [(11, "/approve", "README.md", "OWNER"), (12, "/approve", "corpus/pmid-2.md", None)], "id long, body string, path string, author_association string")
    results, decided = review.answer_comments(docs, comments)
    got = {r["id"]: (r["ok"], r["changed"], r["reply"]) for r in results.collect()}
    refused = (False, False, "only owners, members and collaborators may decide")
    assert got == {
        1: refused, 2: (True, True, "approved"), 3: (True, False, None), 4: (False, False, "a rejection needs notes"), 5: (True, True, "rejected"), 6: (False, False, "the document is rejected already"), 7: (True, False, None),
        9: (False, False, "the document is not in the corpus"), 10: (True, True, "approved"), 11: (False, False, "not on a document of the corpus"), 12: refused,
    }
    assert {r["id"]: (r["folder"], r["front_matter"]["curation_status"], r["front_matter"]["review_notes"]) for r in decided.collect()} == {"pmid-1": ("rejected", "rejected", "poor"), "pmid-2": ("corpus", "approved", None)}
    pull = {"number": 1, "head": {"ref": "ingest/x", "repo": {"full_name": "o/r"}}}
    event = tmp_path / "event.json"
    for body, code in (("/approve", 0), ("/reject", 1)):
        event.write_text(json.dumps({"pull_request": pull, "comment": {"id": 5, "body": body, "path": "corpus/pmid-1.md", "author_association": "OWNER"}}))
        assert main(["comment", "--corpus", str(corpus), "--out", str(tmp_path / "decided"), "--event", str(event), "--name", "pull_request_review_comment", "--repo", "o/r"]) == code
        assert json.loads(capsys.readouterr().out)[0]["ok"] == (code == 0)
    assert spark.read.parquet(str(tmp_path / "decided")).where("text like '%curation_status: approved%'").count() == 1


def test_second_run_leaves_open_batches_alone(spark, service, corpus, tmp_path, capsys):
    out = []
    for _ in range(2):
        assert main(["run", "--corpus", str(corpus), "--out", str(tmp_path / "out"), "--folder", str(service)]) == 0
        out.append(json.loads(capsys.readouterr().out.strip().splitlines()[-1]))
    assert out[0]["new"] == 2 and out[1]["new"] == 0 and out[1]["excluded"]["in_open_pr"] == 2


def test_damaged_nested_and_repeated_files(spark, service, corpus):
    accept(go(spark, service, corpus), corpus)
    kept = (corpus / "corpus" / "pmid-1.md").read_bytes()
    (corpus / "corpus" / "pmid-2.md").write_bytes(kept + b"\xff\xfe\xff")
    (corpus / "corpus" / "sub").mkdir()
    (corpus / "corpus" / "sub" / "pmid-1.md").write_bytes(kept)
    documents = read_corpus(spark, str(corpus))
    assert {(r["path"], r["error"]) for r in documents.collect()} == {("corpus/pmid-1.md", None), ("corpus/pmid-2.md", "not UTF-8"), ("corpus/sub/pmid-1.md", None)}
    assert stats(go(spark, service, corpus)) == (5, {"error_read_corpus": 1, "no_open_access_fulltext": 1, "no_pmcid": 1, "retracted": 1}, 0, 0, 1, 1)
    state = spark.createDataFrame([("pmid-1", "approved", "h", None, None), ("pmid-1", "pending", "h", None, "unreadable")], "id string, status string, content_hash string, review_notes string, error string")
    none = spark.createDataFrame([], "id string")
    flagged = waterfall.with_state(spark.createDataFrame([("1",)], "pmid string"), state, none, none).collect()
    assert [(r["stored_status"], r["stored_error"]) for r in flagged] == [("approved", None)]

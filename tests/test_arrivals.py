"""Three arrivals, one of them run again, against one run over all pages."""

from datetime import UTC, datetime

import pytest

from docflow.config import default_config
from docflow.plans import ingest
from docflow.streaming import arrivals

NOW = datetime(2026, 1, 2, tzinfo=UTC)


def record(pmid, kind="Practice Guideline", pmc=True):
    ids = f'<ArticleId IdType="pmc">PMC{pmid}</ArticleId>' if pmc else ""
    return (
        f"<PubmedArticle><MedlineCitation><PMID>{pmid}</PMID><Article><ArticleTitle>T{pmid}</ArticleTitle><Language>eng</Language><PublicationTypeList><PublicationType>{kind}</PublicationType></PublicationTypeList></Article>"
        f"</MedlineCitation><PubmedData><ArticleIdList>{ids}</ArticleIdList></PubmedData></PubmedArticle>"
    )


def article(pmid):
    meta = f"<article-id pub-id-type='pmc'>{pmid}</article-id><permissions><license xlink:href='https://creativecommons.org/licenses/by/4.0/'/></permissions>"
    return f"<article xmlns:xlink='http://www.w3.org/1999/xlink'><front><article-meta>{meta}</article-meta></front><body><p>{f'word{pmid} ' * 400}</p></body></article>"


PAGES = [[record(i, "Review" if i % 3 else "Practice Guideline", i % 5 > 0) for i in range(a, a + 6)] for a in (1, 7, 13)]
PAGES[1].append(record(2))  # a record of the first page comes again
CORPUS = "path string, folder string, nested boolean, id string, front_matter struct<curation_status:string,content_hash:string,review_notes:string>, error string"


@pytest.fixture
def parts(spark, tmp_path):
    config = default_config().model_copy(deep=True)
    config.corpus.max_pr_size = 2
    articles = spark.createDataFrame([(f"PMC{i}", i, article(i).encode()) for i in range(1, 19) if i != 8], "pmcid string, page long, xml binary")
    fetch = lambda survivors: articles.join(survivors.select("pmcid").distinct(), "pmcid").select("page", "xml")
    corpus = spark.createDataFrame([("rejected/pmid-4.md", "rejected", False, "pmid-4", None, None)], CORPUS)
    return config, corpus, fetch, tmp_path


def arrive(spark, top, k):
    frame = spark.createDataFrame([(k, f"<PubmedArticleSet>{''.join(PAGES[k])}</PubmedArticleSet>".encode())], "page long, xml binary")
    frame.coalesce(1).write.mode("append").parquet(str(top / "pages"))


def go(spark, parts):
    config, corpus, fetch, top = parts
    pages = spark.readStream.schema("page long, xml binary").parquet(str(top / "pages"))
    arrivals.ingest_arrivals(pages, config, corpus, fetch, str(top / "out"), str(top / "check"), NOW)
    rows = {(r["epoch"], r["pmid"], r["outcome"], tuple(r["reasons"])) for r in arrivals.outcomes(spark, str(top / "out")).collect()}
    return rows, sorted(map(str, arrivals.batches(spark, str(top / "out")).collect())), arrivals.statistics(spark, str(top / "out")).first().asDict()


def test_arrivals_equal_one_run(spark, parts):
    config, corpus, fetch, top = parts
    for k in range(3):
        arrive(spark, top, k)
        rows, batches, counts = go(spark, parts)
    for name in ("2", ".2.crc"):  # the last epoch's end has been lost
        (top / "check" / "commits" / name).unlink(missing_ok=True)
    assert go(spark, parts) == (rows, batches, counts)
    assert go(spark, parts) == (rows, batches, counts)  # nothing new

    pages = spark.createDataFrame([(k, f"<PubmedArticleSet>{''.join(p)}</PubmedArticleSet>".encode()) for k, p in enumerate(PAGES)], "page long, xml binary")
    none = spark.createDataFrame([], "id string"), spark.createDataFrame([], "number long")
    whole = ingest.process(spark, config, pages, fetch, corpus, *none, NOW)
    late = {r["pmid"]: r["outcome"] for r in whole.prepared.collect()}
    want = {(r["pmid"], r["reason"] or late[r["pmid"]]) for r in whole.records.collect()}
    assert {(p, o) for _, p, o, _ in rows} == want | {("2", "in_open_pr")}
    texts = {r["front_matter"]["id"]: r["text"] for r in whole.batches.collect()}
    got = arrivals.batches(spark, str(top / "out")).collect()
    assert {r["id"]: r["text"] for r in got} == texts and len(got) == len(texts) > 8
    numbers = {r["branch"]: set() for r in got}
    for r in got:
        numbers[r["branch"]].add((r["epoch"], r["number"]))
    assert all(len(x) == 1 for x in numbers.values()) and len(numbers) == len({r["number"] for r in got})
    one = whole.statistics.first().asDict()
    assert counts["found"] == one["found"] + 1 and counts["new"] == one["new"] and counts["errors"] == one["errors"]
    assert counts["excluded"] == {**one["excluded"], "in_open_pr": 1}

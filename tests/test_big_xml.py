import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docflow import udfs
from docflow.sources import big_xml


def record(rng, i):
    odd = rng.choice(["", "", "", "<!-- </PubmedArticle> -->", "<!-- <PubmedArticle> </PubmedArticle> </PubmedArticle> <![CDATA[ -->", "<![CDATA[ </PubmedArticle> <!-- ]]>", "<!-- a --><!-- ]]> -->"])
    filler = "x" * rng.randrange(400)
    return (
        f"<PubmedArticle>{odd}<MedlineCitation><PMID>{i}</PMID><Article><ArticleTitle>T{i} <![CDATA[</PubmedArticle> {filler} <b>]]> é日本</ArticleTitle></Article></MedlineCitation>{rng.choice(['', odd])}</PubmedArticle>"
        + rng.choice(["", "\n", "<!-- <PubmedArticle> between </PubmedArticle> -->\n", "\n<!-- ]]> -->"])
    )


def whole(text, state):
    """State by state, a character at a time."""
    at = 0
    while at < len(text):
        if state == 0:
            opened = next((o for o in big_xml.OPENS if text.startswith(o, at)), None)
            state, at = (big_xml.OPENS[opened], at + len(opened)) if opened else (0, at + 1)
        elif text.startswith(big_xml.CLOSES[state], at):
            state, at = 0, at + 3
        else:
            at += 1
    return state


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<!--", "-->", "<![CDATA[", "]]>", "a", "-", "]", ">", "<!"]), max_size=12), st.integers(0, 2))
def test_states(parts, state):
    text = "".join(parts)
    assert big_xml.state_after(text, state) == whole(text, state)


@pytest.mark.parametrize("size", ["2k", "64k", "64m"])
def test_ranges_equal_the_whole_parse(spark, tmp_path, size):
    rng = random.Random(4)
    texts = {}
    for name, n in (("a", 400), ("b", 3), ("c", 0)):
        head = '<?xml version="1.0"?>\n<!DOCTYPE PubmedArticleSet [<!ENTITY x "y">]>\n<!-- <PubmedArticle> no </PubmedArticle> -->\n<PubmedArticleSet>\n'
        texts[name] = head + "".join(record(rng, f"{i}{ord(name)}") for i in range(n)) + "</PubmedArticleSet>\n"
        (tmp_path / f"{name}.xml").write_text(texts[name], encoding="utf-8")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        pages = big_xml.read_records(spark, str(tmp_path))
        got = [(r["pmid"], r["title"]) for r in udfs.parse_records(pages).orderBy("page", "at").collect()]
        if size == "2k":
            assert spark.read.option("lineSep", "</PubmedArticle>").text(str(tmp_path)).rdd.getNumPartitions() > 30
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    one = spark.createDataFrame([(k, texts[n].encode()) for k, n in enumerate("abc")], "page long, xml binary")
    want = [(r["pmid"], r["title"]) for r in udfs.parse_records(one).orderBy("page", "at").collect()]
    assert sorted(got) == sorted(want) and len(want) == 403
    assert [p for p, _ in got if p.endswith("97")] == [p for p, _ in want if p.endswith("97")]  # in the order of their file


def test_articles_with_namespaces(spark, tmp_path):
    article = "<article xmlns:xlink='http://www.w3.org/1999/xlink'><front><article-meta><article-id pub-id-type='pmc'>{}</article-id><permissions><license xlink:href='u'/></permissions></article-meta></front><body><p>x</p><sub-article/></body></article>"
    (tmp_path / "x.xml").write_text("<pmc-articleset>" + "".join(article.format(i) for i in range(9)) + "</pmc-articleset>")
    rows = udfs.parse_articles(big_xml.read_records(spark, str(tmp_path), "article")).collect()
    assert sorted(r["pmcid"] for r in rows) == [f"PMC{i}" for i in range(9)] and {r["license_raw"] for r in rows} == {"u"}


def test_no_records(spark, tmp_path):
    (tmp_path / "x.xml").write_text("<PubmedArticleSet/>")
    assert big_xml.read_records(spark, str(tmp_path)).count() == 0

import json

from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docflow import frontmatter, schemas
from docflow.operators import review
from docflow.streaming import review_stream


def parsed(spark, rows):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, body string, path string").orderBy("i")
    return [r[0] and tuple(r[0]) for r in frame.select(review.parse_command(F.col("body"), F.col("path"))).collect()]


def test_commands(spark):
    at = "corpus/pmid-1.md"
    assert parsed(spark, [(" /Approve ", at), ("/reject too\nshort ", at), ("/approved", at), ("please /reject", at), (None, at), ("/approve", "docs/x.md"), ("/approve", None)]) == [
        ("approve", "pmid-1", "", None), ("reject", "pmid-1", "too\nshort", None), None, None, None, ("approve", None, "", "not on a document of the corpus"), ("approve", None, "", "not on a document of the corpus"),
    ]


def test_event_comments(spark):
    def event(repo, ref, **more):
        return json.dumps({"pull_request": {"number": 1, "head": {"ref": ref, "repo": {"full_name": repo}}}, **more})

    comment = {"id": 5, "body": "/approve", "path": "corpus/pmid-1.md", "author_association": "OWNER"}
    rows = [
        ("pull_request_review_comment", event("o/r", "ingest/x", comment=comment)), ("pull_request_review_comment", event("fork/r", "ingest/x", comment=comment)), ("pull_request_review_comment", event("o/r", "main", comment=comment)),
        ("pull_request_review", event("o/r", "ingest/x", review={"id": 1}, comments=[comment, {**comment, "id": 6}])), ("push", event("o/r", "ingest/x")),
    ]
    frame = spark.createDataFrame(rows, "name string, json string").select("name", F.from_json("json", schemas.EVENT).alias("event"))
    assert sorted(r["id"] for r in review.event_comments(frame, "o/r").collect()) == [5, 5, 6]


COMMANDS = st.lists(st.tuples(st.integers(1, 3), st.sampled_from(["approve", "reject"]), st.sampled_from([None, "", "why", "again"])), max_size=25)


@settings(max_examples=8, deadline=None)
@given(COMMANDS)
def test_fold_is_the_sequence_of_steps(spark, commands):
    rows = [(i, d, c, n) for i, (d, c, n) in enumerate(commands)]
    want = {}
    for _, doc, decision, notes in rows:
        status, kept, changes, errors = want.get(doc, ("pending", None, 0, 0))
        status, kept, c, e = review_stream.step(status, kept, decision, notes)
        want[doc] = (status, kept, changes + c, errors + e)
    frame = spark.createDataFrame(rows, "at int, doc int, decision string, notes string")
    assert {r["doc"]: (r["status"], r["notes"], r["changes"], r["errors"]) for r in review.fold(frame, "doc", ["at"]).collect()} == want


def test_stream_drops_repeats(spark, tmp_path):
    base = datetime(2026, 1, 1)
    rows = [(1, base, 7, "approve", None), (1, base, 7, "approve", None), (2, base + timedelta(hours=1), 7, "reject", "why"), (3, base + timedelta(hours=2), 8, "reject", None)]
    schema = "event_id long, ts timestamp, doc long, decision string, notes string"
    for i, part in enumerate((rows[:1], rows[1:])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    out = {r["doc"]: (r["status"], r["notes"], r["changes"], r["errors"]) for r in review_stream.run_available(review_stream.review_states(stream)).collect()}
    assert out == {7: ("rejected", "why", 2, 0), 8: ("pending", None, 0, 1)}


def test_front_matter_round_trip_and_contract():
    keys = {"id": "pmid-1", "published": "2024-03-05", "pmid": "00012", "title": "a: b", "topics": [], "doi": None, "modality": ["transplant"], "retracted": False}
    text = frontmatter.write(keys, "# x\n")
    again, body = frontmatter.read(text.replace("\n", "\r\n"))
    assert body == "# x\n" and again == {"id": "pmid-1", "title": "a: b", "modality": ["transplant"], "retracted": False, "pmid": "00012", "published": "2024-03-05"}
    for bad in ("", "x", "---\na: 1\n", "---\n- 1\n---\n", "---\n{\n---\n"):
        try:
            frontmatter.read(bad)
        except ValueError:
            continue
        raise AssertionError(bad)
    found = list(frontmatter.problems({**keys, "source_type": "pmc_fulltext", "language": "english", "evidence_tier": 6, "population": "x", "extra": 1}))
    assert {"language: wrong form", "evidence_tier: out of range", "population: not one of adult, pediatric, mixed, unspecified", "extra: not a key", "license: missing", "id: not that of the pmid"} <= set(found)
    assert list(frontmatter.problems({"source_type": "x"})) == ["source_type: unknown 'x'"]
    assert set(frontmatter.json_schema()["$defs"]) == {"pmc_fulltext", "pubmed_abstract", "pdf", "web"}

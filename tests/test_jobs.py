"""The two jobs: runs over growing input, epochs run again, odd rows, command lines."""

import hashlib
import json
import random
import shutil
import uuid

import pytest

from docflow import frontmatter
from jobs import common, ingest_increment, publish_reviews

DOCS = "doc_id long, text string, lang string, source string"
CONFIG = ingest_increment.Config(min_body_chars=10, allowed_languages=["en", "fr"], allowed_licenses=["CC-BY-4.0"], require_license=False, tiers={"en": 1, "fr": 2}, batch_size=3)


def digest(text):
    return "sha256:" + hashlib.sha256((text or "").encode()).hexdigest()


class Corpus:
    """What the job should do, an arrival at a time, in plain Python."""

    def __init__(self, retracted, poor, taken):
        self.retracted, self.poor, self.taken, self.stored, self.decisions = retracted, poor, taken, {}, []

    def arrive(self, rows, epoch):
        for r in rows:
            if r[0] is None:
                self.decisions.append((epoch, None, "excluded", ("no_id",)))
        one = {}
        for r in rows:
            order = lambda r: (digest(r[1]), r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
            if r[0] is not None and (r[0] not in one or order(r) < order(one[r[0]])):
                one[r[0]] = r
        before = dict(self.stored)
        fresh = []
        for i, text, lang, source in sorted(one.values(), key=lambda r: r[0]):
            reasons = ["retracted"] if i in self.retracted else ["rejected_in_corpus"] if i in self.poor else ["in_open_pr"] if i in self.taken else ["no_pmcid"] if not source else []
            if not reasons:
                reasons += ["language_missing"] if lang is None else ["language_not_allowed"] if lang not in ("en", "fr") else []
                reasons += ["license_not_allowed"] if "CC0" in (text or "") else []
                reasons += ["body_too_short"] if len(text or "") < 10 else []
            if reasons:
                self.decisions.append((epoch, i, "excluded", tuple(reasons)))
            elif before.get(i) == digest(text):
                self.decisions.append((epoch, i, "unchanged", ()))
            else:
                fresh.append((i, text))
        for i, text in fresh:
            holders = [k for k, h in before.items() if h == digest(text)] or [k for k, t in fresh if digest(t) == digest(text)]
            outcome = "duplicate" if min(holders) != i else "updated" if i in before else "new"
            self.decisions.append((epoch, i, outcome, ()))
            if outcome != "duplicate":
                self.stored[i] = digest(text)


def arrivals(seed, n, ids):
    rng = random.Random(seed)
    texts = [f"text number {k} of the corpus" for k in range(12)] + ["short", "", None, "a text under CC0 1.0 licence", "a text under CC BY 4.0 licence", "Ünï çødé 日本語 text"]
    rows = [(rng.choice(ids), rng.choice(texts), rng.choice(("en", "en", "fr", "de", None)), rng.choice(("s1", "s1", "s2", "", None))) for _ in range(n)]
    return [*rows, rows[0], (None, "no id here at all", "en", "s1")]


@pytest.fixture
def places(spark, tmp_path):
    top = tmp_path / uuid.uuid4().hex
    spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 1, 0), (3, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels")
    spark.createDataFrame([(4,), (4,), (None,)], "item_id long").write.parquet(f"{top}/taken")
    return top


def land(spark, top, rows, name):
    """New files for the stream, as one file."""
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(f"{top}/{name}")
    (top / "documents").mkdir(exist_ok=True)
    for file in (top / name).glob("*.parquet"):
        shutil.copy(file, top / "documents" / f"{name}-{file.name}")


def ingest(spark, top, config=CONFIG, out="out"):
    return ingest_increment.run(spark, config, f"{top}/documents", f"{top}/labels", f"{top}/taken", f"{top}/{out}", f"{top}/{out}-checkpoint")


def seen(spark, top, out="out"):
    return sorted(((r["epoch"], r["doc_id"], r["outcome"], tuple(r["reasons"])) for r in ingest_increment.outcomes(spark, f"{top}/{out}").collect()), key=str)


def test_growing_input(spark, places):
    want = Corpus({1}, {2}, {4})
    parts = [arrivals(1, 40, range(30)), arrivals(2, 40, range(45)), [(900, "one more document", "en", "s1"), *arrivals(2, 40, range(45)), *arrivals(1, 40, range(30))]]
    for epoch, rows in enumerate(parts):
        land(spark, places, rows, f"part{epoch}")
        assert ingest(spark, places) == epoch
        want.arrive(rows, epoch)
        assert seen(spark, places) == sorted(want.decisions, key=str)
        assert ingest(spark, places) == -1  # nothing new
        assert seen(spark, places) == sorted(want.decisions, key=str)
    assert {d[2] for d in want.decisions} == set(ingest_increment.increment.OUTCOMES)
    last = {}
    for r in sorted(ingest_increment.corpus(spark, f"{places}/out").collect(), key=lambda r: r["epoch"]):
        assert digest(r["text"]) == r["content_hash"]
        last[r["doc_id"]] = r["content_hash"]
    assert last == want.stored
    for epoch in range(3):
        rows = [r for r in ingest_increment.outcomes(spark, f"{places}/out").where(f"epoch = {epoch} and batch is not null").collect()]
        ranked = sorted(rows, key=lambda r: (r["tier"], str(r["doc_id"])))
        assert [r["batch"] for r in ranked] == [k // 3 + 1 for k in range(len(ranked))]
    counts = [json.loads(x) for x in spark.read.text(f"{places}/out/statistics/epoch=0").toPandas()["value"]]
    first = [d for d in want.decisions if d[0] == 0]
    assert counts[0]["new"] == sum(d[2] == "new" for d in first) and counts[0]["found"] == len(first) and counts[0]["excluded_total"] == sum(len(d[3]) for d in first)


def test_an_epoch_that_is_run_again_changes_nothing(spark, places):
    land(spark, places, arrivals(3, 30, range(20)), "one")
    ingest(spark, places)
    land(spark, places, arrivals(4, 30, range(25)), "two")
    ingest(spark, places)
    before, texts = seen(spark, places), sorted(map(str, ingest_increment.corpus(spark, f"{places}/out").collect()))
    for name in ("1", ".1.crc"):  # as if the driver had been lost before its commit
        (places / "out-checkpoint" / "commits" / name).unlink(missing_ok=True)
    ingest(spark, places)
    assert seen(spark, places) == before and sorted(map(str, ingest_increment.corpus(spark, f"{places}/out").collect())) == texts


def test_limited_epochs_take_all_files(spark, places):
    parts = [[(i, f"document number {i} here", "en", "s1")] for i in range(10, 14)]
    for k, rows in enumerate(parts):
        land(spark, places, rows, f"p{k}")
    assert ingest(spark, places, CONFIG.model_copy(update={"max_files": 1})) == 3
    assert {(r["epoch"], r["outcome"]) for r in ingest_increment.outcomes(spark, f"{places}/out").collect()} == {(k, "new") for k in range(4)}


def test_empty_table_and_settings(spark, places):
    land(spark, places, [], "none")
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.sources.partitionOverwriteMode", "spark.sql.shuffle.partitions")}
    ingest(spark, places)
    assert before == {k: spark.conf.get(k, None) for k in before}


SAID = "conv_id long, turn long, role string, text string"


def folded(turns):
    status, notes, changes, errors = "pending", None, 0, 0
    for _, role, text in sorted(turns, key=lambda t: t[0]):
        given = (text or "").strip() or None
        if role == "user":
            if status == "pending":
                status, changes = "approved", changes + 1
            errors += status == "rejected"
        elif role == "assistant" and status != "rejected":
            if given:
                status, notes, changes = "rejected", given, changes + 1
            else:
                errors += 1
    return status, notes, changes, errors


def test_publishing_twice(spark, tmp_path):
    rng = random.Random(5)
    docs = [(i, rng.choice(["a text\nwith lines", "  ", None, "---\nlike: front matter\n---\n", "é 日本"]), rng.choice(("en", None)), rng.choice(("s", None))) for i in range(40)]
    said = [(rng.randrange(45), t, rng.choice(("user", "assistant", "system", None)), rng.choice(["no", " see: 'x'\n# y ", "", None])) for t in range(120)]
    spark.createDataFrame([*docs, docs[0], (None, "x", "en", "s")], DOCS).write.parquet(str(tmp_path / "d"))
    spark.createDataFrame(said, SAID).write.parquet(str(tmp_path / "c"))
    rows = []
    for _ in range(2):
        assert publish_reviews.run(spark, publish_reviews.Config(), str(tmp_path / "d"), str(tmp_path / "c"), str(tmp_path / "out")) == 40
        rows.append(sorted(map(str, publish_reviews.published(spark, str(tmp_path / "out")).collect())))
    assert rows[0] == rows[1] and len(rows[0]) == 40
    for r in publish_reviews.published(spark, str(tmp_path / "out")).collect():
        status, notes, changes, errors = folded([(t, role, text) for c, t, role, text in said if c == r["doc_id"]])
        assert (r["status"], r["notes"], r["changes"], r["errors"], r["folder"]) == (status, notes, changes, errors, "rejected" if status == "rejected" else "corpus")
        keys, body = frontmatter.read(r["text"])
        original = docs[r["doc_id"]][1] or ""
        assert body == original and r["content_hash"] == digest(original) == keys["content_hash"] and keys["curation_status"] == status and keys.get("review_notes") == notes
        assert ("empty body" in r["problems"]) == (not original.strip()) and ("curation_status must be approved" in r["problems"]) == (status == "pending")
    counts = spark.read.json(str(tmp_path / "out" / "statistics")).collect()
    assert sum(r["documents"] for r in counts) == 40
    listed = spark.read.csv(str(tmp_path / "out" / "problems"), header=True).collect()
    assert {r["problem"] for r in listed} == {"empty body", "curation_status must be approved"}


def test_command_lines(tmp_path, monkeypatch, spark):
    path = tmp_path / "c.yaml"
    path.write_text("approve_role: user\nsurprise: 1\n")
    with pytest.raises(ValueError, match="surprise"):
        publish_reviews.main(["--config", str(path), "--documents", "a", "--comments", "b", "--output", "c"])
    path.write_text("")
    with pytest.raises(ValueError, match="allowed_languages"):
        ingest_increment.main(["--config", str(path), "--documents", "a", "--registry", "b", "--protected", "c", "--output", "d", "--checkpoint", "e"])
    with pytest.raises(SystemExit):
        ingest_increment.main([])

    class Kept:
        """The tests' session, which a job's end must not stop."""

        def __getattr__(self, name):
            return (lambda: None) if name == "stop" else getattr(spark, name)

    monkeypatch.setattr(publish_reviews, "session", lambda name: Kept())
    small = "/root/testdata/sf0.001"
    publish_reviews.main(["--config", publish_reviews.__file__.replace(".py", ".yaml"), "--documents", f"{small}/documents.parquet", "--comments", f"{small}/conversations.parquet", "--output", str(tmp_path / "o")])
    assert publish_reviews.published(spark, str(tmp_path / "o")).count() == spark.read.parquet(f"{small}/documents.parquet").count()


def test_patterns():
    assert common.as_pattern("/a/b.parquet/") == "/a/b.parque[t]"

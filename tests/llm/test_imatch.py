import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from corpora import frame, simple, words
from helpers import SMALL
from pyspark.sql import functions as F

from docflow.llm import imatch


def check_rows(got, docs):
    """docs: [(doc_id, text)]; got rows of the same, in order of descending doc_id, with the edited text of each."""
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0), reverse=True)
    by = {r["doc_id"]: r for r in got}
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        text, following = text or "", following or ""
        k = len(text) // 3
        edited = text[: len(text) - k] + following[:k]
        assert by[doc]["n_chars"] == len(text) and by[doc]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= by[doc]["near_edited"] <= 1 and 0 <= by[doc]["near_next"] <= 1


@pytest.mark.parametrize("size", [8192, 5])
def test_rows_and_neighbours(spark, monkeypatch, size):
    monkeypatch.setattr(imatch, "RANGE_ROWS", size)
    docs = [(r["doc_id"], r["text"]) for r in frame(spark).collect() if r["doc_id"] != 3 and not (r["doc_id"] is None and r["text"] is None)]
    docs = list(dict.fromkeys(docs))
    got = imatch.fingerprints(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(got) == len(docs)
    check_rows(got, docs)


def test_repeated_rows_keep_their_number(spark, monkeypatch):
    monkeypatch.setattr(imatch, "RANGE_ROWS", 4)
    docs = frame(spark)
    got = imatch.fingerprints(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in docs.collect())
    texts = {}
    for r in imatch.fingerprints(simple(spark, ["same text here", "same text here", "", None])).collect():
        texts.setdefault((r["n_chars"],), set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in texts.values())


def test_one_document_and_none(spark):
    (row,) = imatch.fingerprints(simple(spark, ["abcdef"])).collect()
    assert row["near_next"] == 1.0 and row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()
    assert imatch.fingerprints(frame(spark, [])).count() == 0


def test_lexicon_is_the_band(spark):
    texts = ["common a b", "common a c", "common d e", "common b f"] * 5 + [f"common lone{i}" for i in range(3000)]
    words = imatch.lexicon(simple(spark, texts), len(texts), (0.2, 0.8))
    low, high = len(texts) ** 0.2, len(texts) ** 0.8
    cache, df = imatch.TermHashes(), Counter(t for x in texts for t in set(x.split()))
    wrong = 0
    for term, n in df.items():
        inside = cache.of([term.encode()])[0].item() in words
        assert inside if low <= n <= high else n < low or not inside, term
        wrong += inside and n < low
    assert wrong < 0.03 * 3000


def test_frequencies_are_exact_beyond_what_a_task_holds(spark, monkeypatch):
    monkeypatch.setattr(imatch, "HELD_TERMS", 50)
    texts = [f"a{i % 7} b{i % 40} lone{i}" for i in range(400)]
    got = {r["term"]: r["n"] for r in simple(spark, texts).select("text").mapInArrow(imatch._count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    cache = imatch.TermHashes()
    assert got == {int(cache.of([t.encode()]).view(np.int64)[0]): n for t, n in Counter(t for x in texts for t in x.split()).items()}


def test_subsets_are_independent():
    printer = imatch.Fingerprinter(None)
    assert all(int(a) & int(b) == 0 for i, a in enumerate(printer.bits) for b in printer.bits[:i])
    assert [int(b).bit_count() for b in printer.bits] == [2, 4, 6, 8, 10, 12] and sum(map(int, printer.bits)) < 1 << 64


@pytest.mark.parametrize("size", [8192, 3])
def test_ids_that_are_no_numbers_and_hot_rows(spark, monkeypatch, size):
    monkeypatch.setattr(imatch, "RANGE_ROWS", size)
    docs = [(f"d{i:02d}", f"text number {i} of some words") for i in range(12)] + [("hot", "the same row"), (None, "no id")]
    rows = docs + [("hot", "the same row")] * 30 + [(None, "no id")] * 5
    got = imatch.fingerprints(spark.createDataFrame(rows, "doc_id string, text string").repartition(5)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in rows)
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or ""), reverse=True)
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        k = len(text) // 3
        want = {hashlib.sha256((text[: len(text) - k] + x[:k]).encode()).hexdigest() for x in ({following, text} if doc in ("hot", None) else {following})}
        assert {r["edited_sha256"] for r in got if r["doc_id"] == doc} == want, doc


def test_likeness_follows_overlap(spark):
    import random

    rng, printer = random.Random(1), imatch.Fingerprinter(None)
    for size in (40, 400, 4000):
        for share in (1.0, 0.8, 0.5, 0.0):
            near = []
            for _ in range(20):
                a = [f"t{rng.randrange(10**9)}" for _ in range(size)]
                b = a[: int(size * share)] + [f"t{rng.randrange(10**9)}" for _ in range(size - int(size * share))]
                near.append(imatch.likeness(printer(" ".join(a)), printer(" ".join(b))))
            overlap = share / (2 - share)
            assert abs(sum(near) / 20 - overlap) < 0.2, (size, share)
    assert math.isclose(imatch.likeness(printer(""), printer("")), 1.0) and printer("a b") == printer("b  a a")


def test_edited_is_nearer_than_next(spark):
    rows = imatch.op1_imatch(spark, SMALL).collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.95 * len(rows)


def test_very_long_text(spark):
    import random

    text = words(random.Random(2), 60_000, 50_000)
    rows = {r["doc_id"]: r for r in imatch.fingerprints(simple(spark, [text, text, "b"])).collect()}
    assert rows[1]["near_next"] == 1.0 and rows[0]["fingerprint"] == rows[1]["fingerprint"]

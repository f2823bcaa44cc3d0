import random
import time
from collections import defaultdict

import pytest
from corpora import frame, simple
from hypothesis import given, settings
from hypothesis import strategies as st

from docflow.llm import line_dedup


def brute(docs, min_words):
    """docs in order -> lines to cut: all under the longest run from each line that has an earlier copy, if long enough."""
    seen, cut = defaultdict(list), {}
    texts = [t.split("\n") for t in docs]
    for d, lines in enumerate(texts):
        cut[d] = set()
        size = [len(x.split()) for x in lines]
        for i, line in enumerate(lines):
            best = 0
            for e, j in seen[line]:
                k = 0
                while i + k < len(lines) and j + k < len(texts[e]) and texts[e][j + k] == lines[i + k]:
                    k += 1
                best = max(best, k)
            if sum(size[i : i + best]) >= min_words:
                cut[d].update(range(i, i + best))
            seen[line].append((d, i))
    return cut


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b b", "c c c", "", "d d d d d"]), max_size=14), min_size=1, max_size=8), st.integers(1, 9))
def test_cuts_equal_brute_force(spark, docs, min_words):
    texts = ["\n".join(x) for x in docs]
    got = {r["doc_id"]: set(r["cut"]) for r in line_dedup.repeated_lines(simple(spark, texts), min_words).collect()}
    assert got == {k: v for k, v in brute(texts, min_words).items() if v}


def test_ranks_are_places_in_the_sorted_order(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(-4, 4), rng.randrange(5)) for _ in range(120)] + [(99, i) for i in range(5)]
    got = {(r["a"], r["b"]): r["rank"] for r in line_dedup.suffix_ranks(spark.createDataFrame(pairs, "a long, b long")).collect()}
    shared = [p for p in pairs if pairs.count(p) > 1]
    assert got == {p: sum(q < p for q in shared) for p in shared}


def test_runs_of_many_lines(spark):
    """Runs of many lines take all rounds; copies that differ in the middle do not count as one."""
    rng = random.Random(3)
    block = [rng.choice(["", "", "", "a", "b"]) for _ in range(150)]
    other = [*block[:75], "x", *block[76:]]
    texts = ["\n".join(t) for t in (block, ["head", *block, "tail"], other, [""] * 90, [""] * 90)]
    for limit in (10, 45):
        got = {r["doc_id"]: set(r["cut"]) for r in line_dedup.repeated_lines(simple(spark, texts), limit).collect()}
        assert got == {k: v for k, v in brute(texts, limit).items() if v}


@pytest.mark.parametrize("limit", [50, 3])
def test_odd_rows(spark, limit):
    docs = frame(spark)
    out = line_dedup.drop_repeated_lines(docs, limit)
    assert out.columns == docs.columns
    old = [(r["doc_id"], r["text"]) for r in docs.collect()]
    new = defaultdict(list)
    for r in out.collect():
        new[r["doc_id"]].append(r["text"])
    order = sorted({x for x in old if x[1] is not None and x[0] is not None and x[0] != 3})
    cuts = brute([t for _, t in order], limit)
    if limit == 50:  # no line outside these documents is long enough to matter
        for at, (doc, text) in enumerate(order):
            left = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in cuts[at])
            assert set(new[doc]) == ({left} if left.split() or not cuts[at] else set())
    assert None in new[None] and len(new[2]) in (0, 3)
    assert {(r["key"], r["range"], r["th"], r["cut"], r["cls"]) for r in out.collect()} == {("k", 7, "th", "cut", 1)}


def test_kept_first_copy_and_empty_table(spark):
    line = " ".join(f"w{i}" for i in range(60))
    docs = simple(spark, [line, line, f"x\n{line}\ny", None, ""])
    assert [tuple(r) for r in line_dedup.drop_repeated_lines(docs).orderBy("doc_id").collect()] == [(0, line), (2, "x\ny"), (3, None), (4, "")]
    assert line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0


def test_long_document(spark):
    rng = random.Random(1)
    lines = [f"l{rng.randrange(3000)} a b" for _ in range(20_000)]
    text = "\n".join(lines)
    docs = simple(spark, [text, text])
    assert line_dedup.drop_repeated_lines(docs).where("doc_id = 1").count() == 0


def test_rebuilding_is_linear(spark):
    text = "\n".join(f"line {i} of a long text" for i in range(32_000))
    docs = simple(spark, [text, f"{text}\nown end"]).coalesce(1)
    line_dedup.dedup_lines(simple(spark, ["warm up"])).count()
    began = time.perf_counter()
    assert [r["text"] for r in line_dedup.dedup_lines(docs).orderBy("row.doc_id").collect()] == [text, "own end"]
    assert time.perf_counter() - began < 15  # of which the rounds' fixed cost is most; a quadratic rebuild alone took 50


def test_ranks_by_ranges_are_those_of_one_task(spark, monkeypatch):
    rng = random.Random(9)
    pairs = spark.createDataFrame([(rng.randrange(-9, 9), rng.randrange(12)) for _ in range(900)], "a long, b long")
    few = sorted(map(tuple, line_dedup.suffix_ranks(pairs).collect()))
    monkeypatch.setattr(line_dedup, "FEW_PAIRS", 5)
    assert sorted(map(tuple, line_dedup.suffix_ranks(pairs).collect())) == few
    texts = ["\n".join(rng.choice("abc") for _ in range(30)) for _ in range(12)]
    got = {r["doc_id"]: set(r["cut"]) for r in line_dedup.repeated_lines(simple(spark, texts), 4).collect()}
    assert got == {k: v for k, v in brute(texts, 4).items() if v}

import random
from collections import defaultdict

import numpy as np
import pytest
from corpora import frame, simple, words

from docflow.llm import near_dedup
from docflow.llm.components import components


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(doc_id, text) -> component of each distinct row, by all pairs."""
    rows = sorted({r for r in rows}, key=str)
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                up[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    out = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out[rows[i]] = (len(sets[i]), min(ids, default=None))
    return out


def family(seed, size):
    """Copies of copies with a word or more changed: chains of links, and misses just below the threshold."""
    rng = random.Random(seed)
    texts = [words(rng, 120)]
    for _ in range(size - 1):
        w = rng.choice(texts).split()
        for _ in range(rng.choice((0, 1, 1, 2, 3))):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = family(seed, 150) + [words(rng, 100) for _ in range(30)]
    want = brute(list(enumerate(texts)))
    got = near_dedup.near_duplicates(simple(spark, texts)).collect()
    assert {(r["doc_id"], texts[r["doc_id"]]): (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_chunks_of_a_crowd(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CHUNK", 800)
    texts = family(3, 120)
    want = brute(list(enumerate(texts)))
    assert {(r["doc_id"], texts[r["doc_id"]]): (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(simple(spark, texts)).collect()} == want


def test_odd_rows(spark):
    docs = frame(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    want = sorted([(k[0], *v) for k, v in brute(rows).items()], key=str)
    assert sorted({(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got}, key=str) == sorted(set(want), key=str)
    kept = near_dedup.keep_one(docs)
    gone = {r["doc_id"] for r in got if not r["kept"]}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got} - gone


def test_rows_without_an_id_are_linked(spark):
    rng = random.Random(11)
    a, b, c = (words(rng, 200) for _ in range(3))
    rows = [(1, a), (None, f"{a} more"), (None, b), (None, f"{b} x"), (None, b), (7, c), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_duplicates(docs).collect()
    assert sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in got), key=str) == sorted([(1, 1, True), (None, 1, False), (7, 7, True), *[(None, None, True)] * 5], key=str)
    texts = [(r["doc_id"], r["text"]) for r in near_dedup.keep_one(docs).collect()]
    assert (1, a) in texts and (None, f"{a} more") not in texts and sum(t in (b, f"{b} x") for _, t in texts) in (1, 2) and len({t for _, t in texts if t in (b, f"{b} x")}) == 1
    assert (None, None) in texts and (None, "") in texts


@pytest.mark.parametrize("dense", [0, 3, 10**9])
def test_common_shingles_are_counted(monkeypatch, dense):
    monkeypatch.setattr(near_dedup, "DENSE", dense)
    monkeypatch.setattr(near_dedup, "COLUMNS", 5)
    rng = random.Random(4)
    sets, others = ([frozenset(rng.sample(range(-30, 30), rng.randrange(1, 25))) for _ in range(n)] for n in (9, 14))
    flat = lambda xs: (np.array([i for i, x in enumerate(xs) for _ in x]), np.array([v for x in xs for v in x], np.int64))
    assert near_dedup._common(flat(sets), flat(others), (9, 14)).tolist() == [[len(a & b) for b in others] for a in sets]


def test_empty(spark):
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0 and near_dedup.keep_one(frame(spark, [])).count() == 0


def test_connected_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(300, 300 + i) for i in range(30)] + [(None, 3), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    near = defaultdict(set)
    for u, v in edges:
        if u is not None and u != v:
            near[u].add(v), near[v].add(u)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x), todo.append(x)
        assert got[start] == min(seen)
    assert set(got) == set(near)


def test_threshold_is_a_parameter(spark):
    assert near_dedup.tuned(85) == 8 and near_dedup.tuned(80) == 10
    rng = random.Random(11)
    texts = []
    for _ in range(20):
        w = words(rng, 200).split()
        texts += [" ".join(w), " ".join("new" if i in (40, 90, 140, 170) else x for i, x in enumerate(w))]  # 176 of 216 shingles: 0.815
    docs = simple(spark, texts)
    assert near_dedup.near_duplicates(docs).where("kept").count() == 40
    assert {r["doc_id"] for r in near_dedup.keep_one(docs, 80).collect()} == set(range(0, 40, 2))

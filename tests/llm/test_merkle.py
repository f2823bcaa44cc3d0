import random
from hashlib import sha256

import pytest
from corpora import frame
from helpers import SMALL, duck, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from docflow.llm import merkle
from pyspark.sql import functions as F


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """All levels of a tree, by plain grouping."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 3 * 3
        out.append(("".join(level[run:i]), "".join(level[i + 1 : run + 3])))
        i //= 3
    return out


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def restated(rows, cut):
    first = lambda v: (v is not None, v)
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees, members = [], []
    for s in sources:
        own = sorted(((first(r["doc_id"]), leaf(r, r["text"]), r) for r in rows if r["source"] == s), key=lambda x: x[:2])
        members.append(own)
        trees.append(tree([x[1] for x in own]))
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, (own, levels) in enumerate(zip(members, trees)):
        for i, (_, own_leaf, r) in enumerate(own):
            whole = path(levels, i) + path(top, k)
            at = leaf(r, cut(r)) if cut(r) != r["text"] else own_leaf
            for left, right in whole:
                at = h(left, at, right)
            out.append((r["doc_id"], own_leaf, levels[-1][0], top[-1][0], h(*[x for p in whole for x in p]), at, at == top[-1][0]))
    return out


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 800), st.integers(0, 9))
def test_traversal_equals_the_whole_tree(n, seed):
    leaves = [h(str(seed), str(i)) for i in range(n)]
    levels = tree(leaves)
    raw = [x.encode() for x in leaves]
    assert merkle.height(n) == len(levels) - 1
    got = list(merkle.paths(raw, len(levels) - 1))
    assert len(got) == n and merkle.block_root(raw, len(levels) - 1).decode() == levels[-1][0]
    for i in (0, 1, n // 2, n - 1):
        if i < n:
            assert [(a.decode(), b.decode()) for a, b in got[i]] == path(levels, i)


def test_what_stacks_hold_grows_with_levels(monkeypatch):
    most = {}
    for levels in (4, 5, 6, 7):
        held, real = [], merkle.Treehash.step
        stacks = []

        def made(self, *args, real=merkle.Treehash.__init__, stacks=stacks):
            real(self, *args)
            stacks.append(self)

        monkeypatch.setattr(merkle.Treehash, "__init__", made)
        for i, _ in enumerate(merkle.paths([b"x"] * 3**levels, levels)):
            if i % 7 == 0:
                alive = [s for s in stacks[-4 * levels :] if not s.done]
                held.append(sum(len(x) for s in alive for x in s.open))
        monkeypatch.undo()
        most[levels] = max(held)
        assert real is merkle.Treehash.step
    assert most[7] < 3 * most[4] + 20 and most[7] < 3**7 / 20


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_rows_equal_a_restatement(spark, levels, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    docs = frame(spark)
    cut = lambda r: r["text"].replace("\n", "") if r["text"] is not None and (r["doc_id"] or 1) % 2 == 0 else r["text"]
    got = merkle.manifest(docs, F.coalesce("doc_id", F.lit(1)) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, restated(docs.collect(), cut)))


def test_many_sources_and_one_row(spark):
    rng = random.Random(4)
    rows = [(i, "t" * rng.randrange(5), None, rng.choice([None, "", f"s{rng.randrange(40)}", "é", "\U0001f389"]), i) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    same = lambda r: r["text"]
    got = merkle.manifest(docs).collect()
    assert sorted(map(tuple, got)) == sorted(restated(docs.collect(), same)) and all(r["verified"] for r in got)
    one = docs.limit(1)
    r = merkle.manifest(one).collect()[0]
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] and r["proof_sha256"] == h("")


def test_equal_rows_are_spread(spark):
    docs = spark.createDataFrame([(5, "same", "en", "s", 4)] * 3000 + [(1, "x", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    got = merkle.manifest(docs).collect()
    assert sorted(map(tuple, got)) == sorted(restated(docs.collect(), lambda r: r["text"]))


def test_empty(spark):
    assert merkle.manifest(frame(spark, [])).count() == 0


def test_query_equals_sql(spark):
    assert rows_of(merkle.op11_merkle_manifest(spark, SMALL).toPandas()) == rows_of(duck(SMALL).execute(merkle.ORACLE).df())

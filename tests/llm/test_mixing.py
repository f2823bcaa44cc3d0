import math
import random
import re
from collections import Counter, defaultdict

import pytest
from corpora import frame
from helpers import SMALL
from pyspark.sql import functions as F

from docflow.llm import mixing


def fill(sizes, weights, share=1.5, ceiling=2.0):
    """Targets by handing out, capping and handing out again."""
    total, target, open_ = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_ and total > 1e-9:
        w = sum(weights[i] for i in open_)
        over = {i for i in open_ if total * weights[i] / w >= ceiling * sizes[i]}
        for i in over or open_:
            target[i] = ceiling * sizes[i] if over else total * weights[i] / w
        if not over:
            break
        total -= sum(target[i] for i in over)
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [[100, 100, 100], [5, 1000, 1000, 1000, 3], [0, 0], [7], [0, 50, 1, 90, 4000, 4000, 4000]])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(f"s{i}" if i < len(sizes) - 1 else None, s) for i, s in enumerate(sizes)], "source string, words long")
    got = mixing.source_targets(rows).orderBy("place").collect()
    want = fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
    assert [r["target"] for r in got] == pytest.approx(want, rel=1e-9, abs=1e-6)
    assert got[-1]["source"] is None


def test_hypergeometric(spark):
    pop, good, draws = 20, 7, 9
    n = 4000
    rows = spark.range(n).select(mixing.hypergeometric(F.lit(pop), F.lit(good), F.lit(draws), (F.col("id") + 0.5) / n).alias("x")).groupBy("x").count().collect()
    for r in rows:
        x = r["x"]
        assert r["count"] / n == pytest.approx(math.comb(good, x) * math.comb(pop - good, draws - x) / math.comb(pop, draws), abs=1.5 / n)
    cases = [(0, 0, 0), (5, 0, 3), (5, 5, 3), (5, 3, 5), (10**7, 3 * 10**6, 5 * 10**6)]
    got = [spark.range(1).select(mixing.hypergeometric(*map(F.lit, c), F.lit(0.5))).first()[0] for c in cases]
    assert got[:4] == [0, 0, 3, 3] and abs(got[4] - 1.5e6) < 3000


def test_splitting_tree(spark):
    quotas = [1000, 300, 0, 17]
    leaves = mixing.split_quotas(spark.createDataFrame([(0, quotas, None)], "group long, quotas array<long>, leaves array<long>"), 4, 1).collect()
    assert len(leaves) == 16 and [sum(r["quotas"][i] for r in leaves) for i in range(4)] == quotas
    assert all(min(r["quotas"]) >= 0 for r in leaves) and max(sum(r["quotas"]) for r in leaves) - min(sum(r["quotas"]) for r in leaves) <= 4


def test_mix(spark):
    docs = frame(spark)
    mixed = mixing.mix(docs, block_words=4, levels=3)
    rows, blocks = mixed.collect(), mixing.mixed_blocks(mixed).collect()
    assert len(rows) == docs.count()
    sizes = Counter((r["doc_id"], r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in docs.collect())
    assert sizes == Counter((r["doc_id"], r["source"], r["size"]) for r in rows)
    by, taken, target = defaultdict(int), defaultdict(int), {}
    for r in mixing.taken_words(mixed).collect():
        by[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    names = sorted(by, key=lambda s: (s is None, s))
    assert [target[s] for s in names] == pytest.approx(fill([by[s] for s in names], (5, 2, 1)))
    assert all(abs(taken[s] - target[s]) <= 8 for s in names)
    for r in rows:  # a word is drawn once in a pass
        for turn in (0, 1):
            used = [w for s in r["segments"] or [] if s["pass"] == turn for w in range(s["start_word"], s["start_word"] + s["n_words"])]
            assert len(used) == len(set(used)) and (not used or (min(used) >= 0 and max(used) < r["size"]))
    assert len({b["shard"] for b in blocks}) == 8
    per_shard = Counter(b["shard"] for b in blocks)
    assert max(per_shard.values()) < 1.4 * min(per_shard.values())


def test_reruns_agree_and_empty(spark):
    one, two = ([tuple(r) for r in mixing.op5_mix_to_weights(spark, SMALL).orderBy("doc_id").collect()] for _ in range(2))
    assert one == two and len(one) == 200
    assert mixing.taken_words(mixing.mix(frame(spark, []))).count() == 0
    nothing = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.taken_words(mixing.mix(nothing)).collect()] == [(0.0, 0)] * 2


@pytest.mark.parametrize("sources", [1, 2, 40])
def test_tree_over_groups_of_sources(spark, sources):
    rng = random.Random(sources)
    quotas = [rng.choice((0, 3, 50, 900)) for _ in range(sources)]
    dealt = mixing.deal_quotas(spark.createDataFrame(list(enumerate(quotas)), "place long, quota long"), sources, 3, 1).collect()
    assert len(dealt) == 8 * sources and all(sum(r["drawn"] for r in dealt if r["place"] == i) == q for i, q in enumerate(quotas))
    shards = [sum(r["drawn"] for r in dealt if r["shard"] == k) for k in range(8)]
    assert max(shards) - min(shards) <= 3 and min(r["drawn"] for r in dealt) >= 0


@pytest.mark.parametrize("count", [1, 2, 3, 5, 7, 12, 13, 97, 1000, 1024, 1025, 65_536])
def test_permutation(spark, count):
    rows = math.ceil(math.sqrt(count))
    cols = math.ceil(count / rows)
    made = spark.range(count).select(mixing.permuted(F.col("id"), F.lit(count).cast("long"), F.lit(rows).cast("long"), F.lit(cols).cast("long"), [F.lit(k) for k in (11, 12, 13, 14)]).alias("p"))
    p = [r["p"] for r in made.collect()]
    assert sorted(p) == list(range(count))
    if count >= 1000:  # neighbours land apart: as many next to each other as by chance
        assert sum(abs(a - b) <= 1 for a, b in zip(p, p[1:], strict=False)) < 20


def test_blocks_of_a_document_are_spread(spark):
    texts = [(i, "word " * (32 * 64), "a") for i in range(16)]  # 1,024 blocks
    blocks = mixing.mixed_blocks(mixing.mix(spark.createDataFrame(texts, "doc_id long, text string, source string"))).collect()
    for i in range(16):
        assert len({b["shard"] for b in blocks if b["doc_id"] == i}) > 32
    order = sorted(blocks, key=lambda b: (b["shard"], b["order_key"]))
    assert sum(a["doc_id"] == b["doc_id"] for a, b in zip(order, order[1:], strict=False)) < len(order) / 6


def test_small_sources_meet_their_targets(spark):
    rows = [(10 * k + i, "five words of a text", s) for k, s in enumerate("abc") for i in range(4)]
    rows += [(100 + i, "w " * 900, "large") for i in range(9)]
    for given in (rows[:12], rows):
        taken, target = defaultdict(int), {}
        for r in mixing.taken_words(mixing.mix(spark.createDataFrame(given, "doc_id long, text string, source string"))).collect():
            taken[r["source"]] += r["taken"]
            target[r["source"]] = r["target"]
        assert all(abs(taken[s] - t) <= max(1, 0.01 * t) for s, t in target.items()), (taken, target)


@pytest.mark.parametrize("copies", [4096, 300])
def test_a_row_that_is_there_very_often(spark, copies, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", copies)
    n = 20_000
    hot = spark.range(n).select(F.lit(1).cast("long").alias("doc_id"), F.lit("the same five words again").alias("text"), F.lit("a").alias("source"))
    rest = spark.range(2000).select((F.col("id") + 10).alias("doc_id"), F.concat(F.lit("other words of number "), F.col("id").cast("string")).alias("text"), F.when(F.col("id") % 2 == 0, "b").otherwise("a").alias("source"))
    rows = mixing.taken_words(mixing.mix(hot.unionByName(rest))).collect()
    assert len(rows) == n + 2000 and sum(r["doc_id"] == 1 for r in rows) == n
    taken, target = defaultdict(int), {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 0.01 * t for s, t in target.items())
    assert len({r["taken"] for r in rows if r["doc_id"] == 1}) > 1  # copies have places of their own
    shared = mixing.mix(hot.unionByName(rest)).where("doc_id = 1 and size > 0").select(F.explode("segments").alias("s")).select("s.shard").distinct().count()
    assert shared == 64


def test_many_sources_are_ranked_as_few_are(spark, monkeypatch):
    rows = spark.createDataFrame([(f"s{i:03d}" if i else None, i % 7) for i in range(60)], "source string, words long")
    few = sorted(map(str, mixing.source_targets(rows).collect()))
    monkeypatch.setattr(mixing, "FEW_SOURCES", 5)
    assert sorted(map(str, mixing.source_targets(rows).collect())) == few

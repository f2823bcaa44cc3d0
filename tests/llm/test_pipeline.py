"""Stages against brute force and planted cases, each on what the last one kept."""

import random

import corpus_pipeline
from corpora import words
from test_line_dedup import brute as cut_lines
from test_near_dedup import brute as group

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def write(spark, path, rows, items):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, tmp_path):
    rng = random.Random(7)
    lines = [[words(rng, 70, 5000) for _ in range(4)] for _ in range(40)]
    texts = ["\n".join(x) for x in lines]
    item = words(rng, 40, 5000)
    near = lambda t: " ".join("changed" if i == 40 else w for i, w in enumerate(t.replace("\n", " ").split(" ")))
    texts += [texts[0], near(texts[1]), lines[2][1] + "\nown line here\n" + lines[3][2], f"{words(rng, 60, 5000)} {item} {words(rng, 60, 5000)}", "1234 !!", None, ""]
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    sf = write(spark, tmp_path, rows, [item])
    docs, kept = spark.read.parquet(f"{sf}/documents.parquet"), {i: t for i, t in enumerate(texts)}

    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == COLUMNS
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        got = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.where("n_chars <> length(text)").count() == 0
        order = sorted(kept)
        if name == "language_id":
            kept = {i: t for i, t in kept.items() if t and any(c.isalpha() for c in t)}
        elif name == "line_dedup":
            cut = cut_lines([kept[i] for i in order], 50)
            left = {i: "\n".join(x for k, x in enumerate(kept[i].split("\n")) if k not in cut[at]) for at, i in enumerate(order)}
            kept = {i: t for i, t in left.items() if t.split()}
            assert 40 not in kept and kept[42] == "own line here"
        elif name == "near_dedup":
            groups = group(list(kept.items()))
            kept = {i: t for i, t in kept.items() if groups[i, t][1] == i}
            assert 41 not in kept and 1 in kept
        else:
            kept = {i: t for i, t in kept.items() if item not in t}
            assert 43 not in kept
        assert got == kept, name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    run = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, run.collect())) and {r["doc_id"] for r in run.collect()} == set(kept)
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty(spark, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, tmp_path, [], [])).count() == 0


def test_near_dedup_stage_links_at_80_percent(spark, tmp_path):
    w = words(random.Random(3), 200, 5000).split()
    texts = [" ".join(w), " ".join("new" if i in (40, 90, 140, 170) else x for i, x in enumerate(w))]  # 176 of 216 shingles: 0.815
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], COLUMNS)
    assert [r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, str(tmp_path)).collect()] == [0]


def test_language_stage_rejects_what_is_no_language(spark, tmp_path):
    rng = random.Random(6)
    known = [(i, " ".join(rng.choice("the cat and this house of that man with her there then other".split()) for _ in range(60)), "en", "s", 1) for i in range(40)]
    noise = [(100 + i, " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(80)), None, "s", 1) for i in range(10)]
    foreign = [(200 + i, " ".join(rng.choice("ja nie wiem czy pan przyszedł był dzień dobry szczęście źródło żółw".split()) for _ in range(60)), None, "s", 1) for i in range(10)]
    docs = spark.createDataFrame(known + noise + foreign, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in dict(corpus_pipeline.STAGES)["language_id"](spark, docs, str(tmp_path)).collect()) == list(range(40))

import random
import zlib
from collections import Counter

from corpora import frame, simple
from helpers import SMALL, duck

from docflow.llm import language_id as lid


def slow_grams(text):
    counts = Counter()
    word = ""
    for c in [*text.lower(), " "]:
        if c.isalpha():
            word += c
        elif word:
            counts.update(word)
            padded = f"_{word}_"
            for n in (2, 3):
                counts.update(padded[i : i + n] for i in range(len(padded) - n + 1))
            word = ""
    return counts


def test_counts_equal_brute_force():
    letters = lid._letters()
    for text in ("The cat, the CAT!", "a", "12 3", "", "ünï 日本 x🎉y 𝒳𝒴 z", " lead and trail "):
        grams, counts = lid.ngrams(text, letters)
        assert sorted(counts.tolist()) == sorted(slow_grams(text).values()), text


def test_held_out_accuracy(spark):
    rows = lid.op7_language_id(spark, SMALL).collect()
    lang = dict(duck(SMALL).execute("select doc_id, lang from documents").fetchall())
    assert len(rows) == len(lang) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    tested = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in tested) >= 0.98 * len(tested) and all(0 <= r["score"] <= 1 for r in rows)


def test_distance_equals_brute_force(spark):
    texts = {"aa": "ana banana anna nab " * 3, "bb": "otto toto lotto pot " * 3}
    rows = [(i, t, k) for i, (k, t) in enumerate(texts.items())]
    profiles = lid.learn_profiles(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    find, letters = lid.Identifier(profiles), lid._letters()
    for text in ("banana", "lotto pot", "xyz", "anna otto"):
        top = lid.top_ranks(*lid.ngrams(text, letters)).view("int64").tolist()
        far = {k: sum(abs(i - p.index(g)) if g in p else lid.PROFILE for i, g in enumerate(top)) for k, p in profiles.items()}
        best = min(far, key=lambda k: (far[k], k))
        assert find(text) == (best, 1 - far[best] / (len(top) * lid.PROFILE))


def test_training_ignores_held_out_and_unlabelled(spark):
    rows = [(i, "aaa bbb" if zlib.crc32(str(i).encode()) % 4 != 2 else "zzz", "x") for i in range(40)] + [(100, "qqq", None), (None, "vvv", "x"), (101, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = set(lid.train(docs)["x"])
    codes = {c: int(lid.ngrams(c, lid._letters())[0][0]) for c in "abzqv"}
    assert {c for c, h in codes.items() if h in seen} == {"a", "b"}
    assert set(lid.train(docs, sample=1)) == {"x"}


def test_odd_rows(spark):
    docs = frame(spark)
    profiles = lid.train(docs)
    rows = lid.identify(docs, profiles).collect()
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    blank = [r["doc_id"] for r in docs.collect() if not any(c.isalpha() for c in r["text"] or "")]
    assert len(rows) == docs.count() and all(by[i] == ("und", 0.0) for i in blank if i is not None)
    kept = lid.keep_identified(docs, profiles)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len(blank)
    assert [tuple(r) for r in lid.identify(simple(spark, ["text"]), {}).collect()] == [(0, "und", 0.0)]
    assert lid.identify(frame(spark, []), profiles).count() == 0 and lid.train(frame(spark, [])) == {}


def test_copies_do_not_fill_the_sample(spark):
    rng = random.Random(9)
    rows = [(i, " ".join("".join(rng.choice("abcdefgh" if k else "stuvwxyz") for _ in range(5)) for _ in range(30)), "ab"[k]) for i in range(400) for k in (i % 2,)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = lid.learn_profiles(docs, 50)
    assert all(len(p) == lid.PROFILE for p in profiles.values())
    for row in rows[:6]:
        copies = spark.createDataFrame([row] * 300 + [(1000 + i, *row[1:]) for i in range(300)], docs.schema)
        assert lid.learn_profiles(docs.unionByName(copies), 50) == profiles

"""Small document tables with every odd case, and the columns that could clash with the operators' own."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, range int, size string, th string, leaks string, cls int, cut string, component int"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def documents(seed=0, n=60):
    rng = random.Random(seed)
    texts = [words(rng, rng.choice((3, 30, 120, 400))) for _ in range(n)]
    line = [words(rng, 60) for _ in range(4)]
    texts += [texts[0], texts[0], texts[1] + " tail", None, "", " \t\n", "one", "Ünï çødé 日本語 🎉", "\n".join(line), "head\n" + "\n".join(line[1:]) + "\nfoot", "x" * 30_000, "a\n" * 500, "many " * 9_000]
    rows = [(i, t, rng.choice(("en", "de", None)), rng.choice(("s1", "s2", "s2", "s2", None)), None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], (None, "a text without an id", "en", "s1", 1), (None, None, None, None, None), (3, "the same id with another text", "en", "s1", 1)]
    return [(*r, "k", 7, "big", "th", "leak", 1, "cut", 2) for r in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def simple(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

import hashlib
import random
import time

from helpers import SMALL, duck, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docflow.llm import chat_format as chat

MESSAGES = "tree long, id long, parent long, role string, text string, score double"
PIECES = st.lists(st.sampled_from(["<|im_end|>", "<|im_start|>", "\\", "<", "|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\n", "a", "[", "n", "ü"]), max_size=12).map("".join)


def test_query_equals_sql(spark):
    assert rows_of(chat.op3_reply_trees(spark, SMALL).toPandas()) == rows_of(duck(SMALL).execute(chat.ORACLE).df())


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), min_size=1, max_size=6))
def test_round_trip(spark, turns):
    rows = [(1, i, i - 1 if i else None, role, text, None) for i, (role, text) in enumerate(turns)] + [(2, 0, None, "assistant", turns[0][1], 1.0)]
    out = {r["tree"]: r for r in chat.read_back(chat.format_trees(spark.createDataFrame(rows, MESSAGES))).collect()}
    assert [(t["role"], t["text"]) for t in out[1]["turns"]] == turns
    assert out[1]["loss_text"] == "".join(t for r, t in turns if r == "assistant") and out[2]["loss_text"] == turns[0][1]
    for control in ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"):
        assert control not in out[1]["formatted"]
    assert out[1]["formatted"].count("<|") == 2 * len(turns)


def test_branches(spark):
    rows = [
        (1, 0, None, "user", "q", 0.0), (1, 1, 0, "assistant", "a", 1.0), (1, 2, 0, "assistant", "b", 5.0), (1, 3, 2, "user", "c", 1.0), (1, 4, 2, "user", "d", 2.0), (1, 4, 2, "user", "d", 2.0),
        (1, 5, 99, "user", "orphan", 9.0), (1, 6, 7, "user", "loop", 9.0), (1, 7, 6, "user", "loop", 9.0), (1, 8, 7, "user", "below a loop", 9.0), (None, 0, None, None, None, None),
    ]
    frame = spark.createDataFrame(rows, MESSAGES)
    every = chat.format_trees(frame, branches=None)
    assert {(r["tree"], r["leaf"]): (r["rank"], round(r["branch_score"], 3)) for r in every.collect()} == {(1, 5): (1, 9.0), (1, 4): (2, 2.333), (1, 3): (3, 2.0), (1, 1): (4, 0.5), (None, 0): (1, 0.0)}
    best = chat.read_back(chat.format_trees(frame, branches=2)).where("tree = 1").orderBy("rank").collect()
    assert [[t["text"] for t in r["turns"]] for r in best] == [["orphan"], ["q", "b", "d"]]
    assert chat.format_trees(frame.limit(0)).count() == 0


def test_deep_tree(spark):
    frame = spark.range(700).select(F.lit(1).cast("long").alias("tree"), "id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit("assistant").alias("role"), F.col("id").cast("string").alias("text"), F.lit(0.0).alias("score"))
    row = chat.read_back(chat.format_trees(frame)).first()
    assert [t["text"] for t in row["turns"]] == [str(i) for i in range(700)] and row["loss_text"] == "".join(map(str, range(700)))


def test_ties_nulls_and_extra_columns(spark):
    rows = [(1, 2, "user", "b", "x"), (1, 2, "assistant", "a", "x"), (1, None, None, None, "x"), (None, 1, "user", "n", "x")]
    trees = chat.linear_messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tree string"))
    out = {r["tree"]: r["turns"] for r in chat.read_back(chat.format_trees(trees)).collect()}
    assert [(t["role"], t["text"]) for t in out[1]] == [("", ""), ("assistant", "a"), ("user", "b")] and [tuple(t) for t in out[None]] == [("user", "n")]


def test_planted_conversation(spark):
    row = chat.op3_reply_trees(spark, SMALL).where("conv_id = -1").first()
    said = "user\n</s>[INST] ok [/INST]\nassistant\n</s>[INST] ok [/INST]\n"
    assert (row["n_turns"], row["turns_sha256"], row["loss_chars"]) == (2, hashlib.sha256(said.encode()).hexdigest(), 21)


def test_leaves_below_a_cycle_store_nothing(spark):
    rows = [(1, 0, 1, "user", "x", 0.0), (1, 1, 0, "user", "y", 0.0)] + [(1, i, i % 2, "user", "leaf", 0.0) for i in range(2, 600)]
    rows += [(2, i, i - 1 if i else None, "user", str(i), 0.0) for i in range(9)]
    frame = spark.createDataFrame(rows, MESSAGES)
    paths = chat.reply_paths(frame)
    assert paths.count() == 9 and {(r["tree"], r["leaf"]) for r in paths.collect()} == {(2, 8)}


def test_paths_equal_walks(spark):
    rng = random.Random(3)
    parents = {i: rng.choice([None, *range(40)]) for i in range(40)}
    frame = spark.createDataFrame([(1, i, p, "user", str(i), 0.0) for i, p in parents.items()], MESSAGES)
    want = set()
    for leaf in set(parents) - set(parents.values()):
        walk, at = [], leaf
        while at is not None and at not in walk:
            walk.append(at)
            at = parents[at]
        if at is None:
            want |= {(leaf, node, d) for d, node in enumerate(walk)}
    assert {(r["leaf"], r["node"], r["dist"]) for r in chat.reply_paths(frame).collect()} == want


def test_reading_back_is_linear(spark):
    def seconds(n):
        turn = chat.START + "assistant\nsome text" + chat.END
        spans = [(i * len(turn) + len(chat.START) + 10, i * len(turn) + len(chat.START) + 19) for i in range(n)]
        frame = spark.createDataFrame([(turn * n, spans)], "formatted string, loss_spans array<struct<start:long,end:long>>")
        began = time.perf_counter()
        row = chat.read_back(frame).select(F.size("turns").alias("n"), "loss_text").first()
        assert row["n"] == n and row["loss_text"] == "some text" * n
        return time.perf_counter() - began

    seconds(10)
    assert seconds(64_000) < 8 * seconds(8_000) + 3

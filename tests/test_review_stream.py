"""Delivery in any order, in pieces and twice over: the stream's states are those of the batch fold."""

import random
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docflow.operators import review
from docflow.streaming import review_stream as rs

COMMANDS = "event_id long, ts timestamp, doc long, decision string, notes string"
START = datetime(2026, 1, 1)


def made(n, seed=1, docs=6):
    rng = random.Random(seed)
    return [(i, START + timedelta(minutes=rng.randrange(600), microseconds=rng.randrange(3)), rng.randrange(docs), rng.choice(("approve", "reject")), rng.choice((None, "", " why ", f"n{i}"))) for i in range(n)]


class Stream:
    """Files that arrive, and the stream over them, run again and again with one checkpoint."""

    def __init__(self, spark, top, **options):
        self.spark, self.top, self.options, self.n = spark, top, options, 0
        (top / "in").mkdir(parents=True)

    def arrive(self, rows):
        self.n += 1
        self.spark.createDataFrame(rows, COMMANDS).coalesce(1).write.parquet(str(self.top / f"part{self.n}"))
        for file in (self.top / f"part{self.n}").glob("*.parquet"):
            shutil.copy(file, self.top / "in" / f"{self.n}-{file.name}")
        commands = self.spark.readStream.schema(COMMANDS).parquet(str(self.top / "in"))
        out = rs.run_available(rs.review_states(commands, **self.options), str(self.top / "out"), str(self.top / "check"))
        return {r["doc"]: tuple(r)[1:] for r in out.collect()}


def folded(spark, rows):
    frame = spark.createDataFrame(rows, COMMANDS).withColumn("notes", F.trim("notes"))
    return {r["doc"]: (r["status"], r["notes"], r["changes"], r["errors"]) for r in review.fold(frame, "doc", ["ts", "event_id"]).collect()}


def test_shuffled_split_and_repeated_delivery(spark, tmp_path):
    rows = made(120)
    rng = random.Random(7)
    delivered = [*rows, *rng.sample(rows, 40)]
    rng.shuffle(delivered)
    stream = Stream(spark, tmp_path, late="2 days")
    for k in range(3):
        got = stream.arrive(delivered[k::3])
    assert got == folded(spark, rows)


def test_an_earlier_command_in_a_later_batch(spark, tmp_path):
    at = lambda minutes: START + timedelta(minutes=minutes)
    stream = Stream(spark, tmp_path, late="1 hour")
    assert stream.arrive([(2, at(5), 1, "reject", "no")]) == {1: ("rejected", "no", 1, 0)}
    assert stream.arrive([(1, at(0), 1, "approve", None)]) == {1: ("rejected", "no", 2, 0)}


def test_settled_commands_and_too_late_ones(spark, tmp_path):
    at = lambda hours: START + timedelta(hours=hours)
    stream = Stream(spark, tmp_path, late="1 hour")
    stream.arrive([(1, at(0), 1, "approve", None), (2, at(1), 2, "reject", "x")])
    stream.arrive([(3, at(50), 3, "approve", None)])  # the watermark passes all before
    stream.arrive([(4, at(60), 3, "approve", None)])
    got = stream.arrive([(5, at(2), 1, "reject", "too late"), (1, at(0), 1, "approve", None), (6, at(61), 1, "reject", "in time"), (7, at(62), 2, "approve", None)])
    assert got == {1: ("rejected", "in time", 2, 0), 2: ("rejected", "x", 1, 1), 3: ("approved", None, 1, 0)}


def test_forgotten_documents_begin_anew(spark, tmp_path):
    at = lambda hours: START + timedelta(hours=hours)
    stream = Stream(spark, tmp_path, late="1 hour", forget_ms=24 * 3600 * 1000)
    stream.arrive([(1, at(0), 1, "reject", "x"), (2, at(0), 2, "reject", "y")])
    stream.arrive([(3, at(10), 2, "approve", None)])
    for k in range(4, 7):  # each run moves the watermark by what the last one saw
        stream.arrive([(k, at(80 + k), 3, "approve", None)])
    got = stream.arrive([(9, at(95), 1, "approve", None)])
    assert got[1] == ("approved", None, 1, 0) and got[2] == ("rejected", "y", 1, 1)


def test_the_session_is_left_as_it_was(spark, tmp_path):
    name = rs.STORE[0]
    before = spark.conf.get(name, None)
    with pytest.raises(RuntimeError), rs.state_store(spark):
        assert spark.conf.get(name) == rs.STORE[1]
        raise RuntimeError
    assert spark.conf.get(name, None) == before

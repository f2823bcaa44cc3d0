import random

import numpy as np
import pytest
from corpora import frame
from hypothesis import given, settings
from hypothesis import strategies as st

from docflow.llm import token_scan


def brute(tokens, end):
    out, start = [], 0
    for i, t in enumerate(tokens):
        if t == end:
            out.append((len(out), start, i - start, True))
            start = i + 1
    return out + ([(len(out), start, len(tokens) - start, False)] if start < len(tokens) else [])


def blocks(spark, files, size):
    rows = [(name, b, np.array(tokens[i : i + size], "<u2").tobytes()) for name, tokens in files.items() for b, i in enumerate(range(0, max(len(tokens), 1), size))]
    return spark.createDataFrame(rows, "file string, block long, tokens binary")


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=60), min_size=1, max_size=3), st.integers(1, 9), st.integers(1, 4))
def test_scan_equals_brute_force(spark, streams, size, group):
    files = {f"f{i}": s for i, s in enumerate(streams)}
    old, token_scan.SUPER = token_scan.SUPER, group
    try:
        got = token_scan.scan_separators(blocks(spark, files, size), 3).collect()
    finally:
        token_scan.SUPER = old
    for name, tokens in files.items():
        assert sorted((r["ordinal"], r["start"], r["n_tokens"], r["finished"]) for r in got if r["file"] == name) == brute(tokens, 3)


@pytest.mark.parametrize("size", [7, 1 << 16])
def test_counts_equal_the_encoder(spark, size, monkeypatch):
    monkeypatch.setattr(token_scan.write_flat_tokens, "__defaults__", (size,))
    docs = frame(spark)
    encoder, n = token_scan.load_encoder(*token_scan.default_tokenizer()[:2])
    assert n == 50256
    rows = [(r["doc_id"], len(encoder.encode_ordinary(r["text"] or ""))) for r in docs.collect()]
    if size == 7:
        docs, rows = docs.where("length(text) < 200 or text is null"), [(r["doc_id"], len(encoder.encode_ordinary(r["text"] or ""))) for r in docs.where("length(text) < 200 or text is null").collect()]
    got = [(r["doc_id"], r["n_tokens"]) for r in token_scan.count_tokens(docs).collect()]
    assert sorted(got, key=str) == sorted(rows, key=str)


def test_flat_files(spark, tmp_path):
    rng = random.Random(3)
    for name, n in (("a", 1000), ("b", 0), ("c", 17)):
        (tmp_path / name).write_bytes(np.array([rng.choice((5, 6, 50256)) for _ in range(n)], "<u2").tobytes())
    got = token_scan.scan_separators(token_scan.read_flat_files(spark, str(tmp_path), 50256, 10), 50256).collect()
    for name in "abc":
        tokens = np.frombuffer((tmp_path / name).read_bytes(), "<u2").tolist()
        assert sorted((r["ordinal"], r["start"], r["n_tokens"], r["finished"]) for r in got if r["file"].endswith("/" + name)) == brute(tokens, 50256)
    assert token_scan.token_type(100_000).itemsize == 4


def test_empty(spark):
    assert token_scan.count_tokens(frame(spark, [])).count() == 0

import random
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from corpora import frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docflow.llm import token_store


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(token_store.default_tokenizer())


def plain(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


WORDS = ["Hello", "WORLD.", "don't", "it's!", "İstanbul", "ñjarr.", "ΣΑΣ", "été", "J̌", "<|endoftext|>", "<|ENDOFTEXT|>", "a<|startoftext|>b", "日本語", "x1y2", "3.14", "...", "a,b", "🎉🎉", "​zero", "ﬁne", "ͅ", "ʼn", "a b", "a B", "\x1c", "#", "(word).", "'tis", "dogs'", "\"quoted\"", "das,***", "(<|endoftext|>)", "-", "İ.", "J\u030c.", "A\u030a", "ABC\u0301."]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(WORDS), st.text(max_size=8)), max_size=12), max_size=4), st.sampled_from([" ", "\n", "  ", "\t", "\r\n"]))
def test_ids_of_words_are_ids_of_texts(tokenizer, texts, space):
    texts = [space.join(words).encode("utf-8", "ignore").decode() for words in texts]
    got = [np.frombuffer(raw, "<u2").tolist() for raw in token_store.WordIds(token_store.default_tokenizer()).encode(pa.array(texts, pa.string()))]
    assert got == [plain(tokenizer, text) for text in texts]


def test_remembered_words_are_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(token_store, "CACHED_WORDS", 40)
    words, rng = token_store.WordIds(token_store.default_tokenizer()), random.Random(1)
    for _ in range(30):
        texts = [" ".join(f"W{rng.randrange(99)}rd Ab{chr(97 + rng.randrange(26))}." for _ in range(9))]
        assert [np.frombuffer(raw, "<u2").tolist() for raw in words.encode(pa.array(texts))] == [plain(tokenizer, texts[0])]
        assert len(words.words) < 60


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 3000), st.integers(0, 2**32))
def test_hash_is_perfect_minimal_and_tells_strangers(n, seed):
    rng = np.random.default_rng(seed)
    h1, h2 = rng.integers(-(2**63), 2**63, (2, n))
    levels, bits, slots = token_store.build(h1, h2)
    assert sorted(slots) == list(range(n)) and len(bits) == sum(levels)
    prints = np.zeros(n, "<u4")
    prints[slots] = token_store.fingerprint(h2)
    assert (token_store.find(levels, bits, prints, h1, h2) == slots).all()
    others = rng.integers(-(2**63), 2**63, (2, 500))
    assert (token_store.find(levels, bits, prints, *others) == -1).all()


def test_equal_hashes_are_an_error():
    with pytest.raises(ValueError):
        token_store.build(np.array([5, 5]), np.array([7, 7]))


def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


@pytest.mark.parametrize(("block_ids", "bucket_keys"), [(50, 5), (1 << 16, 2048)])
def test_files_read_back(spark, tokenizer, tmp_path, block_ids, bucket_keys):
    docs, path = frame(spark), folder(tmp_path)
    token_store.write_token_files(docs, path, block_ids=block_ids, bucket_keys=bucket_keys)
    got = token_store.read_ids(token_store.keys_of(docs), path).collect()
    rows = docs.select("doc_id", "text").collect()
    place = lambda doc_id: (doc_id is not None, doc_id)
    by_start = sorted(got, key=lambda r: r["start"])
    assert [place(r["doc_id"]) for r in by_start] == sorted(place(r["doc_id"]) for r in rows)
    at = 0
    for r in by_start:
        assert r["start"] == at
        at += len(r["ids"]) // 4
    want = sorted((place(r["doc_id"]), [*plain(tokenizer, r["text"]), 2]) for r in rows)
    assert sorted((place(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == want
    assert sorted((place(r["doc_id"]), r["copy"]) for r in got) == sorted((place(r["doc_id"]), r["copy"]) for r in token_store.keys_of(docs).collect())


def test_one_id_with_most_rows_spans_shards(spark, tmp_path):
    rows = [(7, f"text {i % 3}") for i in range(3000)] + [(i, "other") for i in range(0, 20)]
    docs, path = spark.createDataFrame(rows, "doc_id long, text string").repartition(8), folder(tmp_path)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_store.write_token_files(docs, path, block_ids=64, bucket_keys=100)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert spark.read.parquet(f"{path}/shards").select("shard").distinct().count() > 2
    got = token_store.read_ids(token_store.keys_of(docs), path).where("doc_id = 7").orderBy("start").collect()
    assert [r["copy"] for r in got] == list(range(3001)) and len({r["start"] for r in got}) == 3001


def test_keys_that_are_not_there(spark, tmp_path):
    docs, path = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), folder(tmp_path)
    token_store.write_token_files(docs, path)
    keys = spark.createDataFrame([(2, 0), (2, 1), (99, 0), (None, 0)], "doc_id long, copy long")
    assert [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in token_store.read_ids(keys, path).collect()] == [(2, 2 + 1, [2])]


def test_empty(spark, tmp_path):
    path = folder(tmp_path)
    token_store.write_token_files(frame(spark, []), path)
    assert token_store.read_ids(token_store.keys_of(frame(spark, [])), path).count() == 0


def test_query(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    at, want = 0, []
    for r in sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r["doc_id"]):
        ids = np.array([*plain(tokenizer, r["text"]), 2], "<u4")
        want.append((r["doc_id"], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, token_store.op12_token_store(spark, sf).collect())) == want


def test_latin_words_are_told_without_a_look_at_each(monkeypatch):
    """Words of Latin letters are what most words outside of ASCII are; each must have the ids that the tokenizer gives, and none is looked at in Python."""
    letters = [chr(i) for i in (*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100))]
    texts = [" ".join(f"{a}{b}" for b in ("", "a", "B", "é", "Zz")) for a in letters] + ["(Été,) l'été CAFÉ naïve Straße ÀÉÎ İ ª µ"]
    tokenizer = token_store.WordIds(token_store.default_tokenizer()).tokenizer
    want = [plain(tokenizer, t) for t in texts]
    monkeypatch.setattr(token_store, "_stays", lambda core, lower: {"İ": False, "ª": False, "µ": False}[core])
    got = [np.frombuffer(raw, "<u2").tolist() for raw in token_store.WordIds(token_store.default_tokenizer()).encode(pa.array(texts))]
    assert got == want

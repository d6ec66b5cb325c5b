import hashlib
import random

import pytest

from cartwheel.llm import bpe
from cartwheel.llm.tokenizers import tiktoken_encoding
from tests.llm.helpers import DOCS, SF, clashing, docs, odd_texts

ALPHABET = "ab \n\t  cdé'sll\x1c  中文字🙂 12٣'re  THE the\x85K-_=<|endoftext|>"


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(bpe.VOCABULARY)


def text(rng, most=60):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, most)))


def test_encoding_equals_tiktoken(vocab):
    rng, exact = random.Random(1), tiktoken_encoding(bpe.VOCABULARY)
    for x in [text(rng) for _ in range(3000)] + [t or "" for _, t in odd_texts()]:
        ids = bpe.encode(x)
        assert ids == exact.encode_ordinary(x), x
        assert bpe.decode(ids) == x.encode()


def test_every_prefix_and_append_equal_plain_merging(vocab):
    rng = random.Random(2)
    for _ in range(60):
        data = text(rng).encode()
        table = bpe.PrefixTable(vocab, data)
        for end in range(len(data) + 1):
            assert table.tokens(end) == vocab.merged(data[:end])
        more = text(rng).encode()
        table.append(more)
        assert table.tokens() == vocab.merged(data + more)


def test_edits_equal_a_new_table_and_stay_local(vocab):
    rng = random.Random(3)
    for _ in range(150):
        data = text(rng).encode() * rng.randint(1, 8)
        table = bpe.PrefixTable(vocab, data)
        start, end = sorted(rng.randint(0, len(data)) for _ in "ab")
        new = text(rng, 8).encode()
        table.replace(start, end, new)
        assert table.data == data[:start] + new + data[end:]
        assert table.last == bpe.PrefixTable(vocab, table.data).last
    long = b" the quick brown fox" * 400
    assert bpe.PrefixTable(vocab, long).replace(100, 103, b"xyz") < 300


def test_other_vocabulary_with_ties():
    toy = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"aaa": 257, b"ab": 258, b"aab": 259, b"ba": 260, b"abab": 261}
    vocab, rng = bpe.Vocabulary(toy), random.Random(5)
    for _ in range(400):
        data = "".join(rng.choice("ab") for _ in range(rng.randint(0, 14))).encode()
        assert bpe.PrefixTable(vocab, data).tokens() == vocab.merged(data)


def test_rows(spark):
    data, exact = odd_texts(), tiktoken_encoding(bpe.VOCABULARY)
    table = clashing(docs(spark, data))
    expected = sorted(((k, len(i), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
                       for k, t in data for i in [exact.encode_ordinary(t or "")]), key=repr)
    assert sorted((tuple(r) for r in bpe.round_trip_digest(table).collect()), key=repr) == expected
    encoded = bpe.encode_rows(table)
    assert {(r["doc_id"], bytes(r["data"])) for r in bpe.decode_rows(encoded).collect()} == {(k, (t or "").encode()) for k, t in data}
    empty = spark.createDataFrame([], DOCS)
    assert bpe.round_trip_digest(empty).collect() == [] and bpe.encode_rows(empty).collect() == []


def test_whole_table_round_trip(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    exact = tiktoken_encoding(bpe.VOCABULARY)
    found = {r["doc_id"]: r["n_tokens"] for r in bpe.round_trip_digest(table).collect()}
    assert found == {r["doc_id"]: len(exact.encode_ordinary(r["text"] or "")) for r in table.collect()}


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    encoder = bpe._Encoder(bpe.VOCABULARY)
    monkeypatch.setattr(bpe, "_encoder", lambda name: encoder)
    x = "The the these, there. then thin think thing " * 3
    assert bpe.encode(x) == tiktoken_encoding(bpe.VOCABULARY).encode_ordinary(x)

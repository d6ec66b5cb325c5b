import random
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cartwheel.llm import packing as P
from cartwheel.llm.common import written
from cartwheel.llm.tokenizers import hf_tokenizer
from tests.llm.helpers import DOCS, SF, clashing, docs, odd_texts


def fewest(sizes, capacity):
    """Exact bin packing of a few pieces."""
    best = len(sizes)

    def place(left, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if not left:
            best = len(rooms)
            return
        for room in sorted(set(rooms)):
            if room >= left[0]:
                i = rooms.index(room)
                place(left[1:], rooms[:i] + [room - left[0]] + rooms[i + 1:])
        place(left[1:], rooms + [capacity - left[0]])
    place(sorted(sizes, reverse=True), [])
    return best


def used(plan, capacity, counts):
    made = [0] * (capacity + 1)
    for filling, times in plan:
        assert sum(filling) <= capacity and times > 0
        for n in filling:
            made[n] += times
    assert made == counts
    return sum(times for _, times in plan)


def test_small_plans_are_optimal():
    rng = random.Random(1)
    for _ in range(150):
        capacity = rng.randint(5, 20)
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 9))]
        counts = [sizes.count(n) for n in range(capacity + 1)]
        plan, lower = P.bin_completion(counts, capacity)
        n = used(plan, capacity, counts)
        assert lower <= n and n == fewest(sizes, capacity), (capacity, sizes, plan)


def test_large_plans_stay_near_the_bound():
    rng = random.Random(2)
    for _ in range(5):
        counts = [0] * 1025
        for _ in range(rng.choice([500, 20_000])):
            counts[rng.randint(1, 1024)] += 1
        plan, lower = P.bin_completion(counts)
        n = used(plan, 1024, counts)
        assert n <= sum(t for _, t in P.best_fit(counts, 1024)) and n <= lower * 1.03 + 2


@pytest.mark.parametrize("low, high, n, most", [(200, 500, 20_000, 7_195), (200, 500, 2_000, 713), (250, 420, 3_000, 987)])
def test_search_beats_best_fit_on_middle_lengths(low, high, n, most):
    counts = np.bincount(np.random.default_rng(5).integers(low, high, n), minlength=1025).tolist()
    start = time.monotonic()
    plan, lower = P.bin_completion(counts)
    assert time.monotonic() - start < 10
    assert lower <= used(plan, 1024, counts) <= most < used(P.best_fit(counts, 1024), 1024, counts)


def test_a_filling_is_used_fewer_times_where_that_is_better():
    # around 6, the filling 6 + 4 twice leaves 3 + 3 + 3 + 1 with 5 + 5; used once the rest fills its sequences
    for sizes, capacity in (((6, 6, 4, 4, 3, 3, 3, 1, 5, 5), 10), ((7, 7, 3, 3, 2, 2, 2, 1, 1, 1, 6, 5), 10)):
        counts = [sizes.count(k) for k in range(capacity + 1)]
        assert used(P.bin_completion(counts, capacity)[0], capacity, counts) == fewest(sizes, capacity)
    assert list(P._times(10)) == [10, 5, 2, 1] and list(P._times(0)) == []


def test_very_long_white_space_and_special_strings(spark):
    texts = ["x" + " " * 1_000_000 + "y", "\n" * 2_000_000, "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext|", " <|endoftext|>\n"]
    assert P.token_ids(texts[2]).tolist() == [64, 220, 50256, 275]
    data = list(enumerate(texts))
    verify(P.pack_documents(docs(spark, data)).collect(), data)


def test_ids_equal_the_tokenizers_library():
    tokenizer, rng = hf_tokenizer("byte_bpe_50k.json"), random.Random(3)
    special = "<|endoftext|>"
    texts = [t or "" for _, t in odd_texts()] + ["".join(rng.choice(["a", " ", "\n", special, special[:-1], "|>", "é"]) for _ in range(rng.randint(0, 12)))
                                                 for _ in range(500)] + ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(160, 0x2FFF), 32, 10, rng.randint(0x1F300, 0x1F6FF)]))
                                                        for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    for t in texts:
        assert P.token_ids(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def verify(rows, data, capacity=1024):
    tokenizer = hf_tokenizer("byte_bpe_50k.json")
    at = defaultdict(list)
    for r in rows:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    expected = []
    for k, t in data:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, P.END_ID], dtype="<u4")
        for p, (s, n) in enumerate(P.cut(len(ids), capacity)):
            expected.append((k, p, s, n, zlib.crc32(ids[s:s + n].tobytes())))
    found = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    return len(at)


def test_odd_rows(spark):
    data = odd_texts()
    verify(P.pack_documents(docs(spark, data)).collect(), data)
    verify(P.pack_documents(clashing(docs(spark, data)).drop("piece", "offset"), capacity=1024).collect(), data)
    assert P.pack_documents(spark.createDataFrame([], DOCS)).collect() == []


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    n = verify(P.pack_documents(table).collect(), [(r["doc_id"], r["text"]) for r in table.collect()])
    counts = [0] * 1025
    for r in P.pieces(table).select("length").collect():
        counts[r["length"]] += 1
    assert n == sum(t for _, t in P.bin_completion(counts)[0])


def test_only_longer_documents_are_cut():
    assert P.cut(1024, 1024) == [(0, 1024)]
    assert P.cut(1025, 1024) == [(0, 1), (1, 1024)]
    assert P.cut(2048, 1024) == [(0, 1024), (1024, 1024)]


def test_sequences_hold_the_ids(spark):
    data = [(i, "word " * (i + 1)) for i in range(40)]
    placed = P.pack(written(P.pieces(docs(spark, data), capacity=64, with_ids=True), "t"), capacity=64)
    found = sorted(i for r in P.sequences(placed).collect() for i in r["ids"])
    assert found == sorted(i for _, t in data for i in [*P.token_ids(t).tolist(), P.END_ID])
    assert all(len(r["ids"]) <= 64 for r in P.sequences(placed).collect())

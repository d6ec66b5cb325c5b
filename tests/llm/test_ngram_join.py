import random
import re
from collections import Counter

import numpy as np
import pytest

from cartwheel.llm import ngram_join as N
from cartwheel.llm.components import connected_components
from tests.llm.helpers import DOCS, LONG, SF, Links, clashing, docs, odd_texts, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(data):
    sets = [(k, shingles(t)) for k, t in data]
    links = Links({k for k, _ in data if k is not None})
    holders = {}
    for i, (k, s) in enumerate(sets):
        if k is None:
            continue
        shared = Counter(j for g in s for j in holders.get(g, ()))
        for j, c in shared.items():
            if 100 * c >= 80 * (len(s) + len(sets[j][1]) - c):
                links.join(k, sets[j][0])
        for g in s:
            holders.setdefault(g, []).append(i)
    return sorted(((k, len(s), None if k is None else links.find(k)) for k, s in sets), key=repr)


def found(df):
    return sorted((tuple(r) for r in N.jaccard_components(df).collect()), key=repr)


def edited(rng, base, share):
    out = list(base)
    for _ in range(max(1, int(share * len(out)))):
        at = rng.randrange(len(out))
        out[at:at + 1] = rng.choice([[], words(rng, 1), words(rng, 2)])
    return out


def test_odd_rows(spark):
    data = odd_texts() + [(20, LONG + " end"), (21, "One TWO three four"), (22, "x\x0by z")]
    assert found(docs(spark, data)) == brute(data)
    assert found(clashing(docs(spark, data))) == brute(data)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_near_the_threshold(spark, seed):
    rng, data = random.Random(seed), []
    passage = words(rng, 60)
    for _ in range(40):
        base = words(rng, rng.randint(3, 120), 400)
        if rng.random() < 0.4:
            base += passage
        for _ in range(rng.choice([1, 1, 2, 5])):
            data.append((len(data) * 3 + 1, " ".join(edited(rng, base, rng.choice([0.01, 0.02, 0.04, 0.08])))))
    rng.shuffle(data)
    assert found(docs(spark, data)) == brute(data)


def test_groups_are_compared_in_blocks_and_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(N, "LONG", 3)
    monkeypatch.setattr(N, "RESIDENTS", 8)
    monkeypatch.setattr(N, "VISITORS", 5)
    monkeypatch.setattr(N, "FREQUENT", 4)
    monkeypatch.setattr(N, "MOST_FREQUENT", 100)
    rng, data = random.Random(7), []
    base, passage = words(rng, 80, 500), words(rng, 50, 500)
    for _ in range(90):
        data.append((len(data), " ".join(edited(rng, base, 0.03))))
    for _ in range(60):
        data.append((len(data), " ".join(words(rng, 20, 2000) + passage + words(rng, rng.randint(5, 60), 2000))))
    for _ in range(30):
        data.append((len(data), " ".join(base)))
    assert found(docs(spark, data).repartition(5)) == brute(data)


def test_given_documents(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(table) == brute([(r["doc_id"], r["text"]) for r in table.collect()])


def test_empty_table(spark):
    assert N.jaccard_components(spark.createDataFrame([], DOCS)).collect() == []


def test_keep_representatives(spark):
    data = odd_texts()
    kept = N.keep_representatives(docs(spark, data))
    gone = {k for k, _, c in brute(data) if k is not None and k != c}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(k for k, _ in data if k is not None and k not in gone)


def test_bounds_never_lose_a_link():
    rng = np.random.default_rng(3)
    for _ in range(3000):
        a = np.unique(rng.integers(0, 90, rng.integers(1, 60)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(90, 99, rng.integers(0, 5)).astype(np.uint64)]))
        if not len(b):
            continue
        c = len(np.intersect1d(a, b))
        real = 100 * c >= 80 * (len(a) + len(b) - c)
        assert N.linked(a, b) == real
        if real:
            assert N.may_link(N.parity_bitmap(a), N.parity_bitmap(b), len(a), len(b))
            assert len(np.intersect1d(a[:N.prefix_length(len(a))], b[:N.prefix_length(len(b))]))


def test_shingle_hashes_follow_the_words():
    texts = ["a b c d e f", "A  b\tc d\ne F", "a b c d e", "ab c d e f", "a", "b", "a b", "", " ", "É b c d e", "é b c d e", "a b c d a b c d a b c d"]
    raw = "".join(texts).encode()
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    sets = N.shingle_sets(off, np.frombuffer(raw, dtype=np.uint8))
    real = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in real]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(np.intersect1d(sets[i], sets[j])) == len(real[i] & real[j]), (texts[i], texts[j])


def test_overlaps_from_a_similar_set_equal_those_from_scratch():
    rng = np.random.default_rng(6)
    base = np.unique(rng.integers(0, 400, 120).astype(np.uint64))
    sets = [np.unique(np.concatenate([base[rng.random(len(base)) < 0.9], rng.integers(400, 500, 6).astype(np.uint64)])) for _ in range(40)]
    block = N._Block(list(range(40)), sets, N.SHARE)
    derived = 0
    for x in [*sets, np.array([1000], dtype=np.uint64), base]:
        before = block.known
        assert block.overlaps(x).tolist() == [len(np.intersect1d(x, y)) for y in sets]
        derived += block.known is before
    assert derived > 30


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(500 + i, 501 + i) for i in range(60)] + [(700, 700 + i) for i in range(1, 90)] + [(900, None), (7, 7)]
    links = Links({x for e in edges for x in e if x is not None})
    for a, b in edges:
        if b is not None:
            links.join(a, b)
    out = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {n: links.find(n) for n in {x for a, b in edges if b is not None and a != b for x in (a, b)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from cartwheel.llm import weighted_sampling as W
from cartwheel.llm.queries import QUERIES
from tests.llm.helpers import SF, clashing, docs, odd_texts, rows, words

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
MASK = 2 ** 64 - 1


def weighted(text):
    return Counter(WORD.findall(text.encode().lower()))  # bytes.lower() changes A-Z alone


def jaccard(a, b):
    a, b = weighted(a), weighted(b)
    return sum((a & b).values()) / max(sum((a | b).values()), 1)


def mixed(x):
    for _ in range(2):
        x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & MASK
    return x ^ (x >> 32)


def gamma(bits):
    return -math.log(((bits >> 32) + 0.5) * 2.0 ** -32 * (((bits & 0xFFFFFFFF) + 0.5) * 2.0 ** -32))


def brute_signature(text, samples):
    """One word and sample after the other, with Python's numbers."""
    out = []
    for d in range(samples):
        seed, best = mixed(((d + 1) * 0x9E3779B97F4A7C15) & MASK), None
        for word, weight in weighted(text).items():
            h = xxhash.xxh3_64_intdigest(word)
            one = mixed(h ^ seed)
            two = mixed((one + 0x632BE59BD9B4E019) & MASK)
            b = (mixed((two + 0x632BE59BD9B4E019) & MASK) >> 11) * 2.0 ** -53
            r, c = gamma(one), gamma(two)
            t = math.floor(math.log(weight) / r + b)
            drawn = (c * math.exp(-r * (t + 1 - b)), max(((h + t * 0x9E3779B97F4A7C15) * 0xD6E8FEB86659FD93 & MASK) >> 48, 1))
            best = min(best or drawn, drawn)
        out.append(best[1] if best else 0)
    return out


def brute(table, samples=W.SAMPLES):
    """(key, n_chars, edited hash, fingerprints, likenesses), for distinct keys."""
    ordered = sorted(((k, t or "") for k, t in table), key=lambda r: (r[0] is not None, r[0]))
    out = []
    for (k, t), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        n = len(t)
        changed = t[:n - n // 4] + following[:n // 4]
        mine, other, theirs = (brute_signature(x, samples) for x in (t, changed, following))
        digits = ["".join(f"{s:04x}" for s in sig) for sig in (mine, other)]
        out.append((k, n, hashlib.sha256(changed.encode()).hexdigest(), *digits,
                    sum(a == b for a, b in zip(mine, other)) / samples, sum(a == b for a, b in zip(mine, theirs)) / samples))
    return sorted(out, key=repr)


def texts(seed, n=60):
    rng = random.Random(seed)
    return [(i * 7 % 101, " ".join(words(rng, rng.randint(0, 40), 30)) + rng.choice(["", " É🙂", "\n"])) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 5])
def test_equals_brute_force(spark, parts, monkeypatch):
    monkeypatch.setattr(W, "BATCH_BYTES", 300)
    table = texts(1)
    df = docs(spark, table).repartition(parts)
    assert rows(W.compare_with_next(df, samples=16)) == brute(table, 16)


def test_signatures_by_chunks(monkeypatch):
    many = [t for _, t in texts(2)]
    whole = W.signatures(pa.array(many), 24)
    assert whole.tolist() == [brute_signature(t, 24) for t in many]
    monkeypatch.setattr(W, "CHUNK", 5)
    assert (W.signatures(pa.array(many), 24) == whole).all()


def test_collision_rate_is_the_generalised_jaccard_similarity():
    rng = random.Random(3)
    base = words(rng, 300, 80)
    for share in (0.0, 0.2, 0.5, 0.9, 1.0):
        other = [w if rng.random() < share else f"x{rng.randrange(80)}" for w in base] + base[:int(60 * share)]
        a, b = " ".join(base), " ".join(other)
        found = W.likeness(*(W.signatures(pa.array([t]), 4_000) for t in (a, b)))[0]
        true = jaccard(a, b)
        assert abs(found - true) <= 4 * math.sqrt(max(true * (1 - true), 1e-6) / 4_000) + 1e-3


def test_weights_count():
    few, many = "a b", "a a a a a a a b"
    found = W.likeness(*(W.signatures(pa.array([t]), 4_000) for t in (few, many)))[0]
    assert abs(found - 0.25) < 0.03  # as sets they would be equal
    assert (W.signatures(pa.array(["B a\tA"]), 64) == W.signatures(pa.array(["a  a\nb"]), 64)).all()


def test_odd_texts(spark):
    table = [(None if k is None else 100 * k + i, t) for i, (k, t) in enumerate(odd_texts())] + [(50, "q " * 200_000), (51, "w" * 1_000_000)]
    expected = brute(table, 8)
    assert rows(W.compare_with_next(docs(spark, table), samples=8)) == expected
    assert rows(W.compare_with_next(clashing(docs(spark, table)).withColumn("text2", F.lit(1)).withColumn("part", F.lit(1)), samples=8)) == expected
    assert rows(W.compare_with_next(docs(spark, []))) == []
    one = rows(W.compare_with_next(docs(spark, [(5, "only this one here")]), samples=8))
    assert one == brute([(5, "only this one here")], 8) and one[0][-1] == 1.0
    prints = {r["doc_id"]: r["fingerprint"] for r in W.fingerprints(docs(spark, table), samples=8).collect()}
    assert prints == {r[0]: r[3] for r in expected}


def test_repeated_rows_and_keys(spark):
    """Rows of one key follow each other by hash; a third of all rows equal, dealt over several partitions."""
    table = [(5, "same words again")] * 40 + [(5, f"other {i}") for i in range(10)] + texts(4, 50)
    found = rows(W.compare_with_next(docs(spark, table).repartition(6), samples=8))
    assert len(found) == len(table)
    by_text = Counter(r[3] for r in found)
    assert by_text == Counter("".join(f"{s:04x}" for s in brute_signature(t, 8)) for _, t in table)
    equal = [r for r in found if r[0] == 5 and r[-1] == 1.0]
    assert len(equal) >= 39


def test_edited():
    assert W.edited("abcdefgh", "XYZ") == "abcdefXY"
    assert W.edited("abcdefgh", "X") == "abcdefX"
    assert W.edited("abc", "X") == "abc" and W.edited("", "X") == ""
    assert W.edited("🙂🙂🙂🙂", "é") == "🙂🙂🙂é"


def test_registered_query(spark):
    table = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = {r["doc_id"]: r for r in QUERIES["op13_weighted_fingerprints"](spark, SF).collect()}
    assert len(found) == len(table)
    ordered = sorted(table)
    signed = {}
    for (k, t), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        changed, r = W.edited(t or "", following or ""), found[k]
        assert r["n_chars"] == len(t or "") and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert signed.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        for near, other in ((r["near_edited"], changed), (r["near_next"], following or "")):
            true = jaccard(t or "", other) if weighted(t or "") or weighted(other) else 1.0
            assert abs(near - true) <= 5 * math.sqrt(max(true * (1 - true), 0.02) / W.SAMPLES)
    assert np.mean([r["near_edited"] for r in found.values()]) > np.mean([r["near_next"] for r in found.values()]) + 0.3

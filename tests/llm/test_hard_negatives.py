import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import hard_negatives as H
from cartwheel.llm.queries import QUERIES
from tests.llm.helpers import SF, rows

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(table, every=3, positives=5, negatives=3, low=50, high=95, scale=256):
    """Straight from the definition, with Python integers and every window searched by itself."""
    whole = {}
    for vec_id, v, label in table:
        if vec_id is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = tuple(math.floor(scale * x) for x in v)
        whole[vec_id] = min(whole.get(vec_id, (label, ints)), (label, ints))
    out = []
    for a, (label, v) in whole.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), b) for b, (_, w) in whole.items() if b != a and len(w) == len(v))
        same = [(-s, b) for s, b in scored if whole[b][0] == label][:positives]
        for p, positive in same:
            window = [(-s, b) for s, b in scored if whole[b][0] != label and low * p <= -100 * s <= high * p][:negatives]
            out += [(a, positive, i + 1, b, p, s) for i, (s, b) in enumerate(window)]
    return sorted(out, key=repr)


def found(df, every=3, **settings):
    return rows(H.mine(df, F.col("vec_id") % every == 0, F.col("label"), **settings))


def clusters(seed, groups=12, most=9, dim=6, labels=4, spread=0.5):
    rng, out = np.random.default_rng(seed), []
    for _ in range(groups):
        centre = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, most))):
            out.append((len(out), (centre + rng.normal(size=dim) * spread).tolist(), int(rng.integers(0, labels))))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    table = clusters(seed)
    assert found(spark.createDataFrame(table, SCHEMA)) == brute(table)


def test_many_parts_and_tiles(spark, monkeypatch):
    table = clusters(4, groups=30, most=14)
    expected = brute(table, every=2)
    assert found(spark.createDataFrame(table, SCHEMA), every=2, part_rows=13) == expected
    monkeypatch.setattr(H, "TILE_ANCHORS", 3)
    monkeypatch.setattr(H, "TILE_ROWS", 5)
    part, anchors = H._Part(), []
    for vec_id, v, label in table:
        raw = np.floor(256 * np.array(v)).tobytes()
        part.add(vec_id, label, 6, raw)
        if vec_id % 2 == 0:
            anchors.append({"vec_id": vec_id, "label": label, "dim": 6, "raw": raw})
    columns = [np.concatenate(c) for c in H._positives(anchors, part, 5)]
    positives = {}
    for a, _, s, b in zip(*columns):
        positives.setdefault(int(a), []).append((int(s), int(b)))
    assert all(p == sorted(p, key=lambda x: (-x[0], x[1])) for p in positives.values())
    assert {(a, b, s) for a, p in positives.items() for s, b in p} >= {(r[0], r[1], r[4]) for r in expected}


@pytest.mark.parametrize("low, high, positives, negatives", [(0, 100, 3, 4), (80, 120, 1, 1), (95, 50, 5, 3), (50, 95, 8, 2)])
def test_other_windows(spark, low, high, positives, negatives):
    table = clusters(5)
    settings = dict(low=low, high=high, positives=positives, negatives=negatives)
    assert found(spark.createDataFrame(table, SCHEMA), **settings) == brute(table, **settings)


def test_hot_label_and_ties(spark):
    rng = np.random.default_rng(6)
    table = [(i, [float(x) for x in rng.integers(0, 3, 4)], 0 if i % 3 else i % 5) for i in range(240)]
    assert found(spark.createDataFrame(table, SCHEMA).repartition(5), part_rows=50) == brute(table)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0]
    table = [(0, v, 1), (0, v, 1), (3, v, 1), (3, [0.5, 1.0, 1.0], 0), (6, None, 1), (9, [1.0, nan, 1.0], 1), (12, [1.0, inf, 1.0], 1), (15, [1.0, None], 1),
             (18, v, None), (None, v, 1), (21, [], 1), (22, [], 2), (24, [], 1), (25, [1.0, 2.0], 2), (27, [1.0, 2.0], 1), (30, [2.0, 1.0], 1),
             (1, [0.7, 1.0, 2.0], 2), (2, [0.6, 1.2, 2.0], 2), (4, [0.6, 1.2, 2.0], 2), (5, [-1.0, -2.0, -3.0], 1), (7, [0.0, 0.0, 0.0], 2), (33, [-3.0, 0.0, 0.0], 1),
             (36, [1e12, 2e12], 3), (37, [1e12, 1.5e12], 3), (38, [1e12, 1e12 + 1 / 256], 4), (39, [1e12, 1e12], 4)]
    df = spark.createDataFrame(table, SCHEMA)
    capped = [(*r[:4], *(min(x, 2 ** 63 - 1) for x in r[4:])) for r in brute([r for r in table if r[0] is None or r[0] < 36])]
    assert [r for r in found(df) if r[0] < 36] == capped
    clash = df
    for name in ("part", "is_anchor", "dim", "raw", "slot", "score", "place", "anchor_id"):
        clash = clash.withColumn(name, F.lit("clash"))
    assert found(clash) == found(df)
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(0, v, 1)], SCHEMA)) == []


def test_scores_beyond_doubles_are_exact():
    rng = np.random.default_rng(7)
    a = np.floor(rng.normal(size=(6, 5)) * 2.0 ** 30)
    exact = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in a] for p in a]
    assert H.scores(a, a).tolist() == exact
    assert H.scores(a * 2.0 ** 10, a)[0, 0] == 2 ** 63 - 1


def test_suffix_merge_is_every_limits_top(spark):
    slots = {1: [(90, 1)], 3: [(50, 7), (50, 8), (40, 2)], 5: [(10, 3)]}
    df = spark.createDataFrame([(slots,)], "by_slot map<int,array<struct<score:bigint,other_id:bigint>>>")
    merged = df.select(H.suffix_merged(F.col("by_slot"), 5, 3).alias("m")).first()["m"]
    flat = [[tuple(x) for j in range(i, 6) for x in slots.get(j, [])][:3] for i in range(1, 6)]
    assert [[tuple(x) for x in run] for run in merged[:5]] == flat


def test_limits():
    assert H.limits([100, 10, 0, -10], 50, 95) == ([95, 9, 0, -10], 0, 95)
    assert H.limits([-5], 50, 95) == ([-5], None, None)


def test_registered_query(spark):
    table = [(r["vec_id"], r["embedding"], None if r["label"] is None else (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
             for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert rows(QUERIES["op12_slot_negatives"](spark, SF)) == brute(table, every=50)

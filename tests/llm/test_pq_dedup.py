import math

import numpy as np
import pytest

from cartwheel.llm import pq_dedup as Q
from tests.llm.helpers import SF, Links

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=Q.COSINE):
    links, degree = Links([r[0] for r in rows]), {r[0]: 0 for r in rows}
    units = []
    for _, v, label in rows:
        ok = v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.array(v, dtype=np.float32).astype(np.float64) if ok else None
        units.append(x / np.linalg.norm(x) if ok else None)
    for i, (a, _, la) in enumerate(rows):
        for j in range(i):
            b, _, lb = rows[j]
            if units[i] is not None and units[j] is not None and la == lb and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine:
                degree[a] += 1
                degree[b] += 1
                links.join(a, b)
    return sorted((k, degree[k], links.find(k), links.find(k) == k) for k in degree)


def found(df, **settings):
    return sorted(tuple(r) for r in Q.near_duplicates(df, **settings).collect())


def clusters(seed, groups, most, dim=16, labels=3):
    rng, rows = np.random.default_rng(seed), []
    for _ in range(groups):
        centre, label = rng.normal(size=dim), int(rng.integers(0, labels))
        for _ in range(int(rng.integers(1, most))):
            rows.append((len(rows), (centre + rng.normal(size=dim) * rng.choice([0.0, 0.1, 0.25, 0.35])).tolist(), label))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = clusters(seed, 60, 9)
    assert found(spark.createDataFrame(rows, SCHEMA), slack=1.0, per_cell=20) == brute(rows)


@pytest.mark.parametrize("dim, per_cell", [(2, 4), (4, 4), (16, 8)])
def test_production_slack_loses_no_link_with_many_cells(spark, dim, per_cell):
    rng = np.random.default_rng(dim)
    centres = rng.normal(size=(120, dim))
    rows = [(i, (centres[i % 120] + rng.normal(size=dim) * 0.2).tolist(), 0) for i in range(480)]
    assert found(spark.createDataFrame(rows, SCHEMA), per_cell=per_cell) == brute(rows)


def test_hot_cell_in_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(Q, "MEMBERS", 16)
    monkeypatch.setattr(Q, "VISITORS", 24)
    rows = clusters(3, 6, 60, labels=1) + [(5000 + i, [1.0] * 16, 0) for i in range(50)]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4), slack=1.0, per_cell=30) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, 1), (3, [2.0, 4.0, 6.0], 1), (4, v, None), (5, None, 1), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, nan, 3.0], 1), (8, [inf, 1.0, 1.0], 1),
            (9, [], 1), (10, [1.0, None, 3.0], 1), (11, [1.0, 2.0], 1), (12, [1.0, 2.0], 1), (13, [-1.0, -2.0, -3.0], 1), (14, v, 2), (15, [1e-30, 2e-30, 3e-30], 1)]
    table = spark.createDataFrame(rows, SCHEMA)
    assert found(table) == brute(rows)
    from pyspark.sql import functions as F
    assert found(table.withColumn("cell", F.lit("clash")).withColumn("key", F.lit("clash")).withColumn("block", F.lit(1))) == brute(rows)
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(4, v, None)], SCHEMA)) == [(4, 0, 4, True)]


def test_recall_on_the_given_vectors(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    exact = brute([(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()])
    rows = found(table, per_cell=16)
    links, whole = sum(r[1] for r in rows), sum(r[1] for r in exact)
    assert links <= whole and links >= 0.9 * whole
    assert all(a[1] <= b[1] for a, b in zip(rows, exact))


def test_distances_bound_the_codes():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 20))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = Q.fit(x[:200], 6)
    home, _ = index.assign(x, 0.2)
    codes, error = index.encode(x, home)
    for cell in range(6):
        mine = np.flatnonzero(home == cell)
        if len(mine):
            exact = np.linalg.norm(x[:, None] - x[mine][None], axis=2)
            assert (index.distances(x, cell, codes[mine]) - error[mine][None] <= exact + 1e-9).all()

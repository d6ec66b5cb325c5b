import zlib
from collections import Counter, defaultdict

import pytest

from cartwheel.llm import sharding
from tests.llm.helpers import DOCS, clashing, docs, odd_texts


def check(placed, shards):
    slots = defaultdict(list)
    for r in placed:
        slots[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < shards and r["grown_shard"] in (r["shard"], shards) and r["law"] == "key"
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))


def test_odd_rows(spark):
    data = odd_texts()
    for table in (docs(spark, data), clashing(docs(spark, data)).drop("shard")):
        placed = sharding.shard_rows(table).collect()
        assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in placed if r["doc_id"] is not None) == sorted(
            (k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in data if k is not None)
        assert len(placed) == len(data)
        check(placed, 8)
        assert len({r["shard"] for r in placed if r["doc_id"] == 2}) == 1


def test_shares_follow_weights_and_growth_moves_little(spark):
    table = docs(spark, [(i, "x") for i in range(6000)])
    placed = sharding.shard_rows(table, weights=(1, 1, 2), added_weight=1, parts=16).collect()
    check(placed, 3)
    share = Counter(r["shard"] for r in placed)
    assert abs(share[2] / 6000 - 0.5) < 0.03 and abs(share[0] / 6000 - 0.25) < 0.03
    assert abs(sum(r["grown_shard"] == 3 for r in placed) / 6000 - 0.2) < 0.03
    grown = sharding.shard_rows(table, weights=(1, 1, 2, 1)).collect()
    assert {r["doc_id"]: r["shard"] for r in grown} == {r["doc_id"]: r["grown_shard"] for r in placed}


def test_empty_and_bad_weights(spark):
    assert sharding.shard_rows(spark.createDataFrame([], DOCS)).collect() == []
    with pytest.raises(ValueError):
        sharding.shard_rows(spark.createDataFrame([], DOCS), weights=())


def test_plan_is_native(spark):
    plan = sharding.shard_rows(docs(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))

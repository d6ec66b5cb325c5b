import hashlib
from collections import defaultdict

import pytest

from cartwheel.llm import exact_dedup
from tests.llm.helpers import DOCS, clashing, docs, odd_texts, rows


def brute(data, largest=True):
    groups = defaultdict(list)
    for k, t in data:
        groups[t or ""].append(k)
    out = []
    for k, t in data:
        keys = [x for x in groups[t or ""] if x is not None]
        keep = (max if largest else min)(keys) if keys else None
        out.append((k, keep, len(groups[t or ""]), k == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("nodes", [1, 17])
def test_odd_rows(spark, keep, nodes):
    data = odd_texts()
    for table in (docs(spark, data), clashing(docs(spark, data))):
        assert rows(exact_dedup.exact_dedup(table, keep=keep, nodes=nodes)) == brute(data, keep == "largest")


def test_hot_group_and_negative_keys(spark):
    data = [(i - 300, "hot") for i in range(600)] + [(1000 + i, f"text {i % 90}") for i in range(300)]
    assert rows(exact_dedup.exact_dedup(docs(spark, data).repartition(7))) == brute(data)


def test_empty_table(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], DOCS)).collect() == []


def test_drop_copies_keeps_the_columns(spark):
    data = odd_texts()
    table = docs(spark, data)
    kept = exact_dedup.drop_copies(table)
    assert kept.columns == table.columns
    expected = sorted({(k, t) for k, t in data if (k, t) not in {(1, "same text here"), (3, None), (4, ""), (7, data[7][1])}}, key=repr)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == expected


def test_drop_copies_without_repeated_rows_deals_no_texts(spark):
    data = [(i, f"text {i % 40}") for i in range(60)] + [(None, "text 1"), (100, None)]
    kept = exact_dedup.drop_copies(docs(spark, data))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted([(i, f"text {i % 40}") for i in range(20, 60)] + [(100, None)])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan


def test_every_node_has_a_partition_of_its_own(spark):
    from pyspark.sql import functions as F
    rows_ = [(n, bytes([n]) * 32, 0, n, 1) for n in range(16)]
    entries = spark.createDataFrame(rows_, "_node int, digest binary, check long, best long, rows long")
    merged = exact_dedup.merge_runs(entries, 16, 1).withColumn("p", F.spark_partition_id())
    held = merged.select("_node", "p").distinct().collect()
    assert all(r["_node"] == r["p"] for r in held)

import zlib

import numpy as np
import pytest

from cartwheel.llm import quality_fm as Q
from tests.llm.helpers import DOCS, clashing, docs, odd_texts

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def test_identity_equals_all_pairs():
    rng = np.random.default_rng(1)
    d = Q.BUCKETS + len(Q.STATISTICS)
    machine = Q.Machine(np.zeros(len(Q.STATISTICS)), np.ones(len(Q.STATISTICS)), 0.3, rng.normal(size=d), rng.normal(size=(d, 3)))
    x = np.zeros(d)
    used = rng.choice(d, 12, replace=False)
    x[used] = rng.normal(size=12)
    pairs = sum(machine.factors[i] @ machine.factors[j] * x[i] * x[j] for a, i in enumerate(used) for j in used[:a])
    assert machine.logit(x[None])[0] == pytest.approx(0.3 + x @ machine.linear + pairs)


def test_interactions_are_learned():
    """Labels that only the product of two features tells: a linear model stays at chance."""
    rng = np.random.default_rng(2)
    words = np.zeros((1200, Q.BUCKETS), np.float32)
    stats = rng.normal(size=(1200, len(Q.STATISTICS))).astype(np.float32)
    labels = (stats[:, 0] * stats[:, 1] > 0).astype(np.float32)
    machine = Q.fit(words[:900], stats[:900], labels[:900], epochs=60, rate=0.05)
    assert ((machine.score(words[900:], stats[900:]) > 0.5) == labels[900:]).mean() > 0.85


def test_held_out_accuracy(spark):
    table, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    out = Q.classify(table, labels).collect()
    assert len(out) == table.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in out)
    tested = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    good, bad = ([r["score"] for r in tested if truth[r["doc_id"]] == q] for q in (1, 0))
    auc = np.mean([[a > b for b in bad] for a in good])
    assert auc > 0.95 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in tested]) > 0.95
    assert {(r["doc_id"], r["score"]) for r in Q.classify(table.repartition(5), labels).collect()} == {(r["doc_id"], r["score"]) for r in out}


def test_source_language_and_key_do_not_matter(spark):
    from pyspark.sql import functions as F
    table, labels = spark.read.parquet(f"{SF}/documents.parquet").limit(40), spark.read.parquet(f"{SF}/labels.parquet")
    machine = Q.train(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    one = sorted((r["doc_id"], r["score"]) for r in Q.score_rows(table, machine).collect())
    two = sorted((-r["doc_id"], r["score"]) for r in Q.score_rows(table.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")).withColumn("doc_id", -F.col("doc_id")), machine).collect())
    assert one == two


def test_odd_rows(spark):
    data = odd_texts()
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 0), (7, 1, 0), (9, 0, 1), (9, 1, 1), (10, None, 0), (None, 1, 0), (99, 0, 0), (4, 5, 0)], LABELS)
    for table in (docs(spark, data), clashing(docs(spark, data))):
        out = Q.classify(table, labels).collect()
        assert len(out) == len(data) and all(0 <= r["score"] <= 1 for r in out)
        scores = {}
        for r in out:
            scores.setdefault(r["doc_id"], set()).add(r["score"])
        assert scores[3] == scores[4] == scores[5] and len(scores[2]) == 1
    for few in (spark.createDataFrame([], LABELS), spark.createDataFrame([(1, 1, 0)], LABELS)):
        assert len({r["score"] for r in Q.classify(docs(spark, data), few).collect()}) >= 1
    assert Q.classify(spark.createDataFrame([], DOCS), labels).collect() == []
    kept = Q.keep_good(clashing(docs(spark, data)), labels)
    assert kept.columns == clashing(docs(spark, data)).columns


def test_the_sample_is_bounded(spark):
    table, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    assert Q._training_rows(table, labels, "doc_id", "text", "quality", 50).count() == 50
    rows = Q._training_rows(table, labels, "doc_id", "text", "quality", 10_000).collect()
    assert rows and all(zlib.crc32(r["key"].encode()) % 5 for r in rows)


def test_a_sampled_key_stands_once_however_often_it_repeats(spark):
    rows = [(1, f"copy {i} of a text") for i in range(300)] + [(k, f"plain text number {k} with words") for k in range(2, 40)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(1, 40)], LABELS)
    want = None
    for parts in (1, 6):
        sample = Q._training_rows(docs(spark, rows).repartition(parts), labels, "doc_id", "text", "quality", 12).collect()
        assert len(sample) == 12 and len({r["key"] for r in sample}) == 12
        found = sorted(tuple(r) for r in sample)
        assert want in (None, found)
        want = found

"""What the band join shuffles and in which order its pairs come."""

import datetime as dt
import random
import re

import pytest

from cartwheel.operators import matching
from tests.helpers import EVENTS_SCHEMA, PAYMENTS_SCHEMA

BASE = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("minutes", [15, 60])
def test_a_payment_is_copied_to_the_buckets_of_its_window_alone(spark, minutes):
    """Five copies a payment and one row an event reach each of both joins (twelve copies before); no pair is lost."""
    rnd = random.Random(3)
    some = lambda: BASE + dt.timedelta(seconds=rnd.randint(0, 4 * 3600), microseconds=rnd.choice([0, 1, 999999]))
    evs = [(f"e{i}", some(), BASE, rnd.choice(["view", "purchase"]), 1 + i % 3, f"s{i % 2}", "1", "b", "1", "c", 1.0) for i in range(300)]
    pays = [(f"p{i}", BASE + dt.timedelta(minutes=30 * i) if i < 8 else some(), True, False, 1 + i % 3, f"s{i % 2}", 100, 0, BASE) for i in range(100)]
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        pairs = matching.match_candidates(spark.createDataFrame(pays, PAYMENTS_SCHEMA), spark.createDataFrame(evs, EVENTS_SCHEMA), minutes)
        query = pairs._jdf.queryExecution()
        n, plan = query.toRdd().count(), query.executedPlan()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

    def sent(node):
        own = node.metrics().apply("shuffleRecordsWritten").value() if node.nodeName() == "Exchange" else 0
        return own + sum(sent(node.children().apply(i)) for i in range(node.children().size()))
    window = dt.timedelta(minutes=minutes)
    assert n == sum((p[4] == e[4]) + (p[5] == e[5]) for p in pays for e in evs if p[1] - window <= e[1] <= p[1] + window)
    assert 0 < sent(plan) <= 2 * (5 * len(pays) + len(evs))
    # sorted by time first and an event's pairs together: what is written of a crowded slice stays in runs and dictionaries
    keys = re.findall(r"SortMergeJoin \[([^\]]*)\], \[([^\]]*)\]", plan.toString())
    assert len(keys) == 2 and all(side.startswith("_bucket") for pair in keys for side in pair)
    assert all(mine.startswith("_bucket") and "payment_" not in mine and "payment_" in probed for mine, probed in keys)

"""Bucketed band join == brute force, on random data with one hot user."""

import datetime as dt
import random

from cartwheel.operators import matching
from tests.helpers import EVENTS_SCHEMA, PAYMENTS_SCHEMA

BASE = dt.datetime(2024, 1, 1)


def _rand_time(rnd):
    return BASE + dt.timedelta(seconds=rnd.randint(0, 3 * 24 * 3600),
                               microseconds=rnd.choice([0, 500000, 999999]))


import pytest


@pytest.mark.parametrize("salts", [1, 4, 7])
def test_band_join_matches_brute_force(spark, salts):
    rnd = random.Random(11)
    users = [1] * 8 + [2, 3, 4]                       # user 1 is hot
    evs, pays = [], []
    for i in range(400):
        u = rnd.choice(users)
        t = _rand_time(rnd)
        s = rnd.choice([f"{u}-a", f"{u}-b", None])
        evs.append((f"e{i}", t, t, rnd.choice(["view", "purchase"]), u, s, "1", "b", "1", "c", 1.0))
    for i in range(60):
        u = rnd.choice(users + [None])
        t = _rand_time(rnd)
        # some payments exactly on a window edge of an event
        if i % 10 == 0:
            t = evs[i][1] + dt.timedelta(minutes=60)
        s = rnd.choice([f"{u}-a", f"{u}-b", None]) if u else None
        pays.append((f"p{i}", t, True, False, u, s, 100, 0, t))
    e_df = spark.createDataFrame(evs, EVENTS_SCHEMA)
    p_df = spark.createDataFrame(pays, PAYMENTS_SCHEMA)
    got = sorted((r.payment_intent_id, r.event_id, r.matched_type, r.match_score,
                  r.time_diff_seconds)
                 for r in matching.match_candidates(p_df, e_df, 60, salts=salts).collect())
    want = []
    w = dt.timedelta(minutes=60)
    for p in pays:
        for e in evs:
            if not (p[1] - w <= e[1] <= p[1] + w):
                continue
            diff = int(p[1].replace(microsecond=0).timestamp() - e[1].replace(microsecond=0).timestamp())
            if p[5] is not None and p[5] == e[5]:
                want.append((p[0], e[0], "user_session", 120 if e[3] == "purchase" else 100, diff))
            if p[4] is not None and p[4] == e[4]:
                want.append((p[0], e[0], "user_id", 70 if e[3] == "purchase" else 50, diff))
    assert got == sorted(want)
    assert len(want) > 50


MAPPED = ["payment_intent_id", "event_id", "event_user_id", "event_user_session", "event_type", "matched_type", "match_score", "payment_event_time",
          "clickstream_time", "time_diff_seconds", "last_received_ts", *matching.CARRIED]


@pytest.mark.parametrize("seed, minutes", [(1, 60), (2, 60), (3, 7), (4, 1), (5, 1440)])
def test_sweep_equals_the_best_of_all_candidates(spark, seed, minutes):
    """Same seconds, ties in time and receipt, clicks exactly on the window's edge and fractions beside it, null keys, a hot user."""
    rnd, evs, pays = random.Random(seed), [], []
    users, micros = [1] * 8 + [2, 3, None], [0, 1, 500000, 999999]

    def some_time(spread):
        return BASE + dt.timedelta(seconds=rnd.randint(0, spread), microseconds=rnd.choice(micros))
    spread = minutes * 60 * 6
    for i in range(150):
        u = rnd.choice(users)
        evs.append([f"e{i:03d}", some_time(spread), some_time(3), rnd.choice(["view", "purchase", None]), u, rnd.choice([f"{u}-a", f"{u}-b", None]),
                    rnd.choice(["1", None]), rnd.choice(["b", None]), "1", "c", 1.0])
    for i in range(80):
        u = rnd.choice(users)
        t = rnd.choice([some_time(spread), rnd.choice(evs)[1] + rnd.choice([-1, 0, 1]) * dt.timedelta(minutes=minutes)
                        + dt.timedelta(microseconds=rnd.choice([-500000, -1, 0, 1, 500000]))])
        pays.append((f"p{i}", None if i == 7 else t, True, False, u, rnd.choice([f"{u}-a", f"{u}-b", None]), 100, 0, t))
    for i in range(0, 150, 5):
        evs[i][1] = evs[(i + 1) % 150][1]          # two clicks at once
        evs[i][2] = evs[(i + 1) % 150][2]
    evs[149][1] = None
    e_df = spark.createDataFrame([tuple(e) for e in evs], EVENTS_SCHEMA)
    p_df = spark.createDataFrame(pays, PAYMENTS_SCHEMA)
    got = matching.nearest_click(p_df, e_df, minutes).select(*MAPPED).collect()
    want = matching.map_payment_to_event(matching.match_candidates(p_df, e_df, minutes)).select(*MAPPED).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(want) > 10


def test_a_hot_slice_of_the_sweep_is_bounded(spark):
    """10,000 clicks and 500 payments of one session in two minutes: a slice has a row a second and class."""
    rnd = random.Random(8)
    evs = [(f"e{i}", BASE + dt.timedelta(seconds=rnd.randint(0, 119), microseconds=rnd.choice([0, 7])), BASE, rnd.choice(["view", "purchase"]),
            1, "s", "1", "b", "1", "c", 1.0) for i in range(10_000)]
    pays = [(f"p{i}", BASE + dt.timedelta(seconds=rnd.randint(0, 119)), True, False, 1, "s", 100, 0, BASE) for i in range(500)]
    e_df, p_df = spark.createDataFrame(evs, EVENTS_SCHEMA), spark.createDataFrame(pays, PAYMENTS_SCHEMA)
    clicks = e_df.withColumnsRenamed({"event_pk": "event_id"}).selectExpr(
        "*", "user_id AS event_user_id", "user_session AS event_user_session", "event_time AS clickstream_time")
    assert matching._clicks_by_second(clicks, "user_session").count() <= 240
    got = matching.nearest_click(p_df, e_df).select("payment_intent_id", "event_id").collect()
    want = matching.map_payment_to_event(matching.match_candidates(p_df, e_df)).select("payment_intent_id", "event_id").collect()
    assert sorted(got) == sorted(want) and len(got) == 500


def test_repeated_and_missing_payment_ids_keep_their_best_match(spark):
    """Payments without an id share one row, as in the mapping over the candidates; no row is dropped or multiplied."""
    evs = [(f"e{i}", BASE + dt.timedelta(minutes=7 * i), BASE, "view", 1, "s", "1", "b", "1", "c", 1.0) for i in range(30)]
    pays = [(i, BASE + dt.timedelta(minutes=m), True, False, 1, "s", 100, 0, BASE) for i, m in ((None, 3), (None, 50), ("p", 15), ("p", 101), ("q", 8))]
    e_df, p_df = spark.createDataFrame(evs, EVENTS_SCHEMA), spark.createDataFrame(pays, PAYMENTS_SCHEMA)
    got = matching.nearest_click(p_df, e_df).select(*MAPPED).collect()
    want = matching.map_payment_to_event(matching.match_candidates(p_df, e_df)).select(*MAPPED).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(want) == 3
